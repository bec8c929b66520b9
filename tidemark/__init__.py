"""Data loading, transformation, quality and reporting on Spark."""

from tidemark.plans import (  # noqa: F401
    Dataset,
    LoadInfo,
    Pipeline,
    Resource,
    Source,
    paged_resource,
    source,
    transformation,
)
from tidemark.session import apply_settings, build_session  # noqa: F401
from tidemark.windows import Incremental, TimeWindow  # noqa: F401
