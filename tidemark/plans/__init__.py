from tidemark.plans.dataset import Dataset  # noqa: F401
from tidemark.plans.loading import LoadInfo, NullCursor, Pipeline  # noqa: F401
from tidemark.plans.resources import Resource, Source, paged_resource, source, transformation  # noqa: F401
