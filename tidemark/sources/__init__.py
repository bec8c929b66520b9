from tidemark.sources.features import bounded_events, feature_files, flat_features  # noqa: F401
from tidemark.sources.files import batches, dated, json_pages, parquet_glob, parquet_tree  # noqa: F401
from tidemark.sources.inline import arrow_rows, inline_rows, seeded_pick, seeded_purchases  # noqa: F401
