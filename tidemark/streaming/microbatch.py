"""Continuous loading of landed files: each run begins where the last one ended."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans import folders
from tidemark.plans.loading import Pipeline
from tidemark.plans.resources import Resource


def landed_files(
    spark: SparkSession, folder: str, schema, file_format: str = "json", files_per_batch: int | None = None, **options
) -> DataFrame:
    """A stream of the files that appear in a folder; the schema is declared."""
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def load_stream(
    stream: DataFrame,
    pipeline: Pipeline,
    resource: Resource,
    checkpoint: str,
    parse: Callable[[DataFrame], DataFrame] = lambda df: df,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Load every micro-batch as the given resource.

    The checkpoint remembers which files are done, so there are no gaps. A batch that is
    run again after a failure has the same load id: a finished one is skipped, an
    unfinished one is repeated. Batch numbers begin anew with a new checkpoint, so the
    checkpoint's own id is part of the load id. Late and revised rows are absorbed by a merge.
    """

    def load(batch: DataFrame, number: int) -> None:
        stream_id = json.loads(folders.read_text(pipeline.spark, f"{checkpoint}/metadata"))["id"]
        rows = parse(batch)
        pipeline.run(resource.with_rows(rows), load_id=f"{resource.name}-{stream_id}-{number:012d}")

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
