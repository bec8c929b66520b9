"""What can be loaded: resources, sources and transformations. All of them are lazy."""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources.files import json_pages
from tidemark.windows import Incremental

DISPOSITIONS = ("replace", "append", "merge")


@dataclass(frozen=True)
class Resource:
    """A named table to be loaded.

    build            spark -> DataFrame (paged resources also take `page_limit`)
    columns          per column: free annotations, and `type` for a cast
    newest           column that decides between rows of the same key in one batch
    unique_batch     a batch holds one row per key by construction, so that step is left out
    partition_by     stored layout: one folder per value, so a merge rewrites only touched ones;
                     or (time column, unit) for one folder per period
    buckets          stored layout by hash of the key, for keys without a natural partition
    stable_layout    a key never moves to another folder, so a merge need not look for it elsewhere
    contract         evolve / add / freeze, see operators.normalize.reconciled
    infer_times      text columns that hold ISO instants only are stored as timestamps
    null_keys        a merge may have rows whose key is NULL in part; they are matched NULL with NULL
    row_ids          None: row keys only where a key or nesting asks for them
    """

    name: str
    build: Callable[..., DataFrame]
    write_disposition: str = "append"
    primary_key: Sequence[str] = ()
    columns: Mapping[str, Mapping] = field(default_factory=dict)
    table_name: str | None = None
    incremental: Incremental | None = None
    newest: str | None = None
    unique_batch: bool = False
    partition_by: str | tuple[str, str] | None = None
    buckets: int | None = None
    stable_layout: bool = False
    contract: str = "evolve"
    metrics: tuple = ()
    source: str | None = None
    infer_times: bool = False
    null_keys: bool = False
    row_ids: bool | None = None
    page_limit: int | None = None
    paged: bool = False

    def __post_init__(self):
        key = (self.primary_key,) if isinstance(self.primary_key, str) else tuple(self.primary_key)
        object.__setattr__(self, "primary_key", key)
        if self.write_disposition not in DISPOSITIONS:
            raise ValueError(f"write_disposition: {self.write_disposition}")
        if self.write_disposition == "merge" and not key:
            raise ValueError(f"{self.name}: merge needs a primary key")
        if self.partition_by and self.buckets:
            raise ValueError(f"{self.name}: partition_by and buckets exclude each other")

    @property
    def table(self) -> str:
        return self.table_name or self.name

    def with_name(self, name: str) -> "Resource":
        return replace(self, name=name)

    def with_table(self, table_name: str) -> "Resource":
        return replace(self, table_name=table_name)

    def with_rows(self, df: DataFrame) -> "Resource":
        return replace(self, build=lambda spark: df, page_limit=None, paged=False)

    def with_hints(self, **hints) -> "Resource":
        return replace(self, **hints)

    def with_metrics(self, *metrics) -> "Resource":
        return replace(self, metrics=self.metrics + metrics)

    def rows(self, spark: SparkSession) -> DataFrame:
        if self.page_limit is not None and self.paged:
            df = self.build(spark, page_limit=self.page_limit)
        else:
            df = self.build(spark)
        for column, hint in self.columns.items():
            if "type" in hint:
                df = df.withColumn(column, F.col(column).cast(hint["type"]))
            notes = {k: v for k, v in hint.items() if k != "type"}
            if notes:
                df = df.withMetadata(column, notes)
        return df


def paged_resource(name: str, folder: str, schema=None, **hints) -> Resource:
    """A collection landed as page files; `glob` and `multi_line` go to the scan."""
    scan = {k: hints.pop(k) for k in ("glob", "multi_line", "page_pattern") if k in hints}

    def build(spark: SparkSession, page_limit: int | None = None) -> DataFrame:
        return json_pages(spark, folder, schema, page_limit=page_limit, **scan)

    hints.setdefault("write_disposition", "replace")
    return Resource(name, build, paged=True, **hints)


@dataclass(frozen=True)
class Source:
    """A named, ordered group of resources that share one schema."""

    name: str
    resources: Mapping[str, Resource]

    @classmethod
    def of(cls, name: str, resources: Sequence[Resource]) -> "Source":
        return cls(name, {r.name: replace(r, source=name) for r in resources})

    def __getattr__(self, name: str) -> Resource:
        resources = object.__getattribute__(self, "resources")
        if name in resources:
            return resources[name]
        raise AttributeError(name)

    def with_resources(self, *names: str) -> "Source":
        unknown = [n for n in names if n not in self.resources]
        if unknown:
            raise KeyError(f"{self.name} has no resource {', '.join(unknown)}")
        return Source(self.name, {n: r for n, r in self.resources.items() if n in names})

    def add_limit(self, pages: int) -> "Source":
        """Read only pages 1..n of every paged resource; the others are read whole.

        A source without paged resources has nothing to limit: that is an error.
        """
        if not any(r.paged for r in self.resources.values()):
            raise ValueError(f"{self.name}: no resource is landed in pages")
        return Source(self.name, {n: replace(r, page_limit=pages) for n, r in self.resources.items()})


def source(fn: Callable) -> Callable[..., Source]:
    """Decorator: a function that returns resources becomes a source of that name."""

    @functools.wraps(fn)
    def build(*args, **kwargs) -> Source:
        return Source.of(fn.__name__, list(fn(*args, **kwargs)))

    return build


def transformation(fn: Callable | None = None, *, table_name: str | None = None, **hints):
    """Decorator: a function of a dataset (and parameters) becomes a loadable resource.

    It returns a DataFrame or the text of a query over the dataset. The result is
    replaced on every run unless hinted otherwise; a changed column type is an error.
    """
    hints.setdefault("write_disposition", "replace")
    hints.setdefault("contract", "add")

    def decorate(function: Callable):
        @functools.wraps(function)
        def bind(dataset, *args, **kwargs) -> Resource:
            def build(spark: SparkSession) -> DataFrame:
                result = function(dataset, *args, **kwargs)
                return dataset(result) if isinstance(result, str) else result

            return Resource(table_name or function.__name__, build, **hints)

        return bind

    return decorate(fn) if fn is not None else decorate
