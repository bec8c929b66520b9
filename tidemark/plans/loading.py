"""`Pipeline.run`: from lazy resources to published tables."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from decimal import Decimal
from functools import reduce

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkAssertionError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.operators.merge import keys_repeat, latest_per_key, without_keys
from tidemark.operators.normalize import (
    LOAD_ID,
    PARENT_ID,
    ROOT_ID,
    ROW_ID,
    flatten,
    has_nesting,
    keep_type,
    nested_lists,
    reconciled,
    tables_of_lists,
    timestamps_from_text,
    widened,
    with_row_keys,
)
from tidemark.plans import folders
from tidemark.plans.dataset import Dataset, StoredTable, file_name
from tidemark.plans.resources import Resource, Source
from tidemark.session import fresh_folder
from tidemark.windows import Incremental, as_utc

REFRESH_MODES = ("drop_sources", "drop_resources")


def observed(observation: Observation) -> dict:
    """What an observation has seen; nothing when no plan that ran contained it."""
    try:
        return observation.get
    except (PySparkAssertionError, Py4JJavaError):
        return {}


def _storable(df: DataFrame) -> bool:
    """Whether Parquet can hold the rows as they are: it has no untyped NULLs."""

    def typed(kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return all(typed(f.dataType) for f in kind.fields)
        if isinstance(kind, T.MapType):
            return typed(kind.keyType) and typed(kind.valueType)
        return typed(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, T.NullType)

    return typed(df.schema)


class NullKey(ValueError):
    """Rows of a merge without a key; `null_keys` of the resource allows them."""


class NullCursor(ValueError):
    """Rows without a cursor value, and the resource does not say what to do with them."""


@dataclass
class LoadInfo:
    load_id: str
    pipeline: str
    tables: list[dict] = field(default_factory=list)
    skipped: bool = False

    @property
    def row_counts(self) -> dict[str, int]:
        return {t["table_name"]: t["rows"] for t in self.tables}

    def __str__(self) -> str:
        lines = [f"load {self.load_id} of {self.pipeline}" + (" (already done)" if self.skipped else "")]
        return "\n".join(lines + [f"  {t['table_name']}: {t['rows']} rows, {t['disposition']}" for t in self.tables])


@dataclass
class _Pending:
    table: StoredTable
    entries: list[dict]
    summary: dict


class Pipeline:
    """Loads resources into a dataset under `warehouse`, and keeps loads and cursor state there."""

    def __init__(self, spark: SparkSession, name: str, warehouse: str, dataset: str | None = None):
        self.spark, self.name = spark, name
        self.root = f"{warehouse.rstrip('/')}/{dataset or name}"
        self.last_load: LoadInfo | None = None

    def dataset(self) -> Dataset:
        return Dataset(self.spark, self.root)

    # ---- state ----

    @property
    def _state_file(self) -> str:
        return f"{self.root}/_state/{self.name}.json"

    @property
    def state(self) -> list[dict]:
        """Rows of source, resource, cursor_path and start_value."""
        text = folders.read_text(self.spark, self._state_file)
        return json.loads(text) if text else []

    def _save_state(self, rows: list[dict]) -> None:
        folders.write_text(self.spark, self._state_file, json.dumps(rows))

    def restore_incremental(self, resource: Resource, incremental: Incremental) -> Incremental | None:
        """The cursor with its last saved value, or None when it never ran."""
        if resource.source is None:
            raise ValueError(f"resource {resource.name} does not belong to a source")
        for row in self.state:
            if (row["source"], row["resource"], row["cursor_path"]) == (
                resource.source,
                resource.name,
                incremental.cursor,
            ):
                return incremental.restored(_value(row))
        return None

    # ---- running ----

    def run(
        self,
        what,
        table_name: str | None = None,
        write_disposition: str | None = None,
        refresh: str | None = None,
        load_id: str | None = None,
        file_format: str = "parquet",
    ) -> LoadInfo:
        """Load a source, resource, frame, Arrow table or a list of them.

        Nothing is published or dropped before every table of the run is written; what a
        failed run has written is deleted. A `load_id` of this pipeline that has finished
        before is not run again; with other resources it is an error.
        """
        if refresh is not None and refresh not in REFRESH_MODES:
            raise ValueError(f"refresh: {refresh}")
        load_id = load_id or f"{time.time():.6f}"
        log = f"{self.root}/_loads/{self._load_key(load_id)}.json"
        done = folders.read_text(self.spark, log)
        resources = self._resources(what, table_name, write_disposition)
        if done is not None:
            rows = [json.loads(line) for line in done.splitlines()]
            loaded, asked = {r["table_name"] for r in rows}, {r.table for r in resources}
            if not asked <= loaded or {r["resource"] for r in rows} != {r.name for r in resources}:
                raise ValueError(f"load id {load_id!r} was used for {', '.join(sorted(loaded))}, not for {', '.join(sorted(asked))}")
            self.last_load = LoadInfo(load_id, self.name, rows, skipped=True)
            return self.last_load
        gone, state = self._refreshed(resources, refresh) if refresh else ({}, self.state)
        started = datetime.now(timezone.utc)
        pending: list[_Pending] = []
        cursors: list[dict] = []
        self._opened, self._staged, self._gone = [], [], set(gone)
        try:
            for resource in resources:
                self._load(resource, load_id, file_format, pending, cursors)
        except BaseException:
            for table in self._opened:
                table.discard_written()
            raise
        finally:
            for folder in self._staged:
                folders.remove(self.spark, folder)
        for item in pending:
            item.table.swap(item.entries)
        for name in set(gone) - {item.table.name for item in pending}:
            gone[name].drop()
        self._remember(cursors, state)
        finished = datetime.now(timezone.utc)
        rows = [
            {
                "load_id": load_id,
                "pipeline": self.name,
                **item.summary,
                "status": "completed",
                "started_at": started.isoformat(),
                "finished_at": finished.isoformat(),
            }
            for item in pending
        ]
        folders.write_text(self.spark, log, "\n".join(json.dumps(r) for r in rows))
        self.last_load = LoadInfo(load_id, self.name, rows)
        return self.last_load

    def _resources(self, what, table_name: str | None, disposition: str | None) -> list[Resource]:
        if isinstance(what, Source):
            found = list(what.resources.values())
        elif isinstance(what, (list, tuple)):
            found = [r for item in what for r in self._resources(item, None, None)]
        elif isinstance(what, Resource):
            found = [what]
        elif isinstance(what, (DataFrame, pa.Table)):
            df = self.spark.createDataFrame(what) if isinstance(what, pa.Table) else what
            if table_name is None:
                table_name = "rows"
            found = [Resource(table_name, lambda spark: df)]
        else:
            raise TypeError(f"cannot load {type(what).__name__}")
        if table_name is not None:
            if len(found) > 1:
                raise ValueError("table_name needs a single resource")
            found = [found[0].with_table(table_name)]
        if disposition is not None:
            found = [r.with_hints(write_disposition=disposition) for r in found]
        return found

    def _load_key(self, load_id: str) -> str:
        """A file name that no other load id and no other pipeline has."""
        digest = hashlib.sha256(f"{self.name}\0{load_id}".encode()).hexdigest()[:16]
        return f"{file_name(self.name)}-{file_name(load_id)[:60]}-{digest}"

    def _refreshed(self, resources: Sequence[Resource], mode: str) -> tuple[dict[str, StoredTable], list[dict]]:
        """Tables that a refresh drops when the run is published, and the state that is left."""
        names = {r.table for r in resources}
        origin = {r.source for r in resources if r.source}
        dataset = self.dataset()
        gone = {}
        for name in dataset.tables:
            stored = dataset.stored(name)
            own = name in names or any(name.startswith(f"{n}__") and stored.info.get("parent") for n in names)
            if own or (mode == "drop_sources" and stored.info.get("source") in origin):
                gone[name] = stored
        again = {r.name for r in resources}
        left = [r for r in self.state if r["source"] not in origin or (mode != "drop_sources" and r["resource"] not in again)]
        return gone, left

    def _load(
        self, resource: Resource, load_id: str, file_format: str, pending: list[_Pending], cursors: list[dict]
    ) -> None:
        cursor = resource.incremental
        appends = resource.write_disposition == "append"
        if cursor is not None and cursor.both_closed and appends and not cursor.resumed:
            raise ValueError(f"{resource.name}: append over closed windows would repeat the shared instants; use merge")
        df = resource.rows(self.spark)
        merge = resource.write_disposition == "merge"
        key = list(resource.primary_key)
        seen = []
        if cursor is not None:
            df = cursor.rows(df)
            seen += [F.count_if(F.col(cursor.cursor).isNull()).alias("missing"), F.max(cursor.cursor).alias("top")]
        stage = merge and not resource.unique_batch and _storable(df)
        if merge and not resource.null_keys:
            unnamed = reduce(Column.__or__, [F.col(k).isNull() for k in key])
            if stage:
                seen.append(F.count_if(unnamed).alias("unnamed"))
            elif not df.where(unnamed).isEmpty():
                # Reads the key alone; files with statistics are not even opened.
                raise NullKey(f"{resource.name}: rows lack a part of the key {', '.join(key)}")
        unobserved, high = df, Observation() if seen else None
        if high is not None:
            df = df.observe(high, *seen)
        if appends and cursor is not None and cursor.resumed and cursor.start is not None and (cursor.range_start == "closed" or cursor.lag):
            df = self._unseen(df, resource)
        if stage:
            # The source is read once: keys, winners and rows all come from the stored batch.
            df = self._kept(df, f"batch-{resource.table}")
            counted = observed(high) if seen else {}
            if "unnamed" not in counted and not resource.null_keys:
                counted = df.agg(F.count_if(unnamed).alias("unnamed")).first().asDict()
            if counted.get("unnamed"):
                raise NullKey(f"{resource.name}: rows lack a part of the key {', '.join(key)}")
        if merge and not resource.unique_batch and (not stage or keys_repeat(df, key)):
            df = latest_per_key(df, key, resource.newest, resource.null_keys)
        nested = has_nesting(df)
        lists = nested_lists(flatten(df)) if nested else []
        wants_keys = resource.row_ids if resource.row_ids is not None else bool(lists or key)
        df = df if nested else widened(df)
        if wants_keys:
            df = with_row_keys(df, key, load_id)
        if lists:
            # Parsed once: the parent and every child table read the stored copy.
            df = self._kept(df, f"nested-{resource.table}")
        tables = tables_of_lists(df, resource.table) if nested else {resource.table: (df, None)}
        if resource.infer_times:
            tables = {name: (self._timed(name, rows), column) for name, (rows, column) in tables.items()}
        parents = tables[resource.table][0]
        for name, (rows, column) in tables.items():
            is_child = name != resource.table
            pending.append(self._write(resource, name, rows, parents if is_child else None, column, load_id, file_format))
        if cursor is not None:
            # Spark drops the observed step from the plan of an empty batch: then it is counted apart.
            seen = observed(high) or unobserved.agg(*seen).first().asDict()
            if seen.get("missing") and cursor.on_null == "raise":
                raise NullCursor(f"{resource.name}: {seen['missing']} rows have no {cursor.cursor}")
            if seen.get("top") is not None:
                cursors.append(
                    {
                        "source": resource.source or self.name,
                        "resource": resource.name,
                        "cursor_path": cursor.cursor,
                        "start_value": _plain(seen["top"]),
                        **({"value_type": "decimal"} if isinstance(seen["top"], Decimal) else {}),
                    }
                )

    def _kept(self, df: DataFrame, label: str) -> DataFrame:
        """The rows from a copy in the shared folder, which goes when the run ends."""
        staged = fresh_folder(self.spark, label)
        self._staged.append(staged)
        df.write.parquet(staged)
        return self.spark.read.schema(df.schema).parquet(staged)

    def _unseen(self, df: DataFrame, resource: Resource) -> DataFrame:
        """Rows of a resumed append that are not stored yet: as many copies less as the table has.

        Only stored rows at or above the start are compared, by key or else as whole rows.
        """
        stored = StoredTable(self.spark, self.root, resource.table, resource.table in self._gone)
        cursor, key = resource.incremental, list(resource.primary_key)
        if not stored.exists or cursor.cursor not in stored.schema.fieldNames():
            return df
        near = stored.read().where(F.col(cursor.cursor) >= cursor.low(stored.schema[cursor.cursor].dataType))
        if key:
            return without_keys(df, near, key)
        if has_nesting(df):
            if nested_lists(flatten(df)):
                raise ValueError(f"{resource.name}: appending nested rows from a closed start needs a primary key, or range_start='open'")
            df = flatten(df)
        ready = reconciled(df, stored.schema, resource.contract, resource.table)
        hidden = (ROW_ID, LOAD_ID)
        names = [c for c in ready.columns if c not in hidden]
        types = {f.name: f.dataType for f in ready.schema.fields}
        have = set(near.columns)
        same = near.select(*[F.col(f"`{c}`") if c in have else F.lit(None).cast(types[c]).alias(c) for c in names])
        return ready.select(*[f"`{c}`" for c in names]).exceptAll(same)

    def _timed(self, name: str, rows: DataFrame) -> DataFrame:
        """Text columns of a table that is not stored yet become timestamps where all values are; later
        loads follow the stored type."""
        stored = StoredTable(self.spark, self.root, name, name in self._gone).schema
        known = set(stored.fieldNames()) if stored is not None else set()
        texts = [f for f, kind in rows.dtypes if kind == "string" and f not in (ROW_ID, PARENT_ID, ROOT_ID)]
        return timestamps_from_text(rows, [c for c in texts if c not in known])

    def _write(
        self,
        resource: Resource,
        name: str,
        rows: DataFrame,
        parents: DataFrame | None,
        column: str | None,
        load_id: str,
        file_format: str,
    ) -> _Pending:
        stored = StoredTable(self.spark, self.root, name, name in self._gone)
        self._opened.append(stored)
        is_child = parents is not None
        key = [ROW_ID] if is_child else list(resource.primary_key)
        by = None if is_child else resource.partition_by
        keep_type(rows, stored.schema, [*key, *([by[0] if isinstance(by, tuple) else by] if by else [])], name)
        ready = reconciled(rows.withColumn(LOAD_ID, F.lit(load_id)), stored.schema, resource.contract, name)
        info = {"key": key, "source": resource.source, "resource": resource.name, "dropped": False}
        if is_child:
            info["parent"] = resource.table if "__" not in name[len(resource.table) + 2 :] else name.rsplit("__", 1)[0]
        else:
            info["metrics"] = [m.as_row() for m in resource.metrics] or stored.info.get("metrics", [])
        if not stored.exists:
            info["format"] = file_format
            info["partition_by"], info["period"] = by if isinstance(by, tuple) else (by, None)
            info["buckets"] = None if is_child else resource.buckets
            info["stable_layout"] = resource.stable_layout
            info["list"] = column
        stored.describe(ready, **info)
        if is_child and stored.info.get("list") == column:
            ready = ready.withColumn(ROW_ID, F.lit(None).cast("string"))
        counted = Observation()
        disposition = resource.write_disposition
        load_key = self._load_key(load_id)
        if disposition == "replace":
            entries = stored.replace(ready, load_key, counted)
        elif disposition == "append":
            entries = stored.append(ready, load_key, counted)
        elif is_child:
            link = ROOT_ID if ROOT_ID in rows.columns else PARENT_ID
            entries = stored.merge_children(ready, load_key, parents.select(ROW_ID), link, counted)
        else:
            entries = stored.merge(ready, load_key, key, counted)
        shape = json.dumps(stored.info["schema"], sort_keys=True)
        return _Pending(
            stored,
            entries,
            {
                "source": resource.source,
                "resource": resource.name,
                "table_name": name,
                "disposition": disposition,
                "rows": int(observed(counted).get("rows", 0)),
                "schema_hash": hashlib.sha256(shape.encode()).hexdigest()[:16],
            },
        )

    def _remember(self, cursors: list[dict], state: list[dict]) -> None:
        if not cursors and state == self.state:
            return
        rows = {(r["source"], r["resource"], r["cursor_path"]): r for r in state}
        for row in cursors:
            spot = (row["source"], row["resource"], row["cursor_path"])
            old = rows.get(spot)
            if old is None or _value(row) > _value(old):
                rows[spot] = row
        self._save_state(list(rows.values()))


def _plain(value):
    if isinstance(value, datetime):
        return as_utc(value).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return str(value) if isinstance(value, Decimal) else value


def _value(row: dict):
    """The saved cursor value of a row of the state, in its own type."""
    return Decimal(row["start_value"]) if row.get("value_type") == "decimal" else row["start_value"]
