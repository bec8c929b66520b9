"""Stored tables: a folder per load and a small file that says which of them are current.

Spark cannot overwrite files it is reading, and a reader must never see half a load.
So a load writes a new folder and then swaps the table's `current.json`. One writer
per table is assumed. Files of a child table leave a `_row_id` empty that is the hash of the
parent's key and the place: it takes more room than the rest of a small row, and `read` makes
it again.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from datetime import date, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.operators.merge import same_key, without_keys
from tidemark.operators.normalize import LOAD_ID, PARENT_ID, ROW_ID, child_key
from tidemark.plans import folders
from tidemark.windows import TimeWindow

# Hidden layout columns: a hash bucket, a period of a time column, a copy of a text column
# (a folder name cannot tell an empty text from NULL, so the column itself stays in the files).
BUCKET, PERIOD, PART = "_bucket", "_period", "_part"
HIDDEN = {BUCKET: T.IntegerType(), PERIOD: T.DateType(), PART: T.StringType()}
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

# A merge broadcasts the keys of its batch only below both of these, and joins by shuffle above.
SMALL_BATCH_ROWS = 200_000
SMALL_BATCH_BYTES = 64 * 1024 * 1024

# Text formats must keep the microseconds, which they do not by default.
TEXT_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def format_options(file_format: str) -> dict[str, str]:
    if file_format == "csv":
        return {"header": "true", "escape": '"', "multiLine": "true", **TEXT_OPTIONS}
    return dict(TEXT_OPTIONS) if file_format == "json" else {}

LOADS_SCHEMA = (
    "load_id string, pipeline string, source string, resource string, table_name string, disposition string,"
    " rows bigint, schema_hash string, status string, started_at timestamp, finished_at timestamp"
)


def file_name(load_id: str) -> str:
    """A load id with the characters that paths do not allow replaced."""
    return re.sub(r"[^A-Za-z0-9._-]", "_", load_id)


def period_start(unit: str, day: date) -> date:
    """The first day of the period that a day lies in, as `date_trunc` has it."""
    unit = unit.lower()
    if unit == "week":
        return day - timedelta(days=day.weekday())
    if unit in ("month", "mon", "mm"):
        return day.replace(day=1)
    if unit == "quarter":
        return day.replace(month=day.month - (day.month - 1) % 3, day=1)
    if unit in ("year", "yyyy", "yy"):
        return day.replace(month=1, day=1)
    return day


class StoredTable:
    def __init__(self, spark: SparkSession, root: str, name: str, fresh: bool = False):
        self.spark, self.name = spark, name
        self.folder = f"{root}/{name}"
        self.written: list[str] = []
        self._read_pointer()
        if fresh:
            # As if it had been dropped; the pointer on disk stays until the next swap.
            self.info = {}

    def _read_pointer(self) -> None:
        text = folders.read_text(self.spark, f"{self.folder}/current.json")
        self.info: dict = json.loads(text) if text else {}

    @property
    def exists(self) -> bool:
        return bool(self.info) and not self.info.get("dropped")

    @property
    def schema(self) -> T.StructType | None:
        return T.StructType.fromJson(self.info["schema"]) if self.exists else None

    @property
    def layout(self) -> str | None:
        """The column that names the folders: a hidden one, or a stored column that is not text."""
        column = self.info.get("partition_by")
        if self.info.get("buckets"):
            return BUCKET
        if self.info.get("period"):
            return PERIOD
        if column and T.StructType.fromJson(self.info["schema"])[column].dataType == T.StringType():
            return PART
        return column

    @property
    def layout_follows_key(self) -> bool:
        """Rows of one key are always in one folder."""
        if self.layout in (None, BUCKET) or self.info.get("stable_layout"):
            return True
        return self.info["partition_by"] in self.info["key"]

    def read(self, entries: Sequence[dict] | None = None, with_layout: bool = False, as_stored: bool = False) -> DataFrame:
        """Rows of the current or the given entries; `as_stored` leaves the keys of child rows as empty as files have them."""
        schema, made = self.schema, {}
        entries = self.info["entries"] if entries is None else entries
        stored = schema
        if self.layout in HIDDEN:
            stored = T.StructType([*schema.fields, T.StructField(self.layout, HIDDEN[self.layout])])
        if self.info.get("list") and not as_stored:
            made[ROW_ID] = F.coalesce(ROW_ID, F.when(F.col(PARENT_ID).isNotNull(), child_key(self.info["list"])))
        if not entries:
            df = self.spark.createDataFrame([], stored)
        else:
            paths = [f"{self.folder}/{e['dir']}" for e in entries]
            reader = self.spark.read.format(self.info["format"]).schema(stored).option("basePath", self.folder)
            df = reader.options(**format_options(self.info["format"])).load(paths)
        keep = stored.fieldNames() if with_layout else schema.fieldNames()
        notes = {f.name: f.metadata for f in schema.fields}
        return df.select(*[made.get(n, F.col(f"`{n}`")).alias(n, metadata=notes.get(n) or {}) for n in keep])

    # ---- writing ----

    def describe(self, df: DataFrame, **info) -> None:
        """Take over schema and hints; they are published with the next swap."""
        if not self.exists:
            self.info = {"entries": [], "format": "parquet"}
        self.info["schema"] = df.schema.jsonValue()
        for field in self.info["schema"]["fields"]:
            field["nullable"] = True
        self.info.update(info)

    def write_files(
        self, df: DataFrame, load_id: str, counted: Observation | None = None, gather: bool = True
    ) -> list[dict]:
        """Write a new folder and return its entries, one per layout value.

        `gather` brings the rows of a folder together, in pieces of a sensible file size.
        Rows are counted in the last stage, where a task that is run again counts once.
        """
        folder = f"_version={file_name(load_id)}-{uuid.uuid4().hex[:8]}"
        self.written.append(folder)
        layout = self.layout
        if layout == BUCKET:
            key = [F.col(c) for c in self.info["key"]]
            df = df.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(self.info["buckets"])).cast("int"))
        elif layout == PERIOD:
            df = df.withColumn(PERIOD, F.date_trunc(self.info["period"], self.info["partition_by"]).cast("date"))
        elif layout == PART:
            df = df.withColumn(PART, F.col(self.info["partition_by"]))
        if layout and gather:
            df = df.hint("rebalance", F.col(layout))
        if counted is not None:
            df = df.observe(counted, F.count(F.lit(1)).alias("rows"))
        writer = df.write.format(self.info["format"])
        writer = writer.options(**format_options(self.info["format"]))
        if layout:
            writer = writer.partitionBy(layout)
        writer.save(f"{self.folder}/{folder}")
        if not layout:
            return [{"load": load_id, "dir": folder, "part": None}]
        parts = [n for n in folders.names(self.spark, f"{self.folder}/{folder}") if n.startswith(f"{layout}=")]
        return [{"load": load_id, "dir": f"{folder}/{p}", "part": p} for p in parts]

    def swap(self, entries: list[dict], **info) -> None:
        self.info.update(info, entries=entries)
        folders.write_text(self.spark, f"{self.folder}/current.json", json.dumps(self.info))

    def replace(self, df: DataFrame, load_id: str, counted: Observation | None = None) -> list[dict]:
        return self.write_files(df, load_id, counted)

    def append(self, df: DataFrame, load_id: str, counted: Observation | None = None) -> list[dict]:
        """A retry of the same load takes the place of its first attempt.

        A load that has been compacted with others cannot be taken out again: it stays, and
        the retry adds nothing.
        """
        if any(load_id in e.get("loads", ()) for e in self.info["entries"]):
            return self.info["entries"]
        kept = [e for e in self.info["entries"] if e["load"] != load_id]
        return kept + self.write_files(df, load_id, counted)

    def merge(
        self, df: DataFrame, load_id: str, key: Sequence[str], counted: Observation | None = None
    ) -> list[dict]:
        """Update or insert. The batch is written once; of the layout folders it touches, the rows it
        does not replace are written again next to it. Other folders stay as they are."""
        staged = self.write_files(df, load_id, counted)
        current = self.info["entries"]
        if not current:
            return staged
        keys = self.read(staged).select(*key)
        small = counted is not None and self._is_small(staged, self.read(staged).count())
        if small:
            keys = F.broadcast(keys)
        touched = self._touched(keys, staged, current, key)
        old = [e for e in current if e["part"] in touched]
        untouched = [e for e in current if e["part"] not in touched]
        if not old:
            return untouched + staged
        kept = without_keys(self.read(old), keys, key)
        # Beside a broadcast batch the kept rows stay in scan order, folder by folder.
        return untouched + staged + self.write_files(kept, load_id, gather=not small)

    def _is_small(self, entries: Sequence[dict], rows: int) -> bool:
        if rows > SMALL_BATCH_ROWS:
            return False
        return sum(folders.size(self.spark, f"{self.folder}/{e['dir']}") for e in entries) <= SMALL_BATCH_BYTES

    def _touched(self, keys: DataFrame, staged: list[dict], current: list[dict], key: Sequence[str]) -> set:
        parts = {e["part"] for e in staged}
        if self.layout_follows_key:
            return parts
        # An older row of a batch key may lie in another folder. Only key and layout are read to find it.
        layout = self.layout
        stored = self.read(current, with_layout=True).select(*key, layout)
        probe = keys.select(*[F.col(k).alias(f"_k_{k}") for k in key])
        found = stored.join(probe, same_key(stored, probe, key, "_k_"), "left_semi")
        values = {r[0] or NULL_FOLDER for r in found.select(F.col(layout).cast("string")).distinct().collect()}
        return parts | {e["part"] for e in current if unquote(e["part"].split("=", 1)[1]) in values}

    def merge_children(
        self, df: DataFrame, load_id: str, parent_ids: DataFrame, link: str, counted: Observation | None = None
    ) -> list[dict]:
        """Child rows of the parents in the batch are replaced as a whole."""
        current = self.info["entries"]
        staged = self.write_files(df, load_id, counted)
        if not current:
            return staged
        kept = without_keys(self.read(current, as_stored=True), parent_ids, [link], [parent_ids.columns[0]])
        return self.write_files(kept, load_id) + staged

    def discard_written(self) -> None:
        """Delete the folders of a load that was not published."""
        for folder in self.written:
            folders.remove(self.spark, f"{self.folder}/{folder}")
        self.written = []

    def drop(self) -> None:
        if self.info:
            self.swap([], dropped=True)
            self.info = {"dropped": True}

    def vacuum(self) -> list[str]:
        """Delete load folders that no current entry uses. Only for times without readers of older versions."""
        used = {e["dir"].split("/")[0] for e in self.info.get("entries", [])}
        stale = [n for n in folders.names(self.spark, self.folder) if n.startswith("_version=") and n not in used]
        for name in stale:
            folders.remove(self.spark, f"{self.folder}/{name}")
        return stale


class Dataset:
    """Tables under one folder: `ds.tables`, `ds.table("orders")`, `ds.orders`, `ds("SELECT ...")`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @property
    def tables(self) -> list[str]:
        return [n for n in folders.names(self.spark, self.root) if not n.startswith("_") and self.stored(n).exists]

    def stored(self, name: str) -> StoredTable:
        return StoredTable(self.spark, self.root, name)

    def table(self, name: str) -> DataFrame:
        stored = self.stored(name)
        if not stored.exists:
            raise KeyError(f"no table {name} in {self.root}")
        return stored.read()

    def table_between(self, name: str, column: str, window: TimeWindow) -> DataFrame:
        """Rows of a window; where the table is laid out by that column, other periods are not even listed."""
        stored = self.stored(name)
        if not stored.exists or stored.layout != PERIOD or stored.info["partition_by"] != column:
            return window.rows(self.table(name), column)
        first, last = (period_start(stored.info["period"], m.date()).isoformat() for m in (window.start, window.end))
        # Chosen by folder name: those of other periods never reach the file index.
        within = [e for e in stored.info["entries"] if first <= e["part"].split("=", 1)[1] <= last]
        df = window.rows(stored.read(within, with_layout=True), column)
        return df.where(F.col(PERIOD).between(F.lit(first).cast("date"), F.lit(last).cast("date"))).drop(PERIOD)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        try:
            return self.table(name)
        except KeyError as missing:
            raise AttributeError(str(missing)) from None

    def __getitem__(self, name: str) -> DataFrame:
        return self.table(name)

    def __call__(self, query: str, **args) -> DataFrame:
        """Query the tables by name; `:name` parameters come from `args`."""
        made, shadowed = [], {}
        named = [n for n in folders.names(self.spark, self.root) if re.search(rf"(?<!\w){re.escape(n)}(?!\w)", query, re.I)]
        try:
            # Only tables whose name occurs in the text are opened and listed.
            for name in [n for n in named if (n == "_dq_metrics" or not n.startswith("_")) and self.stored(n).exists]:
                if self.spark.catalog.tableExists(name):
                    shadowed[name] = self.spark.table(name)
                self.table(name).createOrReplaceTempView(name)
                made.append(name)
            return self.spark.sql(query, args=args or None)
        finally:
            for name in made:
                self.spark.catalog.dropTempView(name)
                if name in shadowed:
                    shadowed[name].createOrReplaceTempView(name)

    def row_counts(self, tables: Sequence[str] | None = None) -> DataFrame:
        return stacked(
            [
                self.table(n).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
                for n in (tables or self.tables)
            ],
            self.spark,
            "table_name string, row_count bigint",
        )

    def rows_per_load(self, tables: Sequence[str] | None = None) -> DataFrame:
        return stacked(
            [
                self.table(n)
                .groupBy(LOAD_ID)
                .agg(F.count(F.lit(1)).alias("row_count"))
                .select(F.lit(n).alias("table_name"), LOAD_ID, "row_count")
                for n in (tables or self.tables)
            ],
            self.spark,
            f"table_name string, {LOAD_ID} string, row_count bigint",
        )

    def catalogue(self) -> DataFrame:
        """One row per column of every table: type, key, parent table and annotations."""
        rows = []
        for name in self.tables:
            stored = self.stored(name)
            for place, f in enumerate(stored.schema.fields):
                rows.append(
                    (
                        name,
                        place,
                        f.name,
                        f.dataType.simpleString(),
                        f.name in stored.info.get("key", []),
                        stored.info.get("parent"),
                        json.dumps(f.metadata or {}, sort_keys=True),
                    )
                )
        return self.spark.createDataFrame(
            rows,
            "table_name string, position int, column_name string, data_type string, is_key boolean,"
            " parent_table string, annotations string",
        )

    def loads(self) -> DataFrame:
        """The summary of every load: one row per load and table."""
        folder = f"{self.root}/_loads"
        if not folders.names(self.spark, folder):
            return self.spark.createDataFrame([], LOADS_SCHEMA)
        return self.spark.read.schema(LOADS_SCHEMA).option("pathGlobFilter", "*.json").json(folder)

    def compact(self, name: str) -> None:
        """Write all current folders of a table as one, to end a long row of small appends."""
        stored = self.stored(name)
        loads = sorted({x for e in stored.info["entries"] for x in e.get("loads", [e["load"]])})
        written = stored.write_files(stored.read(as_stored=True), "compacted")
        stored.swap([{**e, "loads": loads} for e in written])


def stacked(parts: Sequence[DataFrame], spark: SparkSession, schema: str) -> DataFrame:
    """`unionByName` of any number of frames, none included."""
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out



def rows_between(dataset, name: str, column: str, window: TimeWindow) -> DataFrame:
    """A window of a table of a dataset, or of a plain dict of frames."""
    if isinstance(dataset, Dataset):
        return dataset.table_between(name, column, window)
    return window.rows(dataset[name], column)
