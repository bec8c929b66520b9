"""Data quality: metrics describe a table, checks assert something about its rows.

All row-wise checks of a table are computed in one aggregate over one scan. A check on
uniqueness needs a count per key, so it is a separate aggregate over that column only.
A NULL outcome is a failure.
"""

from __future__ import annotations

import re
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.operators.rollup import sketch

# ---- checks -----------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    kind: str
    column: str | None
    name: str
    argument: object = None

    def passed(self) -> Column:
        """Row-wise outcome; not for `is_unique`, which needs the other rows."""
        if self.kind == "is_not_null":
            return F.col(self.column).isNotNull()
        if self.kind == "is_in":
            return F.coalesce(F.col(self.column).isin(list(self.argument)), F.lit(False))
        if self.kind == "case":
            return F.coalesce(F.expr(self.argument), F.lit(False))
        raise ValueError(f"{self.kind} is not decided row by row")

    def named(self, name: str) -> "Check":
        return replace(self, name=name)


# Label of the outermost operator of a condition, tried in this order.
CASE_LABELS = [
    (r"\bOR\b", "Or"),
    (r"\bAND\b", "And"),
    (r"\bBETWEEN\b", "Between"),
    (r"\bIN\s*\(", "In"),
    (r"\bLIKE\b", "Like"),
    (r"\bIS\b", "Is"),
    (r">=", "GTE"),
    (r"<=", "LTE"),
    (r"<>|!=", "NEQ"),
    (r">", "GT"),
    (r"<", "LT"),
    (r"=", "EQ"),
]


def case_name(condition: str) -> str:
    """`{first column}__case__{operator}`; text literals, function names and the AND of a BETWEEN are ignored."""
    bare = re.sub(r"'[^']*'", "''", condition)
    bare = re.sub(r"\bBETWEEN\b(.*?)\bAND\b", r"BETWEEN\1", bare, flags=re.I | re.S)
    column = re.search(r"\b(?!NOT\b)[A-Za-z_]\w*\b(?!\s*\()", bare, re.I)
    label = next((name for pattern, name in CASE_LABELS if re.search(pattern, bare, re.I)), "Expr")
    return f"{column.group(0) if column else 'row'}__case__{label}"


def is_not_null(column: str, name: str | None = None) -> Check:
    return Check("is_not_null", column, name or f"{column}__is_not_null")


def is_in(column: str, values: Sequence, name: str | None = None) -> Check:
    return Check("is_in", column, name or f"{column}__is_in", tuple(values))


def is_unique(column: str, name: str | None = None) -> Check:
    """The value occurs once and is not NULL; every copy of a repeated value fails."""
    return Check("is_unique", column, name or f"{column}__is_unique")


def case(condition: str, name: str | None = None) -> Check:
    return Check("case", None, name or case_name(condition), condition)


checks = SimpleNamespace(is_not_null=is_not_null, is_in=is_in, is_unique=is_unique, case=case)


def distinct_names(items: Sequence[Check]) -> list[Check]:
    """A number is added to the second and later checks of one name."""
    used: dict[str, int] = {}
    out = []
    for check in items:
        used[check.name] = used.get(check.name, 0) + 1
        out.append(check if used[check.name] == 1 else check.named(f"{check.name}_{used[check.name]}"))
    return out


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, one row each."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > 1).select(F.col(column).alias("_value"), F.lit(True).alias("_repeated"))


def with_outcomes(df: DataFrame, items: Sequence[Check]) -> DataFrame:
    """The rows with one boolean column per check.

    For uniqueness the rows are joined with the repeated values, which are one row per
    value however often it occurs; a window would put all copies into one task.
    """
    out = df
    plain = {c.name: c.passed() for c in items if c.kind != "is_unique"}
    if plain:
        out = out.withColumns(plain)
    for check in (c for c in items if c.kind == "is_unique"):
        repeated = repeated_values(df.select(check.column), check.column)
        out = (
            out.join(repeated, out[check.column] == repeated["_value"], "left")
            .withColumn(check.name, F.col(check.column).isNotNull() & F.col("_repeated").isNull())
            .drop("_value", "_repeated")
        )
    return out.select(*df.columns, *[c.name for c in items])


def row_results(df: DataFrame, items: Sequence[Check], keys: Sequence[str] | None = None) -> DataFrame:
    items = distinct_names(items)
    return with_outcomes(df, items).select(*(keys or df.columns), *[c.name for c in items])


def _summary_columns(threshold: float) -> list[Column]:
    rate = F.coalesce(F.try_divide(F.col("passed").cast("double"), F.col("n_rows").cast("double")), F.lit(1.0))
    return [
        "table_name",
        "check_name",
        "n_rows",
        "passed",
        (F.col("n_rows") - F.col("passed")).alias("failed"),
        rate.alias("success_rate"),
        (rate >= F.lit(threshold)).alias("ok"),
    ]


def table_results(
    df: DataFrame, items: Sequence[Check], table_name: str = "", threshold: float = 1.0
) -> DataFrame:
    """One row per check: n_rows, passed, failed, success_rate and ok (success_rate >= threshold)."""
    items = distinct_names(items)
    parts = []
    plain = [c for c in items if c.kind != "is_unique"]
    if plain:
        one = df.agg(
            F.count(F.lit(1)).alias("n_rows"), *[F.count_if(c.passed()).alias(f"p{i}") for i, c in enumerate(plain)]
        )
        pairs = [
            F.struct(F.lit(c.name).alias("check_name"), F.col(f"p{i}").alias("passed")) for i, c in enumerate(plain)
        ]
        parts.append(one.select("n_rows", F.explode(F.array(*pairs)).alias("_c")).select("n_rows", "_c.*"))
    for check in (c for c in items if c.kind == "is_unique"):
        counts = df.groupBy(check.column).agg(F.count(F.lit(1)).alias("_n"))
        alone = (F.col("_n") == 1) & F.col(check.column).isNotNull()
        parts.append(
            counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count_if(alone).alias("passed")).select(
                "n_rows", F.lit(check.name).alias("check_name"), "passed"
            )
        )
    if not parts:
        raise ValueError("no checks given")
    long = reduce(DataFrame.unionByName, parts)
    return long.withColumn("table_name", F.lit(table_name)).select(*_summary_columns(threshold))


def with_verdict(results: DataFrame) -> DataFrame:
    """Table results plus one row that counts the checks that are ok and that are not."""
    name = ["table_name", "check_name"]
    total = F.grouping_id() > 0
    n_checks, n_ok = F.count(F.lit(1)), F.count_if("ok")

    def pick(column: str, overall: Column) -> Column:
        return F.when(total, overall).otherwise(F.first(column))

    grouped = results.groupingSets([name, []], *name).agg(
        total.alias("_all"),
        pick("n_rows", n_checks).alias("n_rows"),
        pick("passed", n_ok).alias("passed"),
        pick("failed", n_checks - n_ok).alias("failed"),
        pick("success_rate", F.try_divide(n_ok.cast("double"), n_checks.cast("double"))).alias("success_rate"),
        F.bool_and("ok").alias("ok"),
    )
    return grouped.select(
        F.when(F.col("_all"), "*").otherwise(F.col("table_name")).alias("table_name"),
        F.when(F.col("_all"), "verdict").otherwise(F.col("check_name")).alias("check_name"),
        "n_rows",
        "passed",
        "failed",
        "success_rate",
        "ok",
    )


def prepare_checks(
    df: DataFrame,
    items: Sequence[Check],
    level: str = "row",
    table_name: str = "",
    keys: Sequence[str] | None = None,
    threshold: float = 1.0,
) -> DataFrame:
    """Check results as a lazy frame, for a stored table or any other frame."""
    if level == "row":
        return row_results(df, items, keys)
    if level == "table":
        return table_results(df, items, table_name, threshold)
    if level == "dataset":
        return with_verdict(table_results(df, items, table_name, threshold))
    raise ValueError(f"level: {level}")


def orphans(child: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Child rows with no parent (`on` maps child to parent columns); a NULL reference has none."""
    probe = parent.select(*[F.col(p).alias(f"_p_{p}") for p in on.values()])
    condition = reduce(lambda a, b: a & b, [child[c] == probe[f"_p_{p}"] for c, p in on.items()])
    return child.join(probe, condition, "left_anti")


class DataQualityError(RuntimeError):
    """At least one check of a gate is not ok; `results` holds all of them."""

    def __init__(self, message: str, results: list):
        super().__init__(message)
        self.results = results


class CheckSuite:
    """Checks for several tables of a dataset (or of a dict of frames)."""

    def __init__(self, dataset, checks: Mapping[str, Sequence[Check]]):
        self.dataset = dataset
        self.checks: dict[str, list[Check]] = {}
        for table, items in checks.items():
            self.add_checks(table, items)

    def add_checks(self, table: str, items: Sequence[Check]) -> None:
        self.checks[table] = distinct_names([*self.checks.get(table, []), *items])

    def _rows(self, table: str) -> DataFrame:
        return self.dataset[table]

    def _pick(self, table: str, name: str) -> Check:
        for check in self.checks[table]:
            if check.name == name:
                return check
        raise KeyError(f"{table} has no check {name}")

    def _split(self, table: str, name: str, passed: bool) -> DataFrame:
        rows = self._rows(table)
        outcome = with_outcomes(rows, [self._pick(table, name)])
        return outcome.where(F.col(name) if passed else ~F.col(name)).select(*rows.columns)

    def get_successes(self, table: str, name: str) -> DataFrame:
        return self._split(table, name, True)

    def get_failures(self, table: str, name: str) -> DataFrame:
        return self._split(table, name, False)

    def results(self, level: str = "table", threshold: float = 1.0) -> DataFrame:
        parts = [table_results(self._rows(t), items, t, threshold) for t, items in self.checks.items()]
        union = reduce(DataFrame.unionByName, parts)
        if level == "table":
            return union
        if level == "dataset":
            return with_verdict(union)
        raise ValueError(f"level: {level}; row level is prepare_checks on one table")

    def gate(self, threshold: float = 1.0) -> list:
        """Raise when a check is not ok. Only one row per check comes to the driver."""
        found = self.results("table", threshold).collect()
        lines = [
            f"{'PASS' if r['ok'] else 'FAIL'}: {r['table_name']}.{r['check_name']}"
            + ("" if r["ok"] else f" -- {r['failed']} failures")
            for r in found
        ]
        if not all(r["ok"] for r in found):
            raise DataQualityError("\n".join(lines), found)
        return found


# ---- metrics ----------------------------------------------------------------


@dataclass(frozen=True)
class Metric:
    level: str
    metric: str
    column: str | None = None
    approximate: bool = False
    per: Sequence[str] | None = None

    def as_row(self) -> list:
        return [self.level, self.metric, self.column, self.approximate, self.per and list(self.per)]

    def value(self) -> Column:
        rows = F.count(F.lit(1))
        if self.metric == "row_count":
            return rows
        column = F.col(self.column)
        if self.metric == "null_count":
            return F.count_if(column.isNull())
        if self.metric == "null_rate":
            return F.try_divide(F.count_if(column.isNull()).cast("double"), rows.cast("double"))
        if self.metric == "unique_count":
            return F.approx_count_distinct(column) if self.approximate else F.count_distinct(column)
        if self.metric == "mean":
            return F.avg(column)
        if self.metric == "maximum":
            return F.max(column)
        if self.metric == "minimum":
            return F.min(column)
        raise ValueError(f"metric: {self.metric}")


SKETCH = "distinct_sketch"
"""A mergeable distinct count, see `run_metrics` and `distinct_between`."""


def _column_metric(name: str):
    return lambda column: Metric("column", name, column)


metrics = SimpleNamespace(
    column=SimpleNamespace(
        null_count=_column_metric("null_count"),
        null_rate=_column_metric("null_rate"),
        unique_count=lambda column, approximate=False: Metric("column", "unique_count", column, approximate),
        distinct_sketch=lambda column, time=None, unit="day": Metric("column", SKETCH, column, True, (time, unit) if time else None),
        mean=_column_metric("mean"),
        maximum=_column_metric("maximum"),
        minimum=_column_metric("minimum"),
    ),
    table=SimpleNamespace(row_count=lambda: Metric("table", "row_count")),
    dataset=SimpleNamespace(row_count=lambda: Metric("dataset", "row_count")),
)

METRIC_COLUMNS = ["level", "table_name", "column_name", "metric", "value", "text_value"]


def with_metrics(resource, *items: Metric):
    """The resource, carrying metrics that `run_metrics` computes after a load."""
    return resource.with_metrics(*items)


def compute_metrics(df: DataFrame, items: Sequence[Metric], table_name: str = "") -> DataFrame:
    """One row per metric: a number in `value`, or, for the greatest and smallest value of a
    column that holds no numbers, its text in `text_value`. One aggregate for all of them; several exact distinct
    counts are taken from one more scan as pairs of column and value, which are made distinct before they are shuffled."""
    exact = [m for m in items if m.metric == "unique_count" and not m.approximate and isinstance(df.schema[m.column].dataType, T.AtomicType)]
    paired = exact if len(exact) > 1 else []
    apart = [m for m in items if m.metric == "unique_count" and not m.approximate and m not in exact]
    if len(apart) + bool(exact) == 1:
        apart = []
    together = [m for m in items if m not in paired and m not in apart and m.metric != SKETCH]
    groups = ([together] if together else []) + [[m] for m in apart]
    parts = [_distinct_counts(df, paired, table_name)] if paired else []
    for group in groups:
        words = [m.metric in ("maximum", "minimum") and not isinstance(df.schema[m.column].dataType, T.NumericType) for m in group]
        kinds = ["string" if text else "double" for text in words]
        one = df.agg(*[m.value().cast(kind).alias(f"m{i}") for i, (m, kind) in enumerate(zip(group, kinds))])
        entries = [
            F.struct(
                F.lit(m.level).alias("level"),
                F.lit(table_name).alias("table_name"),
                F.lit(m.column).cast("string").alias("column_name"),
                F.lit(m.metric).alias("metric"),
                (F.lit(None).cast("double") if words[i] else F.col(f"m{i}")).alias("value"),
                (F.col(f"m{i}") if words[i] else F.lit(None).cast("string")).alias("text_value"),
            )
            for i, m in enumerate(group)
        ]
        parts.append(one.select(F.explode(F.array(*entries)).alias("_m")).select("_m.*"))
    return reduce(DataFrame.unionByName, parts)


def _distinct_counts(df: DataFrame, items: Sequence[Metric], table_name: str) -> DataFrame:
    """Exact distinct counts of several columns: one scan, one shuffle of (column, value) pairs.

    A task sends each pair once, so the rows are multiplied before the first aggregate only.
    Values travel as text, which tells all values of a plain type apart; -0.0 is 0.0.
    """

    def text(name: str) -> Column:
        kind, x = df.schema[name].dataType, F.col(name)
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return F.when(x == 0, F.lit(0.0).cast(kind)).otherwise(x).cast("string")
        return F.hex(x) if isinstance(kind, T.BinaryType) else x.cast("string")

    numbered = [F.struct(F.lit(i).alias("i"), text(m.column).alias("v")) for i, m in enumerate(items)]
    pairs = df.select(F.explode(F.array(*numbered)).alias("p")).select("p.i", "p.v").distinct()
    counts = pairs.agg(*[F.count_if((F.col("i") == i) & F.col("v").isNotNull()).cast("double").alias(f"m{i}") for i in range(len(items))])
    rows = [
        F.struct(
            F.lit(m.level).alias("level"),
            F.lit(table_name).alias("table_name"),
            F.lit(m.column).alias("column_name"),
            F.lit(m.metric).alias("metric"),
            F.col(f"m{i}").alias("value"),
            F.lit(None).cast("string").alias("text_value"),
        )
        for i, m in enumerate(items)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("_m")).select("_m.*")


METRICS_TABLE = "_dq_metrics"
SKETCHES_TABLE = "_dq_sketches"


def run_metrics(pipeline, run_id: str | None = None, extra: Sequence[Metric] = ()) -> DataFrame:
    """Compute the metrics the dataset's tables carry and append them to the history.

    `extra` may hold dataset-level metrics. Returns the rows of this run. Distinct sketches go to a
    table of their own, one per period, and are taken from the rows of the last load alone:
    those of earlier loads are there already, and any span of them can be put together.
    """
    from tidemark.plans.dataset import StoredTable

    dataset = pipeline.dataset()
    run_id = run_id or f"{time.time():.6f}"
    load_id = pipeline.last_load.load_id if pipeline.last_load else None

    def append(table: str, rows: DataFrame) -> DataFrame:
        stamped = rows.select(F.lit(run_id).alias("run_id"), F.lit(load_id).cast("string").alias("load_id"), F.current_timestamp().alias("computed_at"), "*")
        history = StoredTable(dataset.spark, dataset.root, table)
        history.describe(stamped, key=[], source=None, resource=table, dropped=False)
        history.swap(history.append(stamped, run_id))
        return dataset.table(table).where(F.col("run_id") == run_id)

    parts, sketches = [], []
    for name in dataset.tables:
        items = [Metric(*r) for r in dataset.stored(name).info.get("metrics") or []]
        sketches += [_sketches(dataset.table(name), m, name, load_id) for m in items if m.metric == SKETCH]
        if any(m.metric != SKETCH for m in items):
            parts.append(compute_metrics(dataset.table(name), items, name))
    if any(m.level == "dataset" for m in extra):
        total = dataset.row_counts().agg(F.sum("row_count").cast("double").alias("value"))
        parts.append(
            total.select(
                F.lit("dataset").alias("level"),
                F.lit(None).cast("string").alias("table_name"),
                F.lit(None).cast("string").alias("column_name"),
                F.lit("row_count").alias("metric"),
                "value",
                F.lit(None).cast("string").alias("text_value"),
            )
        )
    if not parts and not sketches:
        raise ValueError("no table of this dataset carries metrics")
    if sketches:
        found = append(SKETCHES_TABLE, reduce(DataFrame.unionByName, sketches))
    return append(METRICS_TABLE, reduce(DataFrame.unionByName, parts).select(*METRIC_COLUMNS)) if parts else found


def _sketches(rows: DataFrame, metric: Metric, table_name: str, load_id: str | None) -> DataFrame:
    """table_name, column_name, period, state: the sketch of each period of the rows of a load."""
    if load_id is not None and "_load_id" in rows.columns:
        rows = rows.where(F.col("_load_id") == load_id)
    period = F.date_trunc(metric.per[1], F.col(metric.per[0])).cast("timestamp_ntz") if metric.per else F.lit(None).cast("timestamp_ntz")
    made = rows.groupBy(period.alias("period")).agg(sketch(metric.column).alias("state"))
    return made.select(F.lit(table_name).alias("table_name"), F.lit(metric.column).alias("column_name"), "period", "state")


def distinct_between(
    dataset, table: str, column: str, first=None, last=None, by: str | None = None, load_ids: Sequence[str] | None = None
) -> DataFrame:
    """Distinct values of a column over any span of stored periods, from sketches: (`by`,) estimate.

    `first` and `last` are included; `by` is a unit (`month`) for one row each. A sketch that was
    stored twice counts once. Values that a later load took away stay counted; for a table
    that loads replace, name the load to look at.
    """
    rows = dataset.table(SKETCHES_TABLE).where((F.col("table_name") == table) & (F.col("column_name") == column))
    for bound, keep in ((first, F.col("period") >= F.lit(first)), (last, F.col("period") <= F.lit(last))):
        rows = rows if bound is None else rows.where(keep)
    if load_ids is not None:
        rows = rows.where(F.col("load_id").isin(list(load_ids)))
    groups = [F.date_trunc(by, "period").cast("timestamp_ntz").alias(by)] if by else []
    return rows.groupBy(*groups).agg(F.hll_sketch_estimate(F.hll_union_agg("state")).alias("estimate"))


def read_metric(dataset, table: str | None, metric: str, column: str | None = None) -> DataFrame:
    """History of one metric, oldest first."""
    rows = dataset.table(METRICS_TABLE).where(
        F.col("table_name").eqNullSafe(F.lit(table).cast("string"))
        & (F.col("metric") == metric)
        & F.col("column_name").eqNullSafe(F.lit(column).cast("string"))
    )
    return rows.orderBy("computed_at", "run_id")
