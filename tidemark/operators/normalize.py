"""Nested rows to flat relational tables: flattening, child tables, row keys, variants."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

SEPARATOR = "__"
ROW_ID, PARENT_ID, ROOT_ID = "_row_id", "_parent_id", "_root_id"
LIST_INDEX, LOAD_ID = "_list_idx", "_load_id"
COPIES_PER_TASK_ROW = 10_000
COPIES_IN_PLACE = 16


class SchemaConflict(ValueError):
    """An incoming column does not fit the stored table, or two columns claim one name."""


# ---- flattening -------------------------------------------------------------


def _leaves(schema: T.StructType, prefix: str = "", path: str = ""):
    for field in schema.fields:
        name = f"{prefix}{field.name}"
        here = f"{path}.`{field.name}`" if path else f"`{field.name}`"
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, name + SEPARATOR, here)
        else:
            yield name, here, field


def is_nested_list(kind: T.DataType) -> bool:
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType))


def has_nesting(df: DataFrame) -> bool:
    return any(isinstance(f.dataType, T.StructType) or is_nested_list(f.dataType) for f in df.schema.fields)


def flatten(df: DataFrame) -> DataFrame:
    """Struct fields become columns named by their path, joined with `__`; arrays stay."""
    leaves = list(_leaves(df.schema))
    seen: set[str] = set()
    for name, _, _ in leaves:
        if name.lower() in seen:
            raise SchemaConflict(f"two columns would be named {name}")
        seen.add(name.lower())
    return df.select(*[F.col(path).alias(name, metadata=field.metadata or {}) for name, path, field in leaves])


def nested_lists(flat: DataFrame) -> list[str]:
    return [f.name for f in flat.schema.fields if is_nested_list(f.dataType)]


def child_rows(flat: DataFrame, column: str) -> DataFrame:
    """One row per element of a list column, with the parent's key and the element's place.

    An empty list makes no child row. The key of a child is a function of its parent
    and place, so no shuffle is needed.
    """
    links = [F.col(ROW_ID).alias(PARENT_ID)]
    if PARENT_ID in flat.columns:
        # Below the first level the top row is kept too, so a merge can find all rows of a parent.
        links.append(F.col(ROOT_ID if ROOT_ID in flat.columns else PARENT_ID).alias(ROOT_ID))
    exploded = flat.select(*links, F.posexplode(column).alias(LIST_INDEX, "element"))
    kind = flat.schema[column].dataType.elementType
    if isinstance(kind, T.StructType):
        rows = exploded.select(*[c for c in exploded.columns if c != "element"], "element.*")
    else:
        rows = exploded.withColumnRenamed("element", "value")
    return rows.select(child_key(column).alias(ROW_ID), "*")


def child_key(column: str) -> Column:
    """The key of a row of the child table of a list column, from its parent's key and its place."""
    return F.sha2(F.concat_ws("|", PARENT_ID, F.lit(column), F.col(LIST_INDEX).cast("string")), 256)


def relational_tables(df: DataFrame, name: str) -> dict[str, DataFrame]:
    """The flat parent table and, for each list of objects, a child table `parent__field`; recursive.

    `df` must carry `_row_id` when it has nested lists.
    """
    return {table: rows for table, (rows, _) in tables_of_lists(df, name).items()}


def tables_of_lists(df: DataFrame, name: str, column: str | None = None) -> dict[str, tuple[DataFrame, str | None]]:
    """The tables of `relational_tables`, each with the list column that a child table's rows come from."""
    flat = flatten(df)
    lists = nested_lists(flat)
    if lists and ROW_ID not in flat.columns:
        raise ValueError("nested lists need row keys first: with_row_keys(...)")
    tables = {name: (flat.drop(*lists), column)}
    for each in lists:
        tables.update(tables_of_lists(child_rows(flat, each), f"{name}{SEPARATOR}{each}", each))
    return tables


# ---- row keys ---------------------------------------------------------------


def _canonical(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def with_row_keys(df: DataFrame, key: Sequence[str] = (), load_id: str = "") -> DataFrame:
    """Add `_row_id`, equal on every retry and for every partitioning.

    With a key it is the hash of the key: no shuffle. Without one it is the hash of
    the whole row, the load and, for exact copies, a running number.
    """
    if key:
        return df.select(F.sha2(_canonical(list(key)), 256).alias(ROW_ID), "*")
    columns = df.columns
    numbered = numbered_copies(df, "_copy")
    content = F.concat_ws("|", _canonical(columns), F.lit(load_id), F.col("_copy").cast("string"))
    return numbered.select(F.sha2(content, 256).alias(ROW_ID), *columns)


def numbered_copies(df: DataFrame, name: str, chunk: int = COPIES_PER_TASK_ROW) -> DataFrame:
    """Number the exact copies of each row 0, 1, 2, ...

    Copies are counted (partly before the shuffle, so a row repeated very often is one
    small record by then) and made again from the count. A count above `COPIES_IN_PLACE` is cut
    into pieces of `chunk` that are spread over all shuffle partitions first: their number is
    given, because pieces are so small that Spark would gather them in one task. Those rows are
    a small part of the input.
    """
    columns = df.columns
    counted = _counted_copies(df)
    in_place = min(chunk, COPIES_IN_PLACE)
    few = counted.where(F.col("_n") <= in_place).select(
        *columns, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)).alias(name)
    )
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(chunk).cast("bigint")))
    many = (
        counted.where(F.col("_n") > in_place)
        .select(*columns, "_n", starts.alias("_from"))
        .repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_from", *_hashable(df))
        .select(
            *columns,
            F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + chunk, F.col("_n")) - 1)).alias(name),
        )
    )
    return few.unionByName(many)


def _counted_copies(df: DataFrame) -> DataFrame:
    """Distinct rows with `_n`, how often each occurs, and every value as it came in.

    Grouping makes one value of 0.0 and -0.0. Where a column of its own is a fraction, the places of
    negative zeros are grouped beside the values and put back. Rows with fractions inside lists
    and objects, or with maps, which have no order to group by, are grouped by their text.
    """
    columns, fields = df.columns, df.schema.fields
    if any(_needs_text(f.dataType) for f in fields if not isinstance(f.dataType, FRACTIONS)):
        content = F.sha2(_canonical(columns), 256).alias("_content")
        return df.groupBy(content).agg(F.any_value(F.struct(*columns)).alias("_row"), F.count(F.lit(1)).alias("_n")).select("_row.*", "_n")
    signed = [f.name for f in fields if isinstance(f.dataType, FRACTIONS)]
    if not signed:
        return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    minus = F.array_compact(F.array(*[F.when((F.col(c) == 0) & F.col(c).cast("string").startswith("-"), F.lit(c)) for c in signed]))
    counted = df.groupBy(*columns, minus.alias("_minus")).agg(F.count(F.lit(1)).alias("_n"))
    kinds = {f.name: f.dataType for f in fields}
    back = {c: F.when(F.array_contains("_minus", c), F.lit(-0.0).cast(kinds[c])).otherwise(F.col(c)) for c in signed}
    return counted.select(*[back[c].alias(c) if c in back else c for c in columns], "_n")


FRACTIONS = (T.DoubleType, T.FloatType)


def _needs_text(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_needs_text(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, *FRACTIONS)) or (isinstance(kind, T.ArrayType) and _needs_text(kind.elementType))


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]


# ---- types ------------------------------------------------------------------

# The short type names used in variant columns.
TYPE_NAMES = {
    "bigint": "bigint",
    "double": "double",
    "string": "text",
    "boolean": "bool",
    "timestamp": "timestamp",
    "timestamp_ntz": "timestamp",
    "date": "date",
    "binary": "binary",
}


def type_name(kind: T.DataType) -> str:
    text = kind.simpleString()
    if isinstance(kind, T.DecimalType):
        return "decimal"
    return TYPE_NAMES.get(text, text.split("<")[0])


def widened(df: DataFrame) -> DataFrame:
    """Stored column types: whole numbers as bigint, floats as double, untyped NULLs as text."""
    targets = {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "float": "double", "void": "string"}
    change = {
        f.name: F.col(f"`{f.name}`").cast(targets[f.dataType.simpleString()]).alias(f.name, metadata=f.metadata or {})
        for f in df.schema.fields
        if f.dataType.simpleString() in targets
    }
    return df.withColumns(change) if change else df


ISO_INSTANT = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?( ?(Z|[+-]\d{2}(:?\d{2})?))?)?$"


def instant(text: Column) -> Column:
    """A full ISO date or date and time as a timestamp; NULL for anything else, digits and clock times too."""
    return F.when(text.rlike(ISO_INSTANT), F.try_to_timestamp(text))


def timestamps_from_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns become timestamps when every non-NULL value parses; one pass for all columns."""
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    if not texts:
        return df
    tests = [F.count_if(F.col(c).isNotNull() & instant(F.col(c)).isNull()).alias(c) for c in texts]
    filled = [F.count(c).alias(f"{c}__filled") for c in texts]
    result = df.agg(*tests, *filled).first()
    good = [c for c in texts if result[c] == 0 and result[f"{c}__filled"] > 0]
    return df.withColumns({c: instant(F.col(c)) for c in good}) if good else df


def split_variant(value: Column, incoming: T.DataType, stored: T.DataType) -> tuple[Column, Column]:
    """The part of a column that the stored type holds exactly, and the rest.

    Numbers are compared after the round trip, so 3.0 fits a bigint column and 3.5 does not.
    Text fits a timestamp column when it is an instant.
    """
    if isinstance(incoming, T.StringType) and isinstance(stored, (T.TimestampType, T.TimestampNTZType)):
        parsed = instant(value).cast(stored)
        return parsed, F.when(parsed.isNull(), value)
    as_stored = value.try_cast(stored)
    back = as_stored.try_cast(incoming)
    fits = F.coalesce(back == value, F.lit(False))
    return F.when(fits, as_stored), F.when(~fits, value)


def _castable(incoming: T.DataType, stored: T.DataType) -> bool:
    simple = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return isinstance(incoming, simple) and isinstance(stored, simple)


def _pair_has_cast(incoming: T.DataType, stored: T.DataType) -> bool:
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(incoming, times) != isinstance(stored, times):
        return isinstance(incoming, T.StringType) or isinstance(stored, T.StringType)
    return True


def keep_type(df: DataFrame, stored: T.StructType | None, columns: Sequence[str], table: str) -> None:
    """Raise when a key or layout column arrives as another type than the stored one.

    Its values would go to a variant column, and rows would lose their key.
    """
    for field in widened(df).schema.fields if stored is not None else ():
        if field.name in columns and field.name in stored.fieldNames() and stored[field.name].dataType != field.dataType:
            raise SchemaConflict(
                f"{table}.{field.name}: stored {stored[field.name].dataType.simpleString()}, incoming {field.dataType.simpleString()}"
            )


CONTRACTS = ("evolve", "add", "freeze")


def reconciled(df: DataFrame, stored: T.StructType | None, contract: str = "evolve", table: str = "") -> DataFrame:
    """Fit a frame to the stored schema, before anything is executed.

    `evolve` adds columns and sends values of another type to a variant column,
    `add` adds columns but refuses another type, `freeze` refuses both.
    Stored columns that are missing come as NULL.
    """
    if contract not in CONTRACTS:
        raise ValueError(f"contract: {contract}")
    df = widened(df)
    if stored is None:
        return df
    known = {f.name.lower(): f for f in stored.fields}
    out: dict[str, Column] = {}
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        match = known.get(field.name.lower())
        if match is None:
            if contract == "freeze":
                raise SchemaConflict(f"{table}: new column {field.name}")
            out[field.name] = value
        elif match.dataType == field.dataType:
            out[match.name] = value
        elif contract != "evolve":
            raise SchemaConflict(
                f"{table}.{match.name}: stored {match.dataType.simpleString()}, incoming {field.dataType.simpleString()}"
            )
        elif _castable(field.dataType, match.dataType) and _pair_has_cast(field.dataType, match.dataType):
            base, rest = split_variant(value, field.dataType, match.dataType)
            out[match.name] = base
            out[f"{match.name}{SEPARATOR}v_{type_name(field.dataType)}"] = rest
        else:
            out[match.name] = F.lit(None).cast(match.dataType)
            out[f"{match.name}{SEPARATOR}v_{type_name(field.dataType)}"] = value
    for field in stored.fields:
        if field.name not in out:
            out[field.name] = F.lit(None).cast(field.dataType)
    order = [f.name for f in stored.fields] + [n for n in out if n.lower() not in known]
    notes = {f.name: f.metadata for f in [*stored.fields, *df.schema.fields] if f.metadata}
    return df.select(*[out[n].alias(n, metadata=notes.get(n, {})) for n in order])


# ---- annotations ------------------------------------------------------------


def annotated(df: DataFrame, notes: Mapping[str, Mapping]) -> DataFrame:
    for column, note in notes.items():
        df = df.withMetadata(column, {**(df.schema[column].metadata or {}), **note})
    return df


def flagged_columns(df: DataFrame, flag: str) -> list[str]:
    """Names of the columns whose annotation `flag` is set."""
    return [f.name for f in df.schema.fields if (f.metadata or {}).get(flag)]
