"""Columns of JSON text to typed columns, through VARIANT.

One aggregate over the parsed values gives the schema of all of them: numbers, booleans and
nested objects at any depth, and VARIANT wherever values of different kinds meet. Objects are
flattened as everywhere else (`payload__a__b`). A place where kinds meet is split: the commonest
kind keeps the name, the others get columns of their own (`payload__a__v_string`), so no value
is lost or turned into text beside its kind.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

KINDS = ("bigint", "double", "boolean", "string", "json")
"""Kinds of values that are told apart; of equally common ones the first keeps the name. `json` holds objects and arrays as text."""


def typed_json(df: DataFrame, column: str, separator: str = "__") -> DataFrame:
    """`df` with the JSON text in `column` replaced by one typed column per leaf.

    A name that `df` has already is an error. Text that is no JSON gives NULL in all of them
    (see `rejected_json`), as do a missing place and a JSON null; a leaf that is null everywhere is
    a text column of NULLs. Whole numbers and fractions in one place are doubles. Arrays of one
    plain type are arrays, other arrays JSON text. A column without any value disappears.
    """
    parsed = df.withColumn(column, F.try_parse_json(column))
    found = parsed.agg(F.schema_of_variant_agg(column)).first()[0]
    if found is None or found == "VOID":
        return df.drop(column)
    found = re.sub(r"(?<=: )VOID(?=[,>])|(?<=ARRAY<)VOID(?=>)", "STRING", found)
    schema = T.DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", found))
    leaves = _leaves(schema, "$", column, separator)
    value = lambda path: F.try_variant_get(column, path, "variant")
    mixed = {name: path for name, path, kind in leaves if isinstance(kind, T.VariantType)}
    kinds = _kinds(parsed, {name: value(path) for name, path in mixed.items()})
    columns: dict[str, Column] = {}
    for name, path, kind in leaves:
        if name in mixed:
            first, *others = kinds[name]
            for k in (first, *others):
                columns[name if k == first else f"{name}{separator}v_{k}"] = _of_kind(value(path), k, kinds[name])
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.VariantType, T.StructType, T.ArrayType)):
            columns[name] = F.to_json(value(path))
        elif isinstance(kind, T.DecimalType):
            columns[name] = F.try_variant_get(column, path, "double")
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.DecimalType):
            columns[name] = F.try_variant_get(column, path, "array<double>")
        else:
            columns[name] = F.try_variant_get(column, path, kind.simpleString())
    kept = [c for c in df.columns if c != column]
    if clash := sorted(set(kept) & set(columns)):
        raise ValueError(f"typed columns of {column} would replace {clash}")
    return parsed.select(*kept, *[c.alias(name) for name, c in columns.items()])


def rejected_json(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is no JSON."""
    return df.where(F.col(column).isNotNull() & F.try_parse_json(column).isNull())


def _leaves(schema: T.DataType, path: str, name: str, separator: str) -> list[tuple[str, str, T.DataType]]:
    """(column name, path, type) of everything that is not an object, in order."""
    if not isinstance(schema, T.StructType):
        return [(name, path, schema)]
    out = []
    for field in schema.fields:
        quote = '"' if "'" in field.name else "'"
        if quote in field.name:
            raise ValueError(f"a name with both quotes cannot be reached: {field.name}")
        out += _leaves(field.dataType, f"{path}[{quote}{field.name}{quote}]", f"{name}{separator}{field.name}", separator)
    return out


def _kind(value: Column) -> Column:
    word = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return (
        F.when(word == "BIGINT", "bigint")
        .when(word.isin("DECIMAL", "DOUBLE", "FLOAT"), "double")
        .when(word == "BOOLEAN", "boolean")
        .when(word.isin("OBJECT", "ARRAY"), "json")
        .when(word.isin("VOID", ""), None)
        .otherwise("string")
    )


def _kinds(rows: DataFrame, mixed: dict[str, Column]) -> dict[str, list[str]]:
    """The kinds that meet in each place, the commonest first; one aggregate for all places."""
    if not mixed:
        return {}
    counts = [F.count_if(_kind(value) == kind).alias(f"{i} {kind}") for i, value in enumerate(mixed.values()) for kind in KINDS]
    found = rows.agg(*counts).first().asDict()
    out = {}
    for i, name in enumerate(mixed):
        n = {kind: found[f"{i} {kind}"] for kind in KINDS if found[f"{i} {kind}"]}
        if "double" in n and "bigint" in n:
            n["double"] += n.pop("bigint")
        out[name] = sorted(n, key=lambda kind: (-n[kind], KINDS.index(kind)))
    return out


def _of_kind(value: Column, kind: str, among: list[str]) -> Column:
    """The values of one kind, NULL for others."""
    own = _kind(value)
    if kind == "json":
        return F.when(own == kind, F.to_json(value))
    is_own = own.isin("bigint", "double") if kind == "double" and "bigint" not in among else own == kind
    return F.when(is_own, F.try_variant_get(value, "$", kind))
