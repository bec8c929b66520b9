"""Update-or-insert by key, as joins on plain tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def same_key(left: DataFrame, right: DataFrame, key: Sequence[str], prefix: str = "") -> Column:
    """NULL-safe equality over a (composite) key."""
    condition = None
    for name in key:
        equal = left[name].eqNullSafe(right[prefix + name])
        condition = equal if condition is None else condition & equal
    return condition


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or (isinstance(kind, T.ArrayType) and _has_map(kind.elementType))


def keys_repeat(batch: DataFrame, key: Sequence[str]) -> bool:
    """Whether a key has several rows; reads the key alone."""
    return not batch.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).isEmpty()


def latest_per_key(batch: DataFrame, key: Sequence[str], newest: str | None = None, null_keys: bool = True) -> DataFrame:
    """One row per key: the greatest `newest` wins, then the greatest row hash.

    Only key, `newest` and hash are aggregated, partly before the shuffle; whole rows move
    once, to meet the winners. Rows that agree in all of it are copies, of which one stays;
    they are together already. Without `null_keys`, rows that lack a part of the key are
    left out.
    """
    columns = [f"`{c}`" for c in batch.columns]
    # A map has no hash of its own; its text has.
    hashed = [F.to_json(F.struct(c)) if _has_map(f.dataType) else F.col(c) for c, f in zip(columns, batch.schema.fields)]
    ranked = batch.withColumn("_rank", F.struct(*([F.col(newest)] if newest else []), F.xxhash64(*hashed)))
    best = ranked.groupBy(*key).agg(F.max("_rank").alias("_best"))
    best = best.select(*[F.col(k).alias(f"_k_{k}") for k in key], "_best")
    if null_keys:
        matched = same_key(ranked, best, key, "_k_")
    else:
        matched = reduce(Column.__and__, [ranked[k] == best[f"_k_{k}"] for k in key])
    kept = ranked.join(best, matched & (ranked["_rank"] == best["_best"]))
    return kept.dropDuplicates([*key, "_rank"]).select(*columns)


def without_keys(target: DataFrame, keys: DataFrame, key: Sequence[str], as_key: Sequence[str] | None = None) -> DataFrame:
    """Target rows whose key does not occur among `keys`."""
    names = list(as_key or key)
    probe = keys.select(*[F.col(n).alias(f"_k_{c}") for n, c in zip(names, key)])
    return target.join(probe, same_key(target, probe, key, "_k_"), "left_anti")


def merged(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of `batch` replace target rows of the same key; the others are kept."""
    return without_keys(target, batch, key).unionByName(batch, allowMissingColumns=True)
