"""Exact duplicates by distributed MSD radix partitioning.

Texts are byte strings. Every round takes the next run of bytes as the digit and
splits each open group by it: rows of one group that share the digit go to one new
group. A group is closed when it has a single row, or when its texts have ended, for
then they are equal. The length in bytes is the first digit, so that all texts of a
group end in the same round. Equality rests on the bytes alone, no digest is taken.

A group is never gathered in a task: groups are counted with partial aggregates and
joined back to their rows, and the join of a hot group is one that Spark may split. The
small side is hashed, so the texts are not sorted, and the join is the same at every size.
Digits grow from round to round, since few groups of different texts stay open for
long; texts of any length end after a number of rounds that is the logarithm of it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import Scratch, utf8

FIRST_DIGIT = 64
"""Bytes of the first digit."""

GROWTH = 16
"""How many times longer each digit is than all before it together."""

RESULT = ("keep_id", "group_size", "kept")


def radix_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", first_digit: int = FIRST_DIGIT, growth: int = GROWTH
) -> DataFrame:
    """One row per row of `docs`: its columns, and `keep_id`, `group_size`, `kept`.

    Texts are equal when their UTF-8 bytes are; null counts as empty. The row with the
    greatest id stays. A null id counts as the smallest. Rows that repeat an id and a
    text are copies like any other: exactly one row of each group is `kept`. Columns of
    `docs` may have any names; those called like a result column are replaced. An empty
    table gives an empty result.
    """
    names = [c for c in docs.columns if c not in RESULT]
    # Columns go by number on the way, so that no name can clash with those used here.
    carried = {f"c{i}": name for i, name in enumerate(names)}
    rows = docs.select(
        *[F.col(f"`{name}`").alias(c) for c, name in carried.items()],
        F.col(f"`{id_col}`").alias("id"),
        utf8(F.col(f"`{text_col}`")).alias("bytes"),
    ).withColumn("group", F.octet_length("bytes").cast("long"))
    scratch, done, at, width = Scratch(docs.sparkSession, "radix"), [], 0, first_digit
    while True:
        dealt = rows.withColumn("digit", F.substring("bytes", at + 1, width))
        counted = dealt.groupBy("group", "digit").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        shared, _ = scratch.keep(counted.withColumn("next", F.monotonically_increasing_id()))
        split = dealt.join(shared.hint("shuffle_hash"), ["group", "digit"], "left")
        done.append(split.where("size IS NULL").select(*carried, F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")))
        at += width
        # The tag tells apart rows that agree in everything; it is fixed by being written.
        left = dealt.join(shared.hint("shuffle_hash"), ["group", "digit"]).select(
            *carried, "id", "bytes", F.col("next").alias("group"), F.monotonically_increasing_id().alias("tag")
        )
        left, _ = scratch.keep(left)
        done.append(_closed(scratch, left.where(F.octet_length("bytes") <= at), carried))
        rows = left.where(F.octet_length("bytes") > at).drop("tag")
        if rows.isEmpty():
            break
        width = at * growth
    found = reduce(DataFrame.unionByName, done)
    return found.select(*[F.col(c).alias(name) for c, name in carried.items()], *RESULT)


def _closed(scratch: Scratch, rows: DataFrame, carried: dict[str, str]) -> DataFrame:
    """Rows of groups whose texts are equal, with the row that stays.

    The winners are written before they are joined: Spark splits a hot group only
    where both sides of a join are shuffled for it.
    """
    best, _ = scratch.keep(
        rows.groupBy("group").agg(F.max(F.struct("id", "tag")).alias("best"), F.count(F.lit(1)).alias("group_size"))
    )
    return rows.join(best.hint("shuffle_hash"), "group").select(
        *carried,
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("tag") == F.col("best.tag")).alias("kept"),
    )
