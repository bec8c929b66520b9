"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short and documents long, so what counts is containment: the share of an
item's word shingles that a document holds. Items are partitioned by size (powers of
two). Each is represented by its bottom-k MinHash sketch, the `k` shingles of least hash,
where `k` depends on the size partition: a document that contains the share t of an item
of q shingles lacks at most q - ceil(t q) of them, so of one more than that it holds one
at least, whatever its length. Documents that hold a sketch shingle and are large enough
are candidates, and no true one is missed. Candidates are verified by exact containment
of whole shingles.

A banded signature of the whole document is not used: a passage of 30 shingles in a
document of 5000 has a Jaccard similarity of 0.005, which takes thousands of slots to see.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import Scratch, words_pattern

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_ROWS = 1_000_000
"""Rows of two or three numbers that may be sent to every task; more are joined by a shuffle."""

BROADCAST_ITEMS = 20_000
"""Items whose shingles may be sent to every task."""


def words(text: Column) -> Column:
    """Words of a text, A-Z in lower case; none for null."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), words_pattern())
    return F.filter(parts, lambda word: word != "")


def each_shingle(words: Column, k: int, make) -> Column:
    """`make` of every run of `k` words; of all words when there are fewer; nothing without words."""

    def runs(words: Column) -> Column:
        many = F.size(words)
        all_runs = F.transform(F.sequence(F.lit(1), F.greatest(many - k + 1, F.lit(1))), lambda i: make(F.slice(words, i, k)))
        return F.when(many >= k, all_runs).when(many > 0, F.array(make(words))).otherwise(F.slice(F.array(make(words)), 1, 0))

    # As the variable of a function the words are split once, not once per run.
    return F.element_at(F.transform(F.array(words), runs), 1)


def small(df: DataFrame, rows: int) -> DataFrame:
    """For broadcast when a count shows that it has at most so many rows, else left to a shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def contained(
    docs: DataFrame,
    items: DataFrame,
    k: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Pairs of a document and an item that it contains: ids, `n_item`, `n_shared`, `containment`.

    One row per document row and item with 100 * shared >= percent * shingles of the item.
    Items without words are contained in nothing; an item of fewer than `k` words is one
    shingle, which only a document of the same words has. Null texts count as empty. Rows
    without an id can't be named: they give no pair. Items that repeat id and text count
    once; items that share an id count apart. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "contained")
    number = lambda run: F.xxhash64(run)
    phrase = lambda run: F.array_join(run, " ")
    asked = (
        items.select(F.col(f"`{item_col}`").alias("item"), words(F.col(f"`{item_text_col}`")).alias("words"))
        .where("item IS NOT NULL AND size(words) > 0")
        .distinct()
        .select("item", F.array_distinct(each_shingle(F.col("words"), k, phrase)).alias("phrases"), F.array_distinct(each_shingle(F.col("words"), k, number)).alias("numbers"))
        .withColumn("n_item", F.size("phrases"))
        .withColumn("part", F.floor(F.log2("n_item")).cast("int"))
        .withColumn("no", F.monotonically_increasing_id())
    )
    asked, _ = scratch.keep(asked)
    # The longest sketch that an item of the partition needs.
    sketch_size = F.floor((F.pow(2, F.col("part") + 1) - 1) * (100 - percent) / 100).cast("int") + 1
    sketches = asked.select("no", "n_item", F.explode(F.slice(F.array_sort("numbers"), 1, sketch_size)).alias("number"))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where("id IS NOT NULL")
    held = texts.select("id", words(F.col("text")).alias("words"))
    # An upper bound of a document's shingles, to leave out items that are too large for it.
    held = held.select("id", F.size("words").alias("most"), F.explode(each_shingle(F.col("words"), k, number)).alias("number"))
    candidates = (
        held.join(small(sketches, BROADCAST_ROWS), "number")
        .where(F.col("most") * 100 >= F.col("n_item") * percent)
        .select("id", "no")
        .distinct()
    )
    candidates, _ = scratch.keep(candidates)
    named = candidates.select("id").distinct()
    whole = texts.join(small(named, BROADCAST_ROWS), "id", "left_semi")
    whole = whole.select("id", each_shingle(words(F.col("text")), k, phrase).alias("held"))
    pairs = whole.join(small(candidates, BROADCAST_ROWS), "id").join(
        small(asked.select("no", "item", "n_item", "phrases"), BROADCAST_ITEMS), "no"
    )
    shared = F.size(F.array_intersect("phrases", "held"))
    return pairs.withColumn("shared", shared).where(F.col("shared") * 100 >= F.col("n_item") * percent).select(
        F.col("id").alias(id_col),
        F.col("item").alias(item_col),
        F.col("n_item").cast("long").alias("n_item"),
        F.col("shared").cast("long").alias("n_shared"),
        (F.col("shared") / F.col("n_item")).alias("containment"),
    )
