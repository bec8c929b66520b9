"""Near-duplicate groups: SuperMinHash signatures, banding, exact verification, union-find.

1. Each text becomes the set of its word shingles, a signature, and band keys. Texts of
   equal sets form a class; from here on one document, the smallest id, stands for it.
2. Classes that share a band key are candidates. No bucket is expanded into pairs. First
   every member is compared with one centre of its bucket, for a few choices of centre,
   and components are taken from the links found. Buckets that still hold more than one
   component are finished in blocks: all members outside the largest component against
   all members. What a pair of rows of one component could add is known already, so no
   link between different components is lost.
3. Every link is confirmed on the full sets: 100 * common >= threshold * union.

The bands are chosen so that a pair at the threshold shares none with a probability of
about one in ten million (5 rows, 40 bands, Jaccard 0.8); pairs above it even less.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm import superminhash
from tidemark.llm.common import Scratch
from tidemark.llm.graph import components
from tidemark.llm.shingles import mix, shingles

BANDS, ROWS = 40, 5
TEXTS_AT_ONCE = 1 << 20
"""Bytes of text that are turned into arrays together; a longer text is taken alone."""

BROADCAST_IDS = 2_000_000
"""Ids of candidates that may be sent to every task; more of them are joined by a shuffle."""

QUERY_SHINGLES, TARGET_SHINGLES = 1_000_000, 2_000_000
"""Elements of the two sides of a block."""

CENTRES = 2
"""Rounds in which the members of a bucket are compared with one of them."""

RESULT = ("n_shingles", "component_id", "kept")


def runs(texts: list[bytes], most: int = TEXTS_AT_ONCE) -> Iterator[slice]:
    """Slices of a list of texts that have `most` bytes each, or one text."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if texts:
        yield slice(start, len(texts))


def signed(texts: DataFrame, k: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """`id`, `n`, two numbers that name the set (`h1`, `h2`), and its band `keys`, of `id`, `text`."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [(t or "").encode() for t in batch["text"]]
            for part in runs(raw):
                some = raw[part]
                numbers, owners = shingles(some, k)
                values = superminhash.signatures(numbers, owners, len(some), bands * rows)
                keys = superminhash.bands(values, rows)
                keys = mix(keys + np.arange(bands, dtype=np.uint64)).view(np.int64)
                n = np.bincount(owners, minlength=len(some))
                names = np.zeros((2, len(some)), np.uint64)
                for i in (0, 1):
                    np.add.at(names[i], owners, mix(numbers ^ np.uint64(0xA5A5A5A5 + i)))
                yield pd.DataFrame(
                    {
                        "id": batch["id"].iloc[part],
                        "n": n,
                        "h1": names[0].view(np.int64),
                        "h2": names[1].view(np.int64),
                        "keys": list(keys),
                    }
                )

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInPandas(sign, f"id {kind}, n long, h1 long, h2 long, keys array<long>")


def sets_of(texts: DataFrame, k: int) -> DataFrame:
    """`id` and `set`, the sorted shingle numbers, of `id`, `text`."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [(t or "").encode() for t in batch["text"]]
            for part in runs(raw):
                numbers, owners = shingles(raw[part], k)
                cuts = np.searchsorted(owners, np.arange(1, len(raw[part])))
                yield pd.DataFrame({"id": batch["id"].iloc[part], "set": np.split(numbers.view(np.int64), cuts)})

    return texts.mapInPandas(make, f"id {texts.schema['id'].dataType.simpleString()}, set array<long>")


def similar(common: Column, n1: Column, n2: Column, threshold: int) -> Column:
    return common * 100 >= (n1 + n2 - common) * threshold


def near_duplicates(
    docs: DataFrame, k: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `docs`: its id, `n_shingles`, `component_id`, `kept`.

    A component's id is the smallest id in it, and that document is kept. Texts without
    words have an empty set, stand alone and are kept; null counts as empty. A text of
    fewer than `k` words is one shingle. Rows that repeat an id are one document if their
    texts are equal; each of the rows is returned. A row without an id cannot be named:
    it is returned with no component, kept, and links nothing. Further columns of `docs`
    are not read. Texts of any length are taken whole.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "neardup")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    signs, _ = scratch.keep(signed(texts, k))
    named = signs.where("id IS NOT NULL AND n > 0")
    classes, _ = scratch.keep(named.groupBy("h1", "h2", "n").agg(F.min("id").alias("rep")))
    member, _ = scratch.keep(named.join(classes.hint("shuffle_hash"), ["h1", "h2", "n"]).select("id", "n", "rep"))

    leaders = named.join(classes.hint("shuffle_hash"), ["h1", "h2", "n"]).where("id = rep").select("rep", "n", "keys")
    entries = leaders.select(F.explode("keys").alias("key"), "rep", "n")
    buckets = (
        entries.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.min("rep").alias("centre"),
            F.bit_xor(F.xxhash64("rep")).alias("x1"),
            F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("x2"),
        )
        .where("size > 1")
        # Bands that gather the same members say the same: one of them is enough.
        .groupBy("size", "x1", "x2", "centre")
        .agg(F.min("key").alias("key"))
        .select("key")
    )
    buckets, _ = scratch.keep(buckets)
    if buckets.isEmpty():
        return _result(signs, member, None, id_col)
    shared, _ = scratch.keep(entries.join(buckets.hint("shuffle_hash"), "key").distinct())
    wanted = shared.select(F.col("rep").alias("id")).distinct()
    wanted, _ = scratch.keep(wanted)
    few = wanted.count() <= BROADCAST_IDS
    # A repeated id may carry another text: only the one whose set is the class's counts.
    chosen = texts.join(F.broadcast(wanted) if few else wanted.hint("shuffle_hash"), "id", "left_semi" if few else "inner")
    sets, _ = scratch.keep(sets_of(chosen.dropDuplicates(["id", "text"]) if _repeats(wanted, chosen) else chosen, k))

    links, roots = [], None
    for turn in range(CENTRES):
        if roots is None:
            state = shared.withColumn("root", F.col("rep"))
        else:
            state = shared.join(roots.hint("shuffle_hash"), F.col("rep") == F.col("v"), "left").select(
                *shared.columns, F.coalesce("root", "rep").alias("root")
            )
        order = F.struct(F.xxhash64("rep", F.lit(turn)), "rep") if turn else F.struct("rep")
        centres = state.groupBy("key").agg(F.min_by(F.struct("rep", "n", "root"), order).alias("centre"))
        centres, _ = scratch.keep(centres)
        pairs = (
            state.join(centres.hint("shuffle_hash"), "key")
            .where("root <> centre.root")
            .where(F.least("n", "centre.n") * 100 >= F.greatest("n", "centre.n") * threshold)
            .select(F.least("rep", "centre.rep").alias("a"), F.greatest("rep", "centre.rep").alias("b"))
            .distinct()
        )
        links.append(_confirmed(scratch, pairs, sets, threshold))
        known = links[0] if len(links) == 1 else links[0].unionByName(links[1])
        roots = None if known.isEmpty() else components(scratch, known)
        links = [known]
    rest = _finished(scratch, shared, roots, sets, threshold)
    known = links[0].unionByName(rest)
    return _result(signs, member, None if known.isEmpty() else components(scratch, known), id_col)


def _repeats(wanted: DataFrame, chosen: DataFrame) -> bool:
    return chosen.select("id").count() > wanted.count()


def _confirmed(scratch: Scratch, pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs `a`, `b` whose full sets are similar."""
    left = sets.select(F.col("id").alias("a"), F.col("set").alias("sa")).hint("shuffle_hash")
    right = sets.select(F.col("id").alias("b"), F.col("set").alias("sb")).hint("shuffle_hash")
    pairs, at = scratch.keep(pairs)
    common = F.size(F.array_intersect("sa", "sb"))
    close = pairs.join(left, "a").join(right, "b").where(similar(common, F.size("sa"), F.size("sb"), threshold))
    found, _ = scratch.keep(close.select("a", "b"))
    scratch.drop(at)
    return found


def _finished(scratch: Scratch, shared: DataFrame, roots: DataFrame | None, sets: DataFrame, threshold: int) -> DataFrame:
    """Links between members of different components within a bucket, by blocks."""
    state = shared.withColumn("root", F.col("rep"))
    if roots is not None:
        state = shared.join(roots.hint("shuffle_hash"), F.col("rep") == F.col("v"), "left").select(
            *shared.columns, F.coalesce("root", "rep").alias("root")
        )
    state, _ = scratch.keep(state)
    parts = state.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("elements"))
    mixed = parts.groupBy("key").agg(
        F.max(F.struct("size", "root", "elements")).alias("largest"), F.sum("elements").alias("all"), F.count(F.lit(1)).alias("roots")
    )
    mixed = mixed.where("roots > 1").select(
        "key",
        F.col("largest.root").alias("largest"),
        F.ceil((F.col("all") - F.col("largest.elements")) / QUERY_SHINGLES).cast("int").alias("rows"),
        F.ceil(F.col("all") / TARGET_SHINGLES).cast("int").alias("columns"),
    )
    mixed, _ = scratch.keep(mixed)
    inside = state.join(mixed.hint("shuffle_hash"), "key")
    inside = inside.join(sets.select(F.col("id").alias("rep"), "set").hint("shuffle_hash"), "rep")
    place = lambda side: F.pmod(F.xxhash64("rep"), F.col(side)).cast("int")
    every = lambda side: F.explode(F.sequence(F.lit(0), F.col(side) - 1))
    columns = ["key", "rep", "root", "set"]
    queries = inside.where("root <> largest").select(*columns, F.lit(True).alias("query"), place("rows").alias("i"), every("columns").alias("j"))
    targets = inside.select(*columns, F.lit(False).alias("query"), place("columns").alias("j"), every("rows").alias("i"))

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        query, target = block[block["query"]], block[~block["query"]]
        a, b = _links(list(query["set"]), list(target["set"]), query["root"].to_numpy(), target["root"].to_numpy(), threshold)
        return pd.DataFrame({"a": query["rep"].to_numpy()[a], "b": target["rep"].to_numpy()[b]})

    kind = shared.schema["rep"].dataType.simpleString()
    blocks = queries.unionByName(targets).groupBy("key", "i", "j")
    found = blocks.applyInPandas(compare, f"a {kind}, b {kind}")
    return scratch.keep(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())[0]


def _links(queries: list, targets: list, roots: np.ndarray, target_roots: np.ndarray, threshold: int) -> tuple[list[int], list[int]]:
    """Places of similar sets of different roots, counted through an inverted index of the targets."""
    if not queries or not targets:
        return [], []
    sizes = np.array([len(t) for t in targets])
    owner = np.repeat(np.arange(len(targets)), sizes)
    numbers = np.concatenate(targets)
    order = np.argsort(numbers, kind="stable")
    numbers, owner = numbers[order], owner[order]
    a, b = [], []
    for i, query in enumerate(queries):
        low, high = np.searchsorted(numbers, query, "left"), np.searchsorted(numbers, query, "right")
        lengths = high - low
        at = np.arange(lengths.sum()) + np.repeat(low - np.append(0, np.cumsum(lengths)[:-1]), lengths)
        common = np.bincount(owner[at], minlength=len(targets))
        close = common * 100 >= (sizes + len(query) - common) * threshold
        hits = np.flatnonzero(close & (common > 0) & (target_roots != roots[i]))
        a += [i] * len(hits)
        b += hits.tolist()
    return a, b


def _result(signs: DataFrame, member: DataFrame, roots: DataFrame | None, id_col: str) -> DataFrame:
    if roots is not None:
        member = member.join(roots.hint("shuffle_hash"), F.col("rep") == F.col("v"), "left").select(
            "id", "n", F.coalesce("root", "rep").alias("component")
        )
    else:
        member = member.select("id", "n", F.col("rep").alias("component"))
    alone = signs.where("id IS NULL OR n = 0").select("id", "n", F.col("id").alias("component"))
    rows = member.unionByName(alone)
    return rows.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )
