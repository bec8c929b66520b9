"""Removal of long repeated byte strings, by sorting suffixes.

A byte is removed when a string of `length` bytes that covers it also starts somewhere
else, in any document. Sorting the suffixes at every byte of a corpus would multiply it;
this sorts a sparse set of suffixes that decides about all of them:

1. Anchors. Every window of `length` bytes has one anchor, its short string (`gram` bytes)
   of least hash, the last of equals. Equal windows have equal anchors at equal places, so
   windows only have to be compared with those of the same anchor string. Neighbouring
   windows mostly share their anchor; together they are a stretch of text around it.
2. Anchor strings that occur once are settled: nothing there repeats. Stretches that are
   equal as a whole are settled too: all their windows repeat. Both come from counts, taken
   with partial aggregates.
3. One copy of each different stretch around a repeated anchor string remains. Their
   suffixes from the anchor on are put in order by deep-shallow sorting, and so are the
   texts before it, read backwards. The common prefixes of neighbours in the two orders
   say, for each offset of a window, which windows agree on both sides of the anchor.
4. An anchor string in very many different stretches is split: its windows are dealt out
   one by one and counted by their bytes.

The anchors are about one in a hundred bytes. Texts are cut out of the documents and the
spans removed from them over one shuffle of the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm import suffixes
from tidemark.llm.common import Scratch, utf8
from tidemark.llm.shingles import BASE, mix, powers, running

LENGTH, GRAM = 200, 32
HOT_STRETCHES = 50_000
"""Different stretches around one anchor string that are sorted together at most."""

STRETCHES_AT_ONCE = 20_000
"""Stretches that are sorted together on average."""

PIECE = 4 << 20
"""Bytes of a text that are turned into arrays together; windows across the cut are kept."""

RESULT = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
_U = np.uint64
_LOW = _U(0xFFFFFFFF)


def anchors(data: bytes, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Stretches of a text: hashes of anchor string and stretch, first and last window, place of the anchor."""
    parts = [_anchors(data[at : at + PIECE + length - 1], at, length, gram) for at in range(0, max(len(data) - length + 1, 0), PIECE)]
    if not parts:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(column) for column in zip(*parts))


def _anchors(piece: bytes, offset: int, length: int, gram: int) -> tuple[np.ndarray, ...]:
    text = np.frombuffer(piece, np.uint8)
    sums, scale = running(text), powers(BASE, len(text) + 1)
    grams = mix((sums[gram:] - sums[:-gram]) * scale[: len(text) - gram + 1])
    # Least hash first, then the last place: both read off one number.
    least = (grams & ~_LOW) | (_LOW - np.arange(len(grams), dtype=np.uint64))
    many, span = length - gram + 1, 1
    while 2 * span <= many:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if many > span:
        least = np.minimum(least[: span - many], least[many - span :])
    place = (_LOW - (least & _LOW)).astype(np.int64)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    last = np.append(first[1:], len(place)) - 1
    at = place[first]
    shape = ((at - first) << 16 | (last - first)).astype(np.uint64)
    stretch = mix((sums[last + length] - sums[first]) * scale[first] + mix(shape))
    return grams[at], stretch, first + offset, last + offset, at + offset


def found_anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """`gram`, `stretch` (hashes), `doc`, `first`, `shape` (anchor's and last window's distance) of `doc`, `bytes`."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc, data in zip(batch["doc"], batch["bytes"]):
                name, stretch, first, last, at = anchors(data, length, gram)
                if len(name):
                    yield pd.DataFrame(
                        {
                            "gram": name.view(np.int64),
                            "stretch": stretch.view(np.int64),
                            "doc": doc,
                            "first": first,
                            "shape": ((at - first) << 16 | (last - first)).astype(np.int32),
                        }
                    )

    def gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for frame in find(batches):
            held.append(frame)
            rows += len(frame)
            if rows >= 100_000:
                yield pd.concat(held)
                held, rows = [], 0
        if held:
            yield pd.concat(held)

    return texts.mapInPandas(gathered, "gram long, stretch long, doc long, first long, shape int")


def repeated_windows(stretches: list[bytes], before: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
    """Which windows of each stretch occur in another one as well, as a table of flags.

    Stretch i has `before[i]` bytes up to its anchor and `windows[i]` windows, the first of
    which starts at its first byte. Windows are compared byte by byte through two sorted
    orders: of what follows the anchors, and of what precedes them, backwards.
    """
    n = len(stretches)
    sizes = np.array([len(s) for s in stretches])
    ends = np.cumsum(sizes)
    data = b"".join(stretches)
    right, right_common = suffixes.order(data, ends - sizes + before, sizes - before)
    left, left_common = suffixes.order(data[::-1], len(data) - (ends - sizes + before), before)
    flags = np.zeros((n, int(windows.max(initial=0))), bool)
    after, ahead = np.empty(n, np.int64), np.empty(n, np.int64)
    for offset in range(int(before.max(initial=-1)) + 1):
        # Stretches with a window that has `offset` bytes before the anchor.
        rows = np.flatnonzero((before >= offset) & (before - offset < windows))
        if len(rows) < 2:
            continue
        after[right] = np.cumsum(right_common < length - offset)
        ahead[left] = np.cumsum(left_common < offset)
        _, which, count = np.unique(after[rows] * (n + 1) + ahead[rows], return_inverse=True, return_counts=True)
        again = rows[count[which] > 1]
        flags[again, before[again] - offset] = True
    return flags


def spans_of(flags: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Runs of flagged windows as byte ranges."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(a, b - 1 + length) for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist())]


def merged(spans: np.ndarray) -> list[tuple[int, int]]:
    """Ranges packed as start << 32 | end, joined where they overlap or touch."""
    out: list[list[int]] = []
    for value in np.sort(spans).tolist():
        start, end = value >> 32, value & 0xFFFFFFFF
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _keys(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """A number for each row's id and text. Other seeds are tried until no two different rows share one."""
    for seed in range(8):
        key = F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
        other = F.xxhash64(F.lit(seed + 100), F.col(f"`{text_col}`"), F.col(f"`{id_col}`"))
        pairs = docs.select(key.alias("key"), other.alias("other")).groupBy("key")
        if pairs.agg(F.min("other").alias("a"), F.max("other").alias("b")).where("a <> b").isEmpty():
            return key
    raise RuntimeError("no seed tells the rows apart")


def repeats_removed(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = False,
    hot: int = HOT_STRETCHES,
) -> DataFrame:
    """One row per row of `docs`: its id, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256`; `kept` bytes if asked.

    Strings are judged on the input and may overlap; matches never cross documents. Null
    counts as empty; a text shorter than `length` loses nothing. Ids may be null or
    repeated: every row is a document, and repeated rows are copies of one another. Other
    columns are not read. The whole of every text counts.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "repeats")
    texts = docs.select(
        F.col(f"`{id_col}`").alias("id"), _keys(docs, id_col, text_col).alias("doc"), utf8(F.col(f"`{text_col}`")).alias("bytes")
    )
    occurring = found_anchors(texts.select("doc", "bytes"), length, gram)
    shared = occurring.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    shared, shared_at = scratch.keep(shared)
    hits, _ = scratch.keep(occurring.join(shared.hint("shuffle_hash"), "gram"))
    scratch.drop(shared_at)
    stretches = hits.groupBy("gram", "stretch").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "first", "shape")).alias("one")
    )
    stretches, _ = scratch.keep(stretches.select("gram", "stretch", "n", "one.*"))
    different = stretches.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    different, _ = scratch.keep(different)
    settled = stretches.where("n > 1").select("gram", "stretch")
    packed = lambda start, end: F.shiftleft(start, 32).bitwiseOR(end)
    last = F.col("first") + F.col("shape").bitwiseAND(0xFFFF) + length
    whole = hits.join(settled.hint("shuffle_hash"), ["gram", "stretch"]).select("doc", packed(F.col("first"), last).alias("span"))

    # One copy of each stretch, grouped by the document it is cut from.
    open_ = stretches.join(different.hint("shuffle_hash"), "gram")
    numbers = F.array("gram", "first", F.col("shape").cast("long"), (F.col("n") > 1).cast("long"), (F.col("kinds") > hot).cast("long"))
    cuts = open_.groupBy("doc").agg(F.flatten(F.collect_list(numbers)).alias("cuts"))
    cuts, _ = scratch.keep(cuts)
    many = max(1, (stretches.count() // STRETCHES_AT_ONCE) + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc, data, wanted in zip(batch["doc"], batch["bytes"], batch["cuts"]):
                gram_, first, shape, done, hot_ = np.asarray(wanted, np.int64).reshape(-1, 5).T
                ends = (first + (shape & 0xFFFF) + length).tolist()
                yield pd.DataFrame(
                    {
                        "part": gram_ % many,
                        "doc": doc,
                        "first": first,
                        "shape": shape,
                        "done": done,
                        "hot": hot_,
                        "bytes": [data[a:b] for a, b in zip(first.tolist(), ends)],
                    }
                )

    # The same columns as below, so that both joins read one shuffle of the documents.
    pieces = texts.join(cuts.hint("shuffle_hash"), "doc").mapInPandas(cut, "part long, doc long, first long, shape long, done long, hot long, bytes binary")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        # A stretch of repeated rows comes once for each of them.
        group = group.drop_duplicates(["doc", "first"], ignore_index=True)
        shape = group["shape"].to_numpy()
        flags = repeated_windows(group["bytes"].tolist(), shape >> 16, (shape & 0xFFFF) + 1, length)
        docs_, spans = [], []
        for i in np.flatnonzero((group["done"].to_numpy() == 0) & flags.any(axis=1)):
            first = int(group["first"].iloc[i])
            for a, b in spans_of(flags[i], length):
                docs_.append(group["doc"].iloc[i])
                spans.append((first + a) << 32 | (first + b))
        return pd.DataFrame({"doc": np.array(docs_, np.int64), "span": np.array(spans, np.int64)})

    compared = pieces.where("hot = 0").select("part", "doc", "first", "shape", "done", "bytes").groupBy("part")
    spans = whole.unionByName(compared.applyInPandas(compare, "doc long, span long"))
    if not different.where(F.col("kinds") > hot).isEmpty():
        each = F.explode(F.sequence(F.lit(0), F.col("shape").bitwiseAND(0xFFFF).cast("int")))
        windows = pieces.where("hot = 1").dropDuplicates(["doc", "first"]).select("doc", "first", "bytes", each.alias("i"))
        windows = windows.select("doc", (F.col("first") + F.col("i")).alias("start"), F.substring("bytes", F.col("i") + 1, F.lit(length)).alias("window"))
        again = windows.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window")
        again, _ = scratch.keep(again)
        again = windows.join(again.hint("shuffle_hash"), "window")
        spans = spans.unionByName(again.select("doc", packed(F.col("start"), F.col("start") + length).alias("span")))
    by_doc = spans.groupBy("doc").agg(F.collect_list("span").alias("spans"))
    rows = texts.join(by_doc.hint("shuffle_hash"), "doc", "left")

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in (*RESULT, "kept")}
            for data, spans in zip(batch["bytes"], batch["spans"]):
                gone = merged(np.asarray(spans, np.int64)) if spans is not None else []
                edges = [0, *(x for span in gone for x in span), len(data)]
                kept = b"".join([data[a:b] for a, b in zip(edges[0::2], edges[1::2])])
                values = (len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept)
                for name, value in zip(out, values):
                    out[name].append(value)
            if not with_text:
                del out["kept"]
            yield batch[["id"]].assign(**out)

    kind = texts.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return rows.select("id", "bytes", "spans").mapInPandas(remove, schema).withColumnRenamed("id", id_col)
