"""Byte-level BPE, encoding and decoding, with one encoding of each distinct word.

Texts are dealt into blocks of bounded size. A block lists its distinct pre-tokens once
and sends them, by hash, to the tasks that encode: a word that occurs in every document
of the corpus reaches its task once per block, not once per occurrence, and is encoded
there once. Words and ids travel back to the blocks that asked, and each block puts the
ids in place of the pre-tokens of its texts, by position. Decoding looks
every id up in the table of token bytes, which the vocabulary bounds.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import zstandard
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import block_count, dealt, undealt

BLOCK_BYTES = 16 << 20
"""Bytes of text in a block, on average. A longer text is a block's work by itself."""


RESULT = ("n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    """The vocabulary file: a base64 token and its rank per line. Read in each task, never shipped."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(word: bytes, table: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the pair of least rank, the leftmost of equals, is joined first."""
    whole = table.get(word)
    if whole is not None:
        return [whole]
    parts = [word[i : i + 1] for i in range(len(word))]
    if len(parts) > 500:
        return _merge_long(parts, table)
    while len(parts) > 1:
        pairs = [table.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
        least = min(pairs)
        if least == 1 << 60:
            break
        i = pairs.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [table[p] for p in parts]


def _merge_long(parts: list[bytes], table: dict[bytes, int]) -> list[int]:
    """The same by a heap, n log n for pre-tokens without end."""
    import heapq

    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(table[p], i, p) for i in range(n - 1) if (p := parts[i] + parts[i + 1]) in table]
    heapq.heapify(heap)
    while heap:
        _, i, joined = heapq.heappop(heap)
        j = after[i] if parts[i] else n
        if j >= n or not parts[i] or parts[i] + parts[j] != joined:
            continue
        parts[i], parts[j] = joined, b""
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < n and (p := parts[k] + parts[after[k]]) in table:
                heapq.heappush(heap, (table[p], k, p))
    return [table[p] for p in parts if p]


def pack(items: list[bytes]) -> bytes:
    """Byte strings in one compressed value."""
    lengths = np.fromiter(map(len, items), np.uint32, len(items)).tobytes()
    return zstandard.compress(struct.pack("<I", len(items)) + lengths + b"".join(items))


def unpack(value: bytes) -> list[bytes]:
    raw = zstandard.decompress(value)
    (n,) = struct.unpack_from("<I", raw)
    places = (4 + 4 * n + np.append(0, np.cumsum(np.frombuffer(raw, np.uint32, n, 4), dtype=np.int64))).tolist()
    return [raw[a:b] for a, b in zip(places, places[1:])]


def encoded(
    docs: DataFrame,
    path: str,
    pattern: str,
    text_col: str = "text",
    keep: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
    with_ids: bool = False,
) -> DataFrame:
    """`keep` columns (by default all) of every row, and the results of encoding and decoding its text.

    `n_tokens`, `ids_sha256` (of the decimal ids joined by commas), `decoded_sha256` and, if
    asked for, `ids` (array) and `decoded` (binary). Null counts as empty: no tokens, and the
    digests of nothing. Repeated rows stay repeated. Columns of `docs` may have any names;
    those called like a result give way. `path` is a rank file that every executor can read.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c not in RESULT]
    texts = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    blocks = block_count(docs, f"`{text_col}`", block_bytes)
    key = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in names if c != text_col] or [F.lit(0)], texts), F.lit(blocks))
    rows = docs.select(
        key.alias("block"), texts.alias("text"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    )

    def ask(block: pd.DataFrame) -> pd.DataFrame:
        find, words = regex.compile(pattern).findall, set()
        for text in undealt(block["rows"])["text"]:
            words.update(find(text))
        parts: dict[int, list[bytes]] = {}
        for word in map(str.encode, sorted(words)):
            parts.setdefault(zlib.crc32(word) % blocks, []).append(word)
        number = int(block["block"].iloc[0])
        return pd.DataFrame({"bucket": list(parts), "block": number, "words": [pack(w) for w in parts.values()]})

    def answer(bucket: pd.DataFrame) -> pd.DataFrame:
        table, known, replies = ranks(path), {}, []
        for value in bucket["words"]:
            ids = []
            for word in unpack(value):
                found = known.get(word)
                if found is None:
                    found = known[word] = b",".join([b"%d" % i for i in merge(word, table)])
                ids.append(found)
            replies.append(pack(ids))
        return pd.DataFrame({"block": bucket["block"], "words": bucket["words"], "ids": replies})

    def reassemble(block: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        tokens = {b"%d" % rank: token for token, rank in ranks(path).items()}
        known: dict[str, tuple[bytes, bytes]] = {}
        for words, values in zip(replies["words"], replies["ids"]):
            for word, ids in zip(unpack(words), unpack(values)):
                known[word.decode()] = (ids, b"".join([tokens[i] for i in ids.split(b",")]))
        find, out = regex.compile(pattern).findall, {name: [] for name in (RESULT if with_ids else RESULT[:3])}
        rows = undealt(block["rows"])
        for text in rows["text"]:
            hits = [known[word] for word in find(text)]
            ids, decoded = map(bytes.join, (b",", b""), zip(*hits)) if hits else (b"", b"")
            out["n_tokens"].append(ids.count(b",") + 1 if hits else 0)
            out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
            if with_ids:
                out["ids"].append(np.array(ids.split(b",") if hits else [], np.int32))
                out["decoded"].append(decoded)
        return rows.drop(columns="text").assign(**out)

    # Both uses of the dealt rows read one shuffle.
    packed = dealt(rows)
    requests = packed.groupBy("block").applyInPandas(ask, "bucket long, block long, words binary")
    replies = requests.groupBy("bucket").applyInPandas(answer, "block long, words binary, ids binary")
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    schema = ", ".join(x for x in (kept, "n_tokens long, ids_sha256 string, decoded_sha256 string", "ids array<int>, decoded binary" * with_ids) if x)
    out = packed.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(reassemble, schema)
    results = out.columns[len(names) :]
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], *results)
