"""Language-model scores by a probabilistic suffix tree.

A text is its words in lower case, each ended by a space, and an end symbol. The tree
predicts it byte by byte: its nodes are contexts of up to `DEPTH` bytes, of different
lengths. Every context of the training texts is a candidate, however rare. It is retained
when the next-symbol counts diverge from what its parent (the context less its oldest byte)
predicts, by `MIN_DIVERGENCE` nats over all its occurrences, or when a longer retained
context needs it. Distributions are smoothed towards the parent's. A place is predicted from
its longest retained suffix.

A word's probability is a fixed mixture of how the tree spells it and of its share of all
training words. Counts of words and of contexts cover the whole corpus and grow with it: they
stay distributed. Blocks of documents ask for their distinct words and grams (`DEPTH` symbols
and the one that follows) by hash. The tasks that add up the counts send each distinct gram
once to the task that has all grams with the same newest `STEM` symbols. It makes up that part
of the tree, since counts of shorter contexts are sums of those of grams, and sends back the
log probabilities, which go to the blocks that asked. Only contexts of fewer than `STEM`
symbols, whose number the symbols bound, are held whole.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.bpe import pack, unpack
from tidemark.llm.common import Scratch, block_count, dealt, undealt
from tidemark.llm.neardup import runs

DEPTH = 6
HEAD = 3
"""Symbols that are looked up at once where walks begin."""

STEM = 3
"""Contexts of fewer symbols are held whole, longer ones stay distributed by their newest `STEM` symbols."""

MIN_SHARE = 0.0
"""Share of all training positions that `grown` asks of a context; by default one occurrence is enough."""

MIN_DIVERGENCE = 5.0
PRIOR = 5.0
"""Weight, in occurrences, of the parent's distribution in a smoothed one."""

WORD_SHARE = 0.1
"""Weight of a word's own frequency against its spelling."""

SYMBOLS = 64
"""The most frequent bytes are symbols of their own; the last symbol stands for all others alike."""

BLOCK_BYTES = 16 << 20
BATCH_BYTES = 4 << 20
END = b"\n"


def spelled(text: str | bytes | None) -> bytes:
    """The bytes that the tree predicts for a text, behind `DEPTH` end symbols as its first context."""
    raw = (text or "").encode() if not isinstance(text, bytes) else text
    return joined_words(raw.lower().split())


def joined_words(words: list[bytes]) -> bytes:
    return END * DEPTH + b" ".join([*words, END]) if words else END * (DEPTH + 1)


def spelled_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"text": [spelled(text) for text in batch["text"]]})


def counts_of(batches: Iterator[pd.DataFrame], keys_of, cells: int) -> np.ndarray:
    """How often each key below `cells` occurs in spelled texts; `keys_of` gives the keys of a run of them."""
    total, held, size = np.zeros(cells, np.int64), [], 0
    for batch in batches:
        for text in batch["text"]:
            held.append(bytes(text))
            size += len(text)
            if size >= BATCH_BYTES:
                total += np.bincount(keys_of(held), minlength=cells)
                held, size = [], 0
    if held:
        total += np.bincount(keys_of(held), minlength=cells)
    return total


@dataclass
class Tree:
    symbol: np.ndarray
    """Symbol of each byte."""

    spread: np.ndarray
    """Natural logarithm of a byte's share of its symbol, per byte."""

    size: int
    steps: list[np.ndarray]
    """For each depth, from candidate and next older symbol to the longer candidate.

    The number after the last candidate of a depth stands for none; it leads to none again.
    """

    retained: list[np.ndarray]
    logs: list[np.ndarray]
    """For each depth, natural logarithms of the smoothed distributions of the candidates."""

    walks: list[np.ndarray]
    """The steps between retained contexts only."""

    first: np.ndarray | None = None
    """Where walks begin: for the last `HEAD` symbols of a place, the retained context of that length, or none."""

    first_rows: np.ndarray | None = None
    first_logs: np.ndarray | None = None
    """For the last `HEAD` symbols, the row of the longest retained context of up to `HEAD` symbols in `first_logs`."""

    chances: list[np.ndarray] = field(default_factory=list)
    """For each depth, the smoothed distributions of the candidates."""

    def heads(self, steps: list[np.ndarray]) -> list[np.ndarray]:
        """For each number of steps up to `HEAD`, where they lead from the root, by all the symbols they could meet."""
        found = [np.zeros(1, np.int32)]
        for step in steps[:HEAD]:
            found.append(step[(found[-1][:, None] * np.int32(self.size) + np.arange(self.size, dtype=np.int32)).ravel()])
        return found

    def last(self, symbols: np.ndarray, n: int) -> np.ndarray:
        """The last `n` symbols before each place from `DEPTH` on as one number, the newest first."""
        number = symbols[DEPTH - 1 : len(symbols) - 1]
        for d in range(1, n):
            number = number * np.int32(self.size) + symbols[DEPTH - d - 1 : len(symbols) - d - 1]
        return number

    def grams(self, raw: np.ndarray) -> np.ndarray:
        """The last `DEPTH` symbols before each place from `DEPTH` on, the newest first, and its own, as one number."""
        symbols = self.symbol[raw].astype(np.int64)
        return self.last(symbols, DEPTH) * self.size + symbols[DEPTH:]

    def distributions(self, depth: int) -> np.ndarray:
        """For all contexts of a depth up to `HEAD`, the newest symbol first, the distribution of the longest candidate."""
        return np.concatenate(self.chances[: depth + 1])[_longest(self, self.heads(self.steps)[: depth + 1])]

    def keep(self, contexts: np.ndarray) -> None:
        """Retain candidates of the last depth (up to `HEAD`), given as numbers, since longer ones elsewhere need them."""
        self.retained[-1][self.heads(self.steps)[-1][contexts]] = True
        _link(self)

    def states(self, symbols: np.ndarray, depth: int, heads: list[np.ndarray]) -> np.ndarray:
        """The candidates of a depth that the places from `DEPTH` on have behind them; `heads` of the steps."""
        begun = min(HEAD, depth)
        state = heads[begun][self.last(symbols, begun)]
        for d in range(begun, depth):
            state = self.steps[d][state * np.int32(self.size) + symbols[DEPTH - d - 1 : len(symbols) - d - 1]]
        return state

    def log_probabilities(self, raw: np.ndarray) -> np.ndarray:
        """Natural log probability of every byte of spelled texts from the place `DEPTH` on.

        A retained context's parent is retained, so a place is done at the first context that can't be made longer.
        """
        symbols, size = self.symbol[raw], np.int32(self.size)
        begun = min(HEAD, len(self.walks))
        number = self.last(symbols, begun)
        best = self.first_logs.ravel()[self.first_rows[number] * size + symbols[DEPTH:]]
        state = self.first[number]
        live = np.flatnonzero(state < len(self.logs[begun])).astype(np.int32)
        state = state[live]
        for d in range(begun, len(self.logs)):
            if d < len(self.walks):
                step = self.walks[d]
                longer = step[state * size + symbols[live + np.int32(DEPTH - d - 1)]]
                more = longer < step[-1]
                done = np.flatnonzero(~more)
                ended, last = live[done], state[done]
                live, state = live[more], longer[more]
            else:
                ended, last = live, state
            best[ended] = self.logs[d].ravel()[last * size + symbols[ended + np.int32(DEPTH)]]
        return best + self.spread[raw[DEPTH:]]


def _counted(texts: DataFrame, keys_of, cells: int) -> DataFrame:
    """`key`, `count` over all texts, of keys that occur."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = counts_of(batches, keys_of, cells)
        keys = np.flatnonzero(counts)
        for at in range(0, len(keys), 100_000):
            part = keys[at : at + 100_000]
            yield pd.DataFrame({"key": part, "count": counts[part]})

    return texts.mapInPandas(count, "key long, count long").groupBy("key").agg(F.sum("count").alias("count"))


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of some texts, and which places are predicted: not the first context of each."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum([0, *map(len, texts[:-1])])
    predicted = np.ones(len(data), bool)
    predicted[(starts[:, None] + np.arange(DEPTH)).ravel()] = False
    return data, predicted


def _pairs(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    found = df.toPandas()
    return found["key"].to_numpy(np.int64), found["count"].to_numpy(np.int64)


def grown(texts: DataFrame, depth: int = DEPTH, min_share: float = MIN_SHARE) -> tuple[Tree, int, int]:
    """The tree of all rows of `text`, the number of their words, and the number of rows.

    It is held in one piece, with a table of next symbols for each context up to `depth`.
    Texts are spelled once, and written for the passes that count.
    """
    scratch = Scratch(texts.sparkSession, "spelled")
    texts, written = scratch.keep(texts.select("text").mapInPandas(spelled_texts, "text binary"))

    def bytes_of(run: list[bytes]) -> np.ndarray:
        data, predicted = _joined(run)
        return data[predicted]

    keys, counts = _pairs(_counted(texts, bytes_of, 256))
    bytes_seen = np.zeros(256, np.int64)
    bytes_seen[keys] = counts
    total = int(bytes_seen.sum())
    # The most frequent bytes, of equals the smaller; space and end always have a symbol.
    ranked = sorted(range(256), key=lambda b: (b not in (32, 10), -bytes_seen[b], b))
    size = SYMBOLS
    symbol = np.full(256, size - 1, np.int32)
    symbol[ranked[: size - 1]] = np.arange(size - 1)
    spread = np.where(symbol == size - 1, -np.log(256 - (size - 1)), 0.0)
    need = max(1, int(np.ceil(min_share * total)))
    tree = Tree(symbol, spread, size, [], [], [], [])

    def trigrams(run: list[bytes]) -> np.ndarray:
        data, predicted = _joined(run)
        s = symbol[data]
        return ((s[:-2] * size + s[1:-1]) * size + s[2:])[predicted[2:]]

    cube = np.zeros(size**3, np.int64)
    keys, counts = _pairs(_counted(texts, trigrams, size**3))
    cube[keys] = counts
    cube = cube.reshape(size, size, size)
    tables = [cube.sum(axis=(0, 1))[None, :]]
    seen = cube.sum(axis=(0, 2))  # occurrences of each context of one symbol
    one = np.flatnonzero(seen >= need)
    tables.append(cube.sum(axis=0)[one])
    tree.steps.append(_step(1, size, one))
    two = np.argwhere(cube.sum(axis=2) >= need)  # older symbol, newer symbol
    two = two[np.isin(two[:, 1], one)]
    place = {s: i for i, s in enumerate(one.tolist())}
    keyed = np.array([place[b] * size + a for a, b in two.tolist()], np.int64)
    order = np.argsort(keyed)
    tree.steps.append(_step(len(one), size, keyed[order]))
    tables.append(cube[two[order, 0], two[order, 1]] if len(two) else np.zeros((0, size), np.int64))
    # Longer contexts: a pass for each depth. Extensions of a depth come with the counts of the one before.
    extended = _extensions(texts, tree, 2, need) if depth > 2 else None
    for d in range(3, depth + 1):
        tree.steps.append(_step(len(tables[-1]), size, extended))
        table, extended = _next_counts(texts, tree, d, need, len(extended))
        tables.append(table)
    scratch.drop(written)
    _smooth(tree, tables)
    return tree, int(bytes_seen[32]), int(bytes_seen[10])


def _step(states: int, size: int, kept: np.ndarray) -> np.ndarray:
    step = np.full((states + 1) * size, len(kept), np.int32)
    step[kept] = np.arange(len(kept))
    return step


def _placed(tree: Tree, heads: list[np.ndarray], run: list[bytes], depth: int, states: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of some texts, and the candidates of a depth at the predicted places, `states` for none."""
    data, predicted = _joined(run)
    symbols = tree.symbol[data]
    state = tree.states(symbols, depth, heads)
    return symbols, np.where(predicted[DEPTH:], state, np.int32(states))


def _extensions(texts: DataFrame, tree: Tree, depth: int, need: int) -> np.ndarray:
    """Candidates of one symbol more than `depth`, as state and symbol."""
    states, heads = int(tree.steps[depth - 1].max()), tree.heads(tree.steps)

    def keys(run: list[bytes]) -> np.ndarray:
        symbols, state = _placed(tree, heads, run, depth, states)
        return state * np.int32(tree.size) + symbols[DEPTH - depth - 1 : len(symbols) - depth - 1]

    found, counts = _pairs(_counted(texts, keys, (states + 1) * tree.size).where((F.col("count") >= need) & (F.col("key") < states * tree.size)))
    return np.sort(found)


def _next_counts(texts: DataFrame, tree: Tree, depth: int, need: int, states: int) -> tuple[np.ndarray, np.ndarray]:
    """Next-symbol counts of the candidates of a depth, and the candidates one deeper."""
    half, longest, heads = (states + 1) * tree.size, depth == DEPTH, tree.heads(tree.steps)

    def keys(run: list[bytes]) -> np.ndarray:
        symbols, state = _placed(tree, heads, run, depth, states)
        own = state * np.int32(tree.size)
        following = own + symbols[DEPTH:]
        if longest:
            return following
        return np.concatenate([following, own + symbols[DEPTH - depth - 1 : len(symbols) - depth - 1] + np.int32(half)])

    counts = _counted(texts, keys, half if longest else 2 * half)
    found, number = _pairs(counts.where((F.col("key") < half) | (F.col("count") >= need)))
    table = np.zeros(half, np.int64)
    table[found[found < half]] = number[found < half]
    deeper = found[found >= half] - half
    return table.reshape(states + 1, tree.size)[:-1], np.sort(deeper[deeper < states * tree.size])


def _smooth(tree: Tree, tables: list[np.ndarray]) -> None:
    root = tables[0] + 1.0
    chances = [root / root.sum()]
    gains = [np.array([np.inf])]
    for d, table in enumerate(tables[1:]):
        parents = _parents(tree, d)
        expected, n = chances[d][parents], table.sum(axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(table > 0, table * np.log(table / n / expected), 0.0).sum(axis=1)
        gains.append(gain)
        chances.append((table + PRIOR * expected) / (n + PRIOR))
    tree.retained = [g >= MIN_DIVERGENCE for g in gains]
    tree.logs = [np.log(c).astype(np.float32) for c in chances]
    tree.chances = chances
    _link(tree)


def _link(tree: Tree) -> None:
    """The ways between retained contexts; what a retained context extends is retained too."""
    for d in range(len(tree.logs) - 1, 0, -1):
        tree.retained[d - 1][_parents(tree, d - 1)[tree.retained[d]]] = True
    tree.walks = []
    for d, step in enumerate(tree.steps):
        kept = np.append(tree.retained[d + 1], False)
        tree.walks.append(np.where(kept[step], step, np.int32(len(tree.logs[d + 1]))))
    heads = tree.heads(tree.walks)
    tree.first, tree.first_logs = heads[-1], np.concatenate(tree.logs[: len(heads)])
    tree.first_rows = _longest(tree, heads)


def _longest(tree: Tree, heads: list[np.ndarray]) -> np.ndarray:
    """For all the symbols of the last of `heads`, the longest context they lead to, counted through all depths."""
    rows, above = np.zeros(1, np.int32), 0
    for d, head in enumerate(heads[1:], 1):
        above += len(tree.logs[d - 1])
        rows = np.where(head < len(tree.logs[d]), above + head, np.repeat(rows, tree.size))
    return rows.astype(np.int32)


def _parents(tree: Tree, depth: int) -> np.ndarray:
    """For each candidate one longer than `depth`, the one it extends, in their order."""
    step = tree.steps[depth]
    return np.flatnonzero(step[: -tree.size] < step[-1]) // tree.size


def _press(numbers: np.ndarray) -> bytes:
    """Numbers by places of their bytes, compressed."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.dtype.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(planes.T.tobytes())


def _unpress(value: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(value), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _press_sorted(keys: np.ndarray) -> bytes:
    return _press(np.diff(keys, prepend=0))


def _unpress_sorted(value: bytes) -> np.ndarray:
    return np.cumsum(_unpress(value, np.int64))


def _spread_over(numbers: np.ndarray, parts: int) -> np.ndarray:
    """A part for each number, by hash."""
    return (numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % parts


def _split(parts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each part that occurs, and where, in order."""
    order = np.argsort(parts, kind="stable")
    starts = np.flatnonzero(np.diff(parts[order], prepend=-1))
    for at in np.split(order, starts[1:]) if len(order) else []:
        yield int(parts[at[0]]), at


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.add.reduceat(counts[order], starts) if len(starts) else counts


def _gram_counts(tree: Tree, spelled_runs: Iterator[tuple[bool, list[bytes]]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of runs of spelled texts, and how often they occur in those that are not held out."""
    parts, pending, places = [], [], 0

    def fold() -> None:
        values = np.concatenate(pending)
        values.sort()
        starts = np.flatnonzero(np.diff(values, prepend=-1))
        parts.append((values[starts] >> 1, np.diff(starts, append=len(values)) * (values[starts] & 1)))
        pending.clear()

    for held, texts in spelled_runs:
        raw, predicted = _joined(texts)
        # The last bit marks what counts.
        pending.append(tree.grams(raw)[predicted[DEPTH:]] * 2 + (not held))
        places += len(raw)
        if places >= BATCH_BYTES:
            fold()
            places = 0
    if pending:
        fold()
    return _summed(*map(np.concatenate, zip(*parts)))


def _subtrees(keys: np.ndarray, counts: np.ndarray, size: int, above: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Natural log probability of each gram, nan where no context of `STEM` or more symbols is retained.

    `keys` are distinct and in order, and have all grams of the training texts with the same newest
    `STEM` symbols; `above` are the distributions of all contexts of one symbol fewer. Also the
    contexts of one symbol fewer, as numbers, which a retained one extends.
    """
    levels, pairs, up = [], keys, None
    for d in range(DEPTH, STEM - 1, -1):
        contexts = pairs // size
        fresh = np.diff(contexts, prepend=-1) > 0
        levels.append((pairs, counts, np.flatnonzero(fresh), np.cumsum(fresh) - 1, up))
        if d > STEM:
            pairs, up = np.unique(contexts // size * size + pairs % size, return_inverse=True)
            counts = np.bincount(up, counts, len(pairs)).astype(np.int64)
    levels.reverse()  # the last has `DEPTH` symbols; `up` of a level leads from the next one to it
    stems = levels[0][0][levels[0][2]] // size**2
    expected = above[levels[0][0] // size**2, levels[0][0] % size]
    chances, retained = [], []
    for d, (pairs, counts, starts, owner, _) in enumerate(levels):
        if d:
            expected = chances[-1][levels[d - 1][4]]
        n = np.add.reduceat(counts, starts)[owner]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(counts > 0, counts * np.log(counts / n / expected), 0.0)
        retained.append(np.add.reduceat(gain, starts) >= MIN_DIVERGENCE)
        chances.append((counts + PRIOR * expected) / (n + PRIOR))
    for d in range(len(levels) - 1, 0, -1):
        parents = levels[d - 1][3][levels[d - 1][4][levels[d][2]]]
        retained[d - 1][parents[retained[d]]] = True
    logs = np.full(len(levels[0][0]), np.nan)
    for d, (pairs, counts, starts, owner, _) in enumerate(levels):
        logs = np.where(retained[d][owner], np.log(chances[d]), logs[levels[d - 1][4]] if d else logs)
    return logs.astype(np.float32), np.unique(stems[retained[0]])


def scored(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of `docs`: id, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`.

    Rows where `held_out` is true are scored only; null counts as true. Null and empty texts
    have one token, the end. Scores are decimal logarithms. Without training rows every
    base probability is that of an unseen token and the tree is uniform. Repeated rows stay
    repeated; ids may be null; other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffixtree")
    blocks = block_count(docs, f"`{text_col}`", block_bytes)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(f"`{id_col}`"), text), F.lit(blocks)).alias("block"),
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(held_out, F.lit(True)).alias("held_out"),
        text.alias("text"),
    )
    tree, n_words, n_ends = grown(rows.where("NOT held_out").select("text"), STEM - 1)
    size, above = tree.size, tree.distributions(STEM - 1)

    def ask(block: pd.DataFrame) -> pd.DataFrame:
        counts: Counter[bytes] = Counter()
        rows = undealt(block["rows"])

        def spelled_runs() -> Iterator[tuple[bool, list[bytes]]]:
            for held, group in rows.groupby("held_out"):
                texts = [text.encode() for text in group["text"]]
                for part in runs(texts, BATCH_BYTES // 4):
                    words = [text.lower().split() for text in texts[part]]
                    for some in words:
                        counts.update(dict.fromkeys(some, 0) if held else some)
                    yield held, [joined_words(some) for some in words]

        keys, seen = _gram_counts(tree, spelled_runs())
        parts: dict[int, tuple[list, list]] = {}
        for word in sorted(counts):
            words, numbers = parts.setdefault(zlib.crc32(word) % blocks, ([], []))
            words.append(word)
            numbers.append(counts[word])
        del counts
        # Grams that differ in the oldest and the last symbol only stay together, which packs well.
        grams = {b: (_press_sorted(keys[at]), _press(seen[at])) for b, at in _split(_spread_over(keys // size**2, blocks))}
        none = np.zeros(0, np.int64)
        nothing = (_press_sorted(none), _press(none))
        buckets = sorted({*parts, *grams})
        return pd.DataFrame(
            {
                "bucket": buckets,
                "block": int(block["block"].iloc[0]),
                "words": [pack(parts[b][0] if b in parts else []) for b in buckets],
                "counts": [np.array(parts[b][1] if b in parts else [], np.int64).tobytes() for b in buckets],
                "grams": [grams.get(b, nothing)[0] for b in buckets],
                "seen": [grams.get(b, nothing)[1] for b in buckets],
            }
        )

    def add(bucket: pd.DataFrame) -> pd.DataFrame:
        keys, seen = _summed(np.concatenate([*map(_unpress_sorted, bucket["grams"])]), np.concatenate([_unpress(v, np.int64) for v in bucket["seen"]]))
        parts = dict(_split(_spread_over(keys // size ** (DEPTH + 1 - STEM), blocks)))
        number = int(bucket["bucket"].iloc[0])
        return pd.DataFrame(
            {
                "stem": list(parts),
                "bucket": number,
                "grams": [_press_sorted(keys[at]) for at in parts.values()],
                "seen": [_press(seen[at]) for at in parts.values()],
            }
        )

    def grow(stem: pd.DataFrame) -> pd.DataFrame:
        asked = [*map(_unpress_sorted, stem["grams"])]
        keys, seen = np.concatenate(asked), np.concatenate([_unpress(v, np.int64) for v in stem["seen"]])
        order = np.argsort(keys)
        logs = np.zeros(len(keys), np.float32)
        logs[order], stems = _subtrees(keys[order], seen[order], size, above)
        ends = np.cumsum([*map(len, asked)])
        return pd.DataFrame(
            {
                "bucket": stem["bucket"],
                "grams": stem["grams"],
                "logs": [*map(_press, np.split(logs, ends[:-1]))],
                "stems": [stems.tolist(), *[[]] * (len(asked) - 1)],
            }
        )

    def answer(bucket: pd.DataFrame, grown: pd.DataFrame) -> pd.DataFrame:
        asked = [unpack(w) for w in bucket["words"]]
        total: dict[bytes, int] = {}
        for words, counts in zip(asked, bucket["counts"]):
            for word, n in zip(words, np.frombuffer(counts, np.int64).tolist()):
                total[word] = total.get(word, 0) + n
        distinct = np.zeros(len(bucket), np.int64)
        distinct[:1] = sum(1 for n in total.values() if n)
        keys = np.concatenate([np.zeros(0, np.int64), *map(_unpress_sorted, grown["grams"])])
        logs = np.concatenate([np.zeros(0, np.float32), *[_unpress(v, np.float32) for v in grown["logs"]]])
        order = np.argsort(keys)
        keys, logs = keys[order], logs[order]
        stems = sorted({int(n) for some in grown["stems"] for n in some})
        return pd.DataFrame(
            {
                "block": bucket["block"],
                "words": bucket["words"],
                "counts": [np.array([total[w] for w in words], np.int64).tobytes() for words in asked],
                "distinct": distinct,
                "grams": bucket["grams"],
                "logs": [_press(logs[np.searchsorted(keys, _unpress_sorted(v))]) for v in bucket["grams"]],
                "stems": [stems, *[[]] * (len(bucket) - 1)],
            }
        )

    packed = dealt(rows)
    requests = packed.groupBy("block").applyInPandas(ask, "bucket long, block long, words binary, counts binary, grams binary, seen binary")
    # Both uses of the requests read one shuffle.
    added = requests.groupBy("bucket").applyInPandas(add, "stem long, bucket long, grams binary, seen binary")
    parts = added.groupBy("stem").applyInPandas(grow, "bucket long, grams binary, logs binary, stems array<int>")
    replied = "block long, words binary, counts binary, distinct long, grams binary, logs binary, stems array<int>"
    replies, _ = scratch.keep(requests.groupBy("bucket").cogroup(parts.groupBy("bucket")).applyInPandas(answer, replied))
    tree.keep(np.array([r[0] for r in replies.select(F.explode("stems")).distinct().collect()], np.int64))
    distinct = (replies.agg(F.sum("distinct")).first()[0] or 0) + (n_ends > 0)
    n = n_words + n_ends
    unit = float(np.log10(n + 0.1 * (distinct + 1)))

    def score(block: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        known: dict[bytes, int] = {}
        for words, counts in zip(replies["words"], replies["counts"]):
            known.update(zip(unpack(words), np.frombuffer(counts, np.int64).tolist()))
        grams = np.concatenate([*map(_unpress_sorted, replies["grams"])])
        chances = np.concatenate([_unpress(v, np.float32) for v in replies["logs"]])
        short = np.flatnonzero(np.isnan(chances))
        newest = grams[short] // size ** (DEPTH + 2 - STEM)
        chances[short] = tree.first_logs[tree.first_rows[newest], grams[short] % size]
        places = pd.Index(grams)
        rows, parts = undealt(block["rows"]), []
        texts = [text.encode() for text in rows["text"]]
        for part in runs(texts, BATCH_BYTES // 8):
            words = [text.lower().split() for text in texts[part]]
            counts = np.array([c for some in words for c in (*map(known.__getitem__, some), n_ends)], float)
            raw, predicted = _joined([joined_words(some) for some in words])
            at = places.get_indexer(tree.grams(raw)[predicted[DEPTH:]])
            raw = raw[predicted]
            logs = chances[at] + tree.spread[raw]
            # A token ends with its space; the end symbol is the last token of its text.
            last = np.flatnonzero((raw == 32) | (raw == 10))
            tokens = np.add.reduceat(logs, np.append(0, last[:-1] + 1))
            with np.errstate(divide="ignore"):
                mixed = np.logaddexp(tokens + np.log(1 - WORD_SHARE), np.log(counts / max(n, 1) * WORD_SHARE))
            lengths = np.array([len(some) + 1 for some in words])
            first = np.cumsum(lengths) - lengths
            parts.append(
                pd.DataFrame(
                    {
                        "n_tokens": lengths,
                        "n_known": np.add.reduceat((counts > 0).astype(np.int64), first),
                        "train_tokens": n,
                        "base_score": np.add.reduceat(np.log10(counts + 0.1), first) - unit * lengths,
                        "score": np.add.reduceat(mixed, first) / np.log(10),
                    }
                )
            )
        return pd.concat([rows[["id", "held_out"]], pd.concat(parts, ignore_index=True)], axis=1)

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    replies = replies.drop("distinct", "stems")
    found = packed.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(score, schema)
    return found.withColumnRenamed("id", id_col)
