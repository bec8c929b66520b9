"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a probability of being toxic, a
logistic function of its words; a document is toxic when any of its sentences is, so
its probability is the noisy-or of theirs. Only documents are labelled: the gradient of
the noisy-or gives every sentence its share of the blame, and after training the model
points at the sentences that offend.

The model is fitted on a bounded sample of the labelled rows: at most `max_toxic` toxic
and `max_clean` other documents, chosen by a hash of their id and weighted back to their
shares. Its features are words and beginnings of words, at most `MAX_FEATURES`, chosen by a
likelihood-ratio test on that sample. Scoring covers every row and whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import least

MAX_TOXIC, MAX_CLEAN = 8_000, 12_000
"""Labelled documents of either class that the model is fitted on at most."""

MAX_FEATURES = 2000
"""Words and beginnings that the model may use at most."""

MIN_GAIN = 8.0
"""Smallest likelihood ratio (2 ln) of a feature that enters the model."""

PREFIXES = (3, 5, 7)
"""Lengths of the beginnings of words that count as words of their own."""

RESULT = ("toxicity", "sentence_start", "sentence_end", "sentence_score")

_SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]*")
_WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Start and end of each sentence; together they cover the text."""
    return [m.span() for m in _SENTENCE.finditer(text or "") if m.end() > m.start()]


def features_of(word: str) -> list[str]:
    """A word in lower case, and its beginnings, which stand for inflected forms."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) >= n)]


def features_in(text: str) -> set[str]:
    return {f for word in set(_WORD.findall(text.lower())) for f in features_of(word)}


class Lookup:
    """From a word to the numbers of its features in a model; remembers the words it has seen."""

    def __init__(self, index: dict[str, int], remembered: int = 50_000) -> None:
        self.index, self.seen, self.remembered = index, {}, remembered

    def bag(self, text: str) -> list[int]:
        """The known features of a sentence, as often as they occur."""
        seen, found = self.seen, []
        for word in _WORD.findall(text.lower()):
            hit = seen.get(word)
            if hit is None:
                if len(seen) >= self.remembered:
                    seen.clear()
                hit = seen[word] = tuple(self.index[f] for f in features_of(word) if f in self.index)
            if hit:
                found += hit
        return found


@dataclass
class Model:
    index: dict[str, int]
    weights: np.ndarray
    bias: float

    def scores(self, text: str | None, lookup: Lookup) -> tuple[float, int, int, float]:
        """P(toxic) of a text; start, end and probability of its worst sentence (the first of equals)."""
        log_clean, worst, at = 0.0, -np.inf, (0, 0)
        for a, b in sentences(text):
            found = lookup.bag(text[a:b])
            # A sentence without any known feature is no evidence, however many there are.
            logit = self.bias + sum(self.weights[i] for i in found) if found else -np.inf
            log_clean -= np.logaddexp(0.0, logit)
            if logit > worst or not at[1]:
                worst, at = logit, (a, b)
        chance = float(1 / (1 + np.exp(-worst))) if at[1] else 0.0
        return float(-np.expm1(log_clean)), *at, chance


def train(
    features: np.ndarray,
    lengths: np.ndarray,
    bags: np.ndarray,
    plain: np.ndarray,
    y: np.ndarray,
    importance: np.ndarray,
    n_words: int,
    steps: int = 300,
    rate: float = 0.3,
    prior: float = 4.0,
) -> tuple[np.ndarray, float]:
    """Weights and bias that maximise the noisy-or likelihood, by Adam on all bags at once.

    `features` lists those of all sentences one after another, `lengths` how many each
    sentence has, `bags` how many such sentences each document has, and `plain` how many
    without any known feature: they differ in nothing and enter as a count. `y` has the
    labels, `importance` how many documents each stands for. Weights have a normal prior
    of the deviation `prior`.
    """
    owner, rows, cols = np.repeat(np.arange(len(bags)), bags), np.repeat(np.arange(len(lengths)), lengths), features
    weights, bias = np.zeros(n_words), -4.0
    moment = np.zeros((2, n_words + 1))
    for step in range(1, steps + 1):
        logit = np.bincount(rows, weights[cols], len(owner)) + bias
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        q = 1 / (1 + np.exp(-bias))
        clean = np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-9)), len(y)) + plain * np.log1p(-q)
        toxic = np.maximum(-np.expm1(clean), 1e-9)
        # d log-likelihood / d logit of a sentence: p (y - toxic) / toxic of its document.
        share = importance * (y - toxic) / toxic
        slope = p * share[owner]
        gradient = np.append(np.bincount(cols, slope[rows], n_words), slope.sum() + (q * plain * share).sum()) / importance.sum()
        gradient[:-1] -= weights / (prior**2 * importance.sum())
        moment[0] = 0.9 * moment[0] + 0.1 * gradient
        moment[1] = 0.999 * moment[1] + 0.001 * gradient**2
        move = rate * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.999**step)) + 1e-8)
        move *= min(1.0, 2 * (1 - step / (steps + 1)))
        weights += move[:-1]
        bias = min(bias + move[-1], -1.0)
    return weights, bias


def sample(labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> DataFrame:
    """At most so many ids of each class from `id`, `label`, with `weight`: how many rows each stands for."""
    parts = []
    for label, most in ((1, max_toxic), (0, max_clean)):
        rows = labels.where((F.col("label") == label) & F.col("id").isNotNull()).select("id").distinct()
        n = rows.count()
        picked = least(rows, "id", most)
        parts.append(picked.select("id", F.lit(label).alias("label"), F.lit(max(n, 1) / max(min(n, most), 1)).alias("weight")))
    return parts[0].unionByName(parts[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label", **bounds: int) -> Model:
    """Fit on a sample of the rows of `labels` (0 or 1; others and nulls are passed over) that `docs` has.

    An id that is labelled both 0 and 1 counts once each way. Without documents of both
    classes the model has no features and gives every sentence the score 0.
    """
    ids = sample(labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label")), **bounds)
    # The sample is bounded, so it may go to every task; the texts stay where they are.
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = texts.join(F.broadcast(ids), "id").select("text", "label", "weight")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for text, label in zip(batch["text"], batch["label"]):
                for f in features_in(text or ""):
                    seen.setdefault(f, [0, 0])[label] += 1
            yield pd.DataFrame(
                {"feature": list(seen), "clean": [v[0] for v in seen.values()], "toxic": [v[1] for v in seen.values()]}
            )

    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    chosen: list[str] = []
    if n1 and n0:
        counts = rows.mapInPandas(counted, "feature string, clean long, toxic long").groupBy("feature")
        counts = counts.agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t")).where("c + t >= 3")
        cells = [("t", "c + t", n1), ("c", "c + t", n0), (f"{n1} - t", f"{n1 + n0} - c - t", n1), (f"{n0} - c", f"{n1 + n0} - c - t", n0)]
        gain = " + ".join(f"coalesce(({o}) * ln(nullif({o}, 0) * {n1 + n0}D / (nullif({m}, 0) * {k}D)), 0)" for o, m, k in cells)
        best = counts.select("feature", F.expr(f"2 * ({gain})").alias("gain")).where(F.col("gain") >= MIN_GAIN)
        chosen = [r["feature"] for r in best.orderBy(F.desc("gain"), "feature").limit(MAX_FEATURES).collect()]
    index = {f: i for i, f in enumerate(chosen)}

    def bagged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lookup = Lookup(index)
        for batch in batches:
            bags = [[lookup.bag(t[a:b]) for a, b in sentences(t)] for t in batch["text"].fillna("")]
            yield batch[["label", "weight"]].assign(
                plain=[sum(1 for s in b if not s) for b in bags],
                lengths=[np.array([len(s) for s in b if s], np.int32).tobytes() for b in bags],
                features=[np.array([f for s in b for f in s], np.int32).tobytes() for b in bags],
            )

    # Bounded by the sample: one row per document, numbers of known features only.
    rows = rows.mapInPandas(bagged, "label int, weight double, plain long, lengths binary, features binary").collect() if chosen else []
    if not rows:
        return Model({}, np.zeros(0), -6.0)
    rows.sort()
    lengths, features = ([np.frombuffer(r[name], np.int32) for r in rows] for name in ("lengths", "features"))
    weights, bias = train(
        np.concatenate(features),
        np.concatenate(lengths),
        np.array([len(x) for x in lengths]),
        np.array([r["plain"] for r in rows], float),
        np.array([r["label"] for r in rows], float),
        np.array([r["weight"] for r in rows]),
        len(chosen),
    )
    return Model(index, weights, bias)


def scored(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`keep` columns of every row (by default all but the text), `toxicity`, and the worst sentence of the text.

    `sentence_start` and `sentence_end` are places in the text, `sentence_score` is the
    probability of that sentence. A null or empty text has no sentence: score 0, places 0.
    """
    names = [c for c in docs.columns if c != text_col] if keep is None else keep
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col(f"`{text_col}`").alias("text"))
    kept = rows.columns[:-1]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lookup = Lookup(model.index)
        for batch in batches:
            found = [model.scores(t, lookup) for t in batch["text"]]
            yield batch[kept].assign(**{name: [f[i] for f in found] for i, name in enumerate(RESULT)})

    out = rows.mapInPandas(apply, f"{schema}, toxicity double, sentence_start int, sentence_end int, sentence_score double")
    return out.select(*[F.col(c).alias(n) for c, n in zip(kept, names)], *RESULT)
