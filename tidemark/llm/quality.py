"""Document quality by regularised quadratic discriminant analysis.

Every document is described by statistics of its whole text (length, case, symbols,
digits, white space, word lengths, repetition), transformed to be roughly normal. Each
class is a Gaussian whose covariance is shrunk towards a multiple of the identity. A
score is the logistic of the difference of the two log densities and priors; densities
come from Mahalanobis distances through Cholesky factors that are computed once and
sent to the tasks (a few hundred numbers, whatever the corpus).

Class moments are plain aggregates over all labelled rows: no row reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

FEATURES = (
    "log_bytes upper symbols digits spaces other word_length long_words distinct repeats pairs marked line_length".split()
)

SHRINKAGE = 0.03
"""Weight of the identity in a class covariance, between 0 and 1."""

SHORT_BYTES, SHORT_WORDS = 64, 16
"""What is added to the lengths that counts are divided by."""

# ASCII bytes that are neither letters, digits, white space nor the marks of ordinary prose.
SYMBOLS = b"!\"#$%&()*+/:;<=>?@[\\]^_`{|}~"
_KIND = np.zeros(256, np.uint8)
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[list(SYMBOLS)] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[[9, 10, 11, 12, 13, 32]] = 4
_KIND[128:] = 5


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one text; null and empty give those of no bytes."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=6)
    words = raw.split()
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    follow = list(zip(words, words[1:]))
    marked = sum(1 for w in words if w[-1] in SYMBOLS)
    # Shares of a short text are drawn to 0: a single number in it says little.
    share = lambda part, whole: float(np.sqrt(part / whole))
    size, count = len(raw) + SHORT_BYTES, len(words) + SHORT_WORDS
    return [
        float(np.log1p(len(raw))),
        share(kinds[1], size),
        share(kinds[2], size),
        share(kinds[3], size),
        share(kinds[4], size),
        share(kinds[5], size),
        float(np.log1p(lengths.mean())),
        share((lengths > 20).sum(), count),
        float(np.log((len(set(words)) + SHORT_WORDS) / count) / np.log(count)),
        share(sum(1 for a, b in follow if a == b), count),
        share(len(follow) - len(set(follow)), count),
        share(marked, count),
        float(np.log1p(len(raw) / (raw.count(b"\n") + 1))),
    ]


def with_statistics(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """`keep` columns and the array `features`; texts stay in their tasks."""
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.col(f"`{text_col}`").alias("text"))
    kept = rows.columns[:-1]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[kept].assign(features=[statistics(t) for t in batch["text"]])

    return rows.mapInPandas(measured, f"{schema}, features array<double>")


@dataclass
class Discriminant:
    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    offsets: list[float]
    """Log prior less half the log determinant, per class."""

    def score(self, features: np.ndarray) -> np.ndarray:
        """P(class 1) of each row of features."""
        x = (features - self.centre) / self.scale
        logs = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets):
            z = np.linalg.solve(factor, (x - mean).T)
            logs.append(offset - 0.5 * (z * z).sum(axis=0))
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def fit(rows: DataFrame, label: Column, shrinkage: float = SHRINKAGE) -> Discriminant:
    """Fit on all rows with `features` and a label of 0 or 1; other labels are passed over.

    The sums of a class are taken as one flat array per partition and added up by Spark.
    A class without rows gets the moments of the other one and an even prior; without
    any labelled row every score is 0.5.
    """
    d = len(FEATURES)
    width = 1 + d + d * d
    labelled = rows.select("features", label.cast("int").alias("label")).where("label IN (0, 1)")

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, width))
        for batch in batches:
            x, y = np.array(batch["features"].tolist()).reshape(-1, d), batch["label"].to_numpy()
            for k in (0, 1):
                part = x[y == k]
                total[k] += np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part).ravel()])
        yield pd.DataFrame({"label": np.repeat([0, 1], width), "at": np.tile(np.arange(width), 2), "value": total.ravel()})

    parts = labelled.mapInPandas(sums, "label int, at int, value double")
    moments = np.zeros((2, width))
    # 2 * width rows whatever the corpus.
    for row in parts.groupBy("label", "at").agg(F.sum("value").alias("value")).collect():
        moments[row["label"], row["at"]] = row["value"]
    n = moments[:, 0]
    if n.sum() == 0:
        eye = np.eye(d)
        return Discriminant(np.zeros(d), np.ones(d), [np.zeros(d)] * 2, [eye, eye], [0.0, 0.0])
    both = moments.sum(axis=0)
    centre = both[1 : d + 1] / both[0]
    variance = np.diag(both[d + 1 :].reshape(d, d)) / both[0] - centre**2
    scale = np.sqrt(np.maximum(variance, 1e-9))
    means, factors, offsets = [], [], []
    for k in (0, 1):
        m = moments[k] if n[k] else moments[1 - k]
        mean = m[1 : d + 1] / m[0]
        covariance = (m[d + 1 :].reshape(d, d) / m[0] - np.outer(mean, mean)) / np.outer(scale, scale)
        covariance = (1 - shrinkage) * covariance + shrinkage * max(np.trace(covariance) / d, 1e-3) * np.eye(d)
        factor = np.linalg.cholesky(covariance)
        prior = n[k] / n.sum() if n.all() else 0.5
        means.append((mean - centre) / scale)
        factors.append(factor)
        offsets.append(float(np.log(prior) - np.log(np.diag(factor)).sum()))
    return Discriminant(centre, scale, means, factors, offsets)


def scored(rows: DataFrame, model: Discriminant) -> DataFrame:
    """`rows` with `features` replaced by `score`."""
    kept = [c for c in rows.columns if c != "features"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "features")
    d = len(FEATURES)

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch["features"].tolist()).reshape(-1, d)
            yield batch[kept].assign(score=model.score(x))

    return rows.mapInPandas(apply, f"{schema}, score double")
