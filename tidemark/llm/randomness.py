"""Secrets in texts: fixed forms, and runs of characters that only a random source explains.

Fixed forms are assignments to a named secret, access keys and long hexadecimal runs. Other
candidates are maximal runs of at least SHORTEST letters, digits and `+ / _ -`, not touching a
fixed form, unless they have no letter: the digits of any long number look random, so the tests
say nothing about it. For each the encoding is inferred as the smallest alphabet that holds it, and a
battery of tests asks whether the symbols look independent and uniform over that alphabet:

- chi-squared uniformity (too uneven),
- the runs test around the middle of the alphabet (two-sided),
- serial correlation of neighbours (two-sided).

Their p-values are combined by Fisher's method; a candidate below RANDOM_LEVEL is not random.
What passes may still be an ordinary word that is too short to show it. So the chi-squared
statistic is also held against ordinary text: under the character frequencies of the whole
corpus (all characters outside candidates and fixed forms) its mean and variance at that length
and alphabet are known, and the lower tail is the p-value of the hypothesis `this is text`. The
longer a run, the further apart text and chance are. These p-values go through the
Benjamini-Hochberg procedure at FALSE_SHARE, over the distinct candidates of the corpus in each
band of lengths apart, so that many short words cannot hide or excuse long secrets.

Texts are read once. A table with one row per document (spans and the statistics of its
candidates, no text) is written; the frequencies, the counts of p-values by rounded logarithm
(p rounded up), and the spans come from it. The driver sees 128 frequencies and at most
31,000 counts for each of BANDS, whatever the corpus.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import Scratch

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
"""Characters that a match needs: its value for an assignment, itself for the others."""

KINDS = ("assign", "access", "hex", "random")

SHORTEST = 16
CANDIDATE = re.compile(rf"([A-Za-z0-9+/_-]{{{SHORTEST},}})={{0,2}}")
LETTER = re.compile("[A-Za-z]")

_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
ALPHABETS = {
    "hex": _DIGITS + _LOWER[:6],
    "upper hex": _DIGITS + _UPPER[:6],
    "lower letters": _LOWER,
    "upper letters": _UPPER,
    "base32": _UPPER + _DIGITS[2:8],
    "lower base36": _DIGITS + _LOWER,
    "upper base36": _DIGITS + _UPPER,
    "letters": _UPPER + _LOWER,
    "base62": _DIGITS + _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
    "any": _UPPER + _LOWER + _DIGITS + "+/-_",
}
"""Smallest first; the first that holds a run is its encoding."""

NAMES = list(ALPHABETS)
SIZES = np.array([len(a) for a in ALPHABETS.values()])
CODES = np.full((len(NAMES), 128), -1, dtype=np.int16)
for _i, _alphabet in enumerate(ALPHABETS.values()):
    CODES[_i, [ord(c) for c in _alphabet]] = np.arange(len(_alphabet))

BANDS = (16, 20, 24, 32, 48, 64)
"""Least lengths of the bands in which false discoveries are controlled."""

RANDOM_LEVEL = 0.001
FALSE_SHARE = 0.01
PER_DECADE = 100
"""Steps into which a factor of ten of p-values is divided."""


def fixed_forms(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed forms, leftmost without overlaps in each kind, by start and kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return sorted(found)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, str]]:
    """(start, end, run) of the runs that touch none of the spans `taken`; padding belongs to the span only."""
    out, at, reach = [], 0, -1
    for m in CANDIDATE.finditer(text):
        while at < len(taken) and taken[at][0] < m.end():
            reach, at = max(reach, taken[at][2]), at + 1
        if reach <= m.start() and LETTER.search(m.group(1)):
            out.append((m.start(), m.end(), m.group(1)))
    return out


def normal_tail(z: float) -> float:
    """P(Z >= z)."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(run: str) -> tuple[int, int, float, float, float]:
    """Encoding, pairs of equal symbols, and the p-values of uniformity, runs and serial correlation."""
    raw = np.frombuffer(run.encode("ascii"), dtype=np.uint8)
    encoding = int(np.argmax((CODES[:, np.unique(raw)] >= 0).all(axis=1)))
    codes, k, n = CODES[encoding, raw].astype(np.int64), int(SIZES[encoding]), len(raw)
    counts = np.bincount(codes, minlength=k)
    pairs = int((counts * (counts - 1) // 2).sum())
    # Chi-squared of n symbols over k cells is (k / n) * sum(count**2) - n; Wilson and Hilferty give its tail.
    chi = k / n * (2 * pairs + n) - n
    spread = 2 / (9 * (k - 1))
    uniform = normal_tail((np.cbrt(chi / (k - 1)) - 1 + spread) / math.sqrt(spread))
    high = codes * 2 >= k
    n1 = int(high.sum())
    n0 = n - n1
    if n1 and n0:
        mean = 1 + 2 * n1 * n0 / n
        deviation = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
        met = 1 + int((high[1:] != high[:-1]).sum())
        runs = min(1.0, 2 * normal_tail(max(abs(met - mean) - 0.5, 0) / deviation))
    else:
        runs = 2.0 ** (1 - min(n, 1000))
    away = codes - codes.mean()
    total = float((away * away).sum())
    serial = 2 * normal_tail(abs(float((away * np.roll(away, -1)).sum()) / total + 1 / (n - 1)) * math.sqrt(n)) if total else 0.0
    return encoding, pairs, uniform, runs, serial


def combined(*p: float) -> float:
    """Fisher's combination of p-values: the tail of chi-squared with two degrees of freedom for each."""
    half = -sum(math.log(max(x, 1e-300)) for x in p)
    return min(1.0, math.exp(-half) * sum(half**i / math.factorial(i) for i in range(len(p))))


def moments(frequencies: np.ndarray) -> np.ndarray:
    """Per alphabet, the sums of squares and cubes of the shares that its symbols have in text (128 counts, one added to each)."""
    out = []
    for alphabet in ALPHABETS.values():
        counts = frequencies[[ord(c) for c in alphabet]] + 1.0
        shares = counts / counts.sum()
        out.append([(shares**2).sum(), (shares**3).sum()])
    return np.array(out)


def text_step(encoding: int, n: int, pairs: int, shares: np.ndarray) -> int:
    """How far p of `this is text` is below 1, in steps of its logarithm, rounded down."""
    s2, s3 = shares[encoding]
    couples = n * (n - 1) / 2
    variance = couples * (s2 - s2 * s2) + couples * (n - 2) * 2 * (s3 - s2 * s2)
    p = normal_tail(-(pairs + 0.5 - couples * s2) / math.sqrt(max(variance, 1e-12)))
    return int(-math.log10(max(p, 1e-308)) * PER_DECADE)


def band(n: int) -> int:
    return int(np.searchsorted(BANDS, n, side="right")) - 1


def cuts(counts: dict[tuple[int, int], int], totals: dict[int, int], share: float = FALSE_SHARE) -> dict[int, int]:
    """Benjamini-Hochberg in each band: the least step whose p is at most share * rank / total.

    `counts`: distinct candidates by band and step among those that look random; `totals`: all
    distinct candidates of a band.
    """
    out: dict[int, int] = {}
    rank: dict[int, int] = {}
    for b, step in sorted(counts, reverse=True):
        rank[b] = rank.get(b, 0) + counts[b, step]
        if 10.0 ** (-step / PER_DECADE) <= share * rank[b] / totals[b]:
            out[b] = step
    return out


_SPANS = "array<struct<kind: int, start: long, end: long>>"
_FOUND = "array<struct<start: long, end: long, n: long, encoding: int, pairs: long, random: double, name: string>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
_FOUND_TYPE = pa.list_(
    pa.struct([("start", pa.int64()), ("end", pa.int64()), ("n", pa.int64()), ("encoding", pa.int32()), ("pairs", pa.int64()), ("random", pa.float64()), ("name", pa.string())])
)


def scanned(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`keep` columns (by default all but the text) of every row, and `findings`, `text_statistics`.

    `findings` are all spans by start and kind: kind, start, end (code points, end exclusive); the
    fixed forms and, as `random`, the candidates that pass. A candidate that touches a fixed form is
    part of it and not reported again. A null text counts as empty and has none. Every row of repeated
    rows has its own; copies of a candidate count once among the hypotheses. A text of any length is
    scanned whole, and a run of any length is one candidate. Columns of `docs` may have any names;
    one called `findings` gives way. An empty table has an empty result.
    """
    spark = docs.sparkSession
    names = [c for c in (docs.columns if keep is None else keep) if c not in ("findings", text_col)]
    rows = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    own = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    kept = f"{own}, " if own else ""
    table, _ = Scratch(spark, "secrets").keep(rows.mapInArrow(_scan, f"{kept}fixed {_SPANS}, found {_FOUND}, letters array<long>"))
    letters = table.where("letters IS NOT NULL").select(F.posexplode("letters").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect()
    frequencies = np.zeros(128)
    for row in letters:
        frequencies[row["at"]] = row["n"]
    shares = moments(frequencies)
    runs = table.where(F.size("found") > 0).select(F.explode("found").alias("f")).select("f.*").groupBy("name", "n", "encoding", "pairs").agg(F.max("random").alias("random"))
    steps = runs.mapInArrow(_steps(shares), "band int, step int").groupBy("band", "step").count().collect()
    totals: dict[int, int] = {}
    for row in steps:
        totals[row["band"]] = totals.get(row["band"], 0) + row["count"]
    passed = cuts({(r["band"], r["step"]): r["count"] for r in steps if r["step"] >= 0}, totals)
    result = table.where("letters IS NULL").mapInArrow(_judged(shares, passed), f"{kept}findings {_SPANS}")
    kinds = F.array(*map(F.lit, KINDS))
    named = F.transform("findings", lambda x: F.struct(kinds[x["kind"]].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return result.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], named.alias("findings"))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to spans and statistics; one more row per batch has the counts of ordinary characters."""
    for batch in batches:
        fixed, found, letters = [], [], np.zeros(256, dtype=np.int64)
        for value in batch.column("text"):
            text = value.as_py()
            spans = fixed_forms(text)
            runs = candidates(text, spans)
            letters += np.bincount(np.frombuffer(text.encode(), dtype=np.uint8), minlength=256)
            for part in [text[s:e] for s, _, e in spans] + [text[s:e] for s, e, _ in runs]:
                letters -= np.bincount(np.frombuffer(part.encode(), dtype=np.uint8), minlength=256)
            fixed.append([{"kind": kind, "start": s, "end": e} for s, kind, e in spans])
            stats = []
            for s, e, run in runs:
                encoding, pairs, *p = battery(run)
                name = hashlib.blake2b(run.encode(), digest_size=16).hexdigest()
                stats.append({"start": s, "end": e, "n": len(run), "encoding": encoding, "pairs": pairs, "random": combined(*p), "name": name})
            found.append(stats)
        columns = [batch.column(name) for name in batch.schema.names[1:]]
        columns = [pa.concat_arrays([c, pa.nulls(1, c.type)]) for c in columns]
        # Fixed forms of two kinds may share characters, which are then taken off twice.
        columns += [pa.array([*fixed, None], _SPAN_TYPE), pa.array([*found, None], _FOUND_TYPE)]
        columns.append(pa.array([None] * len(fixed) + [np.maximum(letters[:128], 0).tolist()], pa.list_(pa.int64())))
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[1:], "fixed", "found", "letters"])


def _steps(shares: np.ndarray):
    """Distinct candidates to band and step; step -1 if they do not look random."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("n", "encoding", "pairs", "random")))
            out = [(band(n), text_step(encoding, n, pairs, shares) if random >= RANDOM_LEVEL else -1) for n, encoding, pairs, random in rows]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int32()), pa.array([s for _, s in out], pa.int32())], ["band", "step"])

    return measure


def _judged(shares: np.ndarray, passed: dict[int, int]):
    """Rows with the fixed spans and those of the candidates beyond the cut of their band."""

    def secret(x: dict) -> bool:
        cut = passed.get(band(x["n"]))
        return cut is not None and x["random"] >= RANDOM_LEVEL and text_step(x["encoding"], x["n"], x["pairs"], shares) >= cut

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for fixed, found in zip(batch.column("fixed").to_pylist(), batch.column("found").to_pylist()):
                more = [{"kind": 3, "start": x["start"], "end": x["end"]} for x in found if secret(x)]
                spans.append(sorted(fixed + more, key=lambda x: (x["start"], x["kind"])))
            columns = [batch.column(name) for name in batch.schema.names[:-3]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, _SPAN_TYPE)], [*batch.schema.names[:-3], "findings"])

    return judge
