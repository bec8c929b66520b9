import math
import random
import string

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import CLASHING, ODD, frame
from tidemark.llm import randomness
from tidemark.llm.randomness import FALSE_SHARE, NAMES, PER_DECADE, SIZES, band, battery, candidates, combined, cuts, fixed_forms, moments, scanned, text_step

VALUE = set(string.ascii_letters + string.digits + "+/_.=-")
NAMED = ("password", "passwd", "secret", "token", "apikey", "api_key")


def at(text, i, chars):
    """End of the longest stretch of `chars` from i on."""
    while i < len(text) and text[i] in chars:
        i += 1
    return i


def brute_fixed(text):
    """The fixed forms by hand, without a regular expression."""
    out, i = [], 0
    small = "".join(c.lower() if c.isascii() else c for c in text)
    while i < len(text):
        end = None
        for name in NAMED:
            if small.startswith(name, i):
                # Marks are optional, and taken where possible; a value cannot start with one.
                j = i + len(name)
                j += text[j : j + 1] in ("'", '"') and text[j : j + 1] != ""
                j = at(text, j, " ")
                if text[j : j + 1] in (":", "=") and text[j : j + 1]:
                    j = at(text, j + 1, " ")
                    j += text[j : j + 1] in ("'", '"') and text[j : j + 1] != ""
                    k = at(text, j, VALUE)
                    if k > j:
                        end = (j, k)
                        break
        if end:
            if end[1] - end[0] >= 6:
                out.append((i, 0, end[1]))
            i = end[1]
        else:
            i += 1
    i = 0
    while i < len(text):
        k = at(text, i + 4, set(string.ascii_uppercase + string.digits)) if text.startswith("AKIA", i) else i
        if k > i + 4:
            out += [(i, 1, k)] if k - i >= 20 else []
            i = k
        else:
            i += 1
    i = 0
    while i < len(text):
        k = at(text, i, set("0123456789abcdef"))
        out += [(i, 2, k)] if k - i >= 24 else []
        i = max(k, i + 1)
    return sorted(out)


def token(r, alphabet, n):
    return "".join(r.choice(alphabet) for _ in range(n))


B64 = string.ascii_letters + string.digits + "+/"


def test_fixed_forms_against_a_scanner_by_hand():
    r = random.Random(5)
    bits = ["password", "PassWd", "secret", "toKen", "api_key", "APIKEY", "tokenſecret", "=", ":", " ", "  ", "'", '"', "\n", "AKIA", "AKIAAKIA", "é", "=="]
    bits += ["x", "abcdef", "abc123", "0123456789abcdef", "ABCDEFGH12345678", "0a" * 12, "K", "pass"]
    for _ in range(4000):
        text = "".join(r.choice(bits) for _ in range(r.randint(1, 12)))
        assert fixed_forms(text) == brute_fixed(text), text


def test_candidates_touch_no_fixed_form_and_have_a_letter():
    text = "password = Zm9vYmFyYmF6cXV4/plus zaaaaaaaaaaaaaaaaaaaaaa1== 4111-1111-1111-1111-1111 éZm9vYmFyYmF6cXV4"
    found = [text[s:e] for s, e, _ in candidates(text, fixed_forms(text))]
    assert found == ["zaaaaaaaaaaaaaaaaaaaaaa1==", "Zm9vYmFyYmF6cXV4"]


def test_statistics_by_definition():
    r = random.Random(6)
    for alphabet, name in ((string.ascii_lowercase, "lower letters"), (B64, "base64"), ("0123456789abcdef", "hex")):
        run = token(r, alphabet, 400)
        encoding, pairs, *_ = battery(run)
        assert NAMES[encoding] == name and SIZES[encoding] == len(alphabet)
        assert pairs == sum(run[i] == run[j] for i in range(400) for j in range(i))
    assert battery("abcdefghijklmnopqrstuvwxyz" * 4)[4] < 1e-6
    assert battery("z" * 40)[2:] == (battery("z" * 40)[2], 2.0**-39, 0.0)
    assert battery("az" * 30)[3] < 1e-6
    # Fisher's tail with two p-values is p (1 - ln p) of their product.
    assert math.isclose(combined(0.2, 0.3), 0.06 * (1 - math.log(0.06)))


def test_random_runs_are_seldom_rejected():
    r = random.Random(7)
    for n in (24, 40, 100):
        p = [combined(*battery(token(r, B64, n))[2:]) for _ in range(1500)]
        assert sum(x < 0.01 for x in p) < 45
        assert sum(x < randomness.RANDOM_LEVEL for x in p) < 10


def test_moments_of_equal_pairs_in_text():
    """Mean and variance that `text_step` uses, by simulation, and its level on text."""
    r = np.random.default_rng(8)
    shares = r.dirichlet(np.full(26, 0.7))
    frequencies = np.zeros(128)
    frequencies[[ord(c) for c in string.ascii_lowercase]] = shares * 1e9
    squares, cubes = moments(frequencies)[NAMES.index("lower letters")]
    assert math.isclose(squares, (shares**2).sum(), rel_tol=1e-3)
    n = 24
    counts = r.multinomial(n, shares, size=40_000)
    pairs = (counts * (counts - 1) // 2).sum(axis=1)
    couples = n * (n - 1) / 2
    assert math.isclose(pairs.mean(), couples * squares, rel_tol=0.02)
    variance = couples * (squares - squares**2) + couples * (n - 2) * 2 * (cubes - squares**2)
    assert math.isclose(pairs.var(), variance, rel_tol=0.05)
    steps = [text_step(NAMES.index("lower letters"), n, int(u), moments(frequencies)) for u in pairs[:5000]]
    assert sum(s >= 2 * PER_DECADE for s in steps) <= 0.015 * len(steps)


def test_cuts_are_those_of_the_sorted_procedure():
    r = random.Random(9)
    for _ in range(200):
        p = {b: sorted(r.random() ** r.choice([1, 6]) for _ in range(r.randint(1, 40))) for b in range(3)}
        steps = {b: [int(-math.log10(x) * PER_DECADE) for x in v] for b, v in p.items()}
        counts, totals = {}, {b: len(v) + 5 for b, v in p.items()}
        for b, v in steps.items():
            for s in v:
                counts[b, s] = counts.get((b, s), 0) + 1
        got = cuts(counts, totals)
        for b, v in steps.items():
            most = max((i for i, s in enumerate(sorted(v, reverse=True), 1) if 10.0 ** (-s / PER_DECADE) <= FALSE_SHARE * i / totals[b]), default=0)
            assert sum(s >= got[b] for s in v) == most if b in got else most == 0


def corpus(r, n):
    """Texts of letters with the frequencies of a language, with long words among them."""
    letters = "eeeeeeeeeeeettttttttaaaaaaaoooooooiiiiiiinnnnnnnsssssshhhhhhrrrrrrddddllllcccuuummwwffggyyppbbvk"
    return [" ".join(token(r, letters, r.choice([3, 5, 8, 18, 30])) for _ in range(120)) for _ in range(n)]


def test_planted_secrets_are_found_and_long_words_are_not(spark):
    r = random.Random(10)
    rows, planted = [], set()
    for i, text in enumerate(corpus(r, 150)):
        if i % 3 == 0:
            secret = token(r, B64, r.choice([40, 64, 88])) + r.choice(["", "=", "=="])
            text = f"{text} é {secret} end"
            start = text.index(secret)
            planted.add((i, start, start + len(secret)))
        if i % 5 == 0:
            text = f"{text}\napi_key: 'x1y2z3w4' AKIA{'A1' * 9} {'0f' * 20}"
        rows.append((i, text))
    # A copied document with an ordinary word repeats its hypotheses, which count once.
    rows += [(1000 + i, rows[1][1]) for i in range(200)]
    found = scanned(frame(spark, rows).repartition(4)).collect()
    assert len(found) == len(rows)
    added = {(f["doc_id"], s["start"], s["end"]) for f in found for s in f["findings"] if s["kind"] == "random"}
    assert len(planted & added) >= 0.95 * len(planted)
    assert len(added - planted) <= 2
    texts = dict(rows)
    for f in found:
        base = [(s["start"], randomness.KINDS.index(s["kind"]), s["end"]) for s in f["findings"] if s["kind"] != "random"]
        assert base == brute_fixed(texts[f["doc_id"]])
        assert [s["start"] for s in f["findings"]] == sorted(s["start"] for s in f["findings"])


def test_odd_rows(spark):
    out = scanned(frame(spark, ODD))
    assert set(out.columns) == {"doc_id", "findings", *CLASHING}
    rows = out.collect()
    assert len(rows) == len(ODD) and all(r["findings"] == [] for r in rows)
    assert scanned(frame(spark, [])).collect() == []
    long = "ab " * 500_000 + "token=" + "Q1w2" * 100_000 + " x " + "f0" * 200_000
    (row,) = scanned(frame(spark, [(1, long)], extra=False), keep=[]).collect()
    assert [(s["kind"], s["end"] - s["start"]) for s in row["findings"]] == [("assign", 400_006), ("hex", 400_000)]


def test_query_columns(spark, tmp_path):
    from tidemark.llm.queries import op12_secrets

    frame(spark, [(1, "no"), (2, "Token=abcdef1 and " + "0f" * 12), (3, None)], extra=False).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r["doc_id"]: r for r in op12_secrets(spark, str(tmp_path)).collect()}
    assert (rows[2]["n_assign"], rows[2]["n_access"], rows[2]["n_hex"]) == (1, 0, 1)
    assert rows[2]["spans"] == "assign:0:13,hex:18:42" and rows[1]["spans"] == ""
    assert rows[3]["base_sha256"] == spark.range(1).select(F.sha2(F.lit("").cast("binary"), 256)).first()[0]
