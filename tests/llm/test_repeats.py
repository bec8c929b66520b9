import collections
import hashlib
import random

import numpy as np
import pytest

from tests.llm.helpers import ODD, frame
from tidemark.llm import repeats, suffixes


def brute(rows, length):
    seen, texts = collections.Counter(), [(i, (t or "").encode()) for i, t in rows]
    for _, t in texts:
        seen.update(t[i : i + length] for i in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = [False] * len(t)
        for at in range(len(t) - length + 1):
            if seen[t[at : at + length]] > 1:
                gone[at : at + length] = [True] * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df, **options):
    return sorted((tuple(r) for r in repeats.repeats_removed(df, **options).collect()), key=repr)


def corpus(seed):
    r = random.Random(seed)
    word = lambda n: "".join(r.choice("abcé \n") for _ in range(n))
    passages = [word(r.randint(15, 90)) for _ in range(8)] + ["ab" * 60, "x" * 100]
    rows = []
    for i in range(60):
        parts = [r.choice(passages)[r.randint(0, 6) :] if r.random() < 0.5 else word(r.randint(0, 60)) for _ in range(r.randint(0, 5))]
        rows.append((i, "".join(parts)))
    return rows


@pytest.mark.parametrize("hot", [50_000, 2])
def test_against_brute_force(spark, hot, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 150)
    for seed in (1, 2):
        rows = corpus(seed)
        assert found(frame(spark, rows), length=30, gram=8, hot=hot) == brute(rows, 30)


def test_odd_rows_and_empty(spark):
    rows = [*ODD, (11, "a" * 199), (12, "b" * 200), (13, "b" * 201), (14, "c" * 200), (15, "c" * 200)]
    assert found(frame(spark, rows)) == brute(rows, 200)
    assert found(frame(spark, [])) == []


def test_suffix_order_and_common_prefixes():
    r = random.Random(3)
    for _ in range(60):
        letters = r.choice([b"ab", b"a", b"abc\x00\xff"])
        base = bytes(r.choice(letters) for _ in range(r.randint(1, 200)))
        data = base + base[: r.randint(0, len(base))] + base
        start = np.array([r.randrange(len(data)) for _ in range(r.randint(1, 50))])
        length = np.array([min(len(data) - s, r.choice([0, 5, 70, 300])) for s in start])
        texts = [data[s : s + n] for s, n in zip(start, length)]
        order, common = suffixes.order(data, start, length, r.choice([8, 16, 64]))
        assert [texts[i] for i in order] == sorted(texts)
        for k in range(1, len(order)):
            a, b = texts[order[k - 1]], texts[order[k]]
            same = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
            assert common[k] == same
