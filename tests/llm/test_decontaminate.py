import random

from tests.llm.helpers import ODD, frame
from tidemark.llm import decontaminate


def brute(rows, items, k=5, percent=80):
    def grams(text):
        w = [x for x in _split(text) if x]
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()

    out = []
    for item, text in set(items):
        g = grams(text)
        for doc, t in rows:
            both = len(g & grams(t))
            if doc is not None and item is not None and g and both * 100 >= percent * len(g):
                out.append((doc, item, len(g), both))
    return sorted(out)


def _split(text):
    lowered = (text or "").translate(str.maketrans(decontaminate.UPPER, decontaminate.LOWER))
    for gap in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(gap, " ")
    return lowered.split(" ")


def found(docs, items):
    rows = decontaminate.contained(docs, items).collect()
    assert all(abs(r["containment"] - r["n_shared"] / r["n_item"]) < 1e-12 for r in rows)
    return sorted((r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in rows)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "item_id long, text string, no string, words string")


def test_passages_at_the_threshold(spark):
    r = random.Random(5)
    item = lambda n: [f"q{r.randrange(10**6)}" for _ in range(n)]
    words = {i: item(n) for i, n in enumerate([5, 6, 9, 14, 14, 29, 54, 200])}
    rows, filler = [], [f"f{i}" for i in range(3000)]
    for i, w in words.items():
        for cut in (0, 1, len(w) // 5, len(w) // 4, len(w) // 2):
            at = r.randrange(2000)
            rows.append((len(rows), " ".join(filler[:at] + [x.upper() for x in w[cut:]] + filler[at:])))
        broken = list(w)
        broken[len(w) // 2] = "other"
        rows.append((len(rows), "\n".join(broken)))
    items = [(i, " ".join(w)) for i, w in words.items()] + [(90, None), (91, ""), (92, "one two"), (None, "q"), (0, " ".join(words[0]))]
    assert found(frame(spark, rows), items_of(spark, items)) == brute(rows, items)


def test_odd_rows_empty_tables_and_shuffled_sides(spark, monkeypatch):
    items = [(1, "one two"), (2, "one"), (3, "word0x0 word1x1 word2x2 word3x3 word4x4 word5x5"), (4, "the same text")]
    assert found(frame(spark, ODD), items_of(spark, items)) == brute(ODD, items)
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(decontaminate, "BROADCAST_ITEMS", 0)
    assert found(frame(spark, ODD), items_of(spark, items)) == brute(ODD, items)
    assert found(frame(spark, []), items_of(spark, items)) == [] == found(frame(spark, ODD), items_of(spark, []))


def test_no_python_in_the_plan(spark):
    df = decontaminate.contained(frame(spark, ODD), items_of(spark, [(1, "a b")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
