"""Quality, toxicity and the suffix tree: held-out accuracy, brute force, odd rows."""

import collections
import math
import random

import duckdb
import numpy as np
import pytest

from tests.llm.helpers import ODD, frame
from pyspark.sql import functions as F
from tidemark.llm import quality, suffix_tree, toxicity
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def accuracy(rows, column, held=True):
    labels = dict(duckdb.sql(f"SELECT doc_id, {column} FROM '{SF}/labels.parquet'").fetchall())
    pairs = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["doc_id"] in labels and r["held_out"] == held]
    right = collections.Counter(a == b for a, b in pairs)
    return right[True] / len(pairs), sum(b for a, b in pairs if a) / max(1, sum(a for a, _ in pairs))


def test_quality_on_held_out_documents(spark):
    rows = QUERIES["op9_quality"](spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert accuracy(rows, "quality")[0] > 0.95


def test_toxicity_on_held_out_documents(spark):
    rows = QUERIES["op10_toxicity"](spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    right, caught = accuracy(rows, "toxic")
    assert right > 0.9 and caught > 0.4


def test_quality_odd_rows_and_few_labels(spark):
    rows = quality.with_statistics(frame(spark, ODD), "text", ["doc_id"])
    assert rows.count() == len(ODD)
    none = quality.fit(rows, F.lit(None))
    assert [r["score"] for r in quality.scored(rows, none).collect()] == [0.5] * len(ODD)
    one = quality.fit(rows, F.lit(1))
    assert all(0 <= r["score"] <= 1 for r in quality.scored(rows, one).collect())
    empty = quality.with_statistics(frame(spark, []), "text", ["doc_id"])
    assert quality.scored(empty, quality.fit(empty, F.lit(1))).collect() == []


def test_quality_is_the_gaussian_posterior(spark):
    r = np.random.default_rng(1)
    d = len(quality.FEATURES)
    x = {k: r.normal(k, 1 + k, (200, d)) for k in (0, 1)}
    df = spark.createDataFrame([(v.tolist(), k) for k in x for v in x[k]], "features array<double>, label int")
    model = quality.fit(df, F.col("label"), shrinkage=0.1)
    z = np.concatenate([x[0], x[1]])
    scale = z.std(axis=0)
    logs = []
    for k in (0, 1):
        c = np.cov(x[k].T / scale[:, None], bias=True)
        c = 0.9 * c + 0.1 * np.trace(c) / d * np.eye(d)
        e = (z - x[k].mean(axis=0)) / scale
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", e, np.linalg.inv(c), e) - 0.5 * np.linalg.slogdet(c)[1])
    assert np.allclose(model.score(z), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-6)


def test_toxicity_finds_the_sentence(spark):
    r = random.Random(2)
    words = [f"plain{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(400):
        sentences = [" ".join(r.choices(words, k=8)) + "." for _ in range(r.randint(1, 6))]
        toxic = i % 3 == 0
        if toxic:
            sentences[r.randrange(len(sentences))] = f"You {r.choice(['nasty', 'vile'])} thing plain1."
        rows.append((i, " ".join(sentences)))
        labels.append((i, int(toxic)))
    docs = frame(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels + [(None, 1), (9999, 0)], "doc_id long, label int"))
    out = {r["doc_id"]: r for r in toxicity.scored(docs, model).collect()}
    for i, text in rows:
        assert (out[i]["toxicity"] > 0.7) == (i % 3 == 0)
        if i % 3 == 0:
            assert "You" in text[out[i]["sentence_start"] : out[i]["sentence_end"]]
    lookup = toxicity.Lookup(model.index)
    text = rows[0][1]
    chances = [1 / (1 + math.exp(-model.bias - sum(model.weights[f] for f in lookup.bag(text[a:b])))) for a, b in toxicity.sentences(text)]
    assert abs(out[0]["toxicity"] - (1 - math.prod(1 - p for p in chances))) < 1e-9


def test_toxicity_odd_rows(spark):
    docs = frame(spark, ODD)
    empty = spark.createDataFrame([], "doc_id long, label int")
    model = toxicity.fit(docs, empty)
    out = toxicity.scored(docs, model)
    assert out.columns[: len(docs.columns) - 1] == [c for c in docs.columns if c != "text"]
    found = out.collect()
    assert len(found) == len(ODD) and {r["toxicity"] for r in found if r["doc_id"] in (1, 2)} == {0.0}
    assert toxicity.scored(frame(spark, []), model).collect() == []


def brute_base(rows, held):
    counts = collections.Counter()
    for (doc, text), h in zip(rows, held):
        if not h:
            counts.update((text or "").encode().lower().split() + [None])
    n, v = sum(counts.values()), len(counts)
    for (doc, text), h in zip(rows, held):
        tokens = (text or "").encode().lower().split() + [None]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        yield doc, h, len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 6)


@pytest.mark.parametrize("all_held", [False, True])
def test_suffix_tree_base_and_odd_rows(spark, all_held):
    rows = ODD + [(200 + i, f"the cat sat on mat {i % 7}") for i in range(60)]
    held = [all_held or d is None or d % 10 == 0 for d, _ in rows]
    df = frame(spark, rows)
    out = suffix_tree.scored(df, F.lit(True) if all_held else F.col("doc_id") % 10 == 0, block_bytes=10_000).collect()
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in out), key=repr)
    assert got == sorted(brute_base(rows, held), key=repr)
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in out)
    assert suffix_tree.scored(frame(spark, []), F.lit(False)).collect() == []


def test_suffix_tree_distributions(spark):
    """Every retained context predicts proper distributions, as counted by hand."""
    texts = ["abab abab ab", "abba abab", "ba ba ab", None, "aé " * 20] * 30
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    tree, words, ends = suffix_tree.grown(df, depth=4, min_share=0.001)
    assert ends == len(texts) and words == sum(len((t or "").split()) for t in texts)
    counts = collections.Counter()
    for t in texts:
        data = suffix_tree.spelled(t)
        for i in range(suffix_tree.DEPTH, len(data)):
            for d in range(5):
                counts[data[i - d : i], data[i]] += 1
    paths = {0: {0: b""}}
    back = {int(tree.symbol[b]): bytes([b]) for b in range(255, -1, -1) if tree.symbol[b] < tree.size - 1}
    for d, step in enumerate(tree.steps):
        paths[d + 1] = {int(step[k]): back[k % tree.size] + paths[d][k // tree.size] for k in np.flatnonzero(step[: -tree.size] < step[-1])}
    for d in range(1, 5):
        assert len(paths[d]) == len(tree.logs[d])
        for state, context in paths[d].items():
            row = np.exp(tree.logs[d][state].astype(float))
            assert abs(row.sum() - 1) < 1e-4
            above = np.exp(tree.logs[d - 1][next(s for s, c in paths[d - 1].items() if c == context[1:])].astype(float))
            n = sum(c for (x, _), c in counts.items() if x == context)
            for b in b"ab \n":
                s = tree.symbol[b]
                expected = (counts[context, b] + suffix_tree.PRIOR * above[s]) / (n + suffix_tree.PRIOR)
                assert abs(row[s] - expected) < 1e-4


def test_suffix_tree_beats_single_words(spark):
    rows = [r for r in QUERIES["op5_suffix_tree"](spark, SF).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_many_sentences_without_evidence_are_not_toxic():
    text = "The plain words of a calm tale go on. " * 5000
    for model in (toxicity.Model({}, np.zeros(0), -6.0), toxicity.Model({"vile": 0}, np.array([9.0]), -6.0)):
        score, start, end, worst = model.scores(text, toxicity.Lookup(model.index))
        assert score == worst == 0 and start == 0 < end


def test_rows_without_an_id_are_marked_like_an_empty_one(spark, tmp_path):
    from tidemark.llm.queries import op9_quality, op10_toxicity

    words = ["calm water runs over the stones.", "you are an awful hateful fool!"]
    rows = [(None if i == 0 else i, f"{words[i % 2]} line {i}") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, i % 2, i % 2) for i in range(40)] + [(None, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for fn, want in ((op9_quality, True), (op10_toxicity, False)):
        found = {r["doc_id"]: r["held_out"] for r in fn(spark, str(tmp_path)).select("doc_id", "held_out").collect()}
        assert len(found) == 40 and found[None] is want and None not in found.values()


def brute_scores(rows, held):
    """Scores of texts from contexts counted one by one in dictionaries, every distribution and walk spelled out."""
    st, counts, words = suffix_tree, collections.Counter(), collections.Counter()
    train = [st.spelled(t) for (_, t), h in zip(rows, held) if not h]
    seen = collections.Counter(b for data in train for b in data[st.DEPTH :])
    ranked = sorted(range(256), key=lambda b: (b not in (32, 10), -seen[b], b))
    symbol = {b: min(i, st.SYMBOLS - 1) for i, b in enumerate(ranked)}
    for data in train:
        s = [symbol[b] for b in data]
        for i in range(st.DEPTH, len(s)):
            for d in range(st.DEPTH + 1):
                counts[tuple(s[i - d : i]), s[i]] += 1
        words.update((*data[st.DEPTH : -1].split(), b"\n"))
    total, nexts = sum(words.values()), collections.defaultdict(dict)
    for (context, s), n in counts.items():
        nexts[context][s] = n
    need, chance, kept = math.ceil(st.MIN_SHARE * sum(seen.values())), {}, {()}
    for context in sorted({(), *nexts}, key=len):
        here, n = nexts[context], sum(nexts[context].values())
        if context and n < need:
            continue
        if not context:
            chance[context] = [(here.get(s, 0) + 1) / (n + st.SYMBOLS) for s in range(st.SYMBOLS)]
            continue
        above = chance[context[1:]]
        chance[context] = [(here.get(s, 0) + st.PRIOR * above[s]) / (n + st.PRIOR) for s in range(st.SYMBOLS)]
        if sum(c * math.log(c / n / above[s]) for s, c in here.items()) >= st.MIN_DIVERGENCE:
            kept |= {context[i:] for i in range(len(context))}
    scores = []
    for _, text in rows:
        data, score, token = st.spelled(text), 0.0, 0.0
        s, start = [symbol[b] for b in data], st.DEPTH
        for i in range(st.DEPTH, len(data)):
            longest = next(tuple(s[i - d : i]) for d in range(st.DEPTH, -1, -1) if tuple(s[i - d : i]) in kept)
            token += math.log(chance[longest][s[i]]) - (math.log(256 - st.SYMBOLS + 1) if s[i] == st.SYMBOLS - 1 else 0)
            if data[i] in b" \n":
                word = b"\n" if data[i] == 10 else data[start:i]
                score += math.log10((1 - st.WORD_SHARE) * math.exp(token) + st.WORD_SHARE * words[word] / max(total, 1))
                start, token = i + 1, 0.0
        scores.append(score)
    return scores


def test_suffix_tree_scores_against_brute_force(spark):
    """Thirty real texts (long ones cut for the test's sake) and odd ones, some of bytes that no training text has."""
    found = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(30).collect()
    rows = [(r["doc_id"], r["text"][:900]) for r in found] + [(900, None), (901, ""), (902, "unseen 日本 ~~"), (903, " One  two\n")]
    held = [d % 4 == 0 or d == 902 for d, _ in rows]
    out = suffix_tree.scored(frame(spark, rows), F.expr("doc_id % 4 = 0 OR doc_id = 902"), block_bytes=10_000).collect()
    got = {r["doc_id"]: r["score"] for r in out}
    for (doc, _), expected in zip(rows, brute_scores(rows, held)):
        assert abs(got[doc] - expected) < 1e-5 * max(1, abs(expected)), doc


def test_suffix_tree_has_rare_contexts_of_large_corpora(spark, monkeypatch):
    """A context that occurs once among 496,688 training positions is tested like any other (5e-6 of them are three)."""
    rng = random.Random(5)
    common = ["".join(rng.choice("abc  ") for _ in range(1000)) for _ in range(6)]
    rows = [(i, common[i % 6]) for i in range(600)] + [(999, "the quick zebra jumps"), (1001, "quick zebra"), (1002, "zebra jumps over")]
    held = [d >= 1001 or d % 50 == 0 for d, _ in rows]
    out = suffix_tree.scored(frame(spark, rows, extra=False), F.expr("doc_id >= 1001 OR doc_id % 50 = 0"), block_bytes=20_000).collect()
    got = {r["doc_id"]: r["score"] for r in out}
    monkeypatch.setattr(suffix_tree, "MIN_SHARE", 0.0)
    for (doc, _), expected in zip(rows, brute_scores(rows, held)):
        assert abs(got[doc] - expected) < 1e-5 * max(1, abs(expected)), doc


def test_subtrees_by_parts_make_one_tree():
    """Log probabilities of grams, part by part, are those of a tree counted by hand; unseen grams among them."""
    st, rng = suffix_tree, np.random.default_rng(3)
    size, raw = 4, rng.choice(4, 3000, p=[0.6, 0.2, 0.15, 0.05])
    raw[1::3] = raw[::3][: len(raw[1::3])]
    grams = collections.Counter(tuple(raw[i - st.DEPTH : i + 1].tolist()) for i in range(st.DEPTH, len(raw)))
    asked = {**{tuple(rng.choice(4, st.DEPTH + 1).tolist()): 0 for _ in range(500)}, **grams}
    seen = collections.Counter()
    for gram, n in grams.items():
        for d in range(st.DEPTH + 1):
            seen[gram[st.DEPTH - d : -1], gram[-1]] += n
    total = collections.Counter()
    for (context, _), n in seen.items():
        total[context] += n

    def chance(context, s):
        if not context:
            return (seen[(), s] + 1) / (total[()] + size)
        return (seen[context, s] + st.PRIOR * chance(context[1:], s)) / (total[context] + st.PRIOR)

    kept = set()
    for context, n in total.items():
        if len(context) >= st.STEM:
            gain = sum(c * math.log(c / n / chance(context[1:], s)) for s in range(size) if (c := seen[context, s]))
            kept |= {context[i:] for i in range(len(context) + 1 - st.STEM + 1)} if gain >= st.MIN_DIVERGENCE else set()
    above = np.array([[chance((b, a), s) for s in range(size)] for a in range(size) for b in range(size)])
    number = lambda g: int("".join(map(str, [*reversed(g[:-1]), g[-1]])), size)
    keys = {number(g): g for g in asked}
    for stem in {number(g) // size ** (st.DEPTH + 1 - st.STEM) for g in asked}:
        part = np.array(sorted(k for k in keys if k // size ** (st.DEPTH + 1 - st.STEM) == stem), np.int64)
        logs, short = st._subtrees(part, np.array([asked[keys[k]] for k in part.tolist()], np.int64), size, above)
        assert short.tolist() == [stem // size] * any(int("".join(map(str, reversed(c[-st.STEM :]))), size) == stem for c in kept if len(c) >= st.STEM)
        for k, log in zip(part.tolist(), logs):
            gram = keys[k]
            longest = next((gram[i:-1] for i in range(st.DEPTH - st.STEM + 1) if gram[i:-1] in kept), None)
            assert np.isnan(log) if longest is None else abs(log - math.log(chance(longest, gram[-1]))) < 1e-5


@pytest.mark.parametrize("depth", [2, 3, 6])
def test_suffix_tree_walks_from_the_first_symbols(spark, depth):
    """Looking up the first symbols at once leads where single steps lead."""
    rng, st = np.random.default_rng(depth), suffix_tree
    texts = ["".join(rng.choice(list("abcé  "), 300, p=[0.4, 0.25, 0.1, 0.05, 0.1, 0.1])) for _ in range(40)] + ["", None]
    tree, *_ = st.grown(spark.createDataFrame([(t,) for t in texts], "text string"), depth=depth, min_share=0.0005)
    raw = np.frombuffer(st.spelled("ab ba cab zz é" + "abca " * 9), np.uint8)
    symbols, heads = tree.symbol[raw], tree.heads(tree.steps)
    logs = tree.log_probabilities(raw)
    for i in range(st.DEPTH, len(raw)):
        state, row = 0, tree.logs[0][0]
        walking, walked = True, 0
        for d in range(depth):
            state = int(tree.steps[d][state * tree.size + symbols[i - d - 1]])
            assert tree.states(symbols, d + 1, heads)[i - st.DEPTH] == state
            if walking:
                walked = int(tree.walks[d][walked * tree.size + symbols[i - d - 1]])
                walking = walked < len(tree.logs[d + 1])
                row = tree.logs[d + 1][walked] if walking else row
        assert logs[i - st.DEPTH] == row[symbols[i]] + tree.spread[raw[i]]
