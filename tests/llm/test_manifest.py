import collections
import hashlib
import random
import zlib

from pyspark.sql import functions as F

from tidemark.llm.manifest import FAN, built, digest

SCHEMA = "doc_id long, source string, text string, `group` string, leaf string, root string, way string, nodes string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc_id, source, text):
    marked = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, text))
    return sha("".join(marked))


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(nodes):
    """Top of a list of nodes, and for each the neighbours (before, after) level by level."""
    ways, level, places = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(level) > 1:
        for way, at in zip(ways, places):
            run = level[at // FAN * FAN : at // FAN * FAN + FAN]
            way.append(("".join(run[: at % FAN]), "".join(run[at % FAN + 1 :])))
        level = [sha("".join(level[a : a + FAN])) for a in range(0, len(level), FAN)]
        places = [at // FAN for at in places]
    return level[0], ways


def brute(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    ordered = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops, ways = {}, {}
    for g in ordered:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        tops[g], ways[g] = climb([leaf_of(*r) for r in groups[g]])
    root, upper = climb([tops[g] for g in ordered])
    out = []
    for g, above in zip(ordered, upper):
        for r, way in zip(groups[g], ways[g]):
            way = way + above
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            path = [leaf_of(*r[:2], lower(r[2]) if changed else r[2])]
            for before, after in way:
                path.append(sha(before + path[-1] + after))
            out.append((r[0], leaf_of(*r), tops[g], root, sha("".join(b + a for b, a in way)), path))
    return sorted(out, key=repr)


def tree(spark, rows, depth):
    df = frame(spark, rows).repartition(3)
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    ids = [F.col("doc_id"), F.col("source")]
    changed = F.when(hit, digest(*ids, lowered))
    return built(df, F.col("source"), F.col("doc_id"), digest(*ids, F.col("text")), changed, {"root": F.col("doc_id")}, depth)


def check(spark, rows, depth):
    made = tree(spark, rows, depth)
    # The carried column may be called like a result; the positions tell them apart.
    got = [tuple(r) for r in made.rows.collect()]
    assert sorted(got, key=repr) == brute(rows)
    return made


def corpus(n, seed):
    r = random.Random(seed)
    sources = ["hot"] * 3 + [f"s{i}" for i in range(20)] + [None, "", "ä", "Z"]
    return [(i, r.choice(sources), r.choice(["One Text", "plain", None, "", "É Ü"])) for i in r.sample(range(10 * n), n)]


def test_tiers_of_one_level(spark):
    rows = corpus(700, 1) + [(100_000 + i, "hot", f"Text {i}") for i in range(600)]
    made = check(spark, rows, 1)
    assert len(made.tiers) == 3
    want = collections.Counter()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    for g, own in groups.items():
        level, k = [leaf_of(*r) for r in sorted(own)], 0
        while True:
            want.update((g, k, i, h) for i, h in enumerate(level))
            if len(level) == 1:
                break
            level, k = [sha("".join(level[a : a + FAN])) for a in range(0, len(level), FAN)], k + 1
    assert collections.Counter(tuple(r) for r in made.nodes().collect()) == want


def test_blocks_of_two_and_three_levels(spark):
    rows = corpus(300, 2) + [(100_000 + i, "hot", f"Text {i}") for i in range(257)]
    check(spark, rows, 2)
    check(spark, rows, 3)


def test_a_version_shares_what_its_path_does_not_touch(spark):
    rows = [(i, "a", f"Text {i}") for i in range(600)]
    made = tree(spark, rows, 2)
    nodes = {(level, index): h for _, level, index, h in made.nodes().collect()}
    places = {h: index for (level, index), h in nodes.items() if level == 0}
    for row in made.rows.collect():
        path, at = row["copies"], places[row["leaf"]]
        own = {(level, at // FAN**level): h for level, h in enumerate(path)}
        seen = nodes | own
        # Every node of the version is the hash of its children in the version.
        for level in range(1, len(path)):
            run = [seen[level - 1, i] for i in range(at // FAN**level * FAN, min((at // FAN**level + 1) * FAN, 600)) if (level - 1, i) in seen]
            assert seen[level, at // FAN**level] == sha("".join(run))
        assert (path[-1] == made.root) == (path[0] == row["leaf"])


def test_odd_rows(spark):
    rows = [(None, None, None), (None, None, None), (None, "", ""), (1, None, "A"), (1, None, "A"), (1, None, "B"), (5, "x", "LONG " * 200_000), (10, "x", None)]
    check(spark, rows, 1)
    check(spark, [(3, "x", "One")], 3)


def test_copies_of_one_row(spark):
    check(spark, [(7, "hot", "Same")] * 400 + [(8, "hot", "Other")], 1)


def test_empty_table(spark):
    made = tree(spark, [], 3)
    assert made.root is None and made.rows.collect() == [] and made.nodes().collect() == []
