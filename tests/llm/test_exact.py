import collections
import random

from tests.llm.helpers import CLASHING, ODD, frame
from tidemark.llm.exact import radix_groups


def check(rows, found):
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    assert len(found) == len(rows)
    stays = collections.Counter()
    for r in found:
        ids = groups[r["text"] or ""]
        known = [i for i in ids if i is not None]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == (max(known) if known else None)
        if r["kept"]:
            assert r["doc_id"] == r["keep_id"]
            stays[r["text"] or ""] += 1
    assert set(stays.values()) == {1} and len(stays) == len(groups)


def test_odd_rows(spark):
    df = frame(spark, ODD)
    out = radix_groups(df)
    # Input columns named like a result give way to it.
    assert set(out.columns) == {"doc_id", "text", "keep_id", "group_size", "kept", *CLASHING}
    check(ODD, out.select("doc_id", "text", "keep_id", "group_size", "kept").collect())


def test_prefixes_of_all_lengths_and_a_hot_group(spark):
    r = random.Random(4)
    base = "".join(r.choice("ab") for _ in range(400))
    rows = [(i, base[: r.choice([0, 1, 3, 4, 5, 63, 64, 65, 399, 400])] + r.choice(["", "a", "b", "\x00"])) for i in range(200)]
    rows += [(1000 + i, base * 3) for i in range(150)]
    found = radix_groups(frame(spark, rows, extra=False), first_digit=4, growth=2).collect()
    check(rows, found)


def test_empty(spark):
    assert radix_groups(frame(spark, [])).collect() == []
