from functools import partial

import pytest

from tidemark.llm import pages, warc
from tidemark.llm.layouts import Layout
from tidemark.llm.queries import QUERIES, table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return pages.fit(table(spark, SF, "pages"))


def test_given_pages(spark, model):
    """Every page has one article here; its blocks are the main text, nothing else is."""
    for row in pages.main_texts(table(spark, SF, "pages"), model, keep=["page_id", "html"]).join(table(spark, SF, "pages"), "page_id").collect():
        expected = "\n".join(b.text for b in pages.blocks_of(row["html"]) if "article" in b.ancestors)
        assert row["text"] == expected and row["n_chars"] == len(expected)


def test_other_layouts(model):
    """Layouts with other seeds and words than those of the training."""
    right = wrong = missed = 0
    for seed in range(150):
        text = [f"Zorp {seed} blim the quax ran to every fleem, and so on {i}." * (i % 3 + 1) for i in range(9)]
        blocks = pages.blocks_of(Layout(text, 10**9 + seed).page())
        for block, keep in zip(blocks, model.label(blocks)):
            right += block.main and keep
            wrong += keep and not block.main
            missed += block.main and not keep
    assert right / (right + wrong) > 0.93 and right / (right + missed) > 0.93


def test_reading_of_markup():
    blocks = pages.blocks_of(
        "<html><head><title>no</title><body><p>a &amp; b&nbsp;&#233;<b> c<br>d<p>next<script>var t='</p>'</script> on"
        "<ul><li>x<li>y</ul><style>p{}</style><![if x]>tail<div>\n  z \n</div><a href=#>link"
    )
    assert [b.text for b in blocks] == ["a & b é c d", "next on", "x", "y", "tail", "z", "link"]
    assert [b.ancestors[-1] for b in blocks][2:4] == ["li", "li"] and blocks[-1].linked == 4
    assert pages.blocks_of(None) == pages.blocks_of("") == pages.blocks_of("<div><p> \n</p></div>") == []


def test_head_that_is_never_closed():
    head = "<html><head><meta charset=utf-8><title>x <b>y</b></title><style>p {}</style><noscript><p>no</p></noscript><script>s</script>"
    texts = lambda html: [b.text for b in pages.blocks_of(html)]
    for rest in ("<p>some text", "<div><p>some text</div>", "<span>some</span> text", "some text", "<body><p>some text", "</head><p>some text"):
        assert texts(head + rest) == ["some text"], rest
    assert texts("<head><div>a</div><title>t</title><link rel=x></head><body><p>b") == ["a", "b"]
    assert texts(head + "</head></html>") == []


def test_odd_pages(spark, model):
    rows = [(1, None, "u"), (2, "", "u"), (3, "<p>", "u"), (3, "<p>", "u"), (None, "no markup at all", None), (4, "<div>" * 3000 + "deep", "u")]
    rows.append((5, "<article>" + "<p>A sentence of the story, told at length.</p>" * 20_000 + "</article>", "u"))
    df = spark.createDataFrame([(*r, "q") for r in rows], "page_id long, html string, text string, c0 string")
    out = pages.main_texts(df, model).collect()
    assert len(out) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in out)
    assert [r["text"].count("\n") > 19_900 for r in out if r["page_id"] == 5] == [True]
    assert pages.main_texts(df.limit(0), pages.fit(df.limit(0))).collect() == []


def test_viterbi_is_the_best_labelling(model):
    import itertools

    blocks = pages.blocks_of(Layout(["Some words of a story, and more of them."], 5).page())[:9]
    scores = [sum(model.weights.get(n, 0.0) for n in names) for names in pages.features_of(blocks)]

    def total(labels):
        return model.start * labels[0] + sum(s for s, y in zip(scores, labels) if y) + sum(model.step[a][b] for a, b in zip(labels, labels[1:]))

    best = max(total(y) for y in itertools.product((0, 1), repeat=len(blocks)))
    assert abs(total([int(x) for x in model.label(blocks)]) - best) < 1e-9


def test_audit_finds_every_fault(spark):
    rows = [(i, "u" if i % 5 else None, None if i % 7 == 0 else "x" * (i * 37 % 900)) for i in range(300)] + [(None, "u", "lost")]
    df = spark.createDataFrame(rows, "id long, uri string, body string")
    ours = warc.archived(df, 100, "id", "uri", "body")
    theirs = ours.where("id <> 17").withColumn("record", F.when(F.col("id").isin(0, 123, 299), F.lit(b"bad")).otherwise(F.col("record")))
    theirs = theirs.unionByName(spark.createDataFrame([(1, 10**9, 0, b"more"), (None, 1, 0, b"")], theirs.schema))
    for options in ({}, {"fanout": 2, "range_bytes": 500}):
        found = warc.audit(ours, theirs, **options).join(ours, ["file", "offset"], "left").select("id", "fault").collect()
        expected = [(None, "extra"), (0, "changed"), (17, "missing"), (123, "changed"), (299, "changed")]
        assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert warc.audit(ours, ours).collect() == [] == warc.audit(ours.limit(0), ours.limit(0)).collect()
    # Repeated places count together.
    assert warc.audit(ours.unionByName(ours), ours).count() == 300


def test_reading_warc_files(spark, tmp_path):
    import gzip

    make = lambda i, body: b"WARC/1.0\r\nWARC-Record-ID: <%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (i, len(body), body)
    records = [make(1, b"a"), make(2, b"WARC/1.0\r\n\r\nnot a record"), make(3, bytes(range(256)))]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "c.warc").write_bytes(records[0] + b"broken")
    (tmp_path / "d.warc").write_bytes(b"")
    found = warc.read_warc(spark, str(tmp_path)).collect()
    by_file = {}
    for r in sorted(found, key=lambda r: r["offset"]):
        by_file.setdefault(r["file"].rpartition("/")[2], []).append(bytes(r["record"]))
    assert by_file == {"a.warc": records, "b.warc.gz": records, "c.warc": [records[0], b"broken"]}
    assert {r["record_id"] for r in found} == {"<1>", "<2>", "<3>", None}


def test_query_covers_all_pages(spark):
    assert QUERIES["op8_main_text"](spark, SF).count() == table(spark, SF, "pages").count()


def test_audit_of_damaged_files(spark, tmp_path):
    import gzip

    make = lambda i: b"WARC/1.0\r\nWARC-Record-ID: <%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (i, 50 + i, b"x" * (50 + i))
    flip = lambda r, at: r[:at] + bytes([r[at] ^ 1]) + r[at + 1 :]
    for name, stored in (("a.warc", [make(i) for i in range(12)]), ("sub/b.warc.gz", [gzip.compress(make(i), mtime=0) for i in range(12)])):
        length = stored[4].find(b"Content-Length: ") + 16
        theirs = list(stored)
        theirs[2] = flip(stored[2], len(stored[2]) - 9)
        theirs[4] = flip(stored[4], length if length > 15 else 14)
        theirs[8] = flip(stored[8], 0)
        del theirs[6]
        for side, records in (("ours", stored), ("theirs", theirs)):
            (tmp_path / side / name).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / side / name).write_bytes(b"".join(records))
    sides = [partial(warc.stored_files, spark, str(tmp_path / side)) for side in ("ours", "theirs")]
    index = {(r["file"], r["offset"]): r["record_id"] for r in warc.read_warc(spark, str(tmp_path / "ours")).collect()}
    faults = sorted((r["file"], index[r["file"], r["offset"]], r["fault"]) for r in warc.audit_files(*sides).collect())
    kinds = [("<2>", "changed"), ("<4>", "changed"), ("<6>", "missing"), ("<8>", "changed")]
    assert faults == [(name, *kind) for name in ("a.warc", "sub/b.warc.gz") for kind in kinds]
    read = warc.read_warc(spark, str(tmp_path / "theirs")).collect()
    assert {r["file"] for r in read} == {"a.warc", "sub/b.warc.gz"}
    assert all(sum(r["record_id"] == f"<{i}>" for r in read) == 2 for i in (0, 1, 3, 5, 7, 9, 10, 11))


def record(i, body):
    return b"WARC/1.0\r\nWARC-Record-ID: <%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (i, len(body), body)


def found_faults(spark, tmp_path, sound, other, **options):
    """Faults of replicas given as folders of files, by file: id and fault."""
    for side, files in (("ours", sound), ("theirs", other)):
        (tmp_path / side).mkdir(parents=True)
        for name, data in files.items():
            (tmp_path / side / name).write_bytes(data)
    sides = [partial(warc.stored_files, spark, str(tmp_path / side)) for side in ("ours", "theirs")]
    return sorted((r["file"], r["record_id"], r["fault"]) for r in warc.audit_files(*sides, **options).collect())


def test_audit_reads_bytes_where_hashes_leave_doubt(spark, tmp_path):
    """Records that damaged headers melt into one are told apart by the sound lengths, before and behind a lost record."""
    stored = [record(i, b"%d:" % i + b"y" * (i * 31 % 400)) for i in range(60)]
    theirs = list(stored)
    for i in (10, 40):  # The length of one and the header of the next are gone: the next but one begins the next piece.
        theirs[i] = stored[i].replace(b"Length: ", b"Length: x")[: len(stored[i])]
        theirs[i + 1] = stored[i + 1].replace(b"WARC/1.0", b"warc/1.0")
    theirs[20] = b""
    expected = [("a[1].warc", f"<{i}>", "missing" if i == 20 else "changed") for i in (10, 11, 20, 40, 41)]
    sound, other = b"".join(stored), b"".join(theirs)
    for n, options in enumerate(({}, {"fanout": 2, "range_bytes": 300})):
        found = found_faults(spark, tmp_path / str(n), {"a[1].warc": sound, "b": sound}, {"a[1].warc": other, "b": sound}, **options)
        assert found == expected


def test_audit_against_an_edit_by_hand(spark, tmp_path):
    """Random edits of files of distinct and repeated records, compared with what was done."""
    import random

    rng, sound, other, expected = random.Random(4), {}, {}, []
    for f in range(12):
        name, stored, theirs = f"{f}.warc", [record(i, b"z" * rng.randrange(3, 200)) for i in range(80)], []
        for i, r in enumerate(stored):
            fault = rng.choice(["missing", "changed", *[None] * 30]) if i % 3 == 0 else None
            if fault == "changed":
                r = r[:-6] + bytes([r[-6] ^ 1]) + r[-5:]
            theirs.append(b"" if fault == "missing" else r)
            if fault:
                expected.append((name, f"<{i}>", fault))
        if f % 4 == 0:
            theirs.append(record(99, b"more"))
            expected.append((name, "<99>", "extra"))
        sound[name], other[name] = b"".join(stored), b"".join(theirs)
    copies = record(7, b"the same") * 9
    sound["copies"], other["copies"] = copies + record(8, b"end"), copies[len(copies) // 9 :] + record(8, b"end")
    sound["lost"] = other["found"] = record(1, b"x")
    sound["empty"] = other["empty"] = b""
    expected += [("copies", "<7>", "missing"), ("lost", "<1>", "missing"), ("found", "<1>", "extra")]
    assert found_faults(spark, tmp_path / "edits", sound, other, range_bytes=1000) == sorted(expected)
    assert found_faults(spark, tmp_path / "same", sound, sound) == [] == found_faults(spark, tmp_path / "none", {"a": b""}, {"a": b""})


def test_doubtful_bytes_grow_with_the_damage(spark, tmp_path):
    """Only the file with melted records is read a second time."""
    stored = [record(i, b"q" * 50) for i in range(9)]
    theirs = list(stored)
    theirs[3], theirs[4] = stored[3].replace(b"Length: ", b"Length: x")[: len(stored[3])], stored[4].replace(b"WARC/", b"warc/")
    for side, one in (("ours", stored), ("theirs", theirs)):
        (tmp_path / side).mkdir()
        for n in range(6):
            (tmp_path / side / f"{n}.warc").write_bytes(b"".join(one if n == 2 else stored))
    asked = []

    def replica(side, names=None):
        asked.append((side, names))
        return warc.stored_files(spark, str(tmp_path / side), names)

    found = warc.audit_files(partial(replica, "ours"), partial(replica, "theirs")).collect()
    assert sorted((r["file"], r["record_id"], r["fault"]) for r in found) == [("2.warc", "<3>", "changed"), ("2.warc", "<4>", "changed")]
    assert asked == [("ours", None), ("theirs", None), ("theirs", ["2.warc"])]


def test_archives_compressed_as_a_whole(spark, tmp_path):
    import gzip

    stored = [record(i, b"w" * i) for i in range(5)]
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(b"".join(stored)))
    found = sorted(warc.read_warc(spark, str(tmp_path)).collect(), key=lambda r: r["offset"])
    assert [bytes(r["record"]) for r in found] == stored
    assert [r["offset"] for r in found] == [sum(map(len, stored[:i])) for i in range(5)]


def test_audit_query_on_odd_tables(spark, tmp_path):
    """No pages, pages that the other replica lost altogether, null addresses, texts and ids."""
    schema = "page_id long, url string, html string"
    for name, rows, expected in (
        ("none", [], []),
        ("lost", [(3, "u", "x"), (92, None, None)], [(3, "missing"), (92, "missing")]),
        ("odd", [(5, None, None), (3, "u", ""), (7, "u", "é" * 9), (None, "u", "x")], [(3, "missing"), (5, "changed")]),
    ):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name / "pages.parquet"))
        found = QUERIES["op3_merkle_audit"](spark, str(tmp_path / name)).collect()
        assert sorted((r["page_id"], r["fault"]) for r in found) == expected
