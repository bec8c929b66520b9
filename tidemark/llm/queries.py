"""The registered query of every corpus operator, and its SQL where SQL can express it."""

from __future__ import annotations

import hashlib
from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, decontaminate, exact, manifest, neardup, pages, quality, randomness, repeats, shallot, suffix_tree, toxicity, warc
from tidemark.llm.common import Scratch, table, utf8
from tidemark.session import fresh_folder

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return register


@query(
    """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
 doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
 FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""
)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2(utf8("text"), 256).alias("text_sha256"))
    return exact.radix_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def remainder(column: str, n: int):
    """crc32 of the id as text, mod n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


@query()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    # The statistics are a hundredth of the texts: they are taken once, written, and used for both steps.
    rows, _ = Scratch(spark, "quality").keep(quality.with_statistics(docs, "text", ["doc_id"]))
    train = rows.join(labels.select(F.col("doc_id").alias("c0"), F.col("quality").alias("label")), "c0")
    scores = quality.scored(rows, quality.fit(train, F.col("label")))
    return scores.select(
        F.col("c0").alias("doc_id"),
        # A row without an id has the remainder of an empty text, 0, here and below.
        F.coalesce(remainder("c0", 5) == 0, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1)
    model = toxicity.fit(docs, labels, label_col="toxic")
    return toxicity.scored(docs, model).select(
        "doc_id",
        F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.7).cast("int").alias("predicted"),
        "sentence_start",
        "sentence_end",
        "sentence_score",
    )


VOCABULARY = "byte_bpe_multi_50k.tiktoken"


@query()
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encoded(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, keep=["doc_id"])


@query()
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=2)


def _shingles_sql(table_name: str, id_col: str, text: str = "text") -> str:
    lowered = f"translate(coalesce({text}, ''), '{decontaminate.UPPER}', '{decontaminate.LOWER}')"
    return f"""SELECT DISTINCT {id_col}, unnest(CASE WHEN len(w) >= 5
 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
 WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
 FROM (SELECT {id_col}, list_filter(string_split_regex({lowered}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM {table_name})"""


@query(
    f"""WITH d AS ({_shingles_sql("documents", "doc_id")}), b AS ({_shingles_sql("benchmark", "item_id")}),
 size AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id)
 SELECT doc_id, item_id, n_item, count(*) AS n_shared, count(*) / n_item AS containment
 FROM d JOIN b USING (shingle) JOIN size USING (item_id)
 GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 80 * n_item"""
)
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return pages.main_texts(rows, pages.fit(rows))


PAGES_PER_FILE = 4096

_HEAD_SQL = (
    r"'WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:record:' || page_id || '>\r\nWARC-Target-URI: ' || coalesce(url, '') "
    r"|| '\r\nContent-Length: ' || strlen(coalesce(html, '')) || '\r\n\r\n\r\n\r\n'"
).replace(r"\r\n", "' || chr(13) || chr(10) || '")


@query(
    f"""WITH r AS (SELECT page_id, page_id // {PAGES_PER_FILE} AS file, strlen({_HEAD_SQL}) + strlen(coalesce(html, '')) AS size FROM pages),
 placed AS (SELECT page_id, file, coalesce(sum(size) OVER (PARTITION BY file ORDER BY page_id
 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "offset" FROM r)
 SELECT page_id, file, CAST("offset" AS BIGINT) AS "offset", CASE WHEN page_id % 89 = 3 THEN 'missing' ELSE 'changed' END AS fault
 FROM placed WHERE page_id % 89 = 3 OR page_id % 97 = 5"""
)
def op3_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as archives, against a replica that lost some records and has damaged headers, lengths and payloads of others.

    Both are written as compressed WARC files, and audited from these files alone.
    """
    ours = warc.archived(table(spark, sf_dir, "pages"), PAGES_PER_FILE, "page_id", "url", "html")
    text = F.col("record").cast("string")
    damaged = (
        F.when(F.col("id") % 3 == 0, F.overlay(text, F.lit("w"), F.lit(1)))
        .when(F.col("id") % 3 == 1, F.overlay(text, F.lit("x"), F.instr(text, "\r\nContent-Length: ") + 18))
        .otherwise(F.overlay(text, F.lit("\x01"), F.length(text) - 4))
    )
    theirs = F.when(F.expr("id % 97 = 5"), damaged.cast("binary")).otherwise(F.col("record"))
    folder = fresh_folder(spark, "archives")
    warc.write_replicas(ours, {"ours": F.col("record"), "theirs": F.when(F.expr("id % 89 <> 3"), theirs)}, folder)
    found = warc.audit_files(*(partial(warc.numbered_files, spark, folder, side) for side in ("ours", "theirs")))
    page_id = F.regexp_extract("record_id", "<urn:record:(.*)>", 1).cast("long").alias("page_id")
    return found.select(page_id, F.col("file").cast("long").alias("file"), "offset", "fault")


@query()
def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats_removed(table(spark, sf_dir, "documents"))


@query()
def op5_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    return suffix_tree.scored(table(spark, sf_dir, "documents"), held_out)


CENTROIDS, ROUNDS, DIMENSIONS = 16, 3, 64


def _clusters_sql() -> str:
    """Rounds are unrolled; each is a distance to every centroid, the least (distance, number), and floored means."""
    parts = [
        f"""v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
 FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), e) - 1 AS c, e FROM v
 QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id), e) <= {CENTROIDS})""",
    ]
    squared = "list_sum(list_transform(list_zip(v.e, c.e), lambda p: CAST((p[1] - p[2]) * (p[1] - p[2]) AS BIGINT)))"
    for i in range(ROUNDS + 1):
        parts.append(
            f"""a{i} AS (SELECT r, arg_min(c, (d, c)) AS c, CAST(min(d) AS BIGINT) AS d FROM
 (SELECT v.r, c.c, CAST({squared} AS BIGINT) AS d FROM v, c{i} c) GROUP BY r)"""
        )
        if i < ROUNDS:
            parts.append(
                f"""m{i} AS (SELECT c, list(CAST((s - (((s % n) + n) % n)) // n AS BIGINT) ORDER BY j) AS e FROM
 (SELECT a.c, j, CAST(sum(v.e[j]) AS BIGINT) AS s, count(*) AS n FROM v JOIN a{i} a USING (r), range(1, {DIMENSIONS + 1}) t(j) GROUP BY a.c, j) GROUP BY c)"""
            )
            parts.append(f"c{i + 1} AS (SELECT c.c, coalesce(m.e, c.e) AS e FROM c{i} c LEFT JOIN m{i} m USING (c))")
    return f"""WITH {", ".join(parts)}
 SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
 CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(k.e, ',')) AS centroid_sha256
 FROM a{ROUNDS} JOIN v USING (r) JOIN c{ROUNDS} k USING (c)"""


@query(_clusters_sql())
def op13_shallot(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shallot.centroid_clusters(table(spark, sf_dir, "embeddings"), CENTROIDS, ROUNDS, DIMENSIONS)
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]
    place = F.col("cluster") + 1
    return found.rows.select(
        "vec_id",
        "cluster",
        "distance",
        F.element_at(F.array(*map(F.lit, found.inertia)).cast("array<long>"), place).alias("cluster_inertia"),
        F.lit(sum(found.inertia)).cast("long").alias("inertia"),
        F.element_at(F.array(*map(F.lit, hashes)).cast("array<string>"), place).alias("centroid_sha256"),
    )


TAMPERED = 5


def _manifest_sql(fan: int = 16, leaf_levels: int = 5, source_levels: int = 2) -> str:
    """The tree level by level, for up to fan**leaf_levels rows of a source and fan**source_levels sources."""

    def h(text: str) -> str:
        return "sha256('' || " + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    crc = """list_reduce(flatten(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
 lambda j: list_concat([CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(j AS INT), 1)) AS BIGINT)], [-1, -1, -1, -1, -1, -1, -1, -1]))),
 lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END, CAST(4294967295 AS BIGINT))"""
    parts = [
        f"""leaves AS (SELECT row_number() OVER () AS r, doc_id, source, {h("text")} AS leaf,
 CASE WHEN coalesce(xor({crc}, 4294967295) % {TAMPERED} = 0, false) THEN {h(f"translate(text, '{decontaminate.UPPER}', '{decontaminate.LOWER}')")} ELSE {h("text")} END AS changed FROM documents)""",
        "t0 AS (SELECT *, leaf AS h, coalesce('+' || source, '') AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves)",
        "s0 AS (SELECT g, i, h, count(*) OVER (PARTITION BY g) AS n FROM t0)",
    ]

    def climb(name: str, levels: int) -> None:
        for k in range(levels):
            run = f"PARTITION BY g, i // {fan} ORDER BY i ROWS BETWEEN"
            parts.append(
                f"""{name}p{k} AS (SELECT g, i, n, h, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
 coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM {name}{k} WHERE n > 1)"""
            )
            parts.append(
                f"""{name}{k + 1} AS (SELECT g, i // {fan} AS i, sha256(string_agg(h, '' ORDER BY i)) AS h, (any_value(n) + {fan - 1}) // {fan} AS n
 FROM {name}{k} WHERE n > 1 GROUP BY g, i // {fan} UNION ALL SELECT g, i, h, n FROM {name}{k} WHERE n = 1)"""
            )

    climb("s", leaf_levels)
    parts.append(f"u0 AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, h, count(*) OVER () AS n, g AS member FROM s{leaf_levels})")
    climb("u", source_levels)
    columns, joins, proof, fold = [], [], [], "changed"
    for name, levels, at in (("s", leaf_levels, "t0.i"), ("u", source_levels, "u0.i")):
        for k in range(levels):
            p = f"{name}p{k}"
            joins.append(f"LEFT JOIN {p} ON {p}.g = {'t0.g' if name == 's' else chr(39) * 2} AND {p}.i = {at} // {fan**k}")
            proof.append(f"coalesce({p}.b || {p}.a, '')")
            columns.append(f"{p}.b AS {p}b, {p}.a AS {p}a")
    parts.append(
        f"""w0 AS (SELECT t0.*, u0.h AS subroot, sha256({" || ".join(proof)}) AS proof, {", ".join(columns)}, changed AS f
 FROM t0 JOIN u0 ON u0.member = t0.g {" ".join(joins)})"""
    )
    steps = [f"sp{k}" for k in range(leaf_levels)] + [f"up{k}" for k in range(source_levels)]
    for j, p in enumerate(steps):
        parts.append(f"w{j + 1} AS (SELECT * REPLACE (CASE WHEN {p}b IS NULL THEN f ELSE sha256({p}b || f || {p}a) END AS f) FROM w{j})")
    return f"""WITH {", ".join(parts)} SELECT doc_id, leaf, subroot, (SELECT h FROM u{source_levels}) AS root, proof AS proof_sha256,
 f AS folded_root, f = (SELECT h FROM u{source_levels}) AS verified FROM w{len(steps)}"""


@query(_manifest_sql())
def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", decontaminate.UPPER, decontaminate.LOWER)
    changed = F.when(remainder("doc_id", TAMPERED) == 0, manifest.digest(*fields, lowered))
    tree = manifest.built(docs, F.col("source"), F.col("doc_id"), manifest.digest(*fields, F.col("text")), changed, {"doc_id": F.col("doc_id")})
    folded = F.element_at("copies", -1)
    return tree.rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))


@query()
def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = randomness.scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("findings", lambda x: x["kind"] != "random")

    def written(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    counts = [F.expr(f"CAST(size(filter(findings, x -> x.kind = '{kind}')) AS long)").alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("findings")).alias("spans"))
