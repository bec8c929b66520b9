"""Acceptance queries on the driver tables, each with the SQL it has to agree with.

The tables stand in for the inputs of the library: orders for shop orders and commits,
lineitem for payments and child rows, events for earthquakes and nested JSON, documents
with labels for a curated catalogue, embeddings for vectors. Queries that load and merge
write to a new folder under the session's shared folder and read the result back.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import (
    local_day_end,
    local_day_start,
)
from tidemark.operators import curation, intervals, normalize, quality, rollup, variants, vectors
from tidemark.operators.quality import checks, metrics
from tidemark.operators.vector_index import VectorIndex
from tidemark.operators.vector_store import VectorStore, content
from tidemark.plans import Pipeline, Resource, Source, commits, paged_resource, quakes, shop, transformation, videos
from tidemark.session import apply_settings, fresh_folder
from tidemark.sources import bounded_events, dated, feature_files, json_pages, parquet_glob, parquet_tree
from tidemark.streaming import landed_files, load_stream
from tidemark.windows import Incremental, TimeWindow

MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
SMALLEST = "/root/testdata/sf0.001"

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with its SQL twin if it has one."""

    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_settings(spark)
            return fn(spark, sf_dir)

        _QUERIES[fn.__name__] = run
        if sql is not None:
            _ORACLE[fn.__name__] = sql
        return run

    return register


# ---- stand-ins ----------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pipeline(spark: SparkSession, label: str) -> Pipeline:
    return Pipeline(spark, label, fresh_folder(spark, label))


def shop_orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("ordered_at")
    )


def payments(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") == 7, -F.col("l_orderkey")).otherwise(F.col("l_orderkey")).alias("order_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount")
    )


def earthquakes(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("time"),
        F.col("event_type").alias("place"),
        F.col("value").alias("magnitude"),
        F.from_json("props", "k bigint").getField("k").alias("depth_km"),
    )


def feed(spark, sf_dir) -> DataFrame:
    size = F.col("p_size")
    place = F.when(size < 5, None).when(size < 10, "").otherwise(F.concat_ws(", ", "p_type", "p_brand"))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), ((F.col("p_retailprice") - 900) / 12).alias("magnitude"), place.alias("place")
    )


FEED_SQL = """(SELECT p_partkey AS id, (p_retailprice - 900) / 12 AS magnitude,
 CASE WHEN p_size < 10 THEN 'Unknown' ELSE p_brand END AS region FROM part)"""

SEVERITY_SQL = """CASE WHEN magnitude >= 8 THEN 'great' WHEN magnitude >= 7 THEN 'major' WHEN magnitude >= 6 THEN 'strong'
 WHEN magnitude >= 5 THEN 'moderate' WHEN magnitude >= 4 THEN 'light' ELSE 'minor' END"""


def commit_table(spark, sf_dir) -> DataFrame:
    """Orders in the shape of the flat commit table."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("sha"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("author_login"),
        F.col("o_orderdate").alias("authored_at"),
        F.floor("o_totalprice").cast("bigint").alias("message_length"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("is_verified"),
        (F.col("o_orderstatus") == "F").alias("is_merge_commit"),
    )


COMMIT_SQL = """(SELECT CAST(o_orderkey AS VARCHAR) AS sha, 'c' || o_custkey AS author_login, o_orderdate AS authored_at,
 CAST(floor(o_totalprice) AS BIGINT) AS message_length, o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_verified,
 o_orderstatus = 'F' AS is_merge_commit FROM orders)"""


def raw_commits(spark, sf_dir) -> DataFrame:
    """Events as nested commits with 0, 1 or 2 parents each."""
    k = F.from_json("props", "k bigint").getField("k")
    user = F.col("user_id").cast("string")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("sha"),
        F.struct(F.nullif("event_type", F.lit("error")).alias("login")).alias("author"),
        F.struct(F.col("event_type").alias("login")).alias("committer"),
        F.struct(
            F.struct(
                F.concat(F.lit("user "), user).alias("name"),
                F.concat(user, F.lit("@example.org")).alias("email"),
                F.col("ts").alias("date"),
            ).alias("author"),
            F.struct(F.col("ts").alias("date")).alias("committer"),
            F.col("props").alias("message"),
            k.alias("comment_count"),
            F.struct((F.col("value") >= 100).alias("verified")).alias("verification"),
        ).alias("commit"),
        F.slice(
            F.array(F.struct(user.alias("sha")), F.struct(F.col("event_type").alias("sha"))), F.lit(1), (k % 3).cast("int")
        ).alias("parents"),
    )


def catalogue(spark, sf_dir) -> DataFrame:
    """Documents as a catalogue; those without a label have NULL measures."""
    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return documents.join(labels, "doc_id", "left")


CATALOGUE_SQL = "(SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


# ---- shop ---------------------------------------------------------------------

CUSTOMER_ORDERS_SQL = """SELECT o_custkey AS customer_id, min(o_orderdate) AS first_order,
 max(o_orderdate) AS most_recent_order, count(o_orderkey) AS number_of_orders FROM orders GROUP BY o_custkey"""


@query(CUSTOMER_ORDERS_SQL)
def customer_orders(spark, sf_dir):
    return shop.customer_orders({"orders": shop_orders(spark, sf_dir)}).rows(spark)


@query(
    """SELECT o.o_custkey AS customer_id, CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
 FROM lineitem l LEFT JOIN orders o
 ON CASE WHEN l.l_linenumber = 7 THEN -l.l_orderkey ELSE l.l_orderkey END = o.o_orderkey GROUP BY o.o_custkey"""
)
def customer_payments(spark, sf_dir):
    """Every seventh line pays for an order that nobody knows."""
    orders = table(spark, sf_dir, "orders")
    data = {
        "orders": orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_id")),
        "payments": payments(spark, sf_dir),
    }
    totals = shop.customer_payments(data).rows(spark)
    return totals.withColumn("total_amount", F.col("total_amount").cast("double"))


@query("SELECT c_mktsegment AS city, count(c_custkey) AS number_of_customers FROM customer GROUP BY c_mktsegment")
def customers_per_city(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return shop.customers_per_city(
        customers.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("city"))
    )


@query(CUSTOMER_ORDERS_SQL)
def stored_customer_orders(spark, sf_dir):
    """Ingest, transform and read back: the shop's two steps, each replaced as a whole."""
    ingest = pipeline(spark, "shop-ingest")
    ingest.run(
        Source.of("shop", [Resource("orders", lambda s: shop_orders(s, sf_dir), "replace", "id")]), load_id="ingest"
    )
    metrics_run = pipeline(spark, "shop-metrics")
    metrics_run.run(shop.customer_orders(ingest.dataset()), load_id="metrics")
    return metrics_run.dataset()["customer_orders"].drop("_load_id")


@query(
    """SELECT n.n_name AS nation, count(*) AS customers, count(*) FILTER (c.c_acctbal >= 1000) AS rich FROM customer c
 LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name"""
)
def dataset_sql(spark, sf_dir):
    """A transformation given as query text, run over the tables of a dataset."""
    loaded = pipeline(spark, "crm")
    loaded.run(
        [
            Resource("customer", lambda s: table(s, sf_dir, "customer"), "replace"),
            Resource("nation", lambda s: table(s, sf_dir, "nation"), "replace"),
        ]
    )

    @transformation
    def customers_by_nation(dataset):
        return """SELECT n.n_name AS nation, count(*) AS customers, count_if(c.c_acctbal >= 1000) AS rich FROM customer c
            LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name"""

    return customers_by_nation(loaded.dataset()).rows(spark)


# ---- earthquakes --------------------------------------------------------------

STATS_SQL = """SELECT CAST(ts AS DATE) AS day, event_type AS region, count(*) AS event_count,
 round(avg(value), 6) AS avg_magnitude, max(value) AS max_magnitude, min(value) AS min_magnitude,
 round(avg(CAST(json_extract(props, '$.k') AS DOUBLE)), 6) AS avg_depth_km FROM events {where}
 GROUP BY CAST(ts AS DATE), event_type"""
WINDOW_SQL = "WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts <= TIMESTAMP '2024-01-12 18:00:00'"
SOME_WINDOW = ("2024-01-05T06:00:00", "2024-01-12T18:00:00")


def _rounded_stats(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("avg_magnitude", "avg_depth_km")})


@query(STATS_SQL.format(where=WINDOW_SQL))
def windowed_daily_stats(spark, sf_dir):
    data = {"earthquakes": earthquakes(spark, sf_dir)}
    return _rounded_stats(quakes.earthquake_daily_stats(data, TimeWindow(*SOME_WINDOW), align="none").rows(spark))


@query(STATS_SQL.format(where="WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-13 00:00:00'"))
def aligned_daily_stats(spark, sf_dir):
    data = {"earthquakes": earthquakes(spark, sf_dir)}
    return _rounded_stats(quakes.earthquake_daily_stats(data, TimeWindow(*SOME_WINDOW)).rows(spark))


@query(f"SELECT id, region, {SEVERITY_SQL} AS severity FROM {FEED_SQL}")
def severity_classified(spark, sf_dir):
    return (
        quakes.feeds_summary_classified({"feeds_summary": feed(spark, sf_dir)})
        .rows(spark)
        .select("id", "region", "severity")
    )


@query(
    f"""SELECT severity, count(*) AS events, CAST(CASE severity WHEN 'minor' THEN 0 WHEN 'light' THEN 1 WHEN 'moderate' THEN 2
 WHEN 'strong' THEN 3 WHEN 'major' THEN 4 ELSE 5 END AS BIGINT) AS severity_order
 FROM (SELECT {SEVERITY_SQL} AS severity FROM {FEED_SQL}) GROUP BY severity"""
)
def severity_counts(spark, sf_dir):
    classified = quakes.feeds_summary_classified({"feeds_summary": feed(spark, sf_dir)}).rows(spark)
    return quakes.severity_counts(classified)


def _stored_stats(spark, sf_dir) -> DataFrame:
    run = pipeline(spark, "quake-stats")
    run.run(quakes.earthquake_daily_stats({"earthquakes": earthquakes(spark, sf_dir)}))
    return run.dataset()["earthquake_daily_stats"]


@query("SELECT CAST(ts AS DATE) AS day, count(*) AS events FROM events GROUP BY CAST(ts AS DATE)")
def events_per_day(spark, sf_dir):
    return quakes.events_per_day(_stored_stats(spark, sf_dir))


@query(
    """SELECT event_type AS region, count(*) AS events FROM events GROUP BY event_type
 ORDER BY events DESC, region LIMIT 15"""
)
def largest_regions(spark, sf_dir):
    return quakes.largest_regions(_stored_stats(spark, sf_dir))


@query(
    """SELECT CAST(floor(value * 2) / 2 AS DOUBLE) AS magnitude_bin, count(*) AS events FROM events
 WHERE value IS NOT NULL GROUP BY CAST(floor(value * 2) / 2 AS DOUBLE)"""
)
def magnitude_bins(spark, sf_dir):
    return quakes.magnitude_bins(earthquakes(spark, sf_dir))


def _collections(spark, sf_dir) -> DataFrame:
    """Events as JSON text: one feature collection per line; some have no or a short geometry."""
    k = F.from_json("props", "k bigint").getField("k")
    point = F.array((k / 2).cast("double"), F.col("value"), (k / 4).cast("double"))
    point = F.when(k % 5 == 0, None).when(k % 5 == 1, F.slice(point, 1, 2)).otherwise(point)
    ms = F.when(k % 7 != 0, F.unix_millis(F.col("ts").cast("timestamp")))
    feature = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.struct(
            F.col("value").alias("mag"),
            F.lit("ml").alias("magType"),
            F.col("event_type").alias("place"),
            ms.alias("time"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("updated"),
            F.lit("earthquake").alias("type"),
            F.lit(0).alias("tsunami"),
            F.lit("reviewed").alias("status"),
        ).alias("properties"),
        F.when(k % 5 != 0, F.struct(point.alias("coordinates"))).alias("geometry"),
    )
    return table(spark, sf_dir, "events").select(
        F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features"))).alias("value")
    )


@query(
    """SELECT CAST(event_id AS VARCHAR) AS id, value AS magnitude, 'ml' AS magnitude_type, event_type AS place,
 CASE WHEN k % 7 <> 0 THEN date_trunc('millisecond', ts) END AS time, date_trunc('millisecond', ts) AS updated_at,
 'earthquake' AS type, CAST(0 AS BIGINT) AS tsunami, CAST(NULL AS VARCHAR) AS alert, 'reviewed' AS status,
 CAST(NULL AS VARCHAR) AS url, CASE WHEN k % 5 <> 0 THEN k / 2.0 END AS longitude,
 CASE WHEN k % 5 <> 0 THEN value END AS latitude, CASE WHEN k % 5 > 1 THEN k / 4.0 END AS depth_km
 FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)"""
)
def feature_collections(spark, sf_dir):
    """Land the collections as files, then scan and flatten them."""
    folder = fresh_folder(spark, "features")
    _collections(spark, sf_dir).write.text(folder)
    flat = feature_files(spark, folder, glob="*", multi_line=False)
    return flat.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("time", "updated_at")})


BOUNDED_SQL = """SELECT event_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-05 06:00:00'
 AND ts <= TIMESTAMP '2024-01-12 18:00:00' AND value >= 2.5"""


@query(BOUNDED_SQL)
def bounded_scan(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return bounded_events(events, TimeWindow(*SOME_WINDOW), "ts", "value").select("event_id", "ts", "value")


@query(
    """SELECT event_id, CASE WHEN value = floor(value) THEN CAST(floor(value) AS BIGINT) END AS value,
 CASE WHEN value <> floor(value) THEN value END AS value__v_double, value AS merged FROM events"""
)
def variant_columns(spark, sf_dir):
    """Whole numbers arrive first, so the column is bigint; the others land in a variant column."""
    run = pipeline(spark, "variants")
    events = table(spark, sf_dir, "events").select("event_id", "value")
    whole = F.col("value") == F.floor("value")
    run.run(events.where(whole).withColumn("value", F.col("value").cast("bigint")), "quakes", load_id="1")
    run.run(events.where(~whole), "quakes", load_id="2")
    stored = run.dataset()["quakes"]
    return stored.select("event_id", "value", "value__v_double", quakes.remerged(stored, "value").alias("merged"))


@query(
    """SELECT value AS magnitude, CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS DOUBLE) / CASE WHEN event_type = 'click'
 THEN 8 ELSE 1 END AS depth_km, event_type AS type FROM events"""
)
def magnitude_and_depth(spark, sf_dir):
    """Depths are whole in one load and fractional in the next; the report reads both columns."""
    run = pipeline(spark, "depths")
    rows = earthquakes(spark, sf_dir).withColumnRenamed("place", "type")
    run.run(rows.where("type <> 'click'"), "earthquakes", load_id="1")
    run.run(
        rows.where("type = 'click'").withColumn("depth_km", F.col("depth_km").cast("double") / 8),
        "earthquakes",
        load_id="2",
    )
    return quakes.magnitude_and_depth(run.dataset()["earthquakes"])


# ---- commits ------------------------------------------------------------------


def _loaded_commits(spark, sf_dir) -> Pipeline:
    run = pipeline(spark, "commits")
    run.run(Resource("commits", lambda s: raw_commits(s, sf_dir), "replace", "sha"), load_id="raw")
    return run


@query(
    """SELECT CAST(event_id AS VARCHAR) AS sha, CASE WHEN event_type = 'error' THEN 'unknown' ELSE event_type END AS author_login,
 event_type AS committer_login, 'user ' || user_id AS author_name, user_id || '@example.org' AS author_email,
 ts AS authored_at, ts AS committed_at, props AS message, length(props) AS message_length, value >= 100 AS is_verified,
 k AS comment_count, k % 3 AS parent_count, k % 3 > 1 AS is_merge_commit
 FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)"""
)
def commits_enriched(spark, sf_dir):
    """Nested rows to a parent and a child table, then one flat table of 13 columns."""
    return commits.commits(_loaded_commits(spark, sf_dir).dataset()).rows(spark)


@query(
    """SELECT CAST(event_id AS VARCHAR) AS sha, ts AS authored_at, CASE WHEN event_type = 'error' THEN 'unknown' ELSE event_type END AS author_login,
 value >= 100 AS is_verified, k AS comment_count, k % 3 AS parent_count
 FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)"""
)
def landed_commits(spark, sf_dir):
    """Nested JSON whose schema, and which text is a time, is found from the data."""
    folder = fresh_folder(spark, "landed")
    raw_commits(spark, sf_dir).write.option("timestampNTZFormat", MICROSECONDS).json(folder)
    run = pipeline(spark, "landed")
    run.run(paged_resource("commits", folder, multi_line=False, primary_key="sha", infer_times=True), load_id="1")
    flat = commits.commits(run.dataset()).rows(spark).withColumn("authored_at", F.col("authored_at").cast("timestamp_ntz"))
    return flat.select("sha", "authored_at", "author_login", "is_verified", "comment_count", "parent_count")


@query(
    """SELECT sha256('{"sha":"' || event_id || '"}') AS _parent_id, CAST(json_extract(props, '$.k') AS BIGINT) % 3 AS parent_count
 FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) % 3 > 0"""
)
def parents_per_commit(spark, sf_dir):
    return commits.parents_per_commit(_loaded_commits(spark, sf_dir).dataset()["commits__parents"])


@query(
    """SELECT o.o_orderkey, coalesce(c.child_count, 0) AS child_count, coalesce(c.child_count, 0) > 1 AS is_multi
 FROM orders o LEFT JOIN (SELECT CASE WHEN l_quantity > 30 THEN l_orderkey ELSE -l_orderkey END AS parent,
 count(l_linenumber) AS child_count FROM lineitem GROUP BY parent) c ON o.o_orderkey = c.parent"""
)
def parent_child_counts(spark, sf_dir):
    """The child side is counted per key before the join; small lines belong to no order."""
    orders = table(spark, sf_dir, "orders")
    children = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.when(F.col("l_quantity") > 30, F.col("l_orderkey")).otherwise(-F.col("l_orderkey")).alias("parent"))
        .agg(F.count("l_linenumber").alias("n"))
    )
    count = F.coalesce("n", F.lit(0).cast("bigint"))
    return orders.join(children, orders.o_orderkey == children.parent, "left").select(
        "o_orderkey", count.alias("child_count"), (count > 1).alias("is_multi")
    )


@query(
    f"""SELECT count(*) AS total, count(*) FILTER (is_merge_commit) AS merges, count(*) FILTER (NOT is_merge_commit) AS regular,
 count(DISTINCT author_login) AS authors, count(*) FILTER (is_verified) AS verified, round(avg(message_length), 1) AS avg_message
 FROM {COMMIT_SQL}"""
)
def at_a_glance(spark, sf_dir):
    return commits.at_a_glance(commit_table(spark, sf_dir))


AUTHORS_SQL = f"""SELECT author_login, count(sha) AS total_commits, CAST(sum(CAST(is_merge_commit AS INT)) AS BIGINT) AS merge_commits,
 CAST(sum(CAST(is_verified AS INT)) AS BIGINT) AS verified_commits, round(avg(message_length), 1) AS avg_message_length
 FROM {COMMIT_SQL} GROUP BY author_login ORDER BY total_commits DESC, author_login LIMIT 15"""


@query(
    f"""SELECT *, round(CAST(merge_commits AS DOUBLE) / total_commits * 100, 1) AS merge_pct,
 round(CAST(verified_commits AS DOUBLE) / total_commits * 100, 1) AS verified_pct FROM ({AUTHORS_SQL})"""
)
def top_authors(spark, sf_dir):
    return commits.top_authors(commit_table(spark, sf_dir))


@query(
    f"""SELECT author_login AS "Author", total_commits AS "Total", merge_commits AS "Merges", verified_commits AS "Verified",
 avg_message_length AS "Avg Msg Len", round(CAST(merge_commits AS DOUBLE) / total_commits * 100, 1) AS "Merge %",
 round(CAST(verified_commits AS DOUBLE) / total_commits * 100, 1) AS "Verified %" FROM ({AUTHORS_SQL})"""
)
def author_breakdown(spark, sf_dir):
    return commits.author_breakdown(commit_table(spark, sf_dir))


@query(
    f"""SELECT *, total - merges AS regular, round(CAST(merges AS DOUBLE) / total * 100, 1) AS merge_ratio FROM
 (SELECT date_trunc('month', authored_at) AS month, count(sha) AS total,
 CAST(sum(CAST(is_merge_commit AS INT)) AS BIGINT) AS merges FROM {COMMIT_SQL} GROUP BY date_trunc('month', authored_at))"""
)
def monthly_activity(spark, sf_dir):
    return commits.monthly_activity(commit_table(spark, sf_dir))


@query(
    f"""SELECT date_trunc('month', authored_at) AS month, count(DISTINCT author_login) AS unique_authors FROM {COMMIT_SQL}
 GROUP BY date_trunc('month', authored_at)"""
)
def monthly_authors(spark, sf_dir):
    return commits.monthly_authors(commit_table(spark, sf_dir))


@query(
    f"""SELECT *, total - verified AS unverified FROM (SELECT date_trunc('month', authored_at) AS month, count(sha) AS total,
 CAST(sum(CAST(is_verified AS INT)) AS BIGINT) AS verified FROM {COMMIT_SQL} GROUP BY date_trunc('month', authored_at))"""
)
def monthly_verification(spark, sf_dir):
    return commits.monthly_verification(commit_table(spark, sf_dir))


@query(
    """SELECT CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, ['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][isodow(ts)] AS day_name,
 CAST(hour(ts) AS INTEGER) AS hour, count(event_id) AS commits FROM events GROUP BY ALL"""
)
def commit_hours(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return commits.commit_hours(events.select(F.col("event_id").alias("sha"), F.col("ts").alias("authored_at")))


@query(
    """SELECT CAST(floor(length(text) / 500.0) * 500 AS DOUBLE) AS bin_start, CASE WHEN lang = 'en' THEN 'Regular' ELSE 'Merge' END AS type,
 count(*) AS n FROM documents GROUP BY ALL"""
)
def length_histogram(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return commits.message_lengths(
        documents.select(F.length("text").alias("message_length"), (F.col("lang") != "en").alias("is_merge_commit")), 500
    )


@query(
    f"""WITH c AS {COMMIT_SQL}, r AS (SELECT (max(message_length) - min(message_length)) / 50.0 AS raw FROM c),
 s AS (SELECT raw, pow(10, floor(log10(raw))) AS p FROM r),
 t AS (SELECT CASE WHEN p >= raw THEN p WHEN p * 2 >= raw THEN p * 2 WHEN p * 5 >= raw THEN p * 5 ELSE p * 10 END AS step FROM s)
 SELECT CAST(floor(message_length / step) * step AS DOUBLE) AS bin_start, CASE WHEN is_merge_commit THEN 'Merge' ELSE 'Regular' END AS type,
 count(*) AS n FROM c, t GROUP BY ALL"""
)
def message_length_bins(spark, sf_dir):
    """The bin width follows from the smallest and largest value; at most 50 bins."""
    return commits.message_lengths(commit_table(spark, sf_dir))


# ---- normalisation ------------------------------------------------------------


@query(
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props__k, event_type AS meta__kind__name,
 user_id AS meta__user FROM events"""
)
def flattened_structs(spark, sf_dir):
    nested = table(spark, sf_dir, "events").select(
        "event_id",
        F.from_json("props", "k bigint").alias("props"),
        F.struct(F.struct(F.col("event_type").alias("name")).alias("kind"), F.col("user_id").alias("user")).alias("meta"),
    )
    return normalize.flatten(nested)


def _documents_with_lines(spark, sf_dir) -> DataFrame:
    lines = F.transform(F.split("text", "\n"), lambda line: F.struct(F.length(line).alias("n_chars"), line.alias("line")))
    return table(spark, sf_dir, "documents").select("doc_id", F.struct("lang", lines.alias("lines")).alias("body"))


@query(
    """SELECT sha256('{"doc_id":' || doc_id || '}') AS _parent_id, i - 1 AS _list_idx, length(line) AS n_chars, line FROM
 (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
 FROM documents)"""
)
def child_rows(spark, sf_dir):
    """A list of objects inside each document becomes a child table that points to its parent."""
    keyed = normalize.with_row_keys(_documents_with_lines(spark, sf_dir), ["doc_id"])
    return normalize.relational_tables(keyed, "docs")["docs__body__lines"].drop("_row_id")


@query(
    """SELECT l_returnflag, l_linestatus, l_quantity, row_number() OVER (PARTITION BY l_returnflag, l_linestatus, l_quantity) - 1 AS copy
 FROM lineitem"""
)
def numbered_copies(spark, sf_dir):
    """Exact copies get a running number, so that every row has a key of its own."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return normalize.numbered_copies(rows, "copy")


@query("SELECT count(*) AS n_rows, count(*) AS n_keys FROM lineitem")
def row_keys_are_unique(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    keyed = normalize.with_row_keys(rows, load_id="1")
    return keyed.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("_row_id").alias("n_keys"))


@query(
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority,
 CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS o_totalprice FROM orders"""
)
def evolved_schema(spark, sf_dir):
    """A later load brings a new column and lacks an old one; both read as NULL where absent."""
    run = pipeline(spark, "evolution")
    orders = table(spark, sf_dir, "orders")
    run.run(orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_custkey", "o_orderpriority"), "orders", load_id="1")
    run.run(orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice"), "orders", load_id="2")
    return run.dataset()["orders"].drop("_load_id")


# ---- scans --------------------------------------------------------------------


@query("SELECT doc_id, lang, source, n_chars FROM documents")
def pruned_scan(spark, sf_dir):
    """The heavy text column is never read."""
    return parquet_glob(spark, sf_dir, "documents.parquet").drop("text")


@query("SELECT vec_id, label FROM embeddings")
def recursive_scan(spark, sf_dir):
    """A tree of parquet folders, without its heavy columns."""
    root = fresh_folder(spark, "tree")
    vectors_table = table(spark, sf_dir, "embeddings")
    vectors_table.where("label < 5").write.parquet(f"{root}/a/first")
    vectors_table.where("label >= 5").write.parquet(f"{root}/b/second")
    return parquet_tree(spark, root, exclude=videos.HEAVY_COLUMNS)


@query(
    """SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
 WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-01-16'"""
)
def paged_json(spark, sf_dir):
    """Landed JSON pages, read with a declared schema and a start and end date."""
    folder = fresh_folder(spark, "pages")
    columns = ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"]
    table(spark, sf_dir, "orders").select(*columns).write.json(folder)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_totalprice double"
    return dated(json_pages(spark, folder, schema, multi_line=False), "o_orderdate", "1997-01-01", "1997-01-15")


# ---- loading ------------------------------------------------------------------


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders"""
)
def merge_by_key(spark, sf_dir):
    """Base: all but the finished orders from 2000 on. Batch: all finished orders repriced, some known and some new; run twice."""
    run = pipeline(spark, "merge")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    target = Resource(
        "orders",
        lambda s: orders.where("o_orderdate < timestamp_ntz'2000-01-01' OR o_orderstatus <> 'F'"),
        "merge",
        "o_orderkey",
        buckets=4,
    )
    run.run(target, load_id="1")
    batch = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    run.run(target.with_rows(batch), load_id="2")
    run.run(target.with_rows(batch), load_id="3")
    return run.dataset()["orders"].select("o_orderkey", "o_totalprice")


@query(
    """SELECT CAST(ts AS DATE) AS day, event_type AS region, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-10' THEN 2 * count(*)
 ELSE count(*) END AS event_count FROM events GROUP BY CAST(ts AS DATE), event_type"""
)
def merge_by_composite_key(spark, sf_dir):
    """Rows of (day, region) are replaced; only the touched days are rewritten."""
    run = pipeline(spark, "composite")
    stats = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("ts").cast("date").alias("day"), F.col("event_type").alias("region"))
        .agg(F.count(F.lit(1)).alias("event_count"))
    )
    target = Resource("stats", lambda s: stats, "merge", ("day", "region"), partition_by="day")
    run.run(target, load_id="1")
    later = stats.where("day >= date'2024-01-10'").withColumn("event_count", F.col("event_count") * 2)
    run.run(target.with_rows(later), load_id="2")
    return run.dataset()["stats"].drop("_row_id", "_load_id")


@query(
    """SELECT event_id, CASE WHEN event_type = 'purchase' THEN ts + INTERVAL 40 DAY ELSE ts END AS ts, event_type FROM events"""
)
def merge_moves_partition(spark, sf_dir):
    """Laid out by day, keyed by id: revised rows move to another day, and the old ones go."""
    run = pipeline(spark, "moves")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    target = Resource("events", lambda s: events, "merge", "event_id", partition_by=("ts", "day"))
    run.run(target, load_id="1")
    moved = events.where("event_type = 'purchase'").withColumn("ts", F.col("ts") + F.expr("INTERVAL 40 DAY"))
    run.run(target.with_rows(moved), load_id="2")
    return run.dataset()["events"].select("event_id", "ts", "event_type")


@query(
    """SELECT user_id, arg_max(event_id, ts) AS event_id FROM events GROUP BY user_id"""
)
def latest_row_per_key(spark, sf_dir):
    """A batch with many rows per key: the newest wins."""
    run = pipeline(spark, "latest")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    run.run(Resource("last_seen", lambda s: events, "merge", "user_id", newest="ts"), load_id="1")
    return run.dataset()["last_seen"].select("user_id", "event_id")


LOADS_SQL = """SELECT 'events' AS table_name, 'load_a' AS _load_id, count(*) AS row_count FROM events WHERE ts < TIMESTAMP '2024-01-15'
 UNION ALL SELECT 'events', 'load_b', count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-15'
 UNION ALL SELECT 'orders', 'load_a', count(*) FROM orders WHERE o_orderstatus = 'F'
 UNION ALL SELECT 'orders', 'load_b', count(*) FROM orders WHERE o_orderstatus <> 'F'"""


def _two_loads(spark, sf_dir) -> Pipeline:
    run = pipeline(spark, "loads")
    orders, events = table(spark, sf_dir, "orders"), table(spark, sf_dir, "events")
    parts = {
        "load_a": (orders.where("o_orderstatus = 'F'"), events.where("ts < timestamp_ntz'2024-01-15'")),
        "load_b": (orders.where("o_orderstatus <> 'F'"), events.where("ts >= timestamp_ntz'2024-01-15'")),
    }
    for load_id, (some_orders, some_events) in parts.items():
        run.run(
            [Resource("orders", lambda s: some_orders), Resource("events", lambda s: some_events)], load_id=load_id
        )
    return run


@query(LOADS_SQL)
def rows_per_load(spark, sf_dir):
    return _two_loads(spark, sf_dir).dataset().rows_per_load()


@query(f"SELECT _load_id AS load_id, table_name, row_count AS rows, 'append' AS disposition, 'completed' AS status FROM ({LOADS_SQL})")
def load_summaries(spark, sf_dir):
    """What each load reported, counted while it wrote."""
    return _two_loads(spark, sf_dir).dataset().loads().select("load_id", "table_name", "rows", "disposition", "status")


@query(
    """SELECT 'events' AS table_name, count(*) AS row_count FROM events UNION ALL SELECT 'orders', count(*) FROM orders"""
)
def dataset_row_counts(spark, sf_dir):
    return _two_loads(spark, sf_dir).dataset().row_counts()


@query("SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-12' AND ts <= TIMESTAMP '2024-01-25'")
def refresh_from_epoch(spark, sf_dir):
    """A refresh run drops what was loaded and begins again at a later epoch."""
    run = pipeline(spark, "epoch")
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    window = TimeWindow("2024-01-02T00:00:00", "2024-01-25T00:00:00")

    def feeds(span: TimeWindow) -> Source:
        cursor = Incremental("ts", span.start, span.end)
        return Source.of("feeds", [Resource("events", lambda s: events, "merge", "event_id", incremental=cursor)])

    run.run(feeds(window), load_id="1")
    run.run(feeds(window.since("2024-01-12T00:00:00")), refresh="drop_sources", load_id="2")
    return run.dataset()["events"].select("event_id", "ts")


@query(
    """SELECT 'customer' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_orderstatus = 'O'"""
)
def refresh_of_resources(spark, sf_dir):
    """Only the table of the job is dropped and loaded again."""
    run = pipeline(spark, "refresh")
    orders = Resource("orders", lambda s: table(s, sf_dir, "orders"))
    crm = Source.of("crm", [orders, Resource("customer", lambda s: table(s, sf_dir, "customer"))])
    run.run(crm, load_id="1")
    again = Source.of("crm", [orders.with_rows(table(spark, sf_dir, "orders").where("o_orderstatus = 'O'"))])
    run.run(again, refresh="drop_resources", load_id="2")
    return run.dataset().row_counts()


@query("SELECT 'orders' AS table_name, count(*) AS row_count FROM orders WHERE o_orderstatus = 'O'")
def refresh_of_source(spark, sf_dir):
    """Every table of the source is dropped; only what is loaded again is there."""
    run = pipeline(spark, "refresh")
    orders = Resource("orders", lambda s: table(s, sf_dir, "orders"))
    crm = Source.of("crm", [orders, Resource("customer", lambda s: table(s, sf_dir, "customer"))])
    run.run(crm, load_id="1")
    again = Source.of("crm", [orders.with_rows(table(spark, sf_dir, "orders").where("o_orderstatus = 'O'"))])
    run.run(again, refresh="drop_sources", load_id="2")
    return run.dataset().row_counts()


@query(
    """SELECT f AS file_format, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
 FROM customer, (SELECT unnest(['csv', 'json', 'orc', 'parquet']) AS f) GROUP BY f"""
)
def load_file_formats(spark, sf_dir):
    run = pipeline(spark, "formats")
    for file_format in ("csv", "json", "orc", "parquet"):
        run.run(table(spark, sf_dir, "customer"), file_format, load_id=file_format, file_format=file_format)
    data = run.dataset()
    balance = F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance")
    parts = [
        data[name].agg(F.count("c_custkey").alias("n"), balance).select(F.lit(name).alias("file_format"), "n", "balance")
        for name in data.tables
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    """SELECT event_id, event_id AS payload__id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 2 = 0 END AS payload__deep__even,
 CASE WHEN event_id % 7 > 2 THEN CAST(value AS DOUBLE) END AS payload__deep__mixed,
 CASE WHEN event_id % 7 = 0 THEN event_type END AS payload__deep__mixed__v_string,
 CASE WHEN event_id % 7 = 1 THEN true END AS payload__deep__mixed__v_boolean,
 CASE WHEN event_id % 7 = 2 THEN '{"of":' || user_id || '}' END AS payload__deep__mixed__v_json FROM events"""
)
def typed_payloads(spark, sf_dir):
    """JSON text with a nested boolean, and one place where numbers, text, booleans and objects meet."""
    i, quoted = F.col("event_id"), lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    mixed = (
        F.when(i % 7 == 0, quoted(F.col("event_type")))
        .when(i % 7 == 1, "true")
        .when(i % 7 == 2, F.concat(F.lit('{"of": '), F.col("user_id").cast("string"), F.lit("}")))
        .otherwise(F.coalesce(F.col("value").cast("string"), F.lit("null")))
    )
    even = F.when(i % 5 == 0, "null").otherwise((i % 2 == 0).cast("string"))
    text = F.format_string('{"id": %d, "deep": {"even": %s, "mixed": %s}}', i, even, mixed)
    return variants.typed_json(table(spark, sf_dir, "events").select("event_id", text.alias("payload")), "payload")


# ---- incremental --------------------------------------------------------------


@query(
    """SELECT CAST(ts AS DATE) AS day, event_type AS region, count(*) AS event_count FROM events
 WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-20' GROUP BY CAST(ts AS DATE), event_type"""
)
def replayed_windows(spark, sf_dir):
    """Overlapping windows, merged by (day, region), give the same rows as one long window."""
    run = pipeline(spark, "replay")
    ingest = Resource("earthquakes", lambda s: earthquakes(s, sf_dir), "merge", "id", partition_by=("time", "day"))
    run.run(ingest, load_id="ingest")
    data = run.dataset()
    spans = [("2024-01-03T05:00:00", "2024-01-09T07:00:00"), ("2024-01-08T00:00:00", "2024-01-15T03:00:00")]
    spans += [("2024-01-14T22:00:00", "2024-01-19T23:00:00"), ("2024-01-08T00:00:00", "2024-01-15T03:00:00")]
    for number, span in enumerate(spans):
        run.run(quakes.earthquake_daily_stats(data, TimeWindow(*span)), load_id=str(number))
    return run.dataset()["earthquake_daily_stats"].select("day", "region", "event_count")


_ROLLED_SQL = """count(*) AS event_count, round(avg(value), 6) AS avg_magnitude, max(value) AS max_magnitude, min(value) AS min_magnitude,
 round(avg(CAST(json_extract(props, '$.k') AS BIGINT)), 6) AS avg_depth_km, 1 AS places FROM events"""


@query(
    f"""SELECT 'month' AS level, date_trunc('month', ts)::DATE AS month, event_type AS region, {_ROLLED_SQL} GROUP BY date_trunc('month', ts), event_type
 UNION ALL SELECT 'region', NULL, event_type, {_ROLLED_SQL} GROUP BY event_type"""
)
def means_rolled_up(spark, sf_dir):
    """Days to months to regions from stored states, after a late arrival, its replay and a replay for nothing."""
    run = pipeline(spark, "states")
    late = "time >= '2024-01-10' AND time < '2024-01-12' AND id % 3 = 0"
    ingest = Resource("earthquakes", lambda s: earthquakes(s, sf_dir).where(f"NOT ({late})"), "merge", "id", partition_by=("time", "day"))
    run.run(ingest, load_id="early")
    run.run(quakes.earthquake_daily_states(run.dataset()), load_id="all")
    run.run(ingest.with_rows(earthquakes(spark, sf_dir).where(late)), load_id="late")
    for number, span in enumerate([("2024-01-10T06:00:00", "2024-01-11T02:00:00"), ("2024-01-20", "2024-01-21")]):
        run.run(quakes.earthquake_daily_states(run.dataset(), TimeWindow(*span)), load_id=f"replay {number}")
    daily = run.dataset()["earthquake_daily_states"]
    month = F.date_trunc("month", "day").cast("date").alias("month")
    by_month = rollup.rolled(daily, [month, "region"], quakes.QUAKE_MEASURES)
    # The coarser level is made of the finer one, not of the days.
    by_region = rollup.rolled(by_month, ["region"], quakes.QUAKE_MEASURES).withColumn("month", F.lit(None).cast("date"))
    parts = [rollup.finished(x, quakes.QUAKE_MEASURES).withColumn("level", F.lit(n)) for x, n in ((by_month, "month"), (by_region, "region"))]
    found = parts[0].unionByName(parts[1])
    rounded = {c: F.round(c, 6) for c in ("avg_magnitude", "avg_depth_km")}
    return found.withColumns({**rounded, "places": F.col("places").cast("int")})


@query(
    """SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts <= TIMESTAMP '2024-01-20'"""
)
def windowed_ingest(spark, sf_dir):
    """Closed windows that overlap, merged by id: every event once."""
    run = pipeline(spark, "windows")
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    for number, (start, end) in enumerate([("2024-01-05T06:00:00", "2024-01-12T18:00:00"), ("2024-01-12T00:00:00", "2024-01-20")]):
        resource = Resource(
            "events", lambda s: events, "merge", "event_id", incremental=Incremental("ts", start, end), buckets=4
        )
        run.run(resource, load_id=str(number))
    return run.dataset()["events"].select("event_id", "ts")


@query("SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')")
def restored_cursor(spark, sf_dir):
    """The second run begins after the highest value of the first."""
    run = pipeline(spark, "cursor")
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    cursor = Incremental("ts", range_end="open")
    first = Source.of("app", [Resource("events", lambda s: events, incremental=Incremental("ts", None, "2024-01-20", range_end="open"))])
    run.run(first, load_id="1")
    saved = run.restore_incremental(first.events, cursor)
    run.run(Source.of("app", [first.events.with_hints(incremental=saved)]), load_id="2")
    return run.dataset()["events"].where("_load_id = '2'").select("event_id", "ts")


@query("SELECT c_custkey AS id, c_name AS name FROM customer")
def refresh_that_fails_keeps_rows(spark, sf_dir):
    """A refresh whose reload fails leaves table and state as they were."""
    run = pipeline(spark, "refresh-fails")
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    good = Source.of("crm", [Resource("customer", lambda s: rows, incremental=Incremental("id"))])
    run.run(good, load_id="1")
    state = run.state
    broken = rows.withColumn("name", F.raise_error(F.lit("source is down")).cast("string"))
    try:
        run.run(Source.of("crm", [good.customer.with_rows(broken)]), refresh="drop_sources", load_id="2")
    except Exception as error:  # noqa: BLE001
        if "source is down" not in str(error):
            raise
    if run.state != state:
        raise AssertionError("the state was changed")
    return run.dataset()["customer"].select("id", "name")


@query(
    """SELECT 'day 1' AS load, count(*) AS n FROM customer UNION ALL SELECT 'day_1', count(*) FROM customer
 UNION ALL SELECT 'supplier', count(*) FROM supplier"""
)
def same_load_id_other_table(spark, sf_dir):
    """Load ids that look alike as file names, and one id in two pipelines of one dataset, are loads of their own."""
    root = fresh_folder(spark, "ids")
    first, second = (Pipeline(spark, name, root, dataset="shared") for name in ("first", "second"))
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    for load_id in ("day 1", "day_1"):
        first.run(Resource("customer", lambda s: customers), load_id=load_id)
    second.run(Resource("supplier", lambda s: table(s, sf_dir, "supplier").select("s_suppkey")), load_id="day 1")
    data = first.dataset()
    loads = data["customer"].groupBy(F.col("_load_id").alias("load")).agg(F.count(F.lit(1)).alias("n"))
    return loads.unionByName(data["supplier"].select(F.lit("supplier").alias("load")).groupBy("load").agg(F.count(F.lit(1)).alias("n")))


@query("SELECT event_id, ts FROM events")
def cursor_boundary_rows(spark, sf_dir):
    """The first run sees half of the rows of its last day, the second all of them: each is stored once."""
    run = pipeline(spark, "boundary")
    day = F.col("ts").cast("date")
    events = table(spark, sf_dir, "events").select("event_id", "ts", day.alias("day"))
    early = events.where("day < date'2024-01-10' OR (day = date'2024-01-10' AND event_id % 2 = 0)")
    cursor = Incremental("day")
    first = Source.of("app", [Resource("events", lambda s: early, incremental=cursor)])
    run.run(first, load_id="1")
    saved = run.restore_incremental(first.events, cursor)
    run.run(Source.of("app", [first.events.with_rows(events).with_hints(incremental=saved)]), load_id="2")
    return run.dataset()["events"].select("event_id", "ts")


@query("SELECT o_orderkey AS id, o_orderkey + 9007199254740990 AS amount FROM orders")
def decimal_cursor(spark, sf_dir):
    """A decimal cursor beyond what a double holds exactly, in two runs."""
    run = pipeline(spark, "decimal")
    amount = (F.col("o_orderkey") + F.lit(9007199254740990)).cast("decimal(20,0)")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), amount.alias("amount"))
    cursor = Incremental("amount", range_start="open")
    half = orders.where("amount <= 9007199254740990 + 500")
    first = Source.of("app", [Resource("orders", lambda s: half, incremental=cursor)])
    run.run(first, load_id="1")
    saved = run.restore_incremental(first.orders, cursor)
    run.run(Source.of("app", [first.orders.with_rows(orders).with_hints(incremental=saved)]), load_id="2")
    return run.dataset()["orders"].select("id", F.col("amount").cast("bigint").alias("amount"))


@query(
    """SELECT o_orderkey AS id, o_orderdate AS at, CAST(o_custkey AS VARCHAR) AS postcode, strftime(o_orderdate, '%H:%M') AS clock,
 CAST(year(o_orderdate) AS VARCHAR) AS year, 'timestamp,string,string,string' AS types FROM orders"""
)
def inferred_times(spark, sf_dir):
    """ISO instants become timestamps; digits, years and clock times stay text."""
    run = pipeline(spark, "times")
    text = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("at"),
        F.col("o_custkey").cast("string").alias("postcode"),
        F.date_format("o_orderdate", "HH:mm").alias("clock"),
        F.date_format("o_orderdate", "yyyy").alias("year"),
    )
    run.run(Resource("texts", lambda s: text, infer_times=True), load_id="1")
    stored = run.dataset()["texts"].drop("_load_id")
    kinds = dict(stored.dtypes)
    types = ",".join(kinds[c] for c in ("at", "postcode", "clock", "year"))
    return stored.withColumn("at", F.col("at").cast("timestamp_ntz")).withColumn("types", F.lit(types))


@query(
    """SELECT doc_id % 7 + 1 AS page, count(*) AS n FROM documents WHERE doc_id % 7 + 1 <= 3 GROUP BY page"""
)
def page_cap(spark, sf_dir):
    """Pages 1 to 3 of a collection landed as numbered files, all rows of each."""
    folder = fresh_folder(spark, "pages")
    page = (F.col("doc_id") % 7 + 1).alias("page")
    rows = table(spark, sf_dir, "documents").select("doc_id", page)
    rows.repartition("page").write.partitionBy("page").json(folder)
    pages = Source.of(
        "docs", [paged_resource("docs", f"{folder}/page=*", "doc_id bigint", multi_line=False, page_pattern=r"page=(\d+)")]
    )
    run = pipeline(spark, "page-cap")
    run.run(pages.add_limit(3), load_id="1")
    return run.dataset()["docs"].groupBy((F.col("doc_id") % 7 + 1).alias("page")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, ts FROM events")
def look_back(spark, sf_dir):
    """A look-back of two days reads rows again; the merge by key absorbs them."""
    run = pipeline(spark, "lag")
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    target = Resource("events", lambda s: events, "merge", "event_id", buckets=4)
    first = target.with_hints(incremental=Incremental("ts", None, "2024-01-20", range_end="open"))
    run.run(Source.of("app", [first]), load_id="1")
    bound = Source.of("app", [target])
    saved = run.restore_incremental(bound.events, Incremental("ts", lag=timedelta(days=2)))
    run.run(Source.of("app", [target.with_hints(incremental=saved)]), load_id="2")
    return run.dataset()["events"].select("event_id", "ts")


@query("SELECT event_id, ts, event_type, value FROM events")
def micro_batches(spark, sf_dir):
    """Landed JSON files are read as a stream, a few files per batch, and merged by key."""
    landing = fresh_folder(spark, "landing")
    columns = ["event_id", "ts", "event_type", "value"]
    table(spark, sf_dir, "events").select(*columns).repartition(6, "event_id").write.option(
        "timestampNTZFormat", MICROSECONDS
    ).json(landing)
    run = pipeline(spark, "stream")
    schema = "event_id bigint, ts timestamp_ntz, event_type string, value double"
    stream = landed_files(spark, landing, schema, files_per_batch=3, timestampNTZFormat=MICROSECONDS)
    target = Resource("events", lambda s: stream, "merge", "event_id", newest="ts", buckets=4)
    load_stream(stream, run, target, fresh_folder(spark, "stream-progress")).awaitTermination()
    return run.dataset()["events"].select(*columns)


@query("SELECT event_id, ts FROM events")
def stream_with_new_checkpoint(spark, sf_dir):
    """After its table was dropped, a stream that starts over loads all files again."""
    landing = fresh_folder(spark, "landing")
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    events.write.option("timestampNTZFormat", MICROSECONDS).json(landing)
    run = pipeline(spark, "restart")
    stream = landed_files(spark, landing, "event_id bigint, ts timestamp_ntz", timestampNTZFormat=MICROSECONDS)
    target = Resource("events", lambda s: stream, "merge", "event_id", buckets=4)
    for _ in range(2):
        load_stream(stream, run, target, fresh_folder(spark, "stream-progress")).awaitTermination()
        kept = run.dataset()["events"]
        if _ == 0:
            run.dataset().stored("events").drop()
    return kept.select("event_id", "ts")


ACTIVE_DAYS_SQL = """(SELECT user_id, d, sum(brk) OVER (PARTITION BY user_id ORDER BY d) AS island FROM
 (SELECT user_id, d, CASE WHEN lag(d) OVER (PARTITION BY user_id ORDER BY d) = d - INTERVAL 1 DAY THEN 0 ELSE 1 END AS brk FROM
 (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events) a) b)"""


def _active_days(spark, sf_dir) -> DataFrame:
    day = F.col("ts").cast("date")
    days = table(spark, sf_dir, "events").select("user_id", day.alias("day_start")).distinct()
    return days.withColumn("day_end", F.date_add("day_start", 1))


@query(
    f"""SELECT user_id, min(d) AS island_start, CAST(max(d) + INTERVAL 1 DAY AS DATE) AS island_end, count(*) AS n
 FROM {ACTIVE_DAYS_SQL} c GROUP BY user_id, island"""
)
def coverage_islands(spark, sf_dir):
    """Runs of days on which a user was active."""
    return intervals.islands(_active_days(spark, sf_dir), "day_start", "day_end", ["user_id"])


@query(
    f"""SELECT user_id, CAST(e AS DATE) AS gap_start, next_start AS gap_end FROM (SELECT user_id, max(d) + INTERVAL 1 DAY AS e,
 lead(min(d)) OVER (PARTITION BY user_id ORDER BY min(d)) AS next_start FROM {ACTIVE_DAYS_SQL} c GROUP BY user_id, island)
 WHERE next_start IS NOT NULL"""
)
def coverage_gaps(spark, sf_dir):
    return intervals.gaps(_active_days(spark, sf_dir), "day_start", "day_end", ["user_id"])


@query(
    """WITH s AS (SELECT user_id, ts AS s, ts + to_minutes(CAST(json_extract(props, '$.k') AS BIGINT) * 60) AS e FROM events),
 m AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s),
 g AS (SELECT *, sum(CASE WHEN s <= before THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY s, e) AS island FROM m)
 SELECT user_id, min(s) AS island_start, max(e) AS island_end, count(*) AS n FROM g GROUP BY user_id, island"""
)
def overlapping_intervals(spark, sf_dir):
    """Intervals of up to four days that overlap in any way."""
    k = F.from_json("props", "k bigint").getField("k")
    spans = table(spark, sf_dir, "events").select(
        "user_id", "ts", (F.col("ts") + F.make_dt_interval(hours=k.cast("int"))).alias("until")
    )
    return intervals.islands(spans, "ts", "until", ["user_id"])


@query(
    """WITH log AS (SELECT user_id % 60 AS job, CAST(ts AS DATE) AS d, value >= 10 AS done FROM events),
 days AS (SELECT DISTINCT job, d FROM log WHERE done),
 runs AS (SELECT job, d, d - CAST(row_number() OVER (PARTITION BY job ORDER BY d) AS INTEGER) AS island FROM days),
 stretches AS (SELECT job, min(d) AS s, max(d) + INTERVAL 1 DAY AS e FROM runs GROUP BY job, island),
 reached AS (SELECT job, max(e) AS covered_to FROM stretches WHERE s <= TIMESTAMP '2024-01-05' AND e >= TIMESTAMP '2024-01-05' GROUP BY job)
 SELECT job, covered_to, coalesce(covered_to >= TIMESTAMP '2024-01-12', false) AS is_fresh
 FROM (SELECT DISTINCT job FROM log) LEFT JOIN reached USING (job)"""
)
def freshness_with_holes(spark, sf_dir):
    """Events as a run log of days: which jobs have completed the whole needed week, without a hole."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    log = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 60).alias("job"),
        day.alias("interval_start"),
        (day + F.expr("INTERVAL 1 DAY")).alias("interval_end"),
        F.when(F.col("value") >= 10, "completed").otherwise("failed").alias("status"),
    )
    return intervals.freshness(log, TimeWindow("2024-01-05", "2024-01-12"))


@query(
    """WITH s AS (SELECT ts AS s, ts + to_minutes(CAST(1 + event_id % 7 AS BIGINT)) AS e FROM events WHERE event_id % 3 > 0 OR event_id % 1000 = 0),
 m AS (SELECT *, max(e) OVER (ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s)
 SELECT before AS gap_start, s AS gap_end FROM m WHERE before < s"""
)
def uncovered_minutes(spark, sf_dir):
    """Times at which nothing ran, over the whole table as one group."""
    runs = table(spark, sf_dir, "events").where("event_id % 3 > 0 OR event_id % 1000 = 0")
    spans = runs.select("ts", (F.col("ts") + F.make_dt_interval(mins=(1 + F.col("event_id") % 7).cast("int"))).alias("until"))
    return intervals.gaps(spans, "ts", "until")


@query(
    """WITH s AS (SELECT o_custkey % 3 = 0 AS held, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + CAST(CASE WHEN o_orderkey % 97 = 0 THEN 3650 ELSE 1 END AS INTEGER) AS e FROM orders),
 m AS (SELECT *, max(e) OVER (PARTITION BY held ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s),
 g AS (SELECT *, sum(CASE WHEN s <= before THEN 0 ELSE 1 END) OVER (PARTITION BY held ORDER BY s, e) AS island FROM m)
 SELECT held, min(s) AS island_start, max(e) AS island_end, count(*) AS n FROM g GROUP BY held, island"""
)
def decades_of_orders(spark, sf_dir):
    """Two groups, one with two thirds of all rows, and intervals of ten years among those of a day."""
    days = F.when(F.col("o_orderkey") % 97 == 0, 3650).otherwise(1)
    first = F.col("o_orderdate").cast("date").alias("s")
    spans = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 3 == 0).alias("held"), first, F.date_add(F.col("o_orderdate").cast("date"), days).alias("e"))
    return intervals.islands(spans, "s", "e", ["held"])


@query(
    """SELECT date_trunc('day', ts + INTERVAL 1 HOUR) - INTERVAL 1 HOUR AS day_start, date_trunc('day', ts + INTERVAL 1 HOUR)
 + INTERVAL 23 HOUR AS day_end, count(*) AS n FROM events GROUP BY ALL"""
)
def local_days(spark, sf_dir):
    """Events per calendar day of Berlin, as UTC bounds."""
    zone, ts = "Europe/Berlin", F.col("ts").cast("timestamp")
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            local_day_start(ts, zone).cast("timestamp_ntz").alias("day_start"),
            local_day_end(ts, zone).cast("timestamp_ntz").alias("day_end"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


# ---- quality ------------------------------------------------------------------


@query(
    f"""SELECT doc_id, quality IS NOT NULL AS quality__is_not_null, coalesce(quality IN (1), false) AS quality__is_in,
 coalesce(n_chars > 500, false) AS n_chars__case__GT FROM {CATALOGUE_SQL}"""
)
def checks_per_row(spark, sf_dir):
    rules = [checks.is_not_null("quality"), checks.is_in("quality", [1]), checks.case("n_chars > 500")]
    return quality.prepare_checks(catalogue(spark, sf_dir), rules, "row", keys=["doc_id"])


LINE_RULES = [
    checks.case("l_discount <= 0.05"),
    checks.is_in("l_returnflag", ["A", "N"]),
    checks.is_not_null("l_shipdate"),
    checks.is_unique("l_orderkey"),
]

LINE_RESULTS_SQL = """SELECT 'lineitem' AS table_name, check_name, n_rows, passed, n_rows - passed AS failed,
 CAST(passed AS DOUBLE) / n_rows AS success_rate, passed = n_rows AS ok FROM (
 SELECT 'l_discount__case__LTE' AS check_name, count(*) AS n_rows, count(*) FILTER (l_discount <= 0.05) AS passed FROM lineitem
 UNION ALL SELECT 'l_returnflag__is_in', count(*), count(*) FILTER (l_returnflag IN ('A', 'N')) FROM lineitem
 UNION ALL SELECT 'l_shipdate__is_not_null', count(*), count(l_shipdate) FROM lineitem
 UNION ALL SELECT 'l_orderkey__is_unique', (SELECT count(*) FROM lineitem), count(*) FROM
 (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) = 1))"""


@query(LINE_RESULTS_SQL)
def checks_per_table(spark, sf_dir):
    return quality.prepare_checks(table(spark, sf_dir, "lineitem"), LINE_RULES, "table", "lineitem")


@query(
    f"""WITH r AS ({LINE_RESULTS_SQL} UNION ALL SELECT 'orders', 'o_orderkey__is_unique', count(*), count(DISTINCT o_orderkey),
 count(*) - count(DISTINCT o_orderkey), CAST(count(DISTINCT o_orderkey) AS DOUBLE) / count(*), count(*) = count(DISTINCT o_orderkey) FROM orders)
 SELECT * FROM r UNION ALL SELECT '*', 'verdict', count(*), count(*) FILTER (ok), count(*) FILTER (NOT ok),
 CAST(count(*) FILTER (ok) AS DOUBLE) / count(*), bool_and(ok) FROM r"""
)
def checks_per_dataset(spark, sf_dir):
    data = {"lineitem": table(spark, sf_dir, "lineitem"), "orders": table(spark, sf_dir, "orders")}
    suite = quality.CheckSuite(data, {"lineitem": LINE_RULES, "orders": [checks.is_unique("o_orderkey")]})
    return suite.results("dataset")


@query(
    """SELECT 'customer_orders' AS table_name, 'number_of_orders__case__GT' AS check_name, count(*) AS n_rows,
 count(*) FILTER (n > 10) AS passed, count(*) FILTER (n <= 10) AS failed,
 CAST(count(*) FILTER (n > 10) AS DOUBLE) / count(*) AS success_rate, CAST(count(*) FILTER (n > 10) AS DOUBLE) / count(*) >= 0.25 AS ok
 FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey)"""
)
def checks_on_transformation(spark, sf_dir):
    """Rules for a result that is not stored yet, with a success rate as the decision."""
    rows = shop.customer_orders({"orders": shop_orders(spark, sf_dir)}).rows(spark)
    return quality.prepare_checks(
        rows, [checks.case("number_of_orders > 10")], "table", "customer_orders", threshold=0.25
    )


@query("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE NOT coalesce(l_discount <= 0.05, false)")
def check_failures(spark, sf_dir):
    suite = quality.CheckSuite({"lineitem": table(spark, sf_dir, "lineitem")}, {"lineitem": LINE_RULES})
    return suite.get_failures("lineitem", "l_discount__case__LTE").select("l_orderkey", "l_linenumber", "l_discount")


@query("SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag IN ('A', 'N')")
def check_successes(spark, sf_dir):
    suite = quality.CheckSuite({"lineitem": table(spark, sf_dir, "lineitem")}, {"lineitem": LINE_RULES})
    return suite.get_successes("lineitem", "l_returnflag__is_in").select("l_orderkey", "l_linenumber", "l_returnflag")


@query("SELECT user_id, event_id FROM (SELECT *, count(*) OVER (PARTITION BY user_id, CAST(ts AS DATE)) AS c FROM events) WHERE c > 1")
def repeated_keys(spark, sf_dir):
    """All copies of a repeated key fail the uniqueness check."""
    day = F.date_format("ts", "yyyy-MM-dd")
    events = table(spark, sf_dir, "events").withColumn("user_day", F.concat_ws("|", F.col("user_id").cast("string"), day))
    suite = quality.CheckSuite({"events": events}, {"events": [checks.is_unique("user_day")]})
    return suite.get_failures("events", "user_day__is_unique").select("user_id", "event_id")


@query(
    """SELECT l.l_orderkey, l.l_linenumber FROM lineitem l WHERE NOT EXISTS
 (SELECT 1 FROM orders o WHERE CASE WHEN o.o_orderstatus = 'F' THEN o.o_orderkey ELSE -o.o_orderkey END = l.l_orderkey)"""
)
def foreign_key_failures(spark, sf_dir):
    """Lines whose order is there under another key only."""
    key = F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).otherwise(-F.col("o_orderkey"))
    orders = table(spark, sf_dir, "orders").select(key.alias("o_orderkey"))
    lines = table(spark, sf_dir, "lineitem")
    return quality.orphans(lines, orders, {"l_orderkey": "o_orderkey"}).select("l_orderkey", "l_linenumber")


@query(f"SELECT * FROM ({LINE_RESULTS_SQL})")
def stored_check_results(spark, sf_dir):
    """Check results are a frame, so they are loaded like any other."""
    run = pipeline(spark, "quality-results")
    run.run(quality.prepare_checks(table(spark, sf_dir, "lineitem"), LINE_RULES, "table", "lineitem"), "check_results")
    return run.dataset()["check_results"].drop("_load_id")


@query(LINE_RESULTS_SQL)
def quality_gate(spark, sf_dir):
    """The gate stops on failed rules and carries one row per rule."""
    suite = quality.CheckSuite({"lineitem": table(spark, sf_dir, "lineitem")}, {"lineitem": LINE_RULES})
    try:
        found = suite.gate()
    except quality.DataQualityError as stopped:
        found = stopped.results
    return spark.createDataFrame(found)


METRICS_SQL = f"""WITH c AS {CATALOGUE_SQL}
 SELECT 'catalogue' AS table_name, 'table' AS level, CAST(NULL AS VARCHAR) AS column_name, 'row_count' AS metric, CAST(count(*) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text_value FROM c
 UNION ALL SELECT 'catalogue', 'column', 'quality', 'null_count', CAST(count(*) - count(quality) AS DOUBLE), NULL FROM c
 UNION ALL SELECT 'catalogue', 'column', 'quality', 'null_rate', round(CAST(count(*) - count(quality) AS DOUBLE) / count(*), 6), NULL FROM c
 UNION ALL SELECT 'catalogue', 'column', 'quality', 'unique_count', CAST(count(DISTINCT quality) AS DOUBLE), NULL FROM c
 UNION ALL SELECT 'catalogue', 'column', 'source', 'unique_count', CAST(count(DISTINCT source) AS DOUBLE), NULL FROM c
 UNION ALL SELECT 'catalogue', 'column', 'quality', 'mean', round(avg(quality), 6), NULL FROM c
 UNION ALL SELECT 'catalogue', 'column', 'n_chars', 'maximum', CAST(max(n_chars) AS DOUBLE), NULL FROM c
 UNION ALL SELECT 'catalogue', 'column', 'n_chars', 'minimum', CAST(min(n_chars) AS DOUBLE), NULL FROM c
 UNION ALL SELECT 'catalogue', 'column', 'source', 'maximum', NULL, max(source) FROM c
 UNION ALL SELECT 'catalogue', 'column', 'lang', 'minimum', NULL, min(lang) FROM c"""

CATALOGUE_METRICS = [
    metrics.table.row_count(),
    metrics.column.null_count("quality"),
    metrics.column.null_rate("quality"),
    metrics.column.unique_count("quality"),
    metrics.column.unique_count("source"),
    metrics.column.mean("quality"),
    metrics.column.maximum("n_chars"),
    metrics.column.minimum("n_chars"),
    metrics.column.maximum("source"),
    metrics.column.minimum("lang"),
]


@query(METRICS_SQL)
def table_metrics(spark, sf_dir):
    found = quality.compute_metrics(catalogue(spark, sf_dir), CATALOGUE_METRICS, "catalogue")
    return found.withColumn("value", F.round("value", 6))


@query(
    f"""SELECT run_id, level, metric, value FROM ({METRICS_SQL}), (SELECT unnest(['1', '2']) AS run_id)
 UNION ALL SELECT '2', 'dataset', 'row_count', CAST(count(*) AS DOUBLE) FROM documents"""
)
def metric_history(spark, sf_dir):
    """Metrics travel with the resource; every run of them appends to the history."""
    run = pipeline(spark, "metric-history")
    resource = Resource("catalogue", lambda s: catalogue(s, sf_dir), "replace")
    run.run(quality.with_metrics(resource, *CATALOGUE_METRICS), load_id="1")
    quality.run_metrics(run, "1")
    quality.run_metrics(run, "2", extra=[metrics.dataset.row_count()])
    history = run.dataset()[quality.METRICS_TABLE]
    return history.select("run_id", "level", "metric", F.round("value", 6).alias("value"))


@query("SELECT CAST(count(DISTINCT quality) AS DOUBLE) AS value FROM labels")
def one_metric(spark, sf_dir):
    run = pipeline(spark, "one-metric")
    resource = Resource("labels", lambda s: table(s, sf_dir, "labels"), "replace")
    run.run(resource.with_metrics(metrics.column.unique_count("quality"), metrics.table.row_count()), load_id="1")
    quality.run_metrics(run, "1")
    return quality.read_metric(run.dataset(), "labels", "unique_count", "quality").select("value")


@query(
    """SELECT date_trunc('month', ts)::TIMESTAMP AS month, count(DISTINCT user_id) AS unique_authors, true AS within_three_percent
 FROM events GROUP BY date_trunc('month', ts)
 UNION ALL SELECT NULL, count(DISTINCT user_id), true FROM events WHERE ts >= TIMESTAMP '2024-01-04' AND ts < TIMESTAMP '2024-01-18'"""
)
def authors_from_sketches(spark, sf_dir):
    """Unique authors of each month and of a fortnight, from daily sketches of three loads, against exact counts."""
    run = pipeline(spark, "sketches")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    for number in range(3):
        part = Resource("events", lambda s, n=number: events.where(F.col("event_id") % 3 == n), "append")
        run.run(part.with_metrics(metrics.column.distinct_sketch("user_id", "ts")), load_id=str(number))
        quality.run_metrics(run, str(number))
    data = run.dataset()
    month = F.date_trunc("month", "ts").cast("timestamp_ntz").alias("month")
    first, last = datetime(2024, 1, 4), datetime(2024, 1, 17)
    within = (F.col("ts") >= F.lit(first)) & (F.col("ts") < F.lit(last + timedelta(days=1)))
    counted = F.count_distinct("user_id").alias("unique_authors")
    exact = events.groupBy(month).agg(counted).unionByName(events.where(within).agg(counted), allowMissingColumns=True)
    monthly = quality.distinct_between(data, "events", "user_id", by="month")
    estimates = monthly.unionByName(quality.distinct_between(data, "events", "user_id", first, last), allowMissingColumns=True)
    both = exact.unionByName(estimates, allowMissingColumns=True).groupBy("month").agg(*[F.max(c).alias(c) for c in ("unique_authors", "estimate")])
    near = F.abs(F.col("estimate") - F.col("unique_authors")) <= 0.03 * F.col("unique_authors")
    return both.select("month", "unique_authors", near.alias("within_three_percent"))


def _landed_feeds(spark, sf_dir) -> tuple[str, str]:
    """Events as collections of many features each, and the newest version of a feed in a folder of its own."""
    k = F.from_json("props", "k bigint").getField("k")
    feature = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.struct(
            F.col("value").alias("mag"),
            F.concat_ws(", ", F.lit("here"), "event_type").alias("place"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("time"),
        ).alias("properties"),
        F.struct(F.array(k.cast("double"), k.cast("double"), k / 4.0).alias("coordinates")).alias("geometry"),
    )
    folders = [fresh_folder(spark, name) for name in ("events", "summary")]
    for folder, where in zip(folders, ("true", "event_id % 11 = 0")):
        pages = table(spark, sf_dir, "events").where(where).groupBy((F.col("event_id") % 97).alias("page")).agg(F.collect_list(feature).alias("features"))
        pages.select(F.to_json(F.struct("features")).alias("value")).write.text(folder)
    return tuple(folders)


_PLACED_SQL = "SELECT CAST(event_id AS VARCHAR) AS id, event_type AS region, value AS magnitude, CAST(json_extract(props, '$.k') AS BIGINT) / 4.0 AS depth_km"


@query(
    f"""{_PLACED_SQL}, 'window' AS feed FROM (SELECT *, date_trunc('millisecond', ts) AS ms FROM events)
 WHERE ms >= TIMESTAMP '2024-01-05' AND ms <= TIMESTAMP '2024-01-12' AND value >= 2.5
 UNION ALL {_PLACED_SQL}, 'summary' FROM events WHERE event_id % 11 = 0"""
)
def loaded_feeds(spark, sf_dir):
    """Both feeds of the source from landed collections of many features: a window, merged twice, and a snapshot, replaced twice."""
    run = pipeline(spark, "feeds")
    events, summary = _landed_feeds(spark, sf_dir)
    for number, span in enumerate([("2024-01-05", "2024-01-09"), ("2024-01-08", "2024-01-12")]):
        run.run(quakes.quake_feeds(events, summary, TimeWindow(*span), glob="*", multi_line=False), load_id=str(number))
    data = run.dataset()
    parts = [data[name].select("id", quakes.place_region("place").alias("region"), "magnitude", "depth_km", F.lit(feed).alias("feed")) for name, feed in (("earthquakes", "window"), ("feeds_summary", "summary"))]
    return parts[0].unionByName(parts[1])


@query(
    """SELECT 'include' AS policy, count(*) AS n_rows, count(*) FILTER (event_id % 10 = 0) AS without_time FROM events
 WHERE event_id % 10 = 0 OR (ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-12')
 UNION ALL SELECT 'exclude', count(*), 0 FROM events WHERE event_id % 10 <> 0 AND ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-12'"""
)
def rows_without_cursor(spark, sf_dir):
    """Every tenth event has no time: what a window loads of them by policy."""
    run = pipeline(spark, "no-cursor")
    events = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 10 != 0, F.col("ts")).alias("ts"))
    parts = []
    for policy in ("include", "exclude"):
        cursor = Incremental("ts", "2024-01-05", "2024-01-12", on_null=policy)
        run.run(Resource(policy, lambda s: events, "merge", "event_id", incremental=cursor, buckets=4), load_id=policy)
        missing = F.count_if(F.col("ts").isNull()).alias("without_time")
        parts.append(run.dataset()[policy].agg(F.count(F.lit(1)).alias("n_rows"), missing).select(F.lit(policy).alias("policy"), "n_rows", "without_time"))
    return parts[0].unionByName(parts[1])


@query(
    """SELECT c_custkey, sha256(c_name) AS c_name, sha256(CAST(c_acctbal AS VARCHAR)) IS NOT NULL AS has_balance, c_mktsegment FROM customer"""
)
def masked_customers(spark, sf_dir):
    """Columns that are flagged as personal, found by their annotation after a load, leave as hashes."""
    run = pipeline(spark, "masked")
    notes = {"c_name": {"pii": True}, "c_acctbal": {"pii": True}, "c_mktsegment": {"note": "open"}}
    rows = table(spark, sf_dir, "customer").select("c_custkey", *notes)
    run.run(Resource("customer", lambda s: rows, "replace", "c_custkey", columns=notes))
    stored = run.dataset()["customer"]
    hashed = stored.withColumns({c: F.sha2(F.col(c).cast("string").cast("binary"), 256) for c in normalize.flagged_columns(stored, "pii")})
    return hashed.select("c_custkey", "c_name", F.col("c_acctbal").isNotNull().alias("has_balance"), "c_mktsegment")


@query(
    """SELECT 'docs__lines' AS table_name, 'value' AS column_name, 'string' AS data_type, 'docs' AS parent_table, count(*) AS filled
 FROM (SELECT unnest(string_split(text, ' ')) FROM documents)
 UNION ALL SELECT 'docs', 'doc_id', 'bigint', NULL, count(doc_id) FROM documents
 UNION ALL SELECT 'docs', 'lang', 'string', NULL, count(lang) FROM documents"""
)
def exported_schema(spark, sf_dir):
    """The catalogue of a parent and its child table, with how many values each of its columns holds."""
    run = pipeline(spark, "schema")
    lists = F.transform(F.split("text", " "), lambda x: F.struct(x.alias("value")))
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", lists.alias("lines"))
    run.run(Resource("docs", lambda s: rows, "merge", "doc_id"))
    data = run.dataset()
    columns = data.catalogue().where("column_name IN ('doc_id', 'lang', 'value')").select("table_name", "column_name", "data_type", "parent_table")
    counts = None
    for name, names in (("docs", ["doc_id", "lang"]), ("docs__lines", ["value"])):
        one = data[name].agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "column_name", "filled").withColumn("table_name", F.lit(name))
        counts = one if counts is None else counts.unionByName(one)
    return columns.join(counts, ["table_name", "column_name"])


@query(f"SELECT * FROM ({LINE_RESULTS_SQL}) WHERE check_name <> 'none'")
def checks_added_later(spark, sf_dir):
    """A suite that starts with two rules and gets the others one by one has the results of the whole."""
    suite = quality.CheckSuite({"lineitem": table(spark, sf_dir, "lineitem")}, {"lineitem": LINE_RULES[:2]})
    for rule in LINE_RULES[2:]:
        suite.add_checks("lineitem", [rule])
    return suite.results("table")


# ---- curation and vectors -----------------------------------------------------

MEASURES = {"avg_chars": "n_chars", "avg_quality": "quality"}
LIMITS = {"n_chars": 500, "quality": 1}


@query("SELECT lang, count(text) AS count, round(avg(n_chars), 6) AS avg_chars FROM documents GROUP BY lang")
def category_profile(spark, sf_dir):
    profile = curation.category_profile(table(spark, sf_dir, "documents"), "lang", "text", {"avg_chars": "n_chars"})
    return profile.withColumn("avg_chars", F.round("avg_chars", 6))


@query(
    f"""SELECT count(text) AS total, round(avg(n_chars), 6) AS avg_chars, round(avg(quality), 6) AS avg_quality FROM {CATALOGUE_SQL}"""
)
def overall_statistics(spark, sf_dir):
    one = curation.overall_statistics(catalogue(spark, sf_dir), "text", MEASURES)
    return one.withColumns({c: F.round(c, 6) for c in MEASURES})


@query(f"SELECT doc_id, n_chars, quality FROM {CATALOGUE_SQL} WHERE n_chars >= 500 AND quality >= 1")
def curated_rows(spark, sf_dir):
    return curation.curated(catalogue(spark, sf_dir), LIMITS).select("doc_id", "n_chars", "quality")


@query(
    f"""WITH c AS {CATALOGUE_SQL}, k AS (SELECT * FROM c WHERE n_chars >= 500 AND quality >= 1)
 SELECT 'count' AS metric, (SELECT CAST(count(text) AS DOUBLE) FROM c) AS before_full, (SELECT CAST(count(text) AS DOUBLE) FROM k) AS after_filtered
 UNION ALL SELECT 'avg_chars', (SELECT round(coalesce(avg(n_chars), 0), 6) FROM c), (SELECT round(coalesce(avg(n_chars), 0), 6) FROM k)
 UNION ALL SELECT 'avg_quality', (SELECT round(coalesce(avg(quality), 0), 6) FROM c), (SELECT round(coalesce(avg(quality), 0), 6) FROM k)"""
)
def before_after(spark, sf_dir):
    both = curation.before_after(catalogue(spark, sf_dir), LIMITS, "text", MEASURES)
    return both.withColumns({c: F.round(c, 6) for c in ("before_full", "after_filtered")})


@query(
    f"""SELECT count(text) FILTER (n_chars >= 500 AND quality >= 1) AS kept, count(text) AS total,
 round(CAST(count(text) FILTER (n_chars >= 500 AND quality >= 1) AS DOUBLE) / count(text) * 100, 1) AS kept_pct FROM {CATALOGUE_SQL}"""
)
def kept_share(spark, sf_dir):
    return curation.kept_share(catalogue(spark, sf_dir), LIMITS, "text")


@query(f"SELECT doc_id, text, n_chars, quality FROM {CATALOGUE_SQL} WHERE n_chars >= 500 AND quality >= 1")
def published_rows(spark, sf_dir):
    """The curated rows, without a column, written to a dataset of their own."""
    run = pipeline(spark, "published")
    kept = curation.curated(catalogue(spark, sf_dir), LIMITS).drop("toxic", "lang", "source")
    run.run(kept, "documents", write_disposition="replace")
    return run.dataset()["documents"].drop("_load_id")


@query()
def embedded_text(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return vectors.embedded(documents, {"text": "vector"}).select("doc_id", "vector")


@query("SELECT doc_id, CASE WHEN trim(text) = '' THEN 0.0 ELSE 1.0 END AS length, 64 AS dimensions FROM documents")
def embedded_lengths(spark, sf_dir):
    """Every text gives a vector of length 1, an empty one the zero vector."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    vector = vectors.embedded(documents, {"text": "vector"})
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return vector.select("doc_id", F.round(F.sqrt(square), 3).alias("length"), F.size("vector").alias("dimensions"))


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def letter_counts():
    """A provider whose vectors SQL can compute: how often each letter occurs."""
    return lambda texts: [[text.count(c) for c in LETTERS] for text in texts]


@query(
    f"""WITH seen AS (SELECT text, CASE WHEN bool_or(doc_id % 100 <> 0) THEN 'first' ELSE 'second' END AS embedded_in FROM documents GROUP BY text)
 SELECT doc_id, letter, CAST(length(text) - length(replace(text, letter, '')) AS BIGINT) AS n, embedded_in
 FROM documents JOIN seen USING (text), unnest(string_split('{",".join(LETTERS)}', ',')) t(letter)"""
)
def embedded_once(spark, sf_dir):
    """Vectors after two loads, the second with one document of a hundred more: only texts that are new go to the provider."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    store = VectorStore(spark, fresh_folder(spark, "vectors"), "letters", letter_counts)
    store.embedded(documents.where("doc_id % 100 <> 0"), {"text": "vector"}, "first")
    found = store.embedded(documents, {"text": "vector"}, "second")
    loads = store.vectors.select("content", F.col("load").alias("embedded_in"))
    rows = found.join(loads, content("text") == F.col("content")).select("doc_id", "embedded_in", F.posexplode("vector").alias("place", "n"))
    letter = F.substring(F.lit(LETTERS), F.col("place") + 1, F.lit(1))
    return rows.select("doc_id", letter.alias("letter"), F.col("n").cast("bigint").alias("n"), "embedded_in")


_NEIGHBOURS_SQL = """SELECT query_id, vec_id, score FROM (SELECT query_id, vec_id, score,
 row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rn FROM
 (SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])) AS score
 FROM embeddings q JOIN embeddings c ON {met} WHERE q.vec_id % 100 = 0)) WHERE rn <= {k}"""


@query(f"SELECT query_id, vec_id, round(score, 5) AS score FROM ({_NEIGHBOURS_SQL.format(met='true', k=10)})")
def nearest_vectors(spark, sf_dir):
    """The ten nearest vectors, itself included, of every vector whose id is divisible by 100."""
    corpus = table(spark, sf_dir, "embeddings")
    found = vectors.cosine_top_k(corpus, corpus.where("vec_id % 100 = 0"), 10, skip_self=False)
    return found.withColumn("score", F.round("score", 5))


@query(
    """SELECT query_id, vec_id, round(score, 5) AS score FROM (SELECT query_id, vec_id, score,
 row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rn FROM
 (SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])) AS score
 FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)) WHERE rn <= 5"""
)
def nearest_hundredths(spark, sf_dir):
    """The five nearest neighbours of every vector whose id is divisible by 100."""
    corpus = table(spark, sf_dir, "embeddings")
    found = vectors.cosine_top_k(corpus, corpus.where("vec_id % 100 = 0"), 5)
    return found.withColumn("score", F.round("score", 5))


def _vector_index(spark, sf_dir) -> VectorIndex:
    return VectorIndex.build(table(spark, sf_dir, "embeddings"), fresh_folder(spark, "vectors"))


@query()
def nearest_indexed(spark, sf_dir):
    """The five nearest neighbours of every vector whose id is divisible by 100, from the cells it probes."""
    asked = table(spark, sf_dir, "embeddings").where("vec_id % 100 = 0")
    return _vector_index(spark, sf_dir).search(asked, 5).withColumn("score", F.round("score", 5))


@query(
    """SELECT (SELECT count(*) FROM embeddings) AS indexed, count(*) AS neighbours, count(DISTINCT query_id) AS queries, true AS recall_reached
 FROM (SELECT q.vec_id AS query_id, row_number() OVER (PARTITION BY q.vec_id) AS rn
 FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0) WHERE rn <= 5"""
)
def index_recall(spark, sf_dir):
    """How the index compares with the exact search: rows it holds, neighbours there are, and whether it finds nine of ten."""
    corpus = table(spark, sf_dir, "embeddings")
    asked = corpus.where("vec_id % 100 = 0")
    index = _vector_index(spark, sf_dir)
    found = index.search(asked, 5).select("query_id", "vec_id", F.lit(1).alias("hit"))
    joined = vectors.cosine_top_k(corpus, asked, 5).join(found, ["query_id", "vec_id"], "left")
    return joined.agg(
        F.lit(sum(index.counts.values())).alias("indexed"),
        F.count(F.lit(1)).alias("neighbours"),
        F.count_distinct("query_id").alias("queries"),
        (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("recall_reached"),
    )


# ---- contract -----------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: ingest, transform and read back the customer orders."""
    return _QUERIES["stored_customer_orders"](spark, SMALLEST)


def _corpus_queries() -> tuple[dict, dict]:
    """Queries of the corpus operators and their SQL; none where that part is not installed."""
    optional = {"tidemark.llm", "tidemark.llm.queries", "corpus_pipeline"}
    try:
        import corpus_pipeline
        from tidemark.llm.queries import ORACLE, QUERIES
    except ModuleNotFoundError as missing:
        if missing.name not in optional:
            raise
        return {}, {}
    sql = dict(ORACLE)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**QUERIES, "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_corpus_queries()[0]}


def oracle_sql() -> dict[str, str]:
    return {**_ORACLE, **_corpus_queries()[1]}
