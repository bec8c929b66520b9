"""

    python -m tests.measure
"""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from tidemark import Incremental, Pipeline, Resource, TimeWindow, build_session
from tidemark.operators.quality import checks, prepare_checks
from tidemark.plans import quakes
from tidemark.session import fresh_folder

RULES = [checks.case(f"l_discount <= 0.0{i}") for i in range(9)] + [
    checks.is_not_null("l_shipdate"),
    checks.is_in("l_returnflag", ["A", "N"]),
    checks.case("l_quantity > 0"),
]


def seconds(work) -> float:
    began = time.perf_counter()
    work()
    return round(time.perf_counter() - began, 2)


def merge(spark, sf: str) -> str:
    orders = spark.read.parquet(f"/root/testdata/sf{sf}/orders.parquet")
    run = Pipeline(spark, "merge", fresh_folder(spark, "measure"))
    target = Resource("orders", lambda s: orders, "merge", "o_orderkey", buckets=8)
    first = seconds(lambda: run.run(target))
    tenth = orders.where("o_orderkey % 10 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    again = [seconds(lambda: run.run(target.with_rows(tenth))) for _ in range(3)]
    stats = quakes.earthquake_daily_stats({"earthquakes": _quakes(spark, sf)}, TimeWindow("2024-01-10", "2024-01-12"))
    run.run(quakes.earthquake_daily_stats({"earthquakes": _quakes(spark, sf)}))
    composite = [seconds(lambda: run.run(stats)) for _ in range(3)]
    return f"sf{sf}: first {first}, 10 % of keys {sorted(again)[1]}, (day, region) window {sorted(composite)[1]}"


def _quakes(spark, sf: str):
    return spark.read.parquet(f"/root/testdata/sf{sf}/events.parquet").select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("time"),
        F.col("event_type").alias("place"),
        F.col("value").alias("magnitude"),
        F.lit(1.0).alias("depth_km"),
    )


def suite(spark, sf: str) -> str:
    lines = spark.read.parquet(f"/root/testdata/sf{sf}/lineitem.parquet")
    whole = [seconds(lambda: prepare_checks(lines, RULES, "table").collect()) for _ in range(3)]
    single = [
        seconds(lambda: [prepare_checks(lines, [rule], "table").collect() for rule in RULES]) for _ in range(3)
    ]
    return f"sf{sf}: one pass {sorted(whole)[1]}, one query per check {sorted(single)[1]}"


def cycle(spark, sf: str) -> str:
    run = Pipeline(spark, "cycle", fresh_folder(spark, "measure"))

    def ingest(window):
        cursor = Incremental("time", window.start, window.end)
        run.run(
            Resource("earthquakes", lambda s: _quakes(s, sf), "merge", "id", incremental=cursor, partition_by=("time", "day"))
        )
        run.run(quakes.earthquake_daily_stats(run.dataset(), window))

    ingest(TimeWindow("2024-01-01", "2024-01-20"))
    short = [seconds(lambda: ingest(TimeWindow("2024-01-20T00:00:00", f"2024-01-20T0{h}:00:00"))) for h in (1, 2, 3)]
    return f"sf{sf}: {sorted(short)[1]}"


def main() -> None:
    spark = build_session(
        "measure",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="6g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    for part in (merge, suite, cycle):
        for sf in ("0.01", "0.1"):
            print(part.__name__, part(spark, sf), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
