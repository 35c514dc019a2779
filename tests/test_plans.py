"""Plan checks: what reaches the scan, what is broadcast, what is shuffled."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from strataflow.operators import clean, gold, prompts, retrieve, sinks
from strataflow.plans import views
from strataflow.sources.contracts import GOLD_DAILY
from strataflow.storage import materialize, new_path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark):
    path = new_path(spark, "raw")
    spark.range(100).selectExpr(
        "timestamp '2023-01-01 00:00:00' + make_interval(0, 0, 0, id) as ts", "id as a", "id as b", "id as c"
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_event_time_slice_reaches_the_scan_with_two_columns(raw):
    text = plan(clean.slice_event_time(raw, "ts", 2023, 2).select("a"))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert re.search(r"ReadSchema: struct<ts:timestamp,a:bigint>", text)


def test_views_prune_months(spark):
    path = new_path(spark, "gold")
    rows = spark.range(3).selectExpr(
        "concat('2023-0', id + 1, '-05') as summary_date", "'yellow' as taxi_type", "'7' as pu_location_id",
        "1L as trip_count", *(f"1d as {f.name}" for f in GOLD_DAILY.fields[4:10]), "timestamp '2024-01-01' as _gold_ts")
    sinks.replace_dates(path, rows, [f"2023-0{m}-05" for m in (1, 2, 3)])
    table = spark.read.schema(sinks.monthly(GOLD_DAILY)).parquet(path)
    for view in (views.view_daily_trip_summary(table, "2023-03-06", 3), views.view_kpi(table, "2023-03-06", 3)):
        assert "PartitionFilters: [isnotnull(_month" in plan(view)
        assert view.count() == 1
    assert "(_month" in plan(gold.trip_daily(table.withColumnsRenamed(
        {"summary_date": "pickup_date", "avg_fare": "fare_amount", "avg_tip": "tip_amount",
         "avg_distance": "trip_distance", "avg_duration_min": "trip_duration_min"}), ["2023-03-05"]))


def test_contents_are_attached_without_shuffling_the_corpus(spark):
    corpus = materialize(spark.range(50).selectExpr("id", "repeat('x', 100) as content"), "corpus")
    hits = spark.createDataFrame([("a", 3, 1.0, 1)], "qid string, id bigint, score double, rank int")
    text = plan(retrieve.attach_content(hits, corpus))
    start = text.rindex("\n", 0, text.index("LeftSemi"))
    semi = text[start:]
    assert "BroadcastHashJoin" in semi.split("LeftSemi")[0]
    scan_of_texts = semi.split("FileScan parquet [id")[1]
    assert "content" in scan_of_texts and "Exchange" not in semi[:semi.index("FileScan")].replace("BroadcastExchange", "")


def test_pair_scores_are_summed_where_the_document_is(spark):
    corpus = spark.createDataFrame([(1, "a b"), (2, "b c")], "id bigint, content string")
    questions = spark.createDataFrame([("q", "b")], "qid string, question string")
    text = plan(retrieve.bm25_topk(questions, corpus))
    shuffles = re.findall(r"Exchange hashpartitioning\((\w+)#", text)
    assert shuffles == ["qid"]  # winners per question: neither documents nor pairs move


def test_no_retrieval_shuffle_without_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        test_pair_scores_are_summed_where_the_document_is(spark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("split_by", [[], ["kind"]])
def test_touched_directories_prune_the_target(spark, split_by):
    path = new_path(spark, "upsert")
    rows = spark.range(400).selectExpr(
        "cast(id % 2 as string) as kind", "cast(id as string) as k",
        "cast(date_add(date'2023-01-01', cast(id as int)) as string) as day", "id as v")
    sinks.write_upsert(path, rows, ["kind", "k"], "day", date_from=["k"], split_by=split_by)
    few = materialize(rows.where("id in (0, 2, 4)"), "few")
    target = spark.read.schema(sinks.monthly(rows.schema)).parquet(path)
    touched = sinks.touched_rows(target, few, "day", split_by)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        filters = plan(touched).split("PartitionFilters: [")[1].split("\n")[0]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert filters.count("dynamicpruningexpression(") == 1 + len(split_by)
    assert touched.count() == (31 if not split_by else 16)


def test_drift_reads_the_directories_of_two_years(spark, monkeypatch):
    from strataflow.plans import job
    from strataflow.sources import contracts
    from strataflow.sources.reading import layer_path

    seen = []
    monkeypatch.setattr(job.drift, "value_counts", lambda trips, *a, **k: seen.append(plan(trips)) or 1 / 0)
    root = new_path(spark, "lake")
    row = [f"'x' as {f.name}" if f.dataType.simpleString() == "string" else f"cast(null as {f.dataType.simpleString()}) as {f.name}"
           for f in contracts.SILVER_TRIPS.fields]
    spark.range(1).selectExpr(*row, "'2022-01' as _month").write.partitionBy("_month").parquet(layer_path(root, "silver", "nyctaxi"))
    job.check_drift(spark, job.JobParams(root=root, sources={}, year=2023, reference_year=2022))
    assert "_month" in seen[0].split("PartitionFilters: [")[1].split("]")[0]


def test_upsert_joins_on_all_keys_without_cross_products(spark):
    df = spark.range(10).selectExpr("cast(id as string) as k", "id as v")
    text = plan(sinks.upsert(df, df, ["k"]))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_no_python_in_prompts(spark):
    questions = spark.createDataFrame([("q", "b")], "qid string, question string")
    hits = spark.createDataFrame([("q", 1, 2, "c")], "qid string, rank int, id bigint, content string")
    text = plan(prompts.rag_messages(prompts.rag_context(questions, hits)))
    assert "Python" not in text


def test_daily_aggregates_combine_before_the_shuffle(spark):
    trips = spark.range(10).select(
        F.lit("2023-01-01").alias("pickup_date"), F.lit("yellow").alias("taxi_type"), F.lit("7").alias("pu_location_id"),
        *(F.col("id").cast("double").alias(c) for c in (
            "fare_amount", "tip_amount", "trip_distance", "trip_duration_min")))
    assert "partial_avg(fare_amount" in plan(gold.trip_daily(trips))
