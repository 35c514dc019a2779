from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strataflow.operators import documents, evaluate, gold
from strataflow.plans import views
from strataflow.storage import new_path
from strataflow.streaming import alerts


def test_scores_parse_like_integers(spark):
    cases = {
        '{"groundedness": 4, "relevance": 3, "coherence": 5}': (4, 3, 5, True),
        '{"groundedness": 4.7, "relevance": "4", "coherence": true}': (4, 4, 1, False),
        '{"groundedness": -4.7, "relevance": " +4 ", "coherence": 1e2}': (-4, 4, 100, False),
        ' {"coherence": 3, "relevance": 3, "groundedness": 3, "extra": [1]} ': (3, 3, 3, True),
    }
    errors = {
        '{"groundedness": "4.7", "relevance": 4, "coherence": 4}': "not an integer: groundedness",
        '{"groundedness": 4, "relevance": null, "coherence": 4}': "not an integer: relevance",
        '{"groundedness": 4, "relevance": 4, "coherence": {}}': "not an integer: coherence",
        '{"groundedness": 4, "relevance": 4}': "missing coherence",
        "[1, 2, 3]": "not an object", "null": "not an object", "4": "not an object",
        '{"groundedness": 4,': "malformed JSON", "": "malformed JSON",
    }
    df = spark.createDataFrame([(t, t) for t in [*cases, *errors]], "key string, raw string")
    good, bad = evaluate.parse_scores(df, "raw")
    assert {r["key"]: tuple(r)[1:] for r in good.collect()} == cases
    assert {r["key"]: r["error"] for r in bad.collect()} == errors
    assert {r["raw"] for r in bad.collect()} == set(errors)


def test_range_check_is_optional(spark):
    df = spark.createDataFrame([('{"groundedness": 6, "relevance": 3, "coherence": 5}',)], "raw string")
    assert evaluate.parse_scores(df, "raw")[0].count() == 1
    good, bad = evaluate.parse_scores(df, "raw", check_range=True)
    assert good.count() == 0 and bad.first()["error"] == "out of range: groundedness"


def test_answers_survive_without_scores(spark):
    answers = spark.createDataFrame([("a", ["c"]), ("b", []), ("c", ["c"])], "qid string, context_chunks array<string>")
    scores = spark.createDataFrame([("a", 3, 3, 3, True), ("b", 3, 3, 3, True)],
                                   "qid string, groundedness int, relevance int, coherence int, passed boolean")
    got = {r["qid"]: r["passed"] for r in evaluate.eval_join(answers, scores).collect()}
    assert got == {"a": True, "b": None, "c": None}


def test_summary_and_metrics(spark):
    scores = spark.createDataFrame([("m", 3, 3, 3, True), ("m", 1, 5, 4, False)],
                                   "deployment string, groundedness int, relevance int, coherence int, passed boolean")
    row = evaluate.eval_summary(scores).first()
    assert (row["n_evaluated"], row["pass_rate"], row["avg_groundedness"]) == (2, 0.5, 2.0)
    metrics = evaluate.eval_metrics(scores, "2024-01-01 00:00:00").collect()
    assert len(metrics) == 6 and {m["metric"] for m in metrics} == {
        "llm.eval.groundedness", "llm.eval.relevance", "llm.eval.coherence"}
    assert {(m["attr_key"], m["attr_value"]) for m in metrics} == {("deployment", "m")}


def test_alert_messages(spark):
    ok = '{"feature": "fare", "score": 0.5, "threshold": 0.2, "pipeline_run_id": "r1"}'
    bad = ['{"feature": "fare", "score": 0.5', '{"score": 0.5, "threshold": 0.2, "pipeline_run_id": "r1"}',
           '{"feature": "fare", "score": "high", "threshold": 0.2, "pipeline_run_id": "r1"}', "", None]
    df = spark.createDataFrame([(t,) for t in [ok, *bad]], "raw string")
    good, rest = evaluate.parse_alerts(df, "raw")
    assert [tuple(r) for r in good.collect()] == [("fare", 0.5, 0.2, "r1")]
    assert sorted(str(r["raw"]) for r in rest.collect()) == sorted(str(b) for b in bad)


METRICS = """select * from values
    (timestamp '2024-01-01 00:01:00', 'fare', 0.1d), (timestamp '2024-01-01 00:04:59', 'fare', 0.3d),
    (timestamp '2024-01-01 00:05:00', 'fare', 0.2d), (timestamp '2024-01-01 00:06:00', 'tip', double('NaN')),
    (timestamp '2024-01-01 00:07:00', 'tip', 0.9d), (timestamp '2024-01-01 01:00:00', 'fare', 0.9d)
    as t(ts, feature, psi)"""


def test_alert_windows(spark):
    got = {(r["feature"], r["window_start"].minute, r["max_psi"]) for r in
           alerts.drift_alerts(spark.sql(METRICS)).collect()}
    assert got == {("fare", 0, 0.3), ("fare", 0, 0.9)}  # 0.2 does not exceed; NaN is no maximum


def test_stream_equals_the_batch(spark):
    source, path = new_path(spark, "metrics"), new_path(spark, "alerts")
    spark.sql(METRICS).where("not isnan(psi)").coalesce(1).write.parquet(source)
    stream = spark.readStream.schema("ts timestamp, feature string, psi double").parquet(source)
    found = alerts.drift_alerts(stream, watermark="5 minutes")
    alerts.write_alerts(found, path, new_path(spark, "state")).awaitTermination()
    shown = lambda df: sorted(tuple(r) for r in df.select("window_start", "window_end", "feature", "max_psi").collect())
    batch = alerts.drift_alerts(spark.read.parquet(source))
    assert shown(alerts.read_alerts(spark, path)) == shown(batch) and batch.count() == 3  # open windows too
    assert alerts.read_alerts(spark, new_path(spark, "nothing")).count() == 0


def test_an_alert_rises_with_later_rows(spark):
    source, path, state = (new_path(spark, n) for n in ("metrics", "alerts", "state"))
    schema = "ts timestamp, feature string, psi double"
    for psi in (0.3, 0.7, 0.5):
        spark.sql(f"select timestamp '2024-01-01 00:01:00' as ts, 'fare' as feature, {psi}d as psi").write.mode("append").parquet(source)
        found = alerts.drift_alerts(spark.readStream.schema(schema).parquet(source), watermark="5 minutes")
        alerts.write_alerts(found, path, state).awaitTermination()
    assert [(r["feature"], r["max_psi"]) for r in alerts.read_alerts(spark, path).collect()] == [("fare", 0.7)]


def test_metric_rows_of_a_report_raise_alerts(spark):
    report = spark.createDataFrame(
        [("fare", 0.5, 0.1, 0.01, 1.0, True, "ok"), ("tip", 0.1, 0.3, 0.01, 1.0, True, "ok"), ("gone", None, None, None, None, None, "empty_current")],
        "feature string, psi double, ks_statistic double, ks_p_value double, wasserstein double, is_drifted boolean, status string")
    metrics = evaluate.drift_metrics(report, "2024-01-01 00:02:00")
    got = alerts.drift_alerts(alerts.psi_rows(metrics)).collect()
    assert [(r["feature"], r["max_psi"], str(r["window_start"])) for r in got] == [("fare", 0.5, "2024-01-01 00:00:00")]


def test_gold_joins_weather_and_keeps_null_location(spark):
    trips = spark.createDataFrame(
        [("2023-01-01", "yellow", None, 10.0, 1.0, 2.0, None), ("2023-01-01", "yellow", None, 20.0, None, 4.0, 5.0),
         ("2023-01-02", "green", "7", 10.0, 1.0, 2.0, 3.0)],
        "pickup_date string, taxi_type string, pu_location_id string, fare_amount double, tip_amount double,"
        "trip_distance double, trip_duration_min double")
    weather = spark.createDataFrame([("2023-01-01", 1.0, None), ("2023-01-01", 2.0, 4.0)],
                                    "weather_date string, temperature_c double, precip_depth_mm double")
    rows = {r["summary_date"]: r for r in gold.gold_daily_summary(trips, weather).collect()}
    first, second = rows["2023-01-01"], rows["2023-01-02"]
    assert (first["trip_count"], first["avg_fare"], first["avg_tip"], first["avg_duration_min"]) == (2, 15.0, 1.0, 5.0)
    assert (first["avg_temperature_c"], first["avg_precip_depth_mm"]) == (1.5, 4.0)
    assert second["avg_temperature_c"] is None
    only = gold.gold_daily_summary(trips, None, dates=["2023-01-02"]).collect()
    assert len(only) == 1 and only[0]["avg_temperature_c"] is None


def daily(spark):
    return spark.sql("""select summary_date, 'yellow' as taxi_type, '7' as pu_location_id, 2L as trip_count, fare as avg_fare,
        tip as avg_tip, 1d as avg_distance, 1d as avg_duration_min, 1d as avg_temperature_c,
        cast(null as double) as avg_precip_depth_mm, timestamp '2024-01-01 00:00:00' as _gold_ts
        from values ('2023-01-01', 10d, 1d), ('2023-01-08', 0d, 1d), ('2022-10-10', 4d, 1d), ('2022-10-02', 4d, 1d)
        as t(summary_date, fare, tip)""")


def test_views(spark):
    day = views.view_daily_trip_summary(daily(spark), "2023-01-08")
    assert {r["summary_date"]: r["tip_rate"] for r in day.collect()} == {
        "2023-01-01": 0.1, "2023-01-08": None, "2022-10-10": 0.25}  # 90 days back, inclusive
    kpi = views.view_kpi(daily(spark), "2023-01-08").first()
    assert (kpi["total_trips"], kpi["avg_fare_7d"], kpi["avg_tip_rate_7d"]) == (4, 5.0, 0.1)
    years = {r["pickup_year"]: r["day_count"] for r in views.view_yearly_fare_distribution(daily(spark)).collect()}
    assert years == {"2022": 2, "2023": 2}
    views.register_views(daily(spark), "2023-01-08")
    assert spark.sql("select count(*) from kpi_last_7_days").first()[0] == 1


def test_documents_and_batches(spark):
    docs = documents.gold_documents(daily(spark))
    text = docs.where("metadata['summary_date'] = '2023-01-01'").first()["content"]
    assert text.startswith("On 2023-01-01, yellow trips from zone 7: 2 trips, average fare 10.00, tip 1.00")
    assert "precipitation n/a mm" in text and docs.select("id").distinct().count() == 4

    path, out = new_path(spark, "docs"), new_path(spark, "batches")
    rows = spark.range(1234).selectExpr("case when id = 7 then null else cast(1 as string) end as id", "id as n")
    rows.repartition(5).write.parquet(path)  # nearly all rows share one id
    batched = documents.assign_batches(spark, path)
    manifest = documents.write_batches(batched, out)
    sizes = sorted((r["batch_id"], r["n_docs"], r["status"]) for r in manifest.collect())
    assert [s[:2] for s in sizes] == [(0, 500), (1, 500), (2, 234)]
    failed = [s for s in sizes if s[2] == "failed"]
    assert len(failed) == 1
    indexed = documents.n_indexed(manifest).first()[0]
    assert indexed == 1234 - failed[0][1] == spark.read.json(out).count()
    in_order = batched.select("batch_id", F.col("n")).join(
        spark.read.parquet(path).select("n", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i")), "n")
    order = [r["batch_id"] for r in in_order.orderBy("f", "i").collect()]
    assert order == [i // 500 for i in range(1234)]  # by file name, whatever the folder is called
    empty = new_path(spark, "docs")
    rows.where("false").write.parquet(empty)
    assert documents.n_indexed(documents.batch_manifest(documents.assign_batches(spark, empty))).first()[0] == 0


@pytest.mark.parametrize("bad", ["spark-only", "sql-only"])
def test_every_query_has_an_oracle(bad):
    from strataflow.catalog.oracles import oracle_sql
    from strataflow.catalog.queries import QUERIES

    queries, oracles = set(QUERIES), set(oracle_sql())
    assert not (queries - oracles if bad == "spark-only" else oracles - queries)
