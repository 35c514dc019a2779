from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strataflow.operators import clean, sinks
from strataflow.plans import job
from strataflow.sources import contracts
from strataflow.sources.bindings import SOURCES, SourceConfig
from strataflow.sources.reading import (
    IngestionError, event_month, layer_path, read_layer, read_quarantine, read_raw, read_source, slice_source, with_audit,
)
from strataflow.storage import new_path


def test_missing_source_is_an_ingestion_error(spark):
    with pytest.raises(IngestionError, match="Cannot read source"):
        read_source(spark, SourceConfig("x", "/nonexistent/path"))
    with pytest.raises(IngestionError, match="Cannot read source"):
        read_source(spark, SourceConfig("x", "/nonexistent/path", "/nonexistent/too"))


def test_fallback_only_when_the_primary_is_missing(spark, tmp_path):
    good, bad = str(tmp_path / "good"), tmp_path / "bad"
    spark.range(3).write.parquet(good)
    assert read_source(spark, SourceConfig("x", "/nonexistent/path", good)).count() == 3
    assert read_source(spark, SourceConfig("x", good, "/nonexistent/path")).count() == 3
    bad.mkdir()
    (bad / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception) as info:  # noqa: PT011 - the reader's own error
        read_source(spark, SourceConfig("x", str(bad), good))
    assert "PATH_NOT_FOUND" not in str(info.value)


def test_registered_sources():
    yellow = SOURCES["nyctaxi_yellow"]
    assert (yellow.name, yellow.format, yellow.year_col, yellow.month_col) == (
        "nyctaxi_yellow", "parquet", "puYear", "puMonth")
    assert SOURCES["noaa_weather"].month_col == "month"
    assert len(SOURCES["noaa_weather"].features) == 6
    assert yellow.at("/a/b").path == "/a/b"


def test_slice_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "src")
    df = spark.range(24).select("id", (2022 + F.col("id") % 2).cast("int").alias("puYear"),
                                (1 + F.col("id") % 12).cast("int").alias("puMonth"))
    df.write.partitionBy("puYear", "puMonth").parquet(path)
    cfg = SourceConfig("s", path)
    part = slice_source(read_source(spark, cfg), cfg, 2023, 4)
    assert part.count() == 2
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(puYear" in plan and "(puYear#" in plan
    with pytest.raises(IngestionError, match="puYear"):
        slice_source(df.drop("puYear"), cfg, 2023)


def test_audit_columns(spark, tmp_path):
    path = str(tmp_path / "src")
    spark.range(2).write.parquet(path)
    row = with_audit(read_source(spark, SourceConfig("s", path)), SourceConfig("s", path), "2024-01-01 00:00:00").first()
    assert row["_source_name"] == "s" and "src" in row["_source_file"] and row["_ingested_ts"].year == 2024


TRIP = ("1", "2023-03-01 10:00:00", "2023-03-01 10:10:00", 1, 2.0, "7", "9", 1, "N", "card", 10.0, 0.0, 0.5)


def land(spark, root):
    """Two years of small sources; yellow and green share one trip key."""
    def write(name, rows, ddl):
        df = spark.createDataFrame(rows, ddl)
        for c in [f.name for f in SOURCES[name].contract.fields if f.name in df.columns]:
            df = df.withColumn(c, F.col(c).cast(SOURCES[name].contract[c].dataType))
        df.write.parquet(f"{root}/{name}")
        return SourceConfig(name, f"{root}/{name}", contract=SOURCES[name].contract,
                            year_col=SOURCES[name].year_col, month_col=SOURCES[name].month_col,
                            ts_col=SOURCES[name].ts_col)

    def trips(prefix, n):
        rows = []
        for year in (2022, 2023):
            for i in range(n):
                ts = f"{year}-03-01 10:{i % 60:02d}:00"
                rows.append(("1", ts, ts, 1, 2.0 + i, str(i % 3), 10.0 + i, 1.0 * i, year, 3))
        rows.append(rows[-1])  # an exact duplicate
        rows.append(("1", "2023-03-01 11:00:00", None, 1, 2.0, "7", -5.0, 1.0, 2023, 3))  # fails quality
        return rows, (f"vendorID string, {prefix}PickupDatetime string, {prefix}DropoffDatetime string,"
                      "passengerCount int, tripDistance double, puLocationId string, fareAmount double,"
                      "tipAmount double, puYear int, puMonth int")

    weather = [("s1", f"2023-03-0{d} 01:00:00", float(d), 2023, 3) for d in (1, 2)] + [
        ("s2", "2023-03-01 01:00:00", 3.0, 2023, 3)]
    return {
        "nyctaxi_yellow": write("nyctaxi_yellow", *trips("tpep", 20)),
        "nyctaxi_green": write("nyctaxi_green", *trips("lpep", 15)),
        "noaa_weather": write("noaa_weather", weather,
                              "stationName string, datetime string, temperature double, year int, month int"),
    }


def test_job_end_to_end_and_again(spark):
    root = new_path(spark, "job")
    sources = land(spark, root + "/landing")
    common = dict(root=root, sources=sources, run_ts="2024-01-01 00:00:00", reference_year=2022)
    first = job.run(spark, job.JobParams(year=2022, dates=("2022-03-01",), run_drift=False, **common)).first()
    assert first["bronze_weather_rows"] == 0 and first["drift_status"] == "skipped"
    params = job.JobParams(year=2023, month=3, dates=("2023-03-01", "2023-03-02"), **common)
    for _ in range(2):  # a second run changes nothing
        got = job.run(spark, params).first().asDict()
        assert got == {
            "bronze_yellow_rows": 22, "bronze_green_rows": 17, "bronze_weather_rows": 3,
            "silver_rows": 35, "gold_rows": 6, "partition_date": "2023-03-01,2023-03-02", "drift_status": "ok",
        }
    silver = read_layer(spark, root, "silver", "nyctaxi", sinks.monthly(contracts.SILVER_TRIPS))
    assert silver.count() == 70
    gold = read_layer(spark, root, "gold", "daily_trip_summary", sinks.monthly(contracts.GOLD_DAILY))
    assert gold.where("summary_date = '2023-03-01'").select("avg_temperature_c").distinct().first()[0] == 2.0
    assert gold.where("summary_date = '2022-03-01'").count() == 6
    metrics = spark.read.parquet(f"{root}/gold_metrics")
    assert metrics.count() == 9 and "drift.psi" in {r["metric"] for r in metrics.collect()}


def test_ingest_history_is_kept_and_can_be_rebuilt(spark):
    """The same slice ingested twice through the job, with corrected fares; the earlier state is still there."""
    root = new_path(spark, "job")
    sources = land(spark, root + "/landing")
    common = dict(root=root, year=2023, dates=("2023-03-01",), run_drift=False)
    job.run(spark, job.JobParams(sources=sources, run_ts="2024-01-01 00:00:00", **common))
    yellow = sources["nyctaxi_yellow"]
    corrected = spark.read.parquet(yellow.path).withColumn("fareAmount", F.col("fareAmount") + 100)
    corrected.write.parquet(f"{root}/landing/corrected")
    second = sources | {"nyctaxi_yellow": yellow.at(f"{root}/landing/corrected")}
    job.run(spark, job.JobParams(sources=second, run_ts="2024-02-01 00:00:00", **common))
    raw = read_raw(spark, root, "nyctaxi_yellow", yellow.contract)
    binding = job.trip_binding("yellow")
    state = lambda ts: clean.silver_trips(clean.as_of(raw, ts), binding).agg(F.min("fare_amount"), F.count("*")).first()
    assert state("2023-12-31 00:00:00")[1] == 0
    assert state("2024-01-15 00:00:00")[0] == 10.0  # the corrected row of the fare -5 comes with the second run
    assert state("2024-02-15 00:00:00")[0] == 95.0
    assert raw.select("_ingested_ts").distinct().count() == 2
    silver = read_layer(spark, root, "silver", "nyctaxi", sinks.monthly(contracts.SILVER_TRIPS)).where("taxi_type = 'yellow'")
    assert silver.agg(F.min("fare_amount")).first()[0] >= 95.0


def test_drift_failure_does_not_stop_the_job(spark, monkeypatch):
    root = new_path(spark, "job")
    sources = land(spark, root + "/landing")
    monkeypatch.setattr(job.drift, "merged_frequency", lambda *a, **k: 1 / 0)
    params = job.JobParams(root=root, sources=sources, year=2023, dates=("2023-03-01",), reference_year=2022)
    got = job.run(spark, params).first()
    assert got["drift_status"] == "failed: ZeroDivisionError" and got["gold_rows"] == 6


def test_shared_trip_key_lets_green_overwrite_yellow(spark):
    root = new_path(spark, "job")
    sources = land(spark, root + "/landing")
    job.run(spark, job.JobParams(root=root, sources=sources, year=2023, dates=("2023-03-01",), run_drift=False,
                                 shared_trip_key=True))
    silver = read_layer(spark, root, "silver", "nyctaxi", sinks.monthly(contracts.SILVER_TRIPS))
    counts = {r["taxi_type"]: r["count"] for r in silver.groupBy("taxi_type").count().collect()}
    assert counts == {"green": 15, "yellow": 5}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_raw_rows_lie_by_event_month_and_late_ones_are_found(spark):
    """A slice of March that holds a pickup of the December before; the year before finds it in its own directory."""
    root = new_path(spark, "job")
    sources = land(spark, root + "/landing")
    yellow = sources["nyctaxi_yellow"]
    rows = spark.read.parquet(yellow.path).where("puYear = 2023")
    late = rows.limit(1).withColumn("tpepPickupDatetime", F.lit("2022-12-31 23:59:00").cast("timestamp"))
    nowhen = rows.limit(1).withColumn("tpepPickupDatetime", F.lit(None).cast("timestamp"))
    rows.unionByName(late).unionByName(nowhen).write.parquet(f"{root}/landing/late")
    sources["nyctaxi_yellow"] = yellow.at(f"{root}/landing/late")
    p = job.JobParams(root=root, sources=sources, year=2023, month=3, run_ts="2024-01-01 00:00:00")
    assert job.ingest(spark, p, "nyctaxi_yellow") == 23  # the row without a time breaks the contract
    raw = job.raw_trips(spark, p, "nyctaxi_yellow")
    filters = _plan(raw).split("PartitionFilters: [")[1].split("]")[0]
    assert "_event_month" in filters and "_valid" in filters
    opened = [r[0] for r in raw.select(F.input_file_name()).distinct().collect()]
    assert raw.count() == 22 and opened and all("_valid=true/_event_month=2023-03" in f for f in opened)
    before = job.JobParams(root=root, sources=sources, year=2022)
    assert job.raw_trips(spark, before, "nyctaxi_yellow").count() == 1
    held = read_quarantine(spark, root, "nyctaxi_yellow", yellow.contract).collect()
    assert [r["violations"] for r in held] == [["null:tpepPickupDatetime"]] and '"fareAmount"' in held[0]["_raw"]


def test_ingest_reads_its_source_once(spark):
    """Valid and broken rows come from one job: the source's files are opened by one scan."""
    root = new_path(spark, "job")
    sources = land(spark, root + "/landing")
    p = job.JobParams(root=root, sources=sources, year=2023)
    calls = []
    scan = job.read_source

    def counted(*args):
        calls.append(args)
        return scan(*args)

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ingest-once", "one ingest")
    try:
        job.read_source = counted
        assert job.ingest(spark, p, "nyctaxi_green") == 17
    finally:
        job.read_source = scan
        jobs = tracker.getJobIdsForGroup("ingest-once")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(calls) == 1
    # One job reads and writes the rows, one counts the footers of what was written; schemas are read before.
    tasks = [tracker.getStageInfo(s).numTasks for j in jobs for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)]
    assert len(jobs) <= 5 and tasks


def test_an_ingest_may_be_empty_before_and_after_others(spark):
    root = new_path(spark, "job")
    sources = land(spark, root + "/landing")
    for year, want in ((1999, 0), (2023, 3), (1998, 0)):
        assert job.ingest(spark, job.JobParams(root=root, sources=sources, year=year), "noaa_weather") == want
    weather = job.raw_weather(spark, job.JobParams(root=root, sources=sources, year=2023, month=3))
    assert weather.count() == 3 and "_event_month" in _plan(weather).split("PartitionFilters: [")[1].split("]")[0]
    assert read_quarantine(spark, root, "noaa_weather", sources["noaa_weather"].contract).count() == 0
    assert layer_path(root, "bronze", "noaa_weather").endswith("bronze_noaa_weather")


def test_weather_months_follow_the_slice_columns(spark):
    df = spark.createDataFrame([(2023, 3), (2023, None), (None, 3)], "year int, month int")
    months = [r[0] for r in df.select(event_month(SOURCES["noaa_weather"], by_columns=True)).collect()]
    assert months == ["2023-03", "none", "none"]


def test_green_run_leaves_the_files_of_yellow(spark):
    root = new_path(spark, "job")
    sources = land(spark, root + "/landing")
    p = job.JobParams(root=root, sources=sources, year=2023, month=3)
    files = lambda kind: sorted(read_layer(
        spark, root, "silver", "nyctaxi", sinks.monthly(contracts.SILVER_TRIPS)).where(F.col("taxi_type") == kind).inputFiles())
    for name in job.TRIP_SOURCES:
        job.ingest(spark, p, name)
    job.cleanse_trips(spark, p, "nyctaxi_yellow")
    yellow = [f for f in files("yellow") if "taxi_type=yellow" in f]
    job.cleanse_trips(spark, p, "nyctaxi_green")
    job.cleanse_trips(spark, p, "nyctaxi_green")
    assert yellow and [f for f in files("yellow") if "taxi_type=yellow" in f] == yellow
    silver = read_layer(spark, root, "silver", "nyctaxi", sinks.monthly(contracts.SILVER_TRIPS))
    assert {r[0]: r[1] for r in silver.groupBy("taxi_type").count().collect()} == {"yellow": 20, "green": 15}
    assert silver.columns == sinks.monthly(contracts.SILVER_TRIPS).names


def test_the_baseline_year_is_counted_once(spark, monkeypatch):
    """Counts per month add up to the report of the rows, and a second run reads the months of its slice alone."""
    root = new_path(spark, "job")
    sources = land(spark, root + "/landing")
    common = dict(root=root, sources=sources, run_ts="2024-01-01 00:00:00", reference_year=2022)
    counted, value_counts = [], job.drift.value_counts
    monkeypatch.setattr(job.drift, "value_counts", lambda rows, *a: counted.append(
        sorted(r[0] for r in rows.select(sinks.MONTH).distinct().collect())) or value_counts(rows, *a))
    job.run(spark, job.JobParams(year=2022, dates=("2022-03-01",), run_drift=False, **common))
    params = job.JobParams(year=2023, month=3, dates=("2023-03-01",), **common)
    for _ in range(2):
        assert job.run(spark, params).first()["drift_status"] == "ok"
    assert counted == [["2022-03", "2023-03"], ["2023-03"]]
    trips = read_layer(spark, root, "silver", "nyctaxi", sinks.monthly(contracts.SILVER_TRIPS))
    samples = job.drift.drift_input(trips, job.drift.DRIFT_FEATURES, "pickup_ts", 2022, 2023)
    want = sorted(map(tuple, job.drift.drift_report(samples, job.drift.DRIFT_FEATURES).collect()))
    got = spark.read.parquet(layer_path(root, "gold", "drift_report/run=" + params.raw_run_id))
    assert sorted(map(tuple, got.collect())) == want and len(want) == 3
    by_type = job.drift.merged_frequency(
        spark.read.schema(job.COUNTS).parquet(layer_path(root, "gold", "value_counts")), F.lit(True), F.lit(False), ["taxi_type"])
    assert by_type.where("taxi_type = 'green' and feature = 'fare_amount'").agg(F.sum("n_ref")).first()[0] == 30
