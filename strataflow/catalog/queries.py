"""Registered queries: every operator over the whole test tables.

Timestamps are shown as text, and floating-point results rounded, so that results compare
across engines; nothing else is done here but binding operators to tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.operators import (
    bounded_batches, clean, documents, drift, evaluate, gold, prompts, retrieve, sinks, vector_index,
)
from strataflow.plans import job, views
from strataflow.session import configure
from strataflow.sources import contracts, testtables as tt
from strataflow.sources.bindings import SourceConfig, TripBinding, WeatherBinding
from strataflow.sources.reading import in_months, read_raw, read_source, slice_source, with_audit
from strataflow.storage import materialize, new_path, shuffles_dropped
from strataflow.streaming import alerts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

AS_OF = "2001-07-31"
REF_YEAR, CUR_YEAR = 1995, 1999
FEATURES = drift.DRIFT_FEATURES


def query(fn: Callable[[SparkSession, str], DataFrame]):
    """Register under the function's name; the session settings are applied first."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def _text(*names: str) -> list[Column]:
    return [F.date_format(n, "yyyy-MM-dd HH:mm:ss").alias(n) for n in names]


def _shown(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, timestamps as text, integers as bigint, other columns as they are."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            c = F.round(c, digits)
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.IntegerType):
            c = c.cast("bigint")
        columns.append(c.alias(field.name))
    return df.select(*columns)


# --- cleansed and aggregated layers, in memory ---------------------------------------


def trips_silver(spark: SparkSession, d: str, ranged: bool = False) -> DataFrame:
    return clean.silver_trips(tt.trips(spark, d), tt.ADAPTED_TRIPS, tt.RUN_TS, ranged)


def _written_trips(spark: SparkSession, d: str) -> DataFrame:
    """Cleansed trips in files that are ranged by pickup."""
    with shuffles_dropped(spark):
        return materialize(trips_silver(spark, d, ranged=True), "silver_trips", compression=sinks.COMPRESSION)


def weather_silver(spark: SparkSession, d: str) -> DataFrame:
    return clean.silver_weather(tt.weather(spark, d), tt.ADAPTED_WEATHER, tt.RUN_TS)


def daily_gold(spark: SparkSession, d: str) -> DataFrame:
    return gold.gold_daily_summary(trips_silver(spark, d), weather_silver(spark, d), run_ts=tt.RUN_TS)


# --- scans ---------------------------------------------------------------------------


@query
def source_scan(spark, d):
    cfg = SourceConfig("orders", f"{d}/orders.parquet", ts_col="o_orderdate")
    return _shown(read_source(spark, cfg))


@query
def source_formats(spark, d):
    """The same rows through each supported format."""
    orders = tt.table(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    parts = []
    for name in ("parquet", "json", "csv"):
        path = new_path(spark, f"orders_{name}")
        orders.write.format(name).option("header", "true").save(path)
        rows = read_source(spark, SourceConfig("orders", path, format=name, schema=tt.ORDERS_SCHEMA))
        parts.append(rows.select(F.lit(name).alias("format"), "*"))
    return _shown(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query
def source_fallback(spark, d):
    cfg = SourceConfig("customer", f"{d}/not_there.parquet", f"{d}/customer.parquet")
    return _shown(read_source(spark, cfg))


@query
def bronze_slice(spark, d):
    cfg = tt.landed_source(spark, d, "nyctaxi_yellow")
    month = slice_source(read_source(spark, cfg), cfg, 1997, 3)
    return _shown(month.select(
        "vendorID", "tpepPickupDatetime", "tripDistance", "fareAmount", "puLocationId", "puYear", "puMonth"
    ))


@query
def bronze_audit(spark, d):
    cfg = tt.landed_source(spark, d, "noaa_weather")
    audited = with_audit(read_source(spark, cfg), cfg, tt.RUN_TS)
    return _shown(audited.groupBy("_source_name", "_ingested_ts", "year").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("_source_file").contains("landing_noaa_weather")).alias("n_with_file"),
    ))


@query
def bronze_profile(spark, d):
    columns = ["fareAmount", "tripDistance", "passengerCount", "tipAmount"]
    return _shown(drift.profile(tt.trips(spark, d), columns), 4)


@query
def source_profile(spark, d):
    """Every numeric feature listed for the weather source; absent measurements are NULL."""
    cfg = tt.landed_source(spark, d, "noaa_weather")
    return _shown(drift.profile(read_source(spark, cfg), cfg.features), 4)


# --- cleansing -----------------------------------------------------------------------


@query
def silver_slice(spark, d):
    return _shown(clean.slice_event_time(tt.trips(spark, d), "pickup", 1998, 2))


@query
def silver_trips(spark, d):
    return _shown(trips_silver(spark, d))


@query
def silver_weather(spark, d):
    return _shown(weather_silver(spark, d))


@query
def weather_slice(spark, d):
    cfg = tt.landed_source(spark, d, "noaa_weather")
    return _shown(clean.silver_weather(
        slice_source(read_source(spark, cfg), cfg, 1998, 11), WeatherBinding(ingested=None), tt.RUN_TS
    ))


@query
def silver_rejects(spark, d):
    rejected = clean.rejects(tt.trips(spark, d), tt.ADAPTED_TRIPS)
    return rejected.select("taxi_type", F.explode("reasons").alias("reason")).groupBy(
        "taxi_type", "reason").agg(F.count("*").alias("n_rows"))


@query
def trip_key(spark, d):
    keyed = tt.trips(spark, d).select(
        clean.surrogate_key(tt.ADAPTED_TRIPS).alias("trip_id"), "vendorID", "pickup", "puLocationId"
    )
    return _shown(keyed)


@query
def schema_enforce(spark, d):
    """Customers as text with broken balances and missing nations, against a typed contract."""
    key = F.col("c_custkey")
    raw = tt.table(spark, d, "customer").select(
        key.cast("string").alias("c_custkey"),
        F.when(key % 13 != 0, F.col("c_nationkey").cast("string")).alias("c_nationkey"),
        F.when(key % 11 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        "c_mktsegment",
    )
    wanted = contracts.contract(
        "c_custkey! bigint, c_nationkey! int, c_acctbal double, c_mktsegment string, c_comment string"
    )
    valid, quarantine = clean.enforce_schema(raw, wanted)
    shown = valid.withColumn("violations", F.lit(""))
    held = quarantine.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"),
        F.lit(None).cast("int").alias("c_nationkey"),
        F.lit(None).cast("double").alias("c_acctbal"),
        "c_mktsegment",
        F.lit(None).cast("string").alias("c_comment"),
        F.array_join("violations", ",").alias("violations"),
    )
    return _shown(shown.unionByName(held))


def _raw_history(spark: SparkSession, d: str) -> DataFrame:
    """Two ingests: pickups before 1999, then the rest plus corrected fares of earlier green trips.

    One pass over the trips: an earlier green trip becomes two rows.
    """
    rows = tt.trips(spark, d)
    early = F.col("pickup") < F.lit("1999-01-01").cast("timestamp")
    late = F.coalesce(~early | (F.col("taxi_type") == "green"), F.lit(False))
    ingest = lambda day, fare: F.struct(F.lit(day).cast("timestamp").alias("ts"), fare.alias("fare"))
    first = ingest("2023-01-01 00:00:00", F.col("fareAmount"))
    second = ingest("2023-02-01 00:00:00", F.when(early, F.col("fareAmount") + 1).otherwise(F.col("fareAmount")))
    ingests = F.array_compact(F.array(F.when(early, first), F.when(late, second)))
    return rows.withColumn("_ingest", F.explode(ingests)).withColumns(
        {"fareAmount": F.col("_ingest.fare"), "_ingested_ts": F.col("_ingest.ts")}).drop("_ingest")


_HISTORY = TripBinding("pickup", "dropoff", tag_col="taxi_type")


@query
def silver_as_of(spark, d):
    history = clean.as_of(_raw_history(spark, d), "2023-01-15 00:00:00")
    return _shown(clean.silver_trips(history, _HISTORY, tt.RUN_TS))


@query
def silver_latest(spark, d):
    """All ingests: a corrected row replaces the one ingested earlier."""
    return _shown(clean.silver_trips(_raw_history(spark, d), _HISTORY, tt.RUN_TS))


@query
def job_as_of(spark, d):
    """A month of trips ingested by the job, then again with corrected fares; both states rebuilt from the raw table."""
    root, year, month = new_path(spark, "job_as_of"), 1998, 3
    sources = {n: tt.landed_source(spark, d, n) for n in (*job.TRIP_SOURCES, job.WEATHER_SOURCE)}
    yellow = sources["nyctaxi_yellow"]
    corrected = new_path(spark, "landing_corrected")
    rows = slice_source(read_source(spark, yellow), yellow, year, month)
    rows.withColumn("fareAmount", F.col("fareAmount") + 1).write.partitionBy(yellow.year_col, yellow.month_col).parquet(corrected)
    common = dict(root=root, year=year, month=month, dates=(f"{year}-03-01",), run_drift=False)
    job.run(spark, job.JobParams(sources=sources, run_ts="2023-01-01 00:00:00", **common))
    job.run(spark, job.JobParams(
        sources=sources | {yellow.name: yellow.at(corrected)}, run_ts="2023-02-01 00:00:00", **common))
    raw = read_raw(spark, root, yellow.name, yellow.contract, year, month)
    states = [
        clean.silver_trips(clean.as_of(raw, ts), job.trip_binding("yellow"), tt.RUN_TS).withColumn("as_of", F.lit(ts))
        for ts in ("2023-01-15 00:00:00", "2023-02-15 00:00:00")]
    return _shown(states[0].unionByName(states[1]))


# --- sinks ---------------------------------------------------------------------------


@query
def bronze_append(spark, d):
    """All trips in two ingestion runs per source, the first one repeated."""
    parts = []
    for name in job.TRIP_SOURCES:
        cfg = tt.landed_source(spark, d, name)
        path = new_path(spark, f"bronze_{name}")
        source = with_audit(read_source(spark, cfg), cfg, tt.RUN_TS)
        early = F.col(cfg.year_col) < 1998
        for run_id, rows in (("run-early", early), ("run-late", ~early), ("run-early", early)):
            sinks.append_raw(source.where(rows), path, run_id)
        parts.append(spark.read.parquet(path).groupBy("_ingest_id", "puYear").agg(
            F.count("*").alias("n_rows"), F.round(F.sum("fareAmount"), 2).alias("sum_fare")
        ).select(F.lit(name).alias("source"), "_ingest_id", F.col("puYear").cast("bigint").alias("puYear"), "n_rows", "sum_fare"))
    return parts[0].unionByName(parts[1])


def _upserted(spark, target, source, keys, date_col, schema, date_from, split_by=()) -> DataFrame:
    """Load the target, upsert the source twice, read the table back; both are rows of a written table ranged by date."""
    path = new_path(spark, "upserted")
    for rows in (target, source, source):
        sinks.write_upsert(path, rows, keys, date_col, date_from=date_from, split_by=split_by,
                           source_is_written=True, source_is_clustered=True)
    return spark.read.schema(sinks.monthly(schema)).parquet(path).select(schema.names)


@query
def silver_upsert(spark, d):
    trips = _written_trips(spark, d)
    target = trips.where("pickup_date < '1999-01-01'")
    source = trips.where("pickup_date >= '1998-07-01'").withColumn("total_amount", F.col("total_amount") + 1)
    return _shown(_upserted(
        spark, target, source, ["taxi_type", "trip_id"], "pickup_date", contracts.SILVER_TRIPS, ["trip_id"], ["taxi_type"]))


@query
def silver_upsert_shared_key(spark, d):
    """Yellow then green into one table on the trip id alone: equal ids are overwritten."""
    trips = _written_trips(spark, d)
    return _shown(_upserted(
        spark, trips.where("taxi_type = 'yellow'"), trips.where("taxi_type = 'green'"),
        ["trip_id"], "pickup_date", contracts.SILVER_TRIPS, ["trip_id"]))


@query
def weather_upsert(spark, d):
    weather = materialize(sinks.clustered(weather_silver(spark, d), ["weather_date", "station_name", "weather_ts"]), "silver_weather")
    target = weather.where("weather_date < '1999-01-01'")
    source = weather.where("weather_date >= '1998-07-01'").withColumn("temperature_c", F.col("temperature_c") + 1)
    return _shown(_upserted(
        spark, target, source, ["station_name", "weather_ts"], "weather_date", contracts.SILVER_WEATHER, ["weather_ts"]))


@query
def merge_conflicts(spark, d):
    """Times shared by several stations: a merge on the time alone would be ambiguous."""
    return _shown(sinks.duplicate_keys(weather_silver(spark, d), ["weather_ts"]))


REPLACED_DATES = ("1998-03-01", "1998-03-02", "1998-04-03")


@query
def gold_replace_partition(spark, d):
    """All dates written, then three rebuilt with higher fares, the last of them emptied."""
    path = new_path(spark, "gold_daily_trip_summary")
    summary = materialize(daily_gold(spark, d), "gold")
    sinks.replace_table(path, summary)
    rebuilt = summary.where(F.col("summary_date").isin(*REPLACED_DATES[:2])).withColumn(
        "avg_fare", F.col("avg_fare") + 1)
    sinks.replace_dates(path, rebuilt, REPLACED_DATES)
    return _shown(spark.read.schema(sinks.monthly(contracts.GOLD_DAILY)).parquet(path).drop(sinks.MONTH))


@query
def gold_layout(spark, d):
    """The summary written clustered by type and location, read back."""
    path = new_path(spark, "gold_clustered")
    sinks.clustered(daily_gold(spark, d), ["taxi_type", "pu_location_id"]).write.parquet(path)
    return _shown(spark.read.schema(contracts.GOLD_DAILY).parquet(path))


@query
def layer_counts(spark, d):
    """The whole job for two years; the second run's row counts."""
    root = new_path(spark, "layers")
    sources = {n: tt.landed_source(spark, d, n) for n in (*job.TRIP_SOURCES, job.WEATHER_SOURCE)}
    common = dict(root=root, sources=sources, run_ts=tt.RUN_TS, reference_year=REF_YEAR)
    job.run(spark, job.JobParams(year=REF_YEAR, dates=("1995-03-01",), run_drift=False, **common))
    return job.run(spark, job.JobParams(year=CUR_YEAR, dates=("1999-03-01", "1999-03-02"), **common))


# --- aggregates and views ------------------------------------------------------------


@query
def gold_daily_summary(spark, d):
    return _shown(daily_gold(spark, d))


@query
def gold_no_weather(spark, d):
    return _shown(gold.gold_daily_summary(trips_silver(spark, d), None, run_ts=tt.RUN_TS))


@query
def weather_daily(spark, d):
    return _shown(gold.weather_daily(weather_silver(spark, d)))


@query
def view_daily_trip_summary(spark, d):
    return _shown(views.view_daily_trip_summary(daily_gold(spark, d), AS_OF))


@query
def view_kpi_last_7_days(spark, d):
    return _shown(views.view_kpi(daily_gold(spark, d), AS_OF))


@query
def view_yearly_fare_distribution(spark, d):
    return _shown(views.view_yearly_fare_distribution(daily_gold(spark, d)))


@query
def yearly_distinct_days(spark, d):
    """The yearly view counts zone-days; this counts calendar days."""
    return daily_gold(spark, d).groupBy(
        F.left("summary_date", F.lit(4)).alias("pickup_year"), "taxi_type"
    ).agg(F.count_distinct("summary_date").alias("distinct_days"))


def _operations(spark: SparkSession, d: str) -> DataFrame:
    events = tt.table(spark, d, "events").select(
        "ts", "event_type", "value",
        F.concat(F.lit("s"), (F.col("user_id") % 5).cast("string")).alias("system"),
        (F.col("event_type") == "error").alias("critical"),
    )
    return gold.daily_operations_summary(events, "ts", "system", "event_type", "critical", "value")


@query
def daily_operations_summary(spark, d):
    return _shown(_operations(spark, d))


@query
def fact_operations(spark, d):
    facts = views.fact_operations(_operations(spark, d))
    return _shown(facts.withColumn("Date", F.col("Date").cast("string")))


@query
def dim_date(spark, d):
    bounds = tt.table(spark, d, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("last_day")
    )
    return _shown(views.dim_date(spark, bounds).withColumn("date_key", F.col("date_key").cast("string")))


# --- drift ---------------------------------------------------------------------------


def _two_years(spark: SparkSession, d: str) -> DataFrame:
    """The compared years, cleansed: rows of one key share the pickup, so slicing first is safe."""
    rows = tt.trips(spark, d)
    both = clean.within("pickup", REF_YEAR) | clean.within("pickup", CUR_YEAR)
    return clean.silver_trips(rows.where(both), tt.ADAPTED_TRIPS, tt.RUN_TS)


def _samples(spark: SparkSession, d: str) -> DataFrame:
    return drift.drift_input(_two_years(spark, d), FEATURES, "pickup_ts", REF_YEAR, CUR_YEAR)


def _shifted(spark: SparkSession, d: str, factor: float = 1.35) -> DataFrame:
    """Ship years 1995 and 1999 of the order lines, with later prices 35 % higher, or times another ``factor``."""
    lines = tt.table(spark, d, "lineitem").withColumn("ts", F.col("l_shipdate").cast("timestamp"))
    late = clean.within("ts", CUR_YEAR)
    raised = lines.withColumn(
        "l_extendedprice", F.col("l_extendedprice") * F.when(late, F.lit(factor)).otherwise(F.lit(1.0))
    )
    return drift.drift_input(raised, ["l_extendedprice", "l_quantity"], "ts", REF_YEAR, CUR_YEAR)


@query
def drift_input(spark, d):
    return _shown(_samples(spark, d))


@query
def drift_freq(spark, d):
    return _shown(drift.frequency(_samples(spark, d)))


@query
def drift_cumulative(spark, d):
    return _shown(drift.cumulative(drift.frequency_table(_samples(spark, d)), parts=32))


@query
def drift_quantiles(spark, d):
    quantiles = drift.quantiles(drift.cumulative(drift.frequency_table(_samples(spark, d))))
    return quantiles.select("feature", F.posexplode("quantiles").alias("i", "quantile")).select(
        "feature", F.col("i").cast("bigint").alias("i"), F.round("quantile", 9).alias("quantile"))


def _bins(spark: SparkSession, d: str) -> DataFrame:
    freq = drift.frequency_table(_samples(spark, d))
    breaks = materialize(drift.quantiles(drift.cumulative(freq)).select("feature", "breaks"), "breaks")
    return drift.histogram(freq, breaks)


@query
def psi_bins(spark, d):
    return _shown(_bins(spark, d))


@query
def drift_psi(spark, d):
    return _shown(drift.psi(_bins(spark, d)), 9)


@query
def drift_ks(spark, d):
    return _shown(drift.ks(drift.cumulative(drift.frequency_table(_samples(spark, d)))), 9)


@query
def drift_wasserstein(spark, d):
    return _shown(drift.wasserstein(drift.cumulative(drift.frequency_table(_samples(spark, d)))))


@query
def drift_report(spark, d):
    return _shown(drift.drift_report(_samples(spark, d), FEATURES))


@query
def drift_report_partials(spark, d):
    """The same report from counts that are stored per month and trip type and merged for the two years."""
    month = sinks.month_of("pickup_date").alias(sinks.MONTH)
    trips = _two_years(spark, d).withColumn(sinks.MONTH, month)
    path = new_path(spark, "value_counts")
    sinks.replace_months(drift.value_counts(trips, FEATURES, ["taxi_type", sinks.MONTH]), path)
    counts = spark.read.schema(job.COUNTS).parquet(path)
    sides = (in_months(year, column=sinks.MONTH) for year in (REF_YEAR, CUR_YEAR))
    return _shown(drift.report_of(drift.merged_frequency(counts, *sides), FEATURES))


@query
def drift_report_shifted(spark, d):
    return _shown(drift.drift_report(_shifted(spark, d)))


@query
def drift_by_type(spark, d):
    samples = drift.drift_input(
        _two_years(spark, d), FEATURES, "pickup_ts", REF_YEAR, CUR_YEAR, group_by=("taxi_type",))
    return _shown(drift.drift_report(samples, group_by=("taxi_type",)))


@query
def drift_violations(spark, d):
    return _shown(drift.violations(drift.drift_report(_shifted(spark, d))))


@query
def drift_empty(spark, d):
    """A current year without trips, and a listed feature without any value."""
    samples = drift.drift_input(trips_silver(spark, d), FEATURES, "pickup_ts", REF_YEAR, 2010)
    report = drift.drift_report(samples, [*FEATURES, "not_measured"])
    return report.select("feature", "n_ref", "n_cur", "is_drifted", "status")


@query
def drift_metrics(spark, d):
    return _shown(evaluate.drift_metrics(drift.drift_report(_samples(spark, d), FEATURES), tt.RUN_TS))


# --- retrieval -----------------------------------------------------------------------


def _corpus(spark: SparkSession, d: str) -> DataFrame:
    return tt.table(spark, d, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("content"), "lang", "source")


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return tt.table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("content_vector"))


def _questions(spark: SparkSession, d: str) -> DataFrame:
    items = tt.table(spark, d, "benchmark").select(
        F.col("item_id").alias("qid"), F.col("text").alias("question"))
    vectors = tt.table(spark, d, "embeddings").select(
        F.col("vec_id").alias("qid"), F.col("embedding").alias("question_vector"))
    return items.join(vectors, "qid", "left")


@query
def gold_documents(spark, d):
    docs = documents.gold_documents(daily_gold(spark, d), digits=6)
    return docs.select("id", "content", *(
        F.col("metadata")[key].alias(key) for key in ("summary_date", "taxi_type", "pu_location_id")))


@query
def doc_batches(spark, d):
    batched = documents.assign_batches(spark, f"{d}/documents.parquet", "doc_id")
    return documents.write_batches(batched, new_path(spark, "doc_batches"))


@query
def doc_batches_by_bytes(spark, d):
    """Batches of at most 40 documents and 100,000 bytes: both bounds are met, and some documents are larger."""
    batched = bounded_batches.assign_bounded_batches(
        spark, f"{d}/documents.parquet", F.octet_length("text"), count=40, limit=100_000, id_col="doc_id")
    return batched.groupBy("batch_id").agg(
        F.count("*").alias("n_docs"), F.sum("n_bytes").alias("n_bytes"),
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


@query
def bm25_topk(spark, d):
    return _shown(retrieve.bm25_topk(_questions(spark, d), _corpus(spark, d)))


@query
def vector_topk(spark, d):
    return _shown(retrieve.vector_topk(_questions(spark, d), _vectors(spark, d)))


@query
def vector_index_topk(spark, d):
    """Questions against the cell index of all vectors; every cell is probed, so the answer is exact."""
    vectors = _vectors(spark, d)
    index = vector_index.build(vectors)
    return _shown(vector_index.search(_questions(spark, d), index, probes=len(index.centres)))


@query
def vector_index_recall(spark, d):
    """Answers of the cell index with its usual probes, held against the exact search: nine in ten are found."""
    vectors, questions = _vectors(spark, d), _questions(spark, d)
    found = vector_index.search(questions, vector_index.build(vectors))
    measured = vector_index.recall(found, retrieve.vector_topk(questions, vectors))
    return measured.select("n_exact", (F.col("recall") >= 0.9).alias("enough"))


@query
def hybrid_topk(spark, d):
    return _shown(retrieve.hybrid_topk(_questions(spark, d), _corpus(spark, d), _vectors(spark, d)))


@query
def hybrid_filtered(spark, d):
    """Vectors get the metadata of their documents; one without a document matches no filter."""
    vectors = _vectors(spark, d).join(_corpus(spark, d).drop("content"), "id")
    return _shown(retrieve.hybrid_topk(
        _questions(spark, d), _corpus(spark, d), vectors, where=F.col("lang").isin("en", "fr")))


@query
def search_results(spark, d):
    """Keyword hits in the result shape: content, score and metadata attached."""
    corpus = _corpus(spark, d)
    found = retrieve.attach_content(
        retrieve.bm25_topk(_questions(spark, d), corpus), corpus, ("lang", "source"))
    return _shown(found.select(
        "qid", "rank", "id", "content", "score",
        F.col("metadata")["lang"].alias("lang"), F.col("metadata")["source"].alias("source")))


def _contexts(spark: SparkSession, d: str) -> DataFrame:
    corpus, questions = _corpus(spark, d), _questions(spark, d)
    hits = retrieve.attach_content(retrieve.bm25_topk(questions, corpus), corpus)
    return prompts.rag_context(questions, hits)


@query
def rag_context(spark, d):
    return _contexts(spark, d).select(
        "qid", "question", F.array_join("source_ids", ",").alias("source_ids"), "context")


@query
def rag_messages(spark, d):
    messages = prompts.rag_messages(_contexts(spark, d))
    return messages.select("qid", F.posexplode("messages").alias("i", "m")).select(
        "qid", F.col("i").cast("bigint").alias("i"), "m.role", "m.content")


# --- evaluation ----------------------------------------------------------------------


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    """User turns with the assistant turn that follows."""
    turns = tt.table(spark, d, "conversations")
    answer = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    return asked.join(answer, ["conv_id", "turn"]).select(
        F.concat_ws("-", "conv_id", "turn").alias("qid"), "conv_id", "question", "response")


def _answers(spark: SparkSession, d: str) -> DataFrame:
    """Pairs with the chunks retrieved for the question."""
    pairs = materialize(_pairs(spark, d), "pairs")
    corpus = _corpus(spark, d)
    hits = retrieve.attach_content(retrieve.bm25_topk(pairs, corpus), corpus)
    contexts = prompts.rag_context(pairs, hits).drop("question")
    return pairs.join(contexts, "qid")


def _judgements(spark: SparkSession, d: str) -> DataFrame:
    """Judge texts derived from the labels, some of them broken by fixed rules."""
    i, quality, toxic = F.col("doc_id"), F.col("quality"), F.col("toxic")
    text = lambda c: c.cast("string")
    grounded = (
        F.when(i % 30 == 2, '"4.7"').when(i % 30 == 3, "4.7").when(i % 30 == 4, '"4"')
        .when(i % 30 == 6, "true").when(i % 30 == 7, "null").otherwise(text(2 + 3 * quality))
    )
    full = F.concat(
        F.lit('{"groundedness": '), grounded, F.lit(', "relevance": '), text(5 - 3 * toxic),
        F.lit(', "coherence": '), text(3 + quality), F.lit("}"))
    short = F.concat(F.lit('{"groundedness": '), text(quality), F.lit(', "relevance": 3}'))
    raw = F.when(i % 20 == 0, '{"groundedness": 4, "relevance":').when(
        i % 25 == 1, short).when(i % 40 == 9, "[4, 4, 4]").otherwise(full)
    return tt.table(spark, d, "labels").select("doc_id", raw.alias("raw"))


@query
def judge_inputs(spark, d):
    return prompts.judge_inputs(_answers(spark, d)).select("qid", "judge_input")


@query
def eval_parse(spark, d):
    good, _ = evaluate.parse_scores(_judgements(spark, d), "raw")
    return _shown(good)


@query
def eval_rejects(spark, d):
    _, bad = evaluate.parse_scores(_judgements(spark, d), "raw")
    return bad


@query
def eval_join(spark, d):
    good, _ = evaluate.parse_scores(_judgements(spark, d), "raw")
    answers = materialize(_answers(spark, d), "answers")
    scores = answers.select("qid", "conv_id").join(good, F.col("conv_id") == F.col("doc_id"))
    return _shown(evaluate.eval_join(answers, scores).select(
        "qid", F.size("context_chunks").alias("n_chunks"), *evaluate.DIMENSIONS, "passed"))


def _deployed(spark: SparkSession, d: str) -> DataFrame:
    good, _ = evaluate.parse_scores(_judgements(spark, d), "raw")
    source = tt.table(spark, d, "documents").select("doc_id", F.col("source").alias("deployment"))
    return good.join(source, "doc_id")


@query
def eval_summary(spark, d):
    return _shown(evaluate.eval_summary(_deployed(spark, d)))


@query
def eval_metrics(spark, d):
    return _shown(evaluate.eval_metrics(_deployed(spark, d), tt.RUN_TS))


# --- alerts --------------------------------------------------------------------------


def _metric_rows(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("feature"),
        (F.col("value") / 490).alias("psi"),
    )


@query
def drift_alerts(spark, d):
    return _shown(alerts.drift_alerts(_metric_rows(tt.table(spark, d, "events"))))


@query
def drift_alerts_stream(spark, d):
    """The same rule as a stream over the event files, run until the input is used up."""
    schema = tt.table(spark, d, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(d)
    found = alerts.drift_alerts(_metric_rows(events), watermark=alerts.ALERT_WINDOW)
    path = new_path(spark, "alerts")
    stream = alerts.write_alerts(found, path, new_path(spark, "alerts_state"))
    stream.awaitTermination()
    return _shown(alerts.read_alerts(spark, path))


@query
def metric_alerts(spark, d):
    """Drift report to metric rows of two runs to alerts, from the metric table at rest and as a stream."""
    path = new_path(spark, "metrics")
    report = materialize(drift.drift_report(_shifted(spark, d, 0.3)), "report")
    for run, ts in (("a", "2024-01-01 00:01:00"), ("b", "2024-01-01 00:07:30")):
        evaluate.drift_metrics(report, ts).write.parquet(f"{path}/run={run}")
    at_rest = alerts.drift_alerts(alerts.psi_rows(alerts.read_metrics(spark, path)))
    rows = alerts.psi_rows(alerts.read_metrics(spark, path, stream=True))
    sink = new_path(spark, "metric_alerts")
    stream = alerts.write_alerts(
        alerts.drift_alerts(rows, watermark=alerts.ALERT_WINDOW), sink, new_path(spark, "metric_alerts_state"))
    stream.awaitTermination()
    streamed = alerts.read_alerts(spark, sink)
    return _shown(at_rest.withColumn("way", F.lit("batch")).unionByName(streamed.withColumn("way", F.lit("stream"))))


def _messages(spark: SparkSession, d: str) -> DataFrame:
    """Alert messages derived from the events; some are cut off, some lack the feature."""
    i = F.col("event_id")
    feature = F.when(i % 19 == 0, "").otherwise(F.concat(F.lit('"feature": "'), "event_type", F.lit('", ')))
    text = F.concat(
        F.lit("{"), feature, F.lit('"score": '), F.col("value").cast("string"),
        F.lit(', "threshold": 0.2, "pipeline_run_id": "run-'), F.col("user_id").cast("string"),
        F.when(i % 17 == 0, '"').otherwise('"}'))
    return tt.table(spark, d, "events").select("event_id", text.alias("raw"))


@query
def alert_parse(spark, d):
    good, _ = evaluate.parse_alerts(_messages(spark, d), "raw")
    return _shown(good)


@query
def alert_rejects(spark, d):
    _, bad = evaluate.parse_alerts(_messages(spark, d), "raw")
    return bad
