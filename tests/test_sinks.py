from __future__ import annotations

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strataflow import storage
from strataflow.operators import sinks
from strataflow.sources.reading import IngestionError, read_layer, read_optional
from strataflow.storage import new_path

SCHEMA = "kind string, id string, day string, v int"


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def table(spark, path):
    df = spark.read.schema(sinks.monthly(frame(spark).schema)).parquet(path).drop(sinks.MONTH)
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_append_raw_adds_runs_and_replaces_its_own(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert sinks.append_raw(frame(spark, ("a", "1", "2023-01-01", 1)), path, "r1") == 1
    assert sinks.append_raw(frame(spark, ("a", "1", "2023-01-01", 1), ("a", "2", "2023-01-01", 1)), path, "r2") == 2
    assert sinks.append_raw(frame(spark, ("a", "1", "2023-01-01", 1)), path, "r1") == 1
    assert spark.read.parquet(path).count() == 3
    assert sinks.append_raw(frame(spark), path, "r2") == 0
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError):
        sinks.append_raw(frame(spark), path, "../r2")


def test_upsert_updates_inserts_and_keeps(spark):
    target = frame(spark, ("a", "1", "d", 1), ("a", "2", "d", 1), ("b", "1", "d", 1))
    source = frame(spark, ("a", "1", "d", 9), ("a", "3", "d", 9))
    got = sorted(tuple(r) for r in sinks.upsert(target, source, ["kind", "id"]).collect())
    assert got == [("a", "1", "d", 9), ("a", "2", "d", 1), ("a", "3", "d", 9), ("b", "1", "d", 1)]
    crossed = sinks.upsert(target, source, ["id"]).count()
    assert crossed == 3  # the shared key overwrites the other kind's row


def test_null_keys_match_so_a_repeated_upsert_is_a_no_op(spark):
    rows = frame(spark, (None, "1", "d", 1))
    assert sinks.upsert(rows, rows, ["kind", "id"]).count() == 1


def test_written_upsert_is_idempotent_and_touches_only_its_months(spark):
    path = new_path(spark, "upsert")
    first = frame(spark, ("a", "1", "2023-01-05", 1), ("a", "2", "2023-02-05", 1))
    assert sinks.write_upsert(path, first, ["id"], "day", date_from=["id"]) == 2
    untouched = f"{path}/_month=2023-01".removeprefix("file:")
    before = sorted(os.listdir(untouched))
    source = frame(spark, ("a", "2", "2023-02-05", 2), ("a", "3", "2023-02-06", 2))
    for _ in range(2):
        assert sinks.write_upsert(path, source, ["id"], "day", date_from=["id"]) == 2
        assert table(spark, path) == [
            ("a", "1", "2023-01-05", 1), ("a", "2", "2023-02-05", 2), ("a", "3", "2023-02-06", 2)]
    assert sorted(os.listdir(untouched)) == before


def test_rows_without_a_date_survive_an_upsert(spark):
    path = new_path(spark, "upsert")
    sinks.write_upsert(path, frame(spark, ("a", "1", None, 1), ("b", "1", "2024-01-01", 1)), ["kind", "id"], "day", date_from=["id"])
    sinks.write_upsert(path, frame(spark, ("c", "1", None, 2)), ["kind", "id"], "day", date_from=["id"])
    assert table(spark, path) == [("a", "1", None, 1), ("b", "1", "2024-01-01", 1), ("c", "1", None, 2)]


def test_a_date_that_is_no_part_of_the_key_is_refused(spark):
    path, rows = new_path(spark, "upsert"), frame(spark, ("a", "1", "2024-01-01", 1))
    for given in ({}, {"date_from": ["v"]}):
        with pytest.raises(ValueError, match="neither a key nor derived"):
            sinks.write_upsert(path, rows, ["kind", "id"], "day", **given)
    sinks.write_upsert(path, rows, ["id", "day"], "day")
    assert len(table(spark, path)) == 1


def test_raw_runs_with_other_columns_are_refused(spark, tmp_path):
    path = str(tmp_path / "raw")
    sinks.append_raw(frame(spark, ("a", "1", "2023-01-01", 1)), path, "r1")
    for changed in (frame(spark).drop("v"), frame(spark).withColumn("w", F.lit(1)), frame(spark).withColumn("v", F.lit("x"))):
        with pytest.raises(IngestionError, match="columns or types differ"):
            sinks.append_raw(changed, path, "r2")


def test_upsert_over_several_months(spark):
    path = new_path(spark, "upsert")
    sinks.write_upsert(path, frame(spark, *(("a", str(i), f"2023-0{i}-01", 1) for i in range(1, 5))), ["id"], "day", date_from=["id"])
    sinks.write_upsert(path, frame(spark, ("a", "1", "2023-01-01", 7), ("a", "2", "2023-02-01", 7)), ["id"], "day", date_from=["id"])
    assert [r[3] for r in table(spark, path)] == [7, 7, 1, 1]


def test_duplicate_source_keys_stop_the_upsert(spark):
    path = new_path(spark, "upsert")
    sinks.write_upsert(path, frame(spark, ("a", "1", "2023-01-01", 1)), ["id"], "day", date_from=["id"])
    twice = frame(spark, ("a", "1", "2023-01-01", 2), ("b", "1", "2023-01-01", 3))
    with pytest.raises(sinks.MergeConflict):
        sinks.write_upsert(path, twice, ["id"], "day", date_from=["id"])
    assert table(spark, path) == [("a", "1", "2023-01-01", 1)]


def replace(spark, path, rows, dates):
    return sinks.replace_dates(path, frame(spark, *rows), dates, "day", ("kind",))


def test_replace_dates(spark):
    path = new_path(spark, "gold")
    a, b, c = (("a", "1", f"2023-01-0{i}", 1) for i in (1, 2, 3))
    assert replace(spark, path, [a, b, c], ["2023-01-01", "2023-01-02", "2023-01-03"]) == 3
    new = ("n", "9", "2023-01-02", 5)
    assert replace(spark, path, [new], ["2023-01-02"]) == 1
    assert table(spark, path) == sorted([a, new, c], key=str)


def test_replace_with_nothing_clears_the_date(spark):
    path = new_path(spark, "gold")
    rows = [("a", "1", "2023-01-01", 1), ("a", "1", "2023-01-02", 1), ("a", "1", "2023-02-01", 1)]
    replace(spark, path, rows, [r[2] for r in rows])
    assert replace(spark, path, [], ["2023-01-01"]) == 0
    assert table(spark, path) == rows[1:]
    replace(spark, path, [], ["2023-02-01"])  # empties the whole month
    assert table(spark, path) == rows[1:2]


def test_a_row_outside_the_dates_changes_nothing(spark):
    path = new_path(spark, "gold")
    old = ("a", "1", "2023-01-01", 1)
    replace(spark, path, [old], ["2023-01-01"])
    for stray in (("b", "1", "2023-01-02", 1), ("b", "1", None, 1)):
        with pytest.raises(PySparkException, match="outside the replaced dates"):
            replace(spark, path, [("b", "1", "2023-01-01", 2), stray], ["2023-01-01"])
    assert table(spark, path) == [old]


def test_month_directories_prune_and_dates_stay_text(spark):
    path = new_path(spark, "layer")
    sinks.write_upsert(f"{path}/silver_t", frame(spark, ("a", "1", "2023-01-05", 1)), ["id"], "day", date_from=["id"])
    schema = sinks.monthly(frame(spark).schema)
    df = read_layer(spark, path, "silver", "t", schema).where("_month = '2023-01'")
    assert df.first()["day"] == "2023-01-05"
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_month" in plan
    assert read_optional(spark, path, "silver", "absent", schema) is None


def test_clustered_files_hold_disjoint_ranges(spark):
    path = new_path(spark, "clustered")
    df = spark.range(1000).select((F.col("id") % 97).alias("k"), "id")
    sinks.clustered(df, ["k"], files=4).write.parquet(path)
    ranges = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("k"), F.max("k")).collect()
    spans = sorted((r[1], r[2]) for r in ranges)
    assert len(spans) > 1 and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_split_columns_are_keys_and_never_null(spark):
    path, rows = new_path(spark, "upsert"), frame(spark, ("a", "1", "2024-01-01", 1))
    with pytest.raises(ValueError, match="must be keys"):
        sinks.write_upsert(path, rows, ["id"], "day", date_from=["id"], split_by=["kind"])
    with pytest.raises(PySparkException, match="row without a value in kind"):
        sinks.write_upsert(path, frame(spark, (None, "1", "2024-01-01", 1)), ["kind", "id"], "day", date_from=["id"], split_by=["kind"])
    for source in (rows, frame(spark, ("a", "1", "2024-01-01", 2), ("b", "1", "2024-01-01", 3)), frame(spark, ("b", "2", None, 4))):
        sinks.write_upsert(path, source, ["kind", "id"], "day", date_from=["id"], split_by=["kind"])
    got = spark.read.schema(sinks.monthly(frame(spark).schema)).parquet(path).select("kind", "id", "day", "v")
    assert sorted((tuple(r) for r in got.collect()), key=str) == [
        ("a", "1", "2024-01-01", 2), ("b", "1", "2024-01-01", 3), ("b", "2", None, 4)]


def test_an_upsert_deals_its_rows_once(spark):
    path, rows = new_path(spark, "upsert"), [("a", str(i), f"2023-0{1 + i % 3}-05", 1) for i in range(60)]
    sinks.write_upsert(path, frame(spark, *rows), ["id"], "day", date_from=["id"])
    target = spark.read.schema(sinks.monthly(frame(spark).schema)).parquet(path)
    source = frame(spark, ("a", "1", "2023-02-05", 2), ("a", None, None, 3), ("a", "99", "2023-02-07", 4))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        touched = sinks.touched_rows(target, source, "day")
        both = sinks.merged(touched.select(source.columns), source, ["day", "id"])
        plan = both._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange rangepartitioning") == 1 and "SortMergeJoin" not in plan
    got = {r["id"]: (r["day"], r["v"]) for r in both.collect()}
    assert len(got) == 22 and got["1"] == ("2023-02-05", 2) and got[None] == (None, 3) and got["4"] == ("2023-02-05", 1)


def test_a_written_source_is_not_copied(spark, tmp_path, monkeypatch):
    written = str(tmp_path / "source")
    frame(spark, ("a", "1", "2023-01-01", 1), ("a", "2", "2023-01-01", 1)).write.parquet(written)
    source = spark.read.schema(frame(spark).schema).parquet(written)
    monkeypatch.setattr(sinks, "materialize", lambda *a, **kw: pytest.fail("copied"))
    path = new_path(spark, "upsert")
    for _ in range(2):
        assert sinks.write_upsert(path, source, ["id"], "day", date_from=["id"], source_is_written=True) == 2
    assert len(table(spark, path)) == 2


def test_keys_with_nulls_in_other_places_are_no_conflict(spark):
    rows = frame(spark, (None, "a", "d", 1), ("a", None, "d", 1))
    sinks.check_unique(rows, ["kind", "id"])
    with pytest.raises(sinks.MergeConflict):
        sinks.check_unique(rows.unionByName(rows), ["kind", "id"])


def test_an_upsert_deals_keys_and_leaves_the_rows_of_the_target_where_they_are(spark, monkeypatch):
    """Rows that stay are read and written; a join of hashes and bits of row numbers say which ones those are."""
    monkeypatch.setattr(sinks, "GROUP", 64)  # several groups of rows in a file
    path = new_path(spark, "upsert")
    rows = spark.range(1000).select(
        F.when(F.col("id") % 7 > 0, "a").alias("kind"), F.when(F.col("id") != 5, F.col("id").cast("string")).alias("id"),
        F.concat(F.lit("2023-0"), (1 + F.col("id") % 3).cast("string"), F.lit("-05")).alias("day"), F.lit(1).alias("v"))
    sinks.write_upsert(path, rows, ["kind", "id"], "day", date_from=["id"])
    new = rows.where("coalesce(id, 5) % 4 = 1").withColumn("v", F.lit(2)).unionByName(frame(spark, (None, "3000", "2023-01-05", 2)))
    plans, replace_months = [], sinks._replace_months
    monkeypatch.setattr(sinks, "_replace_months", lambda df, *a: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or replace_months(df, *a))
    for _ in range(2):
        assert sinks.write_upsert(path, new, ["kind", "id"], "day", date_from=["id"]) == 251
    changed = {(r["kind"], r["id"]) for r in new.collect()}
    want = [(r["kind"], r["id"], r["day"], 2 if (r["kind"], r["id"]) in changed else 1) for r in rows.collect()]
    assert table(spark, path) == sorted([*want, (None, "3000", "2023-01-05", 2)], key=str)
    for plan in plans:
        dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]
        assert not any("day#" in line for line in dealt) and "rangepartitioning" not in plan


def test_keys_with_nulls_in_other_places_replace_nothing(spark):
    path = new_path(spark, "upsert")
    sinks.write_upsert(path, frame(spark, (None, "a", "2023-01-05", 1)), ["kind", "id"], "day", date_from=["id"])
    sinks.write_upsert(path, frame(spark, ("a", None, "2023-01-05", 2)), ["kind", "id"], "day", date_from=["id"])
    assert table(spark, path) == [("a", None, "2023-01-05", 2), (None, "a", "2023-01-05", 1)]


def test_shuffle_files_of_a_write_go_with_it(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    with storage.shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == "false"
