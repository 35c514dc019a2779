"""Writers: raw append, upsert, date replacement, clustered layout, row counts.

Plain parquet directories. Every writer can be run again after a failure: the raw append
replaces only its own run, upserts and date rebuilds replace whole partitions, and an
upsert never overwrites files it is still reading.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.sources.reading import EVENT_MONTH, NO_MONTH, VALID, IngestionError
from strataflow.storage import is_missing_path, materialize, shuffles_dropped

# Directory column of upserted tables. Months match the slices a run ingests and stay few;
# days are found inside by the files' min/max statistics.
MONTH = "_month"

# Rows of a file whose replacement one bitmap tells; Spark's bitmaps have 4,096 bytes.
GROUP = 32_768

# Hashed keys are text over 16 letters: a codec without entropy coding leaves them as long as they are.
COMPRESSION = "zstd"


class MergeConflict(RuntimeError):
    """Several source rows share one merge key."""


def written_rows(table: DataFrame) -> int:
    """Rows of a written table, from the file footers.

    Neither runs the plan again nor counts a row twice when a lost task was repeated.
    """
    return table.count()


def append_raw(df: DataFrame, path: str, run_id: str) -> int:
    """Add one ingestion run to an append-only table; the same run id replaces itself.

    The run is one partition directory, so a new run adds files and a repeated one
    (even an empty one) overwrites its own. No shuffle. A run whose columns or types differ
    from the table's is refused: the table's schema does not evolve.
    """
    return written_rows(_write_run(df, path, run_id))


def append_checked(checked: DataFrame, path: str, run_id: str, month: Column) -> int:
    """:func:`append_raw` of rows that carry their ``violations``: the number of those without.

    One write for rows that keep the contract and rows that break it, in directories of their own, and below
    these one directory for every ``month``, so a slice by time opens its months alone, whichever ingest they
    came with. A file's rows are counted from its footer.
    """
    rows = checked.select("*", F.col("violations").isNull().alias(VALID), month.alias(EVENT_MONTH))
    return written_rows(_write_run(rows, path, run_id, (VALID, EVENT_MONTH)).where(VALID))


def _write_run(df: DataFrame, path: str, run_id: str, split_by: Sequence[str] = ()) -> DataFrame:
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run_id):
        raise ValueError(f"run id {run_id!r} is not a plain directory name")
    _check_same_columns(df.drop(*split_by), path, ("_ingest_id", *split_by))
    run_path = f"{path}/_ingest_id={run_id}"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*split_by).parquet(run_path)
    return df.sparkSession.read.schema(df.schema).parquet(run_path)


def _check_same_columns(df: DataFrame, path: str, directories: Sequence[str]) -> None:
    """Compares with the footer of one file of the table; no job over rows runs."""
    try:
        known = df.sparkSession.read.parquet(path).schema
    except AnalysisException as error:
        # A table of empty runs alone has directories without a file.
        if is_missing_path(error) or error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return
        raise IngestionError(f"Cannot read table {path!r}: {error}") from error
    types = lambda schema: {f.name: f.dataType.simpleString() for f in schema.fields}
    want, got = types(known), types(df.schema)
    for name in directories:
        want.pop(name, None)
    if want != got:
        differ = sorted(set(want.items()) ^ set(got.items()))
        raise IngestionError(f"Cannot append to {path!r}: columns or types differ in {differ}")


def month_of(date_col: str) -> Column:
    """Directory of a row: the month of its date."""
    return F.coalesce(F.left(F.col(date_col), F.lit(7)), F.lit(NO_MONTH))


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one source row: a merge could not decide between them."""
    return source.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def check_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """Hashes of the keys are counted; the keys themselves only if two rows share a hash."""
    hashed = source.select(F.xxhash64(*keys).alias("key"))
    if duplicate_keys(hashed, ["key"]).first() is None:
        return
    conflict = duplicate_keys(source, keys).first()
    if conflict is not None:
        raise MergeConflict(f"{conflict['n_rows']} source rows for key {[conflict[k] for k in keys]}")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows without a source row of the same key, plus all source rows.

    Keys compare null-safe, as deduplication does, so a repeated run stays a no-op.
    """
    source_keys = source.select(*(F.col(k).alias(f"_s_{k}") for k in keys))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys))
    return target.join(source_keys, same, "left_anti").unionByName(source)


def monthly(schema: T.StructType) -> T.StructType:
    """A table's contract plus its directory column."""
    return T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])


def clustered(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by ``columns``: tight min/max statistics per file.

    A full key as ``columns`` lets a hot date spread over several files.
    """
    by = [F.col(c) for c in columns]
    ranged = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by)


def _layout(date_col: str, keys: Sequence[str], split_by: Sequence[str]) -> list[str]:
    """Columns that a table's rows are ranged and sorted by."""
    return [*split_by, date_col, *(c for c in keys if c != date_col and c not in split_by)]


def _replace_months(df: DataFrame, path: str, date_col: str, split_by: Sequence[str] = ()) -> None:
    """Overwrite the months ``df`` has rows of; its rows are clustered by date and key."""
    message = F.lit(f"row without a value in {', '.join(split_by)}")
    told = {c: F.coalesce(F.col(c), F.raise_error(message).cast(df.schema[c].dataType)) for c in split_by}
    (
        df.withColumns({**told, MONTH: month_of(date_col)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*split_by, MONTH)
        .parquet(path, compression=COMPRESSION)
    )


def merged(target: DataFrame, source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """:func:`upsert` of rows whose key is ``columns``, clustered by them.

    The ranges bring rows of one key together, so the rows are dealt once for both.
    """
    both = source.withColumn("_new", F.lit(True)).unionByName(target.withColumn("_new", F.lit(False)))
    replaced = F.max("_new").over(Window.partitionBy(*columns))
    kept = clustered(both, columns).withColumn("_replaced", replaced).where(F.col("_new") | ~F.col("_replaced"))
    return kept.drop("_new", "_replaced")


def replace_months(df: DataFrame, path: str) -> None:
    """Overwrite the months (a column of ``df``) that ``df`` has rows of; other months stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def _read_if_exists(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path).select(schema.names)
    except AnalysisException as error:
        if is_missing_path(error):
            return None
        raise IngestionError(f"Cannot read table {path!r}: {error}") from error


def write_upsert(path: str, source: DataFrame, keys: Sequence[str], date_col: str,
                 source_is_unique: bool = False, date_from: Sequence[str] = (), split_by: Sequence[str] = (),
                 source_is_written: bool = False, source_is_clustered: bool = False) -> int:
    """Upsert into a table split by month of ``date_col``; only touched months are rewritten.

    A match can only lie in the same month, so ``date_col`` must be one of the keys, or be derived from
    those that ``date_from`` names (a trip key contains its pickup time). ``split_by`` names keys that are
    directories above the months: other values' files stay as they are, and rows without a value are refused.
    The source is written to the shared folder before the target changes; its directories select the target's
    by a join that prunes, so nothing depends on their number. The new ones are built beside the old ones and
    take their place when they are complete. ``source_is_unique`` skips the duplicate-key check for a
    source just deduplicated on the keys, ``source_is_written`` another copy of rows that lie in written files
    outside the table already, ``source_is_clustered`` their range shuffle, if these files are ranged by date.
    Target rows are not shuffled: those that stay are written again as their files hold them, and the source's beside
    them. Returns the number of source rows.
    """
    if date_col not in keys and not (date_from and set(date_from) <= set(keys)):
        raise ValueError(f"{date_col!r} is neither a key nor derived from one: a key whose date changes would be kept twice")
    if not set(split_by) <= set(keys):
        raise ValueError(f"{list(split_by)} must be keys: a match may lie under another value otherwise")
    spark = source.sparkSession
    columns = _layout(date_col, keys, split_by)
    with shuffles_dropped(spark):
        staged = source if source_is_written else materialize(
            clustered(source, columns), "upsert_source", compression=COMPRESSION)
        if not source_is_unique:
            check_unique(staged, keys)
        new = clustered(staged, columns) if source_is_written and not source_is_clustered else staged
        target = _read_if_exists(spark, path, monthly(staged.schema))
        if target is not None:
            touched = touched_rows(with_places(target), staged, date_col, split_by)
            new = kept_rows(touched, staged, keys).unionByName(new)
        _replace_months(new, path, date_col, split_by)
    return written_rows(staged)


def with_places(target: DataFrame) -> DataFrame:
    """A scan of files with the place of every row: its file, as a hash, and its number there."""
    return target.select("*", F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def kept_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` (:func:`with_places`) without a source row of the same key, in the order of their files.

    Keys are dealt, as two hashes, and the places of the rows; the rows themselves stay where they are read. Replaced ones
    are told to every task by one bit per row of their files, in groups of :data:`GROUP` rows. Keys compare null-safe.
    """
    hashes = {f"_h{i}": _hash(keys, i) for i in range(2)}
    replaced = target.select(*_named(hashes), "_file", "_row").join(source.select(*_named(hashes)), list(hashes), "left_semi")
    group, bit = F.expr(f"_row div {GROUP}"), F.col("_row") % GROUP
    bits = replaced.groupBy("_file", group.alias("_group")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    told = target.withColumn("_group", group).join(F.broadcast(bits), ["_file", "_group"], "left")
    octet = F.conv(F.hex(F.substring("_bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_replaced = F.expr("shiftright(_octet, cast(_row % 8 as int)) & 1") == 1
    kept = told.withColumn("_octet", octet).where(F.col("_octet").isNull() | ~is_replaced)
    return kept.drop("_file", "_row", "_group", "_bits", "_octet")


def _hash(keys: Sequence[str], seed: int) -> Column:
    """Nulls are told apart: a hash passes over them."""
    return F.xxhash64(F.lit(seed), *(c for k in keys for c in (F.col(k).isNull(), F.col(k))))


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def touched_rows(target: DataFrame, source: DataFrame, date_col: str, split_by: Sequence[str] = ()) -> DataFrame:
    """Rows of the directories of ``target`` that ``source`` has rows for."""
    # The comparison leaves out nothing; it lets the planner prune directories by this side. A row per directory of the
    # table at most is sent to every task, so the target's rows are not dealt by month.
    wanted = source.select(*split_by, month_of(date_col).alias(MONTH)).distinct().where(F.col(MONTH) >= "")
    return target.join(F.broadcast(wanted), [*split_by, MONTH], "left_semi").drop(MONTH)


def replace_table(path: str, df: DataFrame, column: str = "summary_date",
                  cluster_by: Sequence[str] = ("taxi_type", "pu_location_id")) -> int:
    """Make ``df`` the whole table, in the layout of :func:`replace_dates`."""
    staged = materialize(df, "replaced_table")
    ranged = clustered(staged, [column, *cluster_by]).withColumn(MONTH, month_of(column))
    ranged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(MONTH).parquet(path)
    return written_rows(staged)


def _inside(dates: Sequence[str], column: str) -> Column:
    """True for rows of the given dates; fails the job for any other row."""
    message = F.concat(F.lit("row outside the replaced dates: "), F.coalesce(F.col(column), F.lit("NULL")))
    listed = F.coalesce(F.col(column).isin(list(dates)), F.lit(False))
    return F.when(listed, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))


def replace_dates(
    path: str,
    df: DataFrame,
    dates: Sequence[str],
    column: str = "summary_date",
    cluster_by: Sequence[str] = ("taxi_type", "pu_location_id"),
) -> int:
    """Make ``df`` the whole content of the given dates; other dates stay untouched.

    A date without new rows is emptied. A row outside the dates fails the job before
    anything is replaced.
    """
    spark = df.sparkSession
    new = staged = materialize(df.where(_inside(dates, column)), "replaced_dates")
    months = {day[:7] for day in dates}
    present: set[str] = set()
    target = _read_if_exists(spark, path, monthly(df.schema))
    if target is not None:
        old = target.where(F.col(MONTH).isin(sorted(months)))
        present = _values(old, MONTH)
        kept = old.where(~F.col(column).isin(list(dates))).drop(MONTH)
        new = materialize(kept.unionByName(staged), "replaced_months")
    filled = _values(new.select(month_of(column).alias(MONTH)), MONTH)
    if filled:
        _replace_months(clustered(new, _layout(column, cluster_by, ())), path, column)
    # Dynamic overwrite leaves a month without rows as it was: write zero rows over it.
    for month in sorted(present - filled):
        new.where("false").write.mode("overwrite").parquet(f"{path}/{MONTH}={month}")
    return written_rows(staged)


def _values(df: DataFrame, column: str) -> set[str]:
    """Distinct months among those the caller's dates fall in."""
    return {row[0] for row in df.select(column).distinct().collect()}
