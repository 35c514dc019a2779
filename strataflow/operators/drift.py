"""Two-sample drift statistics for many features at once, without collecting values.

Everything is computed from one frequency table ``(feature, value, n_ref, n_cur)``. Equal
values are combined before the shuffle, so a value that holds a large share of the rows
costs one row per map task. Running counts are formed inside ranges of values and shifted by
the totals of the ranges below, so no window ever spans a whole feature.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions.numeric import count_not_above, ks_pvalue, lerp
from strataflow.operators.clean import within
from strataflow.storage import materialize, ordered_parts

# Bins, smoothing, thresholds, checked features and baseline year.
PSI_BINS = 10
PSI_EPSILON = 1e-6
PSI_THRESHOLD = 0.2
KS_THRESHOLD = 0.1
DRIFT_FEATURES = ("fare_amount", "trip_distance", "tip_amount")
REFERENCE_YEAR = 2022


class DriftThresholdExceeded(RuntimeError):
    """At least one feature exceeds a drift threshold."""

    def __init__(self, feature: str, score: float, threshold: float) -> None:
        super().__init__(f"drift in feature {feature!r}: score {score:.4f} > threshold {threshold:.4f}")
        self.feature, self.score, self.threshold = feature, score, threshold


def two_sample(df: DataFrame, features: Sequence[str], is_ref: Column, is_cur: Column,
               group_by: Sequence[str] = ()) -> DataFrame:
    """Long ``(group…, feature, side, value)`` without NULL and NaN; a row may be on both sides."""
    sides = F.array_compact(F.array(F.when(is_ref, F.lit("ref")), F.when(is_cur, F.lit("cur"))))
    wide = df.where(is_ref | is_cur).select(
        *group_by, F.explode(sides).alias("side"), *(F.col(f).cast("double").alias(f) for f in features)
    )
    long = wide.unpivot([*group_by, "side"], list(features), "feature", "value")
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def drift_input(df: DataFrame, features: Sequence[str], ts_col: str, ref_year: int, cur_year: int,
                group_by: Sequence[str] = ()) -> DataFrame:
    """The values of two years of each feature, all row types pooled unless grouped."""
    return two_sample(df, features, within(ts_col, ref_year), within(ts_col, cur_year), group_by)


def frequency(samples: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Occurrences of every distinct value on both sides."""
    return samples.groupBy(*group_by, "feature", "value").agg(
        F.count_if(F.col("side") == "ref").alias("n_ref"),
        F.count_if(F.col("side") == "cur").alias("n_cur"),
    )


def frequency_table(samples: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    return materialize(frequency(samples, group_by), "drift_freq")


def value_counts(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by…, feature, value, n)`` without NULL and NaN: what :func:`merged_frequency` needs of the rows.

    Tables of different months, kept apart by one of the columns ``by``, add up: no month is counted twice.
    """
    wide = df.select(*by, *(F.col(f).cast("double").alias(f) for f in features))
    long = wide.unpivot(list(by), list(features), "feature", "value")
    return long.where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy(*by, "feature", "value").agg(
        F.count("*").alias("n"))


def merged_frequency(counts: DataFrame, is_ref: Column, is_cur: Column, group_by: Sequence[str] = ()) -> DataFrame:
    """:func:`frequency_table` of two samples from stored counts; a count may be on both sides."""
    merged = counts.where(is_ref | is_cur).groupBy(*group_by, "feature", "value").agg(
        F.coalesce(F.sum(F.when(is_ref, F.col("n"))), F.lit(0)).alias("n_ref"),
        F.coalesce(F.sum(F.when(is_cur, F.col("n"))), F.lit(0)).alias("n_cur"))
    return materialize(merged, "drift_freq")


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join; grouping columns may be NULL, ``feature``, ``_part`` and ``bin`` never are.

    Plain equality on the latter keeps the join partitioned like the windows before it.
    """
    never_null = ("feature", "_part", "bin")
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    pairs = ((k, F.col(k), F.col(f"_r_{k}")) for k in keys)
    on = reduce(
        lambda a, b: a & b, (a == b if k in never_null else a.eqNullSafe(b) for k, a, b in pairs)
    )
    return left.join(renamed, on, how).drop(*(f"_r_{k}" for k in keys))


def cumulative(freq: DataFrame, group_by: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """Running counts up to and including each value, side totals, and the next value.

    The distinct values of all features lie in ranges of ``(group, feature, value)``, as many as the
    shuffle has (or ``parts``), so work follows the rows, whether they belong to one group or to
    many. ``freq`` should be a written table (``frequency_table``).
    """
    keys = [*group_by, "feature"]
    ranged = ordered_parts(freq, [*keys, "value"], "drift_ranges", parts)

    # One row per feature and range.
    by_part = Window.partitionBy(*keys).orderBy("_part")
    below = by_part.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = (
        ranged.groupBy(*keys, "_part")
        .agg(F.sum("n_ref").alias("_ref"), F.sum("n_cur").alias("_cur"), F.min("value").alias("_min"))
        .select(
            *keys,
            "_part",
            F.coalesce(F.sum("_ref").over(below), F.lit(0)).alias("ref_below"),
            F.coalesce(F.sum("_cur").over(below), F.lit(0)).alias("cur_below"),
            F.sum("_ref").over(whole).alias("total_ref"),
            F.sum("_cur").over(whole).alias("total_cur"),
            F.lead("_min").over(by_part).alias("next_part_min"),
        )
    )
    in_part = Window.partitionBy(*keys, "_part").orderBy("value")
    running = in_part.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select(
        "*",
        F.sum("n_ref").over(running).alias("_ref_run"),
        F.sum("n_cur").over(running).alias("_cur_run"),
        F.lead("value").over(in_part).alias("_next"),
    )
    return _join(local, offsets, [*keys, "_part"]).select(
        *keys,
        "value",
        "n_ref",
        "n_cur",
        (F.col("_ref_run") + F.col("ref_below")).alias("cum_ref"),
        (F.col("_cur_run") + F.col("cur_below")).alias("cum_cur"),
        "total_ref",
        "total_cur",
        F.coalesce("_next", "next_part_min").alias("next_value"),
    )


def _gap() -> Column:
    """Distance between the two empirical distribution functions at this value."""
    ref = F.when(F.col("total_ref") > 0, F.col("cum_ref") / F.col("total_ref"))
    cur = F.when(F.col("total_cur") > 0, F.col("cum_cur") / F.col("total_cur"))
    return F.abs(ref - cur)


def ks_statistic() -> Column:
    return F.max(_gap())


def wasserstein_distance() -> Column:
    return F.sum(_gap() * (F.col("next_value") - F.col("value")))


def ks(cum: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Largest distance between the two distribution functions."""
    return cum.groupBy(*group_by, "feature").agg(ks_statistic().alias("ks_statistic"))


def wasserstein(cum: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Area between the two distribution functions."""
    return cum.groupBy(*group_by, "feature").agg(
        F.coalesce(wasserstein_distance(), F.when(F.max(_gap()).isNotNull(), 0.0)).alias("wasserstein")
    )


def _shares(n_bins: int) -> list[float]:
    return [float(p) / 100 for p in np.linspace(0, 100, n_bins + 1)]


def _order_statistic(rank: str) -> str:
    """Reference value at a 0-based rank: the row whose run of equal values covers it."""
    return f"max(case when cum_ref - n_ref <= {rank} and {rank} < cum_ref then value end)"


def _quantiles(n_bins: int) -> tuple[list[Column], Column]:
    """(aggregates finding the neighbouring order statistics, array built from them).

    Written as SQL text: three aggregates per quantile would be many single column calls.
    """
    found, points = [], []
    for i, share in enumerate(_shares(n_bins)):
        position = f"((total_ref - 1) * {share!r}D)"
        found += [
            F.expr(f"{_order_statistic(f'floor({position})')} as _low{i}"),
            F.expr(f"{_order_statistic(f'least(floor({position}) + 1, total_ref - 1)')} as _high{i}"),
            F.expr(f"max({position} - floor({position})) as _t{i}"),
        ]
        points.append(lerp(f"_low{i}", f"_high{i}", f"_t{i}"))
    return found, F.expr(f"array({', '.join(points)})")


def quantiles(cum: DataFrame, n_bins: int = PSI_BINS, group_by: Sequence[str] = ()) -> DataFrame:
    """Linearly interpolated reference quantiles and the distinct break points they give."""
    found, points = _quantiles(n_bins)
    return (
        cum.groupBy(*group_by, "feature")
        .agg(*found)
        .select(*group_by, "feature", points.alias("quantiles"))
        .withColumn("breaks", F.array_sort(F.array_distinct(F.array_compact("quantiles"))))
    )


def discrete_quantiles(cum: DataFrame, shares: Sequence[float], group_by: Sequence[str] = ()) -> DataFrame:
    """Smallest reference value with at least the given share of rows at or below it."""
    def at(share: float) -> Column:
        rank = f"(greatest(1, ceil({share!r}D * total_ref)) - 1)"
        return F.expr(f"{_order_statistic(rank)} as p{round(share * 100)}")

    return cum.groupBy(*group_by, "feature").agg(*(at(share) for share in shares))


def histogram(freq: DataFrame, breaks: DataFrame, n_bins: int = PSI_BINS,
              group_by: Sequence[str] = ()) -> DataFrame:
    """Both sides' counts per bin: half-open, last bin closed, values outside dropped."""
    keys = [*group_by, "feature"]
    last = F.size("breaks") - 1
    found = count_not_above(F.col("breaks"), F.col("value"), n_bins + 1)
    closed = F.when(F.col("value") == F.get("breaks", last), last).otherwise(found)
    counted = (
        _join(freq, breaks, keys)
        .where(F.size("breaks") > 1)
        .select(*keys, last.alias("_bins"), closed.alias("bin"), "n_ref", "n_cur")
        .where((F.col("bin") >= 1) & (F.col("bin") <= F.col("_bins")))
        .groupBy(*keys, "bin")
        .agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    )
    bins = breaks.where(F.size("breaks") > 1).select(
        *keys, F.posexplode(F.slice("breaks", F.lit(1), last)).alias("_i", "low"), "breaks"
    ).select(*keys, (F.col("_i") + 1).alias("bin"), "low", F.get("breaks", F.col("_i") + 1).alias("high"))
    return _join(bins, counted, [*keys, "bin"], "left").na.fill(0, ["n_ref", "n_cur"])


def psi(bins: DataFrame, group_by: Sequence[str] = (), eps: float = PSI_EPSILON) -> DataFrame:
    """Population stability index of each feature that has at least one bin.

    Shares are taken over the values inside the reference range. NaN when no current
    value lies inside it.
    """
    keys = [*group_by, "feature"]
    pairs = bins.groupBy(*keys).agg(
        F.sum("n_ref").alias("_ref"), F.sum("n_cur").alias("_cur"),
        F.collect_list(F.struct("n_ref", "n_cur")).alias("_bins"),  # one entry per bin
    )

    def term(pair: Column) -> Column:
        r = pair["n_ref"] / F.col("_ref") + eps
        c = pair["n_cur"] / F.col("_cur") + eps
        return (c - r) * F.ln(c / r)

    total = F.aggregate("_bins", F.lit(0.0), lambda acc, pair: acc + term(pair))
    inside = (F.col("_ref") > 0) & (F.col("_cur") > 0)
    return pairs.select(*keys, F.when(inside, total).otherwise(F.lit(float("nan"))).alias("psi"))


def drift_report(
    samples: DataFrame,
    features: Sequence[str] | None = None,
    psi_threshold: float = PSI_THRESHOLD,
    ks_threshold: float = KS_THRESHOLD,
    n_bins: int = PSI_BINS,
    group_by: Sequence[str] = (),
    raise_on_drift: bool = False,
    strict: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """:func:`report_of` the values of two samples."""
    return report_of(frequency_table(samples, group_by), features, psi_threshold, ks_threshold, n_bins, group_by,
                     raise_on_drift, strict, parts)


def report_of(
    freq: DataFrame,
    features: Sequence[str] | None = None,
    psi_threshold: float = PSI_THRESHOLD,
    ks_threshold: float = KS_THRESHOLD,
    n_bins: int = PSI_BINS,
    group_by: Sequence[str] = (),
    raise_on_drift: bool = False,
    strict: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """One row per feature: PSI, KS with p-value, Wasserstein-1, flag and status.

    Two passes over the written frequency table: one for the distribution functions and
    reference quantiles, one for the histogram. Features listed in ``features`` but absent
    from ``freq``, or from one of its groups, are reported as empty. ``strict`` raises for an empty side.
    """
    spark = freq.sparkSession
    keys = [*group_by, "feature"]
    found, points = _quantiles(n_bins)
    stats = materialize(
        cumulative(freq, group_by, parts)
        .groupBy(*keys)
        .agg(
            F.max("total_ref").alias("n_ref"), F.max("total_cur").alias("n_cur"),
            ks_statistic().alias("ks_statistic"), wasserstein_distance().alias("wasserstein"), *found,
        )
        .select(
            *keys, "n_ref", "n_cur", "ks_statistic",
            F.when(F.col("ks_statistic").isNotNull(), F.coalesce("wasserstein", F.lit(0.0))).alias("wasserstein"),
            F.array_sort(F.array_distinct(F.array_compact(points))).alias("breaks"),
        ),
        "drift_stats",
    )
    index = psi(histogram(freq, stats.select(*keys, "breaks"), n_bins, group_by), group_by)
    report = _join(stats, index, keys, "left")
    if features is not None:
        names = F.explode(F.array(*map(F.lit, features))).alias("feature")
        groups = stats.select(*group_by).distinct() if group_by else spark.range(1)
        listed = groups.select(*group_by, names)
        report = _join(listed, report, keys, "left").na.fill(0, ["n_ref", "n_cur"])

    status = (
        F.when(F.col("n_ref") == 0, "empty_reference").when(F.col("n_cur") == 0, "empty_current").otherwise("ok")
    )
    ok = F.col("status") == "ok"
    report = (
        report.withColumn("status", status)
        # fewer than two break points: the reference is constant, its PSI is 0
        .withColumn("psi", F.when(ok, F.when(F.size("breaks") < 2, 0.0).otherwise(F.col("psi"))))
        .select(
            *keys, "n_ref", "n_cur", "psi", "ks_statistic",
            F.when(ok, ks_pvalue(F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur"))).alias("ks_p_value"),
            "wasserstein",
            F.when(ok, _exceeds("psi", psi_threshold) | (F.col("ks_statistic") > ks_threshold)).alias("is_drifted"),
            "status",
        )
    )
    if strict or raise_on_drift:
        report = materialize(report, "drift_report")
        _check(report, psi_threshold, ks_threshold, strict, raise_on_drift)
    return report


def _exceeds(column: str, threshold: float) -> Column:
    """NaN counts as not exceeding (Spark orders NaN above every number)."""
    return (F.col(column) > threshold) & ~F.isnan(column)


def violations(report: DataFrame, psi_threshold: float = PSI_THRESHOLD,
               ks_threshold: float = KS_THRESHOLD) -> DataFrame:
    """Drifted features with the dominant score: PSI when it exceeds its threshold, else KS.

    The columns before ``feature`` are the report's groups; they are kept.
    """
    by_psi = _exceeds("psi", psi_threshold)
    keys = report.columns[:report.columns.index("feature") + 1]
    return report.where("is_drifted").select(
        *keys,
        F.when(by_psi, F.lit("psi")).otherwise(F.lit("ks_statistic")).alias("measure"),
        F.when(by_psi, F.col("psi")).otherwise(F.col("ks_statistic")).alias("score"),
        F.when(by_psi, F.lit(psi_threshold)).otherwise(F.lit(ks_threshold)).alias("threshold"),
    )


def _named(row, keys: Sequence[str]) -> str:
    """The feature, with its group if there is one."""
    groups = ", ".join(f"{k}={row[k]}" for k in keys[:-1])
    return f"{row['feature']} ({groups})" if groups else row["feature"]


def _check(report: DataFrame, psi_threshold: float, ks_threshold: float, strict: bool, raise_on_drift: bool) -> None:
    """Raise for the first empty side or drifted feature; reads one row of the report."""
    keys = report.columns[:report.columns.index("feature") + 1]
    if strict:
        empty = report.where("status <> 'ok'").orderBy(*keys).first()
        if empty is not None:
            side = "Reference" if empty["status"] == "empty_reference" else "Current"
            raise ValueError(f"{side} values of feature {_named(empty, keys)!r} are empty")
    if raise_on_drift:
        worst = violations(report, psi_threshold, ks_threshold).orderBy(*keys).first()
        if worst is not None:
            raise DriftThresholdExceeded(_named(worst, keys), worst["score"], worst["threshold"])


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, null share, mean, stddev, min, quartiles and max per column, in long form.

    One pass over ``df``: all measures come from the frequency table of every column, NULL
    included. Quartiles are exact, without a column's values in one task.
    """
    wide = df.select(*(F.col(c).cast("double").alias(c) for c in columns))
    long = wide.unpivot([], list(columns), "feature", "value").withColumn("value", F.nanvl("value", F.lit(None).cast("double")))
    counts = materialize(long.groupBy("feature", "value").agg(F.count("*").alias("n_ref")), "profile_counts")
    n, x = F.col("n_ref"), F.col("value")
    known = F.when(x.isNotNull(), n)
    non_null = F.coalesce(F.sum(known), F.lit(0))
    listed = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, columns))).alias("feature"))
    moments = counts.groupBy("feature").agg(
        non_null.alias("non_null"), (1 - non_null / F.sum(n)).alias("null_rate"), (F.sum(n * x) / F.sum(known)).alias("mean"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    # Squares of distances from the mean, so that large values lose no digits.
    centred = counts.where("value is not null").join(moments.select("feature", "mean", "non_null"), "feature").groupBy("feature").agg(
        F.sqrt(F.sum(n * (x - F.col("mean")) * (x - F.col("mean"))) / F.nullif(F.max("non_null") - 1, F.lit(0))).alias("stddev"))
    values = counts.where("value is not null").withColumn("n_cur", F.lit(0).cast("bigint"))
    quartiles = discrete_quantiles(cumulative(values), (0.25, 0.5, 0.75))
    return (
        listed.join(moments, "feature", "left").join(centred, "feature", "left").join(quartiles, "feature", "left")
        .na.fill(0, ["non_null"])
        .select("feature", "non_null", "null_rate", "mean", "stddev", "min", "p25", "p50", "p75", "max")
    )
