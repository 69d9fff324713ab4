"""Seasonal Theil-Sen trends and what is measured from them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import guarded_ratio, span_years
from ..params import need


def positions(df: DataFrame, keys: list[str], t: str) -> DataFrame:
    """df with i, the place of its date among the series' dates from 0: seasons go by place, not by calendar."""
    return df.withColumn("i", F.row_number().over(Window.partitionBy(*keys).orderBy(t)) - 1)


def seasonal_sen(series: DataFrame, period: int, keys: Iterable[str], value: str = "v") -> DataFrame:
    """(keys, slope, intercept) of series (keys, i, value); i is the place in time.

    slope is the median of the slopes between cycles of one season, intercept
    the median value less the slope times the median place in cycles. A series
    without a value has both null, one without two cycles of a season too.

    A series' cycles of one season are gathered in an array, which holds one
    value a cycle; pairs are made from it in place, and no self-join is needed.
    """
    need(period >= 1, "period must be 1 or more")
    keys = list(keys)
    known = series.where(F.col(value).isNotNull())
    by_season = known.groupBy(*keys, (F.col("i") % period).alias("s")).agg(F.sort_array(F.collect_list(F.struct(F.floor(F.col("i") / period).alias("c"), F.col(value).alias("v")))).alias("a"))
    pairs = F.flatten(F.transform("a", lambda p, n: F.transform(F.filter("a", lambda q: q["c"] > p["c"]), lambda q: (q["v"] - p["v"]) / (q["c"] - p["c"]))))
    slopes = by_season.select(*keys, F.explode(pairs).alias("slope")).groupBy(*keys).agg(F.median("slope").alias("slope"))
    middles = known.groupBy(*keys).agg(F.median(value).alias("mv"), F.median("i").alias("mi"))
    every = series.select(*keys).distinct()
    out = every.join(middles, keys, "left").join(slopes, keys, "left")
    return out.select(*keys, "slope", (F.col("mv") - F.col("mi") / period * F.col("slope")).alias("intercept"))


def metrics(trend: DataFrame, end: Column, restored: Column, start: Column, reference: Column, fraction: float = 0.8) -> DataFrame:
    """trend with span, predicted, delta_ir, r80p and percent_change."""
    out = trend.withColumn("span", span_years(end, restored, start).cast("double"))
    out = out.withColumn("predicted", F.col("intercept") + F.col("slope") * F.col("span")).withColumn("delta_ir", F.col("slope") * F.col("span"))
    return out.withColumn("r80p", guarded_ratio(F.col("predicted"), reference * fraction)).withColumn("percent_change", guarded_ratio(F.col("delta_ir"), reference) * 100)


def infer_period(stack: DataFrame, t: str, configured: int | None = None) -> DataFrame:
    """One row: period, the configured one or the number of calendar months met (1 at least), and the first and last year."""
    if configured is not None:
        need(configured >= 1, "period must be 1 or more")
    months = F.lit(configured) if configured is not None else F.greatest(F.lit(1), F.count_distinct(F.month(t)))
    return stack.agg(months.cast("long").alias("period"), F.min(F.year(t)).alias("first_year"), F.max(F.year(t)).alias("last_year"))


def reference_value(stack: DataFrame, t: str, value: str, period: int, years_before: int = 3, restored: int | None = None, baseline: int | None = None) -> DataFrame:
    """One row: value and source, the median over a baseline year, the years before restoration, or the first dates; over all if that has no date.

    The window's dates are found first, so whether it is empty is decided by
    dates and not by missing values.
    """
    year = F.year(t)
    if baseline is not None:
        inside, source = year == baseline, f"reference_baseline_year_{baseline}"
    elif restored is not None:
        a, b = restored - years_before, restored - 1
        inside, source = year.between(a, b), f"restoration_relative_{a}_{b}"
    else:
        dates = stack.select(t).distinct().orderBy(t).limit(max(1, years_before * period))
        last = dates.agg(F.max(t).alias("_last"))
        stack = stack.crossJoin(F.broadcast(last))
        inside, source = F.col(t) <= F.col("_last"), "fallback_early_window"
    picked = stack.select(F.col(value).alias("_v"), F.coalesce(inside, F.lit(False)).alias("_in"))
    both = picked.agg(F.max("_in").alias("some"), F.median(F.when(F.col("_in"), F.col("_v"))).alias("own"), F.median("_v").alias("all"))
    return both.select(F.when(F.col("some"), F.col("own")).otherwise(F.col("all")).alias("value"), F.when(F.col("some"), F.lit(source)).otherwise(F.lit(f"{source}_fallback_full")).alias("source"))
