"""Recovery of restored sites against reference sites."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import guarded_ratio
from ..params import need, timestep

#: Share of the target that counts as recovered.
SHARE = 0.8


def reference_target(pixels: DataFrame, first: int, last: int, value: str = "v", index: str = "index", year: str = "year") -> DataFrame:
    """(index, target): for each index the median over all reference pixels and years of the window."""
    inside = pixels.where(F.col(year).between(first, last))
    return inside.groupBy(index).agg(F.median(value).alias("target"))


def recovery(series: DataFrame, keys: Iterable[str], target: Column | float, restored: Column | int, disturbed: Column | int, step: int = 5, value: str = "v", year: str = "year") -> DataFrame:
    """(keys, deltaIR, YrYr, R80P, RRI, Y2R) by one aggregation of series (keys, year, value).

    With r the restored year, d the disturbed one and k the step: deltaIR is
    the gain from r to r + k, YrYr that by year, R80P the value at r + k as a
    share of 0.8 of the target, RRI the gain to the better of r + k and
    r + k - 1 against the loss from d to r, Y2R the first number of years
    after r with 0.8 of the target, null if it isn't reached.
    """
    k = timestep(step)
    as_col = lambda c: c if isinstance(c, Column) else F.lit(c)
    r, d, goal = as_col(restored), as_col(disturbed), as_col(target) * SHARE
    v, y = F.col(value), F.col(year)
    at = lambda when: F.max(F.when(y == when, v))
    found = series.groupBy(*keys).agg(
        at(r).alias("_r"),
        at(d).alias("_d"),
        at(r + k).alias("_k"),
        at(r + k - 1).alias("_j"),
        F.max(goal).alias("_goal"),
        F.min(F.when((y >= r) & (v >= goal), y - r)).alias("Y2R"),
    )
    gain = F.col("_k") - F.col("_r")
    return found.select(*keys, gain.alias("deltaIR"), (gain / k).alias("YrYr"), guarded_ratio(F.col("_k"), F.col("_goal")).alias("R80P"), guarded_ratio(F.greatest("_k", "_j") - F.col("_r"), F.col("_d") - F.col("_r")).alias("RRI"), "Y2R")


def check_basins(basins: DataFrame, column: str) -> DataFrame:
    """One row: rows, nulls, distinct ids and whether the ids are good: there are some, none is null and none repeats."""
    need(column in basins.columns, f"no such column: {column}")
    found = basins.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col(column).isNull(), 1)).alias("n_null"), F.count_distinct(column).alias("n_distinct"))
    return found.withColumn("ok", (F.col("n_rows") > 0) & (F.col("n_null") == 0) & (F.col("n_rows") == F.col("n_distinct")))


def by_basin(series: DataFrame, basins: DataFrame, basin: str, keys: Iterable[str], target: float | str, restored: int | str, disturbed: int | str, step: int, **options) -> tuple[DataFrame, DataFrame]:
    """(metrics, status): all basins in one job; a basin without a usable pixel is a row of status and not an error of the others.

    target, restored and disturbed are values for all basins, or names of
    basins' columns, so that each has its own. Basins must be unique.
    """
    keys, own = list(keys), {"_target": target, "_restored": restored, "_disturbed": disturbed}
    mine = {k: c for k, c in own.items() if isinstance(c, str)}
    if mine:
        series = series.join(basins.select(basin, *(F.col(c).alias(k) for k, c in mine.items())), basin)
    values = [F.col(k) if k in mine else F.lit(c) for k, c in own.items()]
    found = recovery(series, [basin, *keys], *values, step, **options)
    usable = found.groupBy(basin).agg(F.count(F.lit(1)).alias("n_pixels"), F.count("deltaIR").alias("n_usable"))
    status = basins.select(basin).join(usable, basin, "left").select(basin, F.coalesce("n_pixels", F.lit(0)).alias("n_pixels"), F.when(F.col("n_usable") > 0, "ok").otherwise("failed").alias("status"), F.when(F.col("n_pixels").isNull(), "no pixels").when(F.col("n_usable") == 0, "no value in the years needed").otherwise("").alias("reason"))
    return found, status


def raise_failed(status: DataFrame, basin: str, show: int = 20) -> None:
    """Raises if a basin failed; called after the summaries are written."""
    failed = status.where(F.col("status") != "ok")
    some = [r[0] for r in failed.select(basin).orderBy(basin).limit(show).collect()]
    if some:
        raise RuntimeError(f"basins failed, among them {some}")
