"""Coverage and medians of dates as scenes arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import is_cloud


def daily_coverage(scenes: DataFrame, delay: str = "2 days", t: str = "t") -> DataFrame:
    """(day, coverage, n): the mean of 1 - cloud by day; rows later than delay after the newest are dropped, as a watermark does."""
    clear = 1 - is_cloud(F.col("SCL")).cast("double")
    return scenes.withWatermark(t, delay).groupBy(F.window(t, "1 day").alias("w")).agg(F.avg(clear).alias("coverage"), F.count(F.lit(1)).alias("n")).select(F.col("w.start").cast("date").alias("day"), "coverage", "n")


def yearly_medians(scenes: DataFrame, value: str, delay: str = "40 days", t: str = "t", rows: int = 1000) -> DataFrame:
    """(y, x, year, median) by approximate percentile, whose state stays small however many dates a pixel has."""
    own = scenes.withWatermark(t, delay).withColumn("year", F.year(t))
    return own.groupBy("y", "x", "year").agg(F.percentile_approx(value, 0.5, rows).alias("median"))
