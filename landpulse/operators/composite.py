"""Best-available-pixel composites, and growing-season medians."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import indices, scalars
from ..params import CLOUD_CLASSES, Composite
from . import neighborhood, spatial


def in_period(t: Column, start: str, end: str, end_inclusive: bool = False) -> Column:
    """Half-open by default: the end day isn't in."""
    last = F.lit(end).cast("date")
    return (t >= F.lit(start).cast("date")) & (t < (F.date_add(last, 1) if end_inclusive else last))


def coverage(df: DataFrame, cloud: str, out: str, groups: Iterable[str] = ("t",)) -> DataFrame:
    """The mean of 1 - cloud over all pixels of a date; a missing date is one too. Means are summed up before the shuffle and joined back by date, so a date's pixels never meet in one task."""
    groups = list(groups)
    means = df.groupBy(*(F.col(g).alias(f"_of_{g}") for g in groups)).agg(F.avg(1 - F.col(cloud).cast("double")).alias(out))
    same = [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in groups]
    return df.join(means, same).drop(*(f"_of_{g}" for g in groups))


def best_of_month(df: DataFrame, score: str, pixel: Iterable[str] = ("y", "x"), t: str = "t") -> DataFrame:
    """The rows with the greatest score of their pixel and calendar month, all of equals; null scores are never chosen."""
    w = Window.partitionBy(*pixel, F.trunc(t, "month"))
    return df.where(F.col(score).isNotNull()).withColumn("_best", F.max(score).over(w)).where(F.col(score) == F.col("_best")).drop("_best")


def scored(scenes: DataFrame, run: Composite) -> DataFrame:
    """scenes (t, y, x, SCL, bands) with cloud, valid, the three scores and score (null where not valid)."""
    base = scenes.withColumn("SCL", F.coalesce("SCL", F.lit(0))).withColumn("cloud", scalars.is_cloud(F.col("SCL"), CLOUD_CLASSES))
    out = neighborhood.dilate(base, "cloud", run.buffer_px, ["t"])
    out = neighborhood.distance_score(out, "cloud", "dtc", run.max_distance, run.resolution, ["t"])
    out = coverage(out, "cloud", "coverage").withColumn("date", scalars.date_score(F.col("t")))
    out = out.withColumn("valid", ~(F.col("cloud") | scalars.is_excluded(F.col("SCL"), run.excluded)))
    return out.withColumn("score", F.when(F.col("valid"), scalars.weighted([F.col("dtc"), F.col("date"), F.col("coverage")], run.weights)))


def inside(scenes: DataFrame, aoi: DataFrame, all_touched: bool = False) -> DataFrame:
    """The rows of scenes whose pixels lie in any zone of aoi (zone_id, rings, in cells of the grid): the zones dissolved.

    The zones' common box, one row, reaches the scan as a filter. Pixels are
    tested once each, whatever their number of dates.
    """
    box = spatial.bbox(aoi).agg(F.min("min_x"), F.min("min_y"), F.max("max_x"), F.max("max_y")).first()
    if box[0] is None:
        return scenes.limit(0)
    near = scenes.where(F.col("x").between(math.floor(box[0]), math.ceil(box[2])) & F.col("y").between(math.floor(box[1]), math.ceil(box[3])))
    pixels = near.select("y", "x").distinct()
    return near.join(spatial.clip(pixels, aoi, all_touched=all_touched).select("y", "x").distinct(), ["y", "x"], "left_semi")


def bap(scenes: DataFrame, run: Composite, aoi: DataFrame | None = None) -> DataFrame:
    """(period, time_label, y, x, payload): for each period the median of the months' best pixels.

    All periods run as one job: each scene row goes to the periods that it
    lies in. Filters on time, cloud cover and area come first, and reach the
    scan. With aoi, only its pixels are looked at, so scores depend on it too,
    and the result is clipped to it.
    """
    run = run.check()
    bands = run.bands()
    if "cloud_cover" in scenes.columns:
        scenes = scenes.where(F.col("cloud_cover") <= run.max_cloud_cover)
    periods = run.periods()
    of_period = [in_period(F.col("t"), p["start"], p["end"], run.end_inclusive) for p in periods]
    any_of = of_period[0]
    for c in of_period[1:]:
        any_of = any_of | c
    labels = F.array_compact(F.array(*(F.when(c, F.struct(F.lit(p["label"]).alias("period"), F.lit(p["time_label"]).alias("time_label"))) for c, p in zip(of_period, periods, strict=True))))
    scenes = scenes.where(any_of)
    if aoi is not None:
        scenes = inside(scenes, aoi)
    rows = scored(scenes.select("t", "y", "x", "SCL", *bands), run).withColumn("p", F.explode(labels)).select("*", "p.*").drop("p")
    best = best_of_month(rows, "score", ("period", "y", "x"))
    medians = best.groupBy("period", "time_label", "y", "x").agg(*(F.median(b).alias(b) for b in bands))
    return indices.payload(medians, run.payload, run.indices, bands, ("period", "time_label", "y", "x"), savi_l=run.savi_l, coefficients=run.tcw)


def season_medians(scenes: DataFrame, months: Iterable[int], soil: float = 0.5, classes: Iterable[int] = CLOUD_CLASSES, pixel: Iterable[str] = ("y", "x"), **offset) -> DataFrame:
    """(pixel, year, savi): raw bands to reflectance (offset: as of scalars.baseline_offset), clouds out, the median index of the months of each year."""
    clean = {b: scalars.baseline_offset(scalars.positive(F.col(b)), F.col("t"), **offset) for b in ("B04", "B08")}
    clear = ~F.coalesce(F.col("SCL"), F.lit(0)).isin(*classes)
    value = F.when(clear, indices.savi(clean["B08"], clean["B04"], soil))
    rows = scenes.where(F.month("t").isin(*months)).select(*pixel, F.year("t").alias("year"), value.alias("savi"))
    return rows.groupBy(*pixel, "year").agg(F.median("savi").alias("savi"))
