"""Rasters as tables of pixels."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import need
from ..schema import to_null


def collection(spark: SparkSession, path: str, bands: Iterable[str], start: str, end: str, box: tuple[int, int, int, int] | None = None, max_cloud_cover: float | None = None) -> DataFrame:
    """(t, y, x, bands) of a scene table; time, box, cloud cover and columns are pruned in the scan."""
    rows = spark.read.parquet(path).where((F.col("t") >= F.lit(start).cast("timestamp")) & (F.col("t") < F.lit(end).cast("timestamp")))
    if box:
        rows = rows.where(F.col("x").between(box[0], box[2]) & F.col("y").between(box[1], box[3]))
    if max_cloud_cover is not None:
        rows = rows.where(F.col("cloud_cover") <= max_cloud_cover)
    return rows.select("t", "y", "x", *bands)


def single_band(df: DataFrame, value: str = "v") -> DataFrame:
    """df as (y, x, value); anything else is an error."""
    if not {"y", "x", value} <= set(df.columns):
        raise TypeError(f"a single-band raster needs y, x and {value}; it has {df.columns}")
    return df.select("y", "x", value)


def yearly_stack(pixels: DataFrame, files: DataFrame, nodata: float | None = None) -> DataFrame:
    """(year, y, x, v) of pixels (name, y, x, v) in the files (year, name), with nodata as null, series by series in one partition."""
    count = files.count()
    need(count > 0, "no raster of any year was found")
    rows = pixels.join(F.broadcast(files) if count < 10_000 else files, "name")
    return rows.select("year", "y", "x", to_null(F.col("v").cast("double"), nodata).alias("v")).repartition("y", "x")


def monthly_stack(pixels: DataFrame, found: DataFrame, nodata: float | None = None) -> DataFrame:
    """(t, y, x, v) of pixels (name, band, y, x, v): of each file the band that found (t, name, band; see manifest.monthly) says, with nodata as null. Nothing found is an error."""
    need(not found.isEmpty(), "the manifest names no raster that is there")
    rows = pixels.join(found.select("t", "name", "band"), ["name", "band"])
    return rows.select("t", "y", "x", to_null(F.col("v").cast("double"), nodata).alias("v"))


def target(spark: SparkSession, path: str) -> DataFrame:
    """A written reference target: (index, target). Pickled objects are never read."""
    need(not path.endswith((".pkl", ".pickle")), "pickled targets aren't read")
    read = spark.read.json if path.endswith(".json") else spark.read.parquet
    out = read(path)
    need({"index", "target"} <= set(out.columns), "this file holds no target")
    return out.select("index", F.col("target").cast("double").alias("target"))


def minmax(pixels: DataFrame, value: str) -> DataFrame:
    """One row: low and high for display, null values left out; equal ones are a little apart, and none at all gives -1 and 1."""
    found = pixels.agg(F.min(value).cast("double").alias("a"), F.max(value).cast("double").alias("b"))
    return found.select(F.coalesce("a", F.lit(-1.0)).alias("low"), F.when(F.col("a").isNull(), 1.0).when(F.col("a") >= F.col("b"), F.col("a") + 1e-6).otherwise(F.col("b")).alias("high"))
