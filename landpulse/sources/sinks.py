"""What pipelines write: composites by period, metrics, manifests, layers, summaries and catalogue items."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import Composite
from ..schema import from_null


def periods(df: DataFrame, path: str, column: str = "period") -> None:
    """A folder for each period; those written again replace their own folder only."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def pending(wanted: DataFrame, spark: SparkSession, path: str, column: str = "period") -> DataFrame:
    """The wanted periods that path doesn't hold yet."""
    try:
        there = spark.read.parquet(path).select(column).distinct()
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        return wanted
    return wanted.join(there, column, "left_anti")


def metrics(df: DataFrame, path: str, names: list[str]) -> None:
    """Metrics of each site as 32-bit floats, by site and metric."""
    long = df.unpivot([c for c in df.columns if c not in names], names, "metric", "value").withColumn("value", F.col("value").cast("float"))
    long.write.mode("overwrite").partitionBy("site", "metric").parquet(path)


def breaks(df: DataFrame, path: str, nodata: float = -1e6) -> None:
    df.select("y", "x", from_null(F.col("change_year"), nodata).alias("year"), from_null(F.col("change_magnitude"), nodata).alias("magnitude")).write.mode("overwrite").parquet(path)


def manifest(entries: DataFrame, run: Composite, path: str) -> None:
    """One JSON document with its entries in order; an entry for each period, so one task writes it."""
    body = entries.agg(F.sort_array(F.collect_list(F.struct("pos", F.struct(*(c for c in entries.columns if c != "pos")).alias("e")))).alias("l")).select(
        F.lit("1.0").alias("schema_version"), F.lit(datetime.now(UTC).isoformat()).alias("generated_at"), F.lit(run.profile).alias("export_profile"), F.lit(run.mode).alias("compositing_mode"), F.lit(run.payload).alias("export_payload"), F.col("l.e").alias("entries")
    )
    body.coalesce(1).write.mode("overwrite").json(path)


def feature(zones: DataFrame) -> DataFrame:
    """(value): each zone as a GeoJSON feature; fields that are null are kept."""
    names = [c for c in zones.columns if c != "rings"]
    coordinates = F.array(F.transform("rings", lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"]))))
    return zones.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*names).alias("properties"), F.struct(F.lit("MultiPolygon").alias("type"), coordinates.alias("coordinates")).alias("geometry")), {"ignoreNullFields": "false"}).alias("value"))


def layer(zones: DataFrame, path: str) -> None:
    """One feature a line, in as many files as there are partitions."""
    feature(zones).write.mode("overwrite").text(path)


def collection(zones: DataFrame, path: str) -> None:
    """Zones as FeatureCollections, one in each file: what vectors.zones() reads, from all files of the folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line = lambda *x: pa.RecordBatch.from_arrays([pa.array(x, pa.string())], ["value"])
        yield line('{"type":"FeatureCollection","features":[')
        first = True
        for batch in batches:
            for value in batch.column(0).to_pylist():
                yield line(value if first else f",{value}")
                first = False
        yield line("]}")

    feature(zones).mapInArrow(run, "value string").write.mode("overwrite").text(path)


def resume(entries: DataFrame, spark: SparkSession, path: str, column: str = "period") -> DataFrame:
    """entries (column and the manifest's fields) with done: whether path holds rows of that period. Those to run are the ones not done; the manifest takes all."""
    todo = pending(entries.select(column).distinct(), spark, path, column)
    return entries.join(todo.withColumn("_todo", F.lit(True)), column, "left").withColumn("done", F.col("_todo").isNull()).drop("_todo")


def flat_reason(reason: Column) -> Column:
    """A reason that a CSV cell can hold."""
    return F.replace(F.replace(reason, F.lit("\n"), F.lit(" ")), F.lit(","), F.lit(";"))


def summary(rows: DataFrame, path: str) -> None:
    """A row for each site or basin, as CSV and JSON."""
    csv = rows.withColumn("reason", flat_reason(F.col("reason"))) if "reason" in rows.columns else rows
    csv.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    rows.coalesce(1).write.mode("overwrite").json(f"{path}/json")


def items(outputs: DataFrame, path: str) -> None:
    """Catalogue items: outputs has id, datetime, bbox (array), asset and any further properties."""
    fixed = {"id", "datetime", "bbox", "asset"}
    more = [c for c in outputs.columns if c not in fixed]
    box = F.col("bbox")
    ring = F.array(*(F.array(box[i], box[j]) for i, j in ((0, 1), (2, 1), (2, 3), (0, 3), (0, 1))))
    out = outputs.select(
        F.lit("Feature").alias("type"), F.lit("1.0.0").alias("stac_version"), "id", "bbox", F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"), F.struct("datetime", *more).alias("properties"), F.struct(F.struct(F.col("asset").alias("href")).alias("data")).alias("assets")
    )
    out.write.mode("overwrite").json(path)


def target(df: DataFrame, path: str) -> None:
    df.select("index", "target").write.mode("overwrite").parquet(path)
