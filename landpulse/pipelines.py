"""Pipelines by name: run(spark, parameters) reads what parameters name, writes results under parameters["output"] and returns catalogue items.

Inputs are Parquet tables and GeoJSON layers by path; layers may be given
inline as well. Each run writes its outputs first, then its manifest or
summary, then its items, so a run that failed half-way can be told from one
that ended, and periods that are there are skipped when it is started again.
"""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import breaks, composite, disturbance, recovery, sen, spatial
from .params import Breaks, Composite, Disturbance, Trend, need
from .sources import geotiff, manifest, rasters, sinks, styles, vectors

Run = Callable[[SparkSession, Mapping[str, Any]], DataFrame]
PIPELINES: dict[str, Run] = {}


def pipeline(f: Run) -> Run:
    PIPELINES[f.__name__] = f
    return f


def run(spark: SparkSession, parameters: Mapping[str, Any]) -> DataFrame:
    """The items (id, datetime, bbox, asset, style) of the pipeline that parameters["algorithm"] names."""
    name = parameters.get("algorithm")
    need(name in PIPELINES, f"algorithm must be one of {sorted(PIPELINES)}")
    need(bool(parameters.get("output")), "an output folder is needed")
    found = PIPELINES[name](spark, parameters)
    sinks.items(found, f"{parameters['output']}/items")
    return found


def settings(kind: type, parameters: Mapping[str, Any]):
    """kind with those of its fields that parameters give; lists become tuples."""
    names = {f.name for f in dataclasses.fields(kind)}
    return kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in parameters.items() if k in names})


def table(spark: SparkSession, parameters: Mapping[str, Any], name: str) -> DataFrame:
    """The Parquet table, or the GeoTIFF files, that the parameter names."""
    need(bool(parameters.get(name)), f"{name} is needed")
    return geotiff.read(spark, parameters[name]) if parameters[name].endswith(".tif") else spark.read.parquet(parameters[name])


def layer(spark: SparkSession, parameters: Mapping[str, Any], name: str, attributes: str) -> DataFrame | None:
    """Zones from the inline layer of that name, else from the file in <name>_file, else None."""
    found = vectors.payload(parameters, name, f"{name}_file")
    if found is None:
        return None
    return vectors.parsed(spark.createDataFrame([(json.dumps(found),)], "value string"), attributes)


def items(spark: SparkSession, rows: list[tuple], box: tuple[float, float, float, float] | None) -> DataFrame:
    """rows: (id, label, asset, and a style if there is one)."""
    df = spark.createDataFrame([(*r, None)[:4] for r in rows], "id string, label string, asset string, style string")
    day = F.coalesce(F.expr("cast(try_to_timestamp(label) as date)"), F.current_date())
    return df.select("id", F.date_format(day, "yyyy-MM-dd'T'00:00:00'Z'").alias("datetime"), F.lit(list(box or (0.0, 0.0, 0.0, 0.0))).cast("array<double>").alias("bbox"), "asset", "style")


def box_of(zones: DataFrame | None) -> tuple[float, float, float, float] | None:
    if zones is None:
        return None
    found = spatial.bbox(zones, zones.columns[0]).agg(F.min("min_x"), F.min("min_y"), F.max("max_x"), F.max("max_y")).first()
    return None if found[0] is None else tuple(found)


@pipeline
def bap(spark: SparkSession, parameters: Mapping[str, Any]) -> DataFrame:
    """scenes: a table (t, y, x, SCL, bands, cloud_cover); area: zones to stay in. Periods that are there aren't built again, but are in the manifest."""
    wish = settings(Composite, parameters).for_profile().check()
    area, path = layer(spark, parameters, "area", "zone_id int"), f"{parameters['output']}/composites"
    if area is not None:
        area = area.withColumn("zone_id", F.monotonically_increasing_id())
    rows = []
    for pos, p in enumerate(wish.periods()):
        name = wish.output_name(p["label"])
        rows.append((pos, p["label"], name, name, p["label"], p["time_label"], [p["start"], p["end"]], wish.profile, wish.mode, wish.payload, wish.bands(), list(wish.indices), wish.resolution))
    schema = "pos int, period string, file string, path string, period_label string, time_label string, temporal_extent array<string>, export_profile string, compositing_mode string, export_payload string, reflectance_bands array<string>, indices array<string>, spatial_resolution int"
    weights = F.struct(*(F.lit(float(w)).alias(n) for n, w in zip(("distance_to_cloud", "date", "coverage"), wish.weights, strict=True))).alias("score_weights")
    entries = spark.createDataFrame(rows, schema).select("*", weights)
    known = sinks.resume(entries, spark, path) if wish.resume else entries.withColumn("done", F.lit(False))
    todo = [r[0] for r in known.where("not done").select("period").collect()]
    if todo:
        sinks.periods(composite.bap(table(spark, parameters, "scenes"), wish, area).where(F.col("period").isin(todo)), path)
    sinks.manifest(entries.drop("period"), wish, f"{parameters['output']}/manifest")
    return items(spark, [(r[1], r[5], f"{path}/period={r[1]}") for r in rows], box_of(area))


@pipeline
def seasonal_sen(spark: SparkSession, parameters: Mapping[str, Any]) -> DataFrame:
    """pixels: a table (name, band, y, x, v) of monthly rasters; manifest: what they are; sites: zones (zone_id), each with a trend of its own pixels."""
    wish = settings(Trend, parameters).check()
    sites = layer(spark, parameters, "sites", "zone_id string")
    need(sites is not None, "sites are needed")
    pixels = table(spark, parameters, "pixels")
    entries = manifest.select(manifest.read(spark, parameters["manifest"]), payloads=("indices", "both"))
    stack = rasters.monthly_stack(pixels, manifest.monthly(entries, wish.index, pixels.select("name").distinct()), parameters.get("nodata"))
    found = sen.infer_period(stack, "t", wish.period).first()
    own = spatial.clip(stack, sites, all_touched=wish.all_touched)
    trend = sen.seasonal_sen(sen.positions(own, ["zone_id", "y", "x"], "t"), found.period, ["zone_id", "y", "x"])
    reference = sen.reference_value(stack, "t", "v", found.period, wish.years_before, parameters.get("restored"), wish.baseline_year).first()
    restored = F.lit(parameters.get("restored")).cast("int")
    out = sen.metrics(trend, F.lit(wish.end_year or found.last_year), restored, F.lit(wish.start_year or found.first_year), F.lit(reference.value), wish.target_fraction)
    names = {"slope_intercept": ["slope", "intercept"], "deltair": ["delta_ir"]}
    wanted = list(dict.fromkeys(c for m in wish.metrics for c in names.get(m, [m])))
    path = f"{parameters['output']}/metrics"
    sinks.metrics(out.select(F.col("zone_id").alias("site"), "y", "x", *wanted), path, wanted)
    counts = own.groupBy("zone_id").agg(F.count(F.lit(1)).alias("n"))
    status = sites.select("zone_id").join(counts, "zone_id", "left").select("zone_id", F.when(F.col("n") > 0, "ok").otherwise("failed").alias("status"), F.when(F.col("n") > 0, "").otherwise("no pixels").alias("reason"), F.lit(reference.source).alias("reference"))
    sinks.summary(status, f"{parameters['output']}/summary")
    return items(spark, [(m, str(found.last_year), f"{path}/metric={m}", styles.trend(m)) for m in wanted], box_of(sites))


@pipeline
def breaks_detection(spark: SparkSession, parameters: Mapping[str, Any]) -> DataFrame:
    """pixels: a table (name, y, x, v) of yearly rasters; manifest says which year each is, or else its name. grid: the fields of a geotiff.Grid, for rasters of year and magnitude beside the table."""
    wish = settings(Breaks, parameters)
    pixels = table(spark, parameters, "pixels")
    files = pixels.select("name").distinct()
    years = manifest.yearly(manifest.read(spark, parameters["manifest"]), files) if parameters.get("manifest") else manifest.yearly_files(files)
    found = breaks.detect(rasters.yearly_stack(pixels, years, wish.nodata), ["y", "x"], threshold=wish.threshold, scale=wish.scale)
    path = f"{parameters['output']}/breaks"
    sinks.breaks(found, path, wish.nodata)
    span = rasters.minmax(found, "change_magnitude").first()
    rows = [("breaks", "", path, styles.grey(span.low, span.high, band=2))]
    for name, column in (("year", "change_year"), ("magnitude", "change_magnitude")) if parameters.get("grid") else ():
        rows.append((name, "", f"{parameters['output']}/{name}.tif"))
        geotiff.write(found.select("y", "x", F.col(column).alias("v")), rows[-1][2], geotiff.Grid(**parameters["grid"]), nodata=wish.nodata)
    return items(spark, rows, None)


@pipeline
def spectral_recovery(spark: SparkSession, parameters: Mapping[str, Any]) -> DataFrame:
    """series: a table (basin, y, x, year, v); reference: one of (index, year, v) for the target, or target_file: a written one; basins: a table whose columns target, restored and disturbed, if there, are each basin's own."""
    basins = table(spark, parameters, "basins")
    ok = recovery.check_basins(basins, "basin").first().ok
    need(ok, "basin ids must be there, and each once")
    if parameters.get("target_file"):
        targets = rasters.target(spark, parameters["target_file"])
    else:
        targets = recovery.reference_target(table(spark, parameters, "reference"), parameters["reference_start"], parameters["reference_end"])
        sinks.target(targets, f"{parameters['output']}/target")
    index = parameters.get("index", "NBR")
    known = targets.where(F.col("index") == index).first()
    own = lambda name, value: name if name in basins.columns else value
    need(known is not None or "target" in basins.columns, f"no target for {index}")
    found, status = recovery.by_basin(
        table(spark, parameters, "series"), basins, "basin", ["y", "x"], own("target", known and known.target), own("restored", parameters.get("restored")), own("disturbed", parameters.get("disturbed")), parameters.get("metric_timestep", 5)
    )
    names, path = ["deltaIR", "YrYr", "R80P", "RRI", "Y2R"], f"{parameters['output']}/metrics"
    sinks.metrics(found.withColumn("Y2R", F.col("Y2R").cast("double")).withColumnRenamed("basin", "site"), path, names)
    sinks.summary(status, f"{parameters['output']}/summary")
    recovery.raise_failed(status, "basin")
    ends = found.agg(*(f(n).cast("double").alias(f"{k}_{n}") for n in names for k, f in (("low", F.min), ("high", F.max)))).first()
    return items(spark, [(n, "", f"{path}/metric={n}", styles.recovered(n, ends[f"low_{n}"], ends[f"high_{n}"])) for n in names], None)


@pipeline
def disturbance_index(spark: SparkSession, parameters: Mapping[str, Any]) -> DataFrame:
    """breaks (y, x, year, magnitude) and built (y, x, v): tables; zones and fires: layers; height, width and pixel_area: of the grid."""
    wish = settings(Disturbance, parameters).check()
    zones = layer(spark, parameters, "zones", "zone_id string")
    need(zones is not None and bool(parameters.get("fires_file")), "zones and fires are needed")
    fires = spatial.check_points(vectors.points(spark, parameters["fires_file"]))
    out = disturbance.flow(zones, table(spark, parameters, "breaks"), fires, table(spark, parameters, "built"), wish, parameters["height"], parameters["width"], parameters["pixel_area"])
    path = f"{parameters['output']}/zones"
    sinks.collection(out, path)
    return items(spark, [("disturbance_index", "", path)], box_of(zones))
