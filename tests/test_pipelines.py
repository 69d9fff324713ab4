"""Pipelines by name, from files to items."""

import json
import random

import pytest
from pyspark.sql import functions as F

from landpulse import pipelines
from landpulse.operators import composite, recovery
from landpulse.params import Composite
from landpulse.sources import geotiff, manifest, rasters, sinks, styles, vectors


def square(x0, y0, x1, y1, **properties):
    return {"type": "Feature", "properties": properties, "geometry": {"type": "Polygon", "coordinates": [[[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]]}}


def layer(*features):
    return {"type": "FeatureCollection", "features": list(features)}


def test_bap_in_an_area_and_resumed(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"2020-0{m}-{d:02d}", y, x, 9 if rng.random() < 0.1 else 4, rng.uniform(100, 900)) for m in (4, 5) for d in (3, 14) for y in range(6) for x in range(6)]
    df = spark.createDataFrame(rows, "d string, y int, x int, SCL int, B08 double").select(F.to_timestamp("d").alias("t"), "y", "x", "SCL", "B08", (F.col("B08") / 2).alias("B12"))
    df.write.parquet(f"{tmp_path}/scenes")
    wish = {"algorithm": "bap", "scenes": f"{tmp_path}/scenes", "output": f"{tmp_path}/out", "mode": "monthly", "years": [2020], "months": [4], "indices": ["NBR"], "buffer_px": 0, "area": layer(square(0.6, 0.6, 3.9, 2.9), square(3.2, 2.1, 4.9, 4.9))}
    items = pipelines.run(spark, wish).collect()
    assert [(r.id, r.datetime) for r in items] == [("2020_04", "2020-04-01T00:00:00Z")] and items[0].bbox == [0.6, 0.6, 4.9, 4.9]
    out = spark.read.parquet(f"{tmp_path}/out/composites")
    inside = {(y, x) for y in range(6) for x in range(6) if (0.6 < x + 0.5 < 3.9 and 0.6 < y + 0.5 < 2.9) or (3.2 < x + 0.5 < 4.9 and 2.1 < y + 0.5 < 4.9)}
    assert {(r.y, r.x) for r in out.collect()} <= inside and out.count() > 0
    # Scores depend on the area alone: what lies outside may as well not be there.
    alone = [(*r[:5],) for r in rows if (r[1], r[2]) in inside]
    small = spark.createDataFrame(alone, "d string, y int, x int, SCL int, B08 double").select(F.to_timestamp("d").alias("t"), "y", "x", "SCL", "B08", (F.col("B08") / 2).alias("B12"))
    run = Composite(mode="monthly", years=(2020,), months=(4,), indices=("NBR",), buffer_px=0)
    assert sorted((r.y, r.x, r.NBR) for r in composite.bap(small, run).collect()) == sorted((r.y, r.x, r.NBR) for r in out.collect())
    # Another month: the first isn't built again, and stays in the manifest.
    again = pipelines.run(spark, wish | {"months": [4, 5], "scenes": f"{tmp_path}/scenes"})
    assert again.count() == 2 and {r.period for r in spark.read.parquet(f"{tmp_path}/out/composites").select("period").distinct().collect()} == {"2020_04", "2020_05"}
    entries = manifest.read(spark, f"{tmp_path}/out/manifest")
    assert [r.period_label for r in entries.orderBy("pos").collect()] == ["2020_04", "2020_05"]
    assert composite.inside(df, spark.createDataFrame([], "zone_id int, rings array<array<struct<x:double,y:double>>>")).count() == 0


def test_coverage_of_rows_without_a_date(spark):
    df = spark.createDataFrame([("a", None, True), ("b", None, False), ("c", "2020-01-01", True)], "id string, t string, cloud boolean")
    assert {r.id: r.coverage for r in composite.coverage(df, "cloud", "coverage").collect()} == {"a": 0.5, "b": 0.5, "c": 0.0}


def test_seasonal_sen(spark, tmp_path):
    months = [(y, m) for y in (2018, 2019, 2020) for m in (4, 5)]
    pixels = [(f"{y}_{m}.tif", b, r, c, 0.1 * (y - 2018) + m + b) for y, m in months for b in (1, 2) for r in range(3) for c in range(3)]
    spark.createDataFrame(pixels, "name string, band long, y int, x int, v double").write.parquet(f"{tmp_path}/px")
    entries = [(i, f"{y}_{m}.tif", f"/out/{y}_{m}.tif", f"{y}_{m}", f"{y}-{m:02d}-01", "indices", ["NBR", "SAVI"]) for i, (y, m) in enumerate(months)]
    df = spark.createDataFrame(entries, "pos int, file string, path string, period_label string, time_label string, export_payload string, indices array<string>")
    sinks.manifest(df, Composite(), f"{tmp_path}/manifest")
    wish = {"algorithm": "seasonal_sen", "pixels": f"{tmp_path}/px", "manifest": f"{tmp_path}/manifest", "output": f"{tmp_path}/out", "metrics": ["DeltaIR"], "sites": layer(square(0, 0, 1, 1, zone_id="a"), square(7, 7, 9, 9, zone_id="far"))}
    items = pipelines.run(spark, wish).collect()
    assert [r.id for r in items] == ["delta_ir"] and json.loads(items[0].style) == json.loads(styles.diverging(0.5))
    got = spark.read.parquet(f"{tmp_path}/out/metrics").collect()
    assert [(r.site, r.metric, r.y, r.x, round(r.value, 5)) for r in got] == [("a", "delta_ir", 0, 0, 0.3)]
    status = {r.zone_id: (r.status, r.reason) for r in spark.read.json(f"{tmp_path}/out/summary/json").collect()}
    assert status == {"a": ("ok", ""), "far": ("failed", "no pixels")}
    touched = pipelines.run(spark, wish | {"all_touched": True, "sites": layer(square(0.2, 0.2, 1.3, 0.9, zone_id="a"))})
    assert touched.count() == 1 and spark.read.parquet(f"{tmp_path}/out/metrics").count() == 2
    with pytest.raises(ValueError, match="no raster"):
        rasters.monthly_stack(spark.read.parquet(f"{tmp_path}/px"), manifest.monthly(manifest.of(spark.createDataFrame([], manifest.MANIFEST)), "SAVI"))


def test_breaks(spark, tmp_path):
    rows = [(f"{y}.tif", 0, x, (900.0 if y < 2006 else 400.0 + x) / 1000) for y in range(2000, 2012) for x in range(2)]
    spark.createDataFrame(rows, "name string, y int, x int, v double").write.parquet(f"{tmp_path}/px")
    pipelines.run(spark, {"algorithm": "breaks_detection", "pixels": f"{tmp_path}/px", "output": f"{tmp_path}/out", "threshold": 25.0})
    assert sorted((r.x, r.year, round(r.magnitude, 6)) for r in spark.read.parquet(f"{tmp_path}/out/breaks").collect()) == [(0, 2006.0, -500.0), (1, 2006.0, -499.0)]
    # The same from GeoTIFF files, and to them.
    for y in range(2000, 2012):
        geotiff.write(spark.createDataFrame([(r[1], r[2], r[3]) for r in rows if r[0] == f"{y}.tif"], "y int, x int, v double"), f"file://{tmp_path}/tif/{y}.tif", geotiff.Grid(1, 2), "float64")
    pipelines.run(spark, {"algorithm": "breaks_detection", "pixels": f"{tmp_path}/tif/*.tif", "output": f"file://{tmp_path}/out2", "threshold": 25.0, "grid": {"height": 1, "width": 2}})
    assert sorted((r.x, r.v) for r in geotiff.read(spark, f"{tmp_path}/out2/year.tif").collect()) == [(0, 2006.0), (1, 2006.0)]
    with pytest.raises(ValueError, match="no raster"):
        rasters.yearly_stack(spark.read.parquet(f"{tmp_path}/px"), spark.createDataFrame([], "year int, name string"))


def test_spectral_recovery(spark, tmp_path):
    v = {2000: 10.0, 2001: 4.0, 2002: 5.0, 2003: 9.0, 2004: 8.0}
    series = [(b, 0, 0, y + shift, x) for b, shift in (("a", 0), ("b", 10)) for y, x in v.items()]
    spark.createDataFrame(series, "basin string, y int, x int, year int, v double").write.parquet(f"{tmp_path}/series")
    spark.createDataFrame([("a", 10.0, 2001, 2000), ("b", 5.0, 2011, 2010)], "basin string, target double, restored int, disturbed int").write.parquet(f"{tmp_path}/basins")
    spark.createDataFrame([("NBR", 2001, 7.0)], "index string, year int, v double").write.parquet(f"{tmp_path}/reference")
    wish = {"algorithm": "spectral_recovery", "series": f"{tmp_path}/series", "basins": f"{tmp_path}/basins", "reference": f"{tmp_path}/reference", "reference_start": 2000, "reference_end": 2003, "output": f"{tmp_path}/out", "metric_timestep": 3}
    assert pipelines.run(spark, wish).count() == 5
    got = {(r.site, r.metric): r.value for r in spark.read.parquet(f"{tmp_path}/out/metrics").collect()}
    assert got["a", "deltaIR"] == got["b", "deltaIR"] == 4.0 and (got["a", "R80P"], got["b", "R80P"]) == (1.0, 2.0) and (got["a", "Y2R"], got["b", "Y2R"]) == (2.0, 0.0)
    assert rasters.target(spark, f"{tmp_path}/out/target").first().target == 7.0
    with pytest.raises(ValueError):
        pipelines.run(spark, {"algorithm": "nothing", "output": "x"})
    found, _ = recovery.by_basin(spark.read.parquet(f"{tmp_path}/series"), spark.read.parquet(f"{tmp_path}/basins"), "basin", [], 10.0, "restored", "disturbed", 3)
    assert {r.basin: r.R80P for r in found.collect()} == {"a": 1.0, "b": 1.0}


def test_disturbance(spark, tmp_path):
    cells = [(y, x, 2010.0 if x < 6 else None, -300.0, float(x)) for y in range(8) for x in range(12)]
    df = spark.createDataFrame(cells, "y int, x int, year double, magnitude double, v double")
    df.write.parquet(f"{tmp_path}/cells")
    (tmp_path / "fires.json").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Point", "coordinates": c}} for c in ([1.5, 1.5], [8.5, 3.5])]}))
    wish = {"algorithm": "disturbance_index", "breaks": f"{tmp_path}/cells", "built": f"{tmp_path}/cells", "fires_file": f"{tmp_path}/fires.json", "zones": layer(square(0, 0, 6, 8, zone_id="w"), square(6, 0, 12, 8, zone_id="e")), "output": f"{tmp_path}/out", "height": 8, "width": 12, "pixel_area": 100.0, "mmu": 100.0, "filter_size": 3}
    pipelines.run(spark, wish)
    # What is written is a layer that can be read again.
    back = {r.zone_id: r for r in vectors.zones(spark, f"{tmp_path}/out/zones", "zone_id string, disturbance_count double, fire_count double, built_sum double, disturbance_index double").collect()}
    assert (back["w"].disturbance_count, back["e"].disturbance_count, back["e"].fire_count, back["w"].built_sum) == (48.0, 0.0, 1.0, 8.0 * 15)
    assert len(back["w"].rings[0]) == 5 and back["w"].disturbance_index > 0
    assert vectors.relabelled("EPSG:1", "EPSG:2") == "EPSG:2" and vectors.relabelled("EPSG:1", None) == "EPSG:1"


def test_item_datetime(spark):
    from landpulse.functions import scalars

    df = spark.createDataFrame([("2019", "x"), ("2019-03-04", "x"), ("m", "/out/2017_04.tif"), ("m", "20170.tif"), (None, None)], "label string, file string")
    got = [str(r[0]) for r in df.select(scalars.item_datetime(F.col("label"), F.col("file"), F.lit("2024-01-02"))).collect()]
    assert got == ["2019-07-01", "2019-03-04", "2017-07-01", "2024-01-02", "2024-01-02"]


def test_styles():
    red, green, blue, seen = json.loads(styles.trend("r80p"))["color"][1:]
    assert red[3:] == [-1.5, 215, -0.75, 253, 0, 255, 0.75, 166, 1.5, 26] and green[3:5] == [-1.5, 25] and blue[-2:] == [1.5, 65] and seen[0] == "case"
    assert json.loads(styles.trend("slope"))["color"][1][3:] == [-1, 0, 1, 255]
    assert json.loads(styles.grey(-3.0, 2.0, 2)) == {"color": ["interpolate", ["linear"], ["band", 2], -3.0, [255, 255, 255, 1], 2.0, [0, 0, 0, 1]]}
    assert json.loads(styles.recovered("Y2R", 1.0, 9.0))["color"][3] == -0.6 and json.loads(styles.recovered("R80P", 1.0, 9.0))["color"][-2:] == [0, [52, 52, 52, 0]]
    assert len(json.loads(styles.recovered("RRI", 1.0, 9.0))["color"]) == 7
