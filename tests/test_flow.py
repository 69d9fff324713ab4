"""Composites, trends, index, manifests, sinks and streams on small inputs."""

import itertools
import json
import math
import random
import statistics

import pytest
from golden_index import ROWS
from pyspark.sql import functions as F

from landpulse.operators import composite, disturbance, recovery, sen, spatial
from landpulse.params import Composite, Disturbance
from landpulse.sources import manifest, rasters, sinks, vectors
from landpulse.streaming import composites as stream

def test_golden_index(spark):
    df = spark.createDataFrame(ROWS, "id int, disturbance_count int, fire_count int, built_sum double, want double")
    out = disturbance.disturbance_index(df, ["disturbance_count", "fire_count", "built_sum"]).collect()
    assert len(out) == 27 and max(abs(r.want - r.disturbance_index) for r in out) < 1e-12


def test_index_is_checked(spark):
    df = spark.createDataFrame([(1, -1.0), (2, 1.0)], "id int, f double")
    with pytest.raises(Exception, match="negative"):
        disturbance.disturbance_index(df, ["f"], [1.0]).collect()
    for bad in ({"factors": ["g"], "weights": [1.0]}, {"factors": ["f"], "weights": [0.0]}, {"factors": ["f"], "weights": [1.0, 2.0]}, {"factors": ["f"], "weights": [1.0], "caps": [1.0, 2.0]}):
        with pytest.raises(ValueError):
            disturbance.disturbance_index(df, **bad)
    holes = spark.createDataFrame([(1, None), (2, 3.0), (3, 0.0)], "id int, f double")
    got = {r.id: r.disturbance_index for r in disturbance.disturbance_index(holes, ["f"], [1.0]).collect()}
    assert got[1] is None and got[2] == pytest.approx(1.0, abs=0.02) and got[3] == 0


def plain_sen(v, period):
    slopes = []
    for s in range(period):
        own = [(c, x) for c, x in enumerate(v[s::period]) if x is not None]
        slopes += [(b - a) / (j - i) for (i, a), (j, b) in itertools.combinations(own, 2)]
    known = [(i, x) for i, x in enumerate(v) if x is not None]
    if not slopes:
        return None, None
    slope = statistics.median(slopes)
    return slope, statistics.median(x for _, x in known) - statistics.median(i for i, _ in known) / period * slope


def test_sen(spark):
    rng = random.Random(1)
    series = {k: [None if rng.random() < 0.3 else rng.uniform(0, 1) + i * 0.01 for i in range(23)] for k in range(8)}
    series[8], series[9] = [None] * 23, [1.0] + [None] * 22
    df = spark.createDataFrame([(k, i, x) for k, v in series.items() for i, x in enumerate(v)], "k int, i int, v double")
    for r in sen.seasonal_sen(df, 5, ["k"]).collect():
        slope, icpt = plain_sen(series[r.k], 5)
        assert (r.slope is None) == (slope is None)
        if slope is not None:
            assert (r.slope, r.intercept) == (pytest.approx(slope), pytest.approx(icpt))
    with pytest.raises(ValueError):
        sen.seasonal_sen(df, 0, ["k"])


def plain_bap(px, run):
    """The composite of one period, by loops."""
    dates = sorted({t for t, _, _ in px})
    clouds = {d: {(y, x) for (t, y, x), (scl, _) in px.items() if t == d and (scl or 0) in (3, 8, 9, 10)} for d in dates}
    taps = [math.exp(-((i - 10) ** 2) / (2 * (21 / 6) ** 2)) for i in range(21)]
    taps = [t / sum(taps) for t in taps]
    best: dict = {}
    for d in dates:
        cells = [(y, x) for t, y, x in px if t == d]
        wide = {(y, x) for y, x in cells if any((y + a, x + b) in clouds[d] for a in range(-2, 3) for b in range(-2, 3))}
        cover = sum((y, x) not in wide for y, x in cells) / len(cells)
        for y, x in cells:
            scl, v = px[d, y, x]
            if (y, x) in wide or (scl or 0) in run.excluded:
                continue
            dtc = 1 - sum(taps[a + 10] * taps[b + 10] for a in range(-10, 11) for b in range(-10, 11) if (y + a, x + b) in wide)
            day = int(d[8:])
            score = (dtc + 0.8 * math.exp(-0.5 * ((day - 15) * 0.2) ** 2) * 0.07978845 + 0.5 * cover) / 2.3
            best.setdefault((y, x, d[:7]), []).append((score, v))
    out: dict = {}
    for (y, x, _), lot in best.items():
        top = max(s for s, _ in lot)
        out.setdefault((y, x), []).extend(v for s, v in lot if abs(s - top) < 1e-12)
    return {k: statistics.median(v) for k, v in out.items()}


def test_bap(spark):
    rng = random.Random(4)
    px = {(f"2020-0{m}-{d:02d}", y, x): (rng.choice([4, 4, 4, 4, 5, 5, 9, None, 7]) if rng.random() < 0.25 else 4, rng.uniform(100, 900)) for m in (4, 5) for d in (3, 14, 25) for y in range(9) for x in range(8)}
    rows = [(t, y, x, scl, v, v * 0.4) for (t, y, x), (scl, v) in px.items()] + [("2020-08-01", 0, 0, 4, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "d string, y int, x int, SCL int, B08 double, B04 double").withColumn("t", F.to_timestamp("d")).withColumn("B12", F.col("B08") / 2)
    run = Composite(years=(2020,), season_start="04-01", season_end="06-30", indices=("NBR",), payload="both", resolution=30)
    out = composite.bap(df, run).collect()
    got = {(r.y, r.x): r.B08 for r in out}
    want = plain_bap(px, run)
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)
    assert {r.period for r in out} == {"2020_0401_0630"} and all(r.NBR == pytest.approx(1 / 3) for r in out)
    empty = composite.bap(df, Composite(years=(2020,), season_start="11-01", season_end="02-01", indices=("NBR",)))
    assert empty.count() == 0  # a season over New Year is empty


def test_recovery(spark):
    v = {2000: 10.0, 2001: 4.0, 2002: 5.0, 2003: 9.0, 2004: 8.0}
    df = spark.createDataFrame([("a", y, x) for y, x in v.items()] + [("b", 2000, 1.0)], "k string, year int, v double")
    out = {r.k: r for r in recovery.recovery(df, ["k"], 10.0, 2001, 2000, 3).collect()}
    a = out["a"]
    assert (a.deltaIR, a.YrYr, a.R80P, a.RRI, a.Y2R) == (4.0, pytest.approx(4 / 3), 1.0, pytest.approx(5 / 6), 2)
    assert out["b"].deltaIR is None and out["b"].Y2R is None
    basins = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    _, status = recovery.by_basin(df, basins, "k", [], 10.0, 2001, 2000, 3)
    assert {(r.k, r.status) for r in status.collect()} == {("a", "ok"), ("b", "failed"), ("c", "failed")}
    with pytest.raises(RuntimeError):
        recovery.raise_failed(status, "k")
    assert not recovery.check_basins(df, "k").first().ok
    for bad in (0, True, 1.5):
        with pytest.raises(ValueError):
            recovery.recovery(df, ["k"], 1.0, 2001, 2000, bad)


def test_flow(spark):
    breaks = spark.createDataFrame([(y, x, 2010.0 if x < 6 else None, -300.0 if y < 6 else -10.0) for y in range(12) for x in range(12)], "y int, x int, year double, magnitude double")
    zones = spatial.rectangles(spark.range(2).select(F.col("id").alias("zone_id")), F.col("zone_id") * 6, F.lit(0), F.col("zone_id") * 6 + 6, F.lit(12))
    fires = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (8.0, 3.0)], "px double, py double")
    built = spark.createDataFrame([(3, 3, 5.0), (3, 9, 1.0)], "y int, x int, v double")
    out = {r.zone_id: r for r in disturbance.flow(zones, breaks, fires, built, Disturbance(mmu=300.0, filter_size=3), 12, 12, 100.0).collect()}
    assert (out[0].fire_count, out[1].fire_count, out[0].built_sum) == (2, 1, 5.0)
    assert out[0].disturbance_count > 25 and out[1].disturbance_count == 0 and out[0].disturbance_index > out[1].disturbance_index


def test_manifest(spark, tmp_path):
    entries = [
        {"file": "2020.tif", "path": "/o/2020.tif", "period_label": "2020_a", "time_label": "2020-04-01", "export_profile": "breaks", "export_payload": "both", "indices": ["NBR", "SAVI"], "reflectance_bands": ["B04"]},
        {"file": "2020b.tif", "path": None, "period_label": "2020_b", "time_label": None, "export_profile": "breaks", "export_payload": "indices", "indices": ["SAVI"]},
        {"file": None, "path": "/o/2019.tif", "period_label": "2019", "time_label": "2019-04-01", "export_profile": "custom", "export_payload": "reflectance", "indices": [], "reflectance_bands": ["B04"]},
    ]
    (tmp_path / "m.json").write_text(json.dumps({"schema_version": "1.0", "entries": entries}))
    df = manifest.read(spark, str(tmp_path / "m.json"))
    assert {(r.year, r.name) for r in manifest.yearly(df).collect()} == {(2020, "2020b.tif"), (2019, "2019.tif")}
    files = spark.createDataFrame([("2020.tif",), ("2019.tif",)], "name string")
    assert {(r.year, r.name) for r in manifest.yearly(df, files).collect()} == {(2020, "2020.tif"), (2019, "2019.tif")}
    assert [r.band for r in manifest.monthly(manifest.select(df, profile="breaks"), "SAVI").collect()] == [3]
    assert manifest.locate_band(df, "SAVI").first().band == 3 and manifest.locate_band(df, "B04").first().band == 1 and manifest.locate_band(df, "SAVI", 7).first().band == 7
    assert manifest.locate_band(df, "NDVI").isEmpty()
    assert manifest.completeness(df, files).first().reason == "missing file: 2020b.tif"
    assert manifest.completeness(df.limit(0), files).first().reason == "no entries"
    assert {r.year for r in manifest.yearly_files(spark.createDataFrame([("2018.tif",), ("x.tif",)], "name string")).collect()} == {2018}
    sinks.manifest(df, Composite(), str(tmp_path / "out"))
    back = manifest.of(spark.read.schema("entries array<struct<file:string>>").json(str(tmp_path / "out")))
    assert [r.file for r in back.orderBy("pos").collect()] == ["2020.tif", "2020b.tif", None]
    (tmp_path / "e.json").write_text(json.dumps({"entries": []}))
    with pytest.raises(ValueError):
        manifest.read(spark, str(tmp_path / "e.json"))


def test_layers_and_sinks(spark, tmp_path):
    square = [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]
    shapes = [{"type": "Polygon", "coordinates": square}, {"type": "MultiPolygon", "coordinates": [square, [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}]
    layer = {"type": "FeatureCollection", "crs": {"properties": {"name": "EPSG:1"}}, "features": [{"type": "Feature", "properties": {"id": i, "fire_count": 3 * i}, "geometry": s} for i, s in enumerate(shapes)]}
    (tmp_path / "z.geojson").write_text(json.dumps(layer))
    assert vectors.layer_crs(layer) == "EPSG:1" and vectors.payload({"f": str(tmp_path / "z.geojson")}, "i", "f") == layer and vectors.payload({}, "i", "f") is None
    z = vectors.zones(spark, str(tmp_path / "z.geojson"), "id int, fire_count int")
    assert sorted((r.id, r.max_x) for r in spatial.bbox(z, "id").collect()) == [(0, 2.0), (1, 6.0)]
    assert {r.id: r["count"] for r in spatial.edges(z, "id").groupBy("id").count().collect()} == {0: 4, 1: 7}
    sinks.layer(z, str(tmp_path / "layer"))
    assert json.loads(spark.read.text(str(tmp_path / "layer")).first()[0])["geometry"]["type"] == "MultiPolygon"
    periods = spark.createDataFrame([("2019",), ("2020",)], "period string")
    assert sinks.pending(periods, spark, str(tmp_path / "none")).count() == 2
    sinks.periods(spark.createDataFrame([(1, "2019")], "v int, period string"), str(tmp_path / "p"))
    assert [r.period for r in sinks.pending(periods, spark, str(tmp_path / "p")).collect()] == ["2020"]
    sinks.summary(spark.createDataFrame([("a", "x,\ny")], "site string, reason string"), str(tmp_path / "s"))
    assert spark.read.option("header", True).csv(str(tmp_path / "s/csv")).first().reason == "x; y"
    low = rasters.minmax(spark.createDataFrame([(None,), (2.0,), (2.0,)], "v double"), "v").first()
    assert (low.low, low.high) == (2.0, 2.0 + 1e-6)
    none = rasters.minmax(spark.createDataFrame([], "v double"), "v").first()
    assert (none.low, none.high) == (-1.0, 1.0)
    with pytest.raises(ValueError):
        vectors.same_crs("EPSG:1", None)
    with pytest.raises(TypeError):
        rasters.single_band(periods)
    with pytest.raises(ValueError):
        rasters.target(spark, "x.pkl")
    sinks.target(spark.createDataFrame([("NBR", 0.5)], "index string, target double"), str(tmp_path / "t"))
    assert rasters.target(spark, str(tmp_path / "t")).first().target == 0.5
    sinks.items(spark.createDataFrame([("a", "2020-07-01", [0.0, 0.0, 1.0, 2.0], "x.tif")], "id string, datetime string, bbox array<double>, asset string"), str(tmp_path / "i"))
    assert spark.read.json(str(tmp_path / "i")).first().assets.data.href == "x.tif"


def test_stream(spark, tmp_path):
    rows = [("2024-01-01 10:00:00", 4), ("2024-01-01 11:00:00", 9), ("2024-01-02 09:00:00", None), ("2024-01-09 00:00:00", 4)]
    spark.createDataFrame(rows, "s string, SCL int").select(F.to_timestamp("s").alias("t"), "SCL").write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema("t timestamp, SCL int").parquet(str(tmp_path / "in"))
    q = stream.daily_coverage(src).writeStream.format("memory").queryName("cover").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {str(r.day): (r.coverage, r.n) for r in spark.table("cover").collect()}
    assert got == {"2024-01-01": (0.5, 2), "2024-01-02": (1.0, 1), "2024-01-09": (1.0, 1)}
