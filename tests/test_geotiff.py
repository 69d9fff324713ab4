"""GeoTIFF files written and read again, and files as others write them."""

import random
import struct
import zlib

import numpy as np
import pytest

from landpulse.sources import geotiff


@pytest.mark.parametrize("kind,big", [("float32", False), ("int16", False), ("uint8", False), ("float64", True)])
def test_round_trip(spark, tmp_path, monkeypatch, kind, big):
    if big:
        monkeypatch.setattr(geotiff, "LARGE", 0)
    rng = random.Random(1)
    cells = {(y, x): float(rng.randrange(1, 200)) for y in range(70) for x in range(45) if rng.random() < 0.8 and not (y >= 64 and x < 32)}
    cells[0, 0] = 7.0
    df = spark.createDataFrame([(y, x, v) for (y, x), v in cells.items()] + [(1, 1, None)] * ((1, 1) not in cells), "y int, x int, v double")
    grid = geotiff.Grid(70, 45, 100.5, 60.25, 0.5, 0.25, 32633, False)
    geotiff.write(df, f"file://{tmp_path}/out/r.tif", grid, kind, nodata=0.0, tile=32)
    got = {(r.y, r.x): r.v for r in geotiff.read(spark, f"{tmp_path}/out").collect()}
    assert got == cells
    f = geotiff.File((tmp_path / "out/r.tif").read_bytes())
    assert (f.height, f.width, f.nodata, f.big) == (70, 45, 0.0, big)
    assert f.tags[geotiff.TIEPOINT][3:5] == (100.5, 60.25) and f.tags[geotiff.SCALE][:2] == (0.5, 0.25) and f.tags[geotiff.GEOKEYS][-1] == 32633
    # The tile of nothing has no place, and the first overview lies before the raster itself.
    assert f.tags[geotiff.TILE_SIZES].count(0) == 1 and len(f.tags[geotiff.TILE_SIZES]) == 6
    assert grid.levels(32) == 3 and [grid.shape(n) for n in range(3)] == [(70, 45), (35, 23), (18, 12)]


def test_overviews(spark):
    grid = geotiff.Grid(64, 64)
    df = spark.createDataFrame([(y, x, float(y // 2)) for y in range(64) for x in range(64)], "y int, x int, v double")
    packed = {(r.level, r.ty, r.tx): np.frombuffer(zlib.decompress(r.data), "<f4").reshape(32, 32) for r in geotiff.tiles(df, grid, "float32", -1.0, 32).collect()}
    assert set(packed) == {(0, a, b) for a in (0, 1) for b in (0, 1)} | {(1, 0, 0)}
    assert (packed[1, 0, 0] == np.arange(32)[:, None]).all()


@pytest.mark.parametrize("order", ["<", ">"])
def test_strips_of_two_bands(spark, tmp_path, order):
    """An uncompressed file in strips of two rows, samples side by side, in either byte order."""
    values = np.arange(5 * 3 * 2).reshape(5, 3, 2).astype(f"{order}u2")
    strips = [values[i : i + 2].tobytes() for i in range(0, 5, 2)]
    tags = [(256, 3, (3,)), (257, 3, (5,)), (258, 3, (16, 16)), (259, 3, (1,)), (273, 4, None), (277, 3, (2,)), (278, 3, (2,)), (279, 4, tuple(map(len, strips))), (339, 3, (1, 1))]
    at = 8 + 2 + 12 * len(tags) + 4
    places, body = [], b""
    for s in strips:
        places.append(at + len(body))
        body += s
    extra, fields = b"", b""
    for tag, kind, v in tags:
        v = v or tuple(places)
        raw = struct.pack(f"{order}{len(v)}{'HI'[kind == 4]}", *v)
        if len(raw) > 4:
            field, extra = struct.pack(f"{order}I", at + len(body) + len(extra)), extra + raw
        else:
            field = raw.ljust(4, b"\0")
        fields += struct.pack(f"{order}HHI", tag, kind, len(v)) + field
    data = (b"II" if order == "<" else b"MM") + struct.pack(f"{order}HIH", 42, 8, len(tags)) + fields + b"\0" * 4 + body + extra
    (tmp_path / "s.tif").write_bytes(data)
    got = {(r.band, r.y, r.x): r.v for r in geotiff.read(spark, str(tmp_path / "s.tif")).collect()}
    assert got == {(b + 1, y, x): float(values[y, x, b]) for y in range(5) for x in range(3) for b in range(2)}
    with pytest.raises(ValueError, match="not a TIFF"):
        geotiff.File(b"PNG")
