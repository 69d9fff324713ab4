"""Tables of pixels as cloud-optimised GeoTIFF files, and back.

Tiles are compressed where their pixels are, in parallel; only their sizes
come to the driver, which lays out the file, and one task writes header and
tiles in order. Each overview halves the one before it. What is written:
one band, tiled, deflate, all directories before the data, overviews first.
"""

from __future__ import annotations

import dataclasses
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import need
from ..shared import written

# Tags, field types and keys of the format.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, STRIP_ROWS, STRIP_SIZES, PLANAR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284
SUBFILE, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_SIZES, FORMAT = 254, 317, 322, 323, 324, 325, 339
SCALE, TIEPOINT, GEOKEYS, NODATA = 33550, 33922, 34735, 42113
TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 11: "f", 12: "d", 16: "Q"}
MODEL_TYPE, RASTER_TYPE, GEOGRAPHIC_CRS, PROJECTED_CRS = 1024, 1025, 2048, 3072
NONE, DEFLATE, OLD_DEFLATE = 1, 8, 32946
KINDS = {"uint8": (1, 8), "uint16": (1, 16), "int16": (2, 16), "int32": (2, 32), "float32": (3, 32), "float64": (3, 64)}

#: Pixels along the side of a tile, and the size from which offsets have 64 bits.
TILE, LARGE = 512, 4_000_000_000


@dataclasses.dataclass(frozen=True)
class Grid:
    """Where a raster lies: its size, the outer corner of its first pixel, the pixel's sides, and the code of its reference system."""

    height: int
    width: int
    left: float = 0.0
    top: float = 0.0
    side_x: float = 1.0
    side_y: float = 1.0
    epsg: int = 4326
    geographic: bool = True

    def levels(self, tile: int) -> int:
        """Overviews down to one tile, and the raster itself."""
        n = 1
        while max(self.height, self.width) > tile << (n - 1):
            n += 1
        return n

    def shape(self, level: int) -> tuple[int, int]:
        return -(-self.height >> level), -(-self.width >> level)


def tiles(pixels: DataFrame, grid: Grid, kind: str, nodata: float, tile: int = TILE) -> DataFrame:
    """(level, ty, tx, data): the compressed tiles of pixels (y, x, v) that hold any, null as nodata; overviews are means, of integers the nearest."""
    whole = pixels.select("y", "x", F.col("v").cast("double").alias("v")).where("v is not null")
    every = None
    for level in range(grid.levels(tile)):
        if level:
            mean = F.avg("v")
            whole = whole.groupBy(F.floor(F.col("y") / 2).alias("y"), F.floor(F.col("x") / 2).alias("x")).agg((mean if kind.startswith("float") else F.round(mean)).alias("v"))
        part = whole.select(F.lit(level).alias("level"), F.floor(F.col("y") / tile).cast("int").alias("ty"), F.floor(F.col("x") / tile).cast("int").alias("tx"), (F.col("y") % tile).cast("int").alias("py"), (F.col("x") % tile).cast("int").alias("px"), "v")
        every = part if every is None else every.unionByName(part)

    def pack(t: pa.Table) -> pa.Table:
        out = np.full((tile, tile), nodata, np.dtype(kind).newbyteorder("<"))
        out[t["py"].to_numpy(), t["px"].to_numpy()] = t["v"].to_numpy()
        return pa.table({"level": t["level"][:1], "ty": t["ty"][:1], "tx": t["tx"][:1], "data": pa.array([zlib.compress(out.tobytes(), 6)], pa.binary())})

    return every.groupBy("level", "ty", "tx").applyInArrow(pack, "level int, ty int, tx int, data binary")


def _directory(entries: list[tuple[int, int, tuple | bytes]], at: int, follows: bool, big: bool) -> bytes:
    """The bytes of one directory that stands at `at`, with the values that don't fit into it behind."""
    room, word = (8, "Q") if big else (4, "I")
    head = struct.pack("<Q" if big else "<H", len(entries))
    size = len(head) + len(entries) * (20 if big else 12) + room
    body, more = b"", b""
    for tag, kind, values in sorted(entries):
        raw = values if isinstance(values, bytes) else struct.pack(f"<{len(values)}{TYPES[kind]}", *values)
        if len(raw) <= room:
            field = raw.ljust(room, b"\0")
        else:
            field = struct.pack(f"<{word}", at + size + len(more))
            more += raw + b"\0" * (-len(raw) % 8)
        body += struct.pack(f"<HH{word}", tag, kind, len(values)) + field
    end = at + size + len(more)
    return head + body + struct.pack(f"<{word}", end if follows else 0) + more


def layout(grid: Grid, kind: str, nodata: float, sizes: dict[tuple[int, int, int], int], tile: int = TILE) -> tuple[bytes, list[tuple[int, int, int]]]:
    """The file's bytes before its tiles, and the tiles in their order; tiles that hold nothing have neither place nor size."""
    order = sorted(sizes, key=lambda k: (-k[0], k[1], k[2]))
    big = sum(sizes.values()) + 32 * len(sizes) > LARGE
    form, bits = KINDS[kind]
    text = f"{nodata:.17g}".encode() + b"\0"
    keys = (1, 1, 0, 3, MODEL_TYPE, 0, 1, 2 if grid.geographic else 1, RASTER_TYPE, 0, 1, 1, GEOGRAPHIC_CRS if grid.geographic else PROJECTED_CRS, 0, 1, grid.epsg)

    def build(start: int) -> bytes:
        places, at = {}, start
        for k in order:
            places[k] = at
            at += sizes[k]
        out = struct.pack("<2sHHHQ", b"II", 43, 8, 0, 16) if big else struct.pack("<2sHIQ", b"II", 42, 16, 0)
        for level in range(grid.levels(tile)):
            h, w = grid.shape(level)
            all_ = [(level, ty, tx) for ty in range(-(-h // tile)) for tx in range(-(-w // tile))]
            entries = [(WIDTH, 4, (w,)), (HEIGHT, 4, (h,)), (BITS, 3, (bits,)), (COMPRESSION, 3, (DEFLATE,)), (PHOTOMETRIC, 3, (1,)), (SAMPLES, 3, (1,)), (PLANAR, 3, (1,)), (FORMAT, 3, (form,)), (TILE_WIDTH, 3, (tile,)), (TILE_HEIGHT, 3, (tile,))]
            entries += [(TILE_OFFSETS, 16 if big else 4, tuple(places.get(k, 0) for k in all_)), (TILE_SIZES, 4, tuple(sizes.get(k, 0) for k in all_)), (NODATA, 2, text)]
            if level:
                entries.append((SUBFILE, 4, (1,)))
            else:
                entries += [(SCALE, 12, (grid.side_x, grid.side_y, 0.0)), (TIEPOINT, 12, (0.0, 0.0, 0.0, grid.left, grid.top, 0.0)), (GEOKEYS, 3, keys)]
            out += _directory(entries, len(out), level + 1 < grid.levels(tile), big)
        return out

    return build(len(build(0))), order


def write(pixels: DataFrame, path: str, grid: Grid, kind: str = "float32", nodata: float = -1e6, tile: int = TILE) -> None:
    """Writes pixels (y, x, v) as one file. Pixels outside the grid, or two in one place, are an error of the caller."""
    need(kind in KINDS, f"kind must be one of {sorted(KINDS)}")
    need(tile % 16 == 0, "a tile's side must be a multiple of 16")
    # A written table: a tile that is made again, after an executor was lost, might have another size.
    packed = written(tiles(pixels, grid, kind, nodata, tile), "tiles")
    sizes = {(r.level, r.ty, r.tx): r.n for r in packed.select("level", "ty", "tx", F.length("data").alias("n")).collect()}  # a row for each tile
    head, _ = layout(grid, kind, nodata, sizes, tile)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, place = pafs.FileSystem.from_uri(path)
        fs.create_dir(place.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(place) as out:
            out.write(head)
            for batch in batches:
                for data in batch.column("data"):
                    out.write(data.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array([path])], ["path"])

    packed.repartition(1).sortWithinPartitions(F.desc("level"), "ty", "tx").mapInArrow(run, "path string").collect()


class File:
    """A file's first image: its tags, and its blocks as arrays."""

    def __init__(self, data: bytes) -> None:
        need(data[:2] in (b"II", b"MM"), "not a TIFF file")
        self.data, self.order = data, "<" if data[:2] == b"II" else ">"
        self.big = self._read("H", 2)[0] == 43
        at = self._read("Q" if self.big else "I", 8 if self.big else 4)[0]
        count = self._read("Q" if self.big else "H", at)[0]
        at += 8 if self.big else 2
        self.tags: dict[int, tuple | bytes] = {}
        room, step = (8, 20) if self.big else (4, 12)
        for i in range(count):
            tag, kind = self._read("HH", at + i * step)
            n = self._read("Q" if self.big else "I", at + i * step + 4)[0]
            if kind not in TYPES:
                continue
            size, place = struct.calcsize(TYPES[kind]) * n, at + i * step + 4 + room
            if size > room:
                place = self._read("Q" if self.big else "I", place)[0]
            self.tags[tag] = data[place : place + n] if kind == 2 else self._read(f"{n}{TYPES[kind]}", place)
        self.height, self.width = self.tags[HEIGHT][0], self.tags[WIDTH][0]
        self.bands = self.tags.get(SAMPLES, (1,))[0]
        kinds = {v: k for k, v in KINDS.items()}
        wanted = (self.tags.get(FORMAT, (1,))[0], self.tags[BITS][0])
        need(wanted in kinds, f"samples of this kind aren't supported: {wanted}")
        need(self.tags.get(COMPRESSION, (1,))[0] in (NONE, DEFLATE, OLD_DEFLATE) and self.tags.get(PREDICTOR, (1,))[0] == 1, "only deflate without a predictor, and no compression, are supported")
        self.kind = np.dtype(kinds[wanted]).newbyteorder(self.order)

    def _read(self, form: str, at: int) -> tuple:
        return struct.unpack_from(self.order + form, self.data, at)

    @property
    def nodata(self) -> float | None:
        text = self.tags.get(NODATA, b"").strip(b"\0 ")
        return float(text) if text else None

    def blocks(self) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """(band from 1, y, x, values) of the tiles or strips that are there."""
        tiled = TILE_OFFSETS in self.tags
        h, w = (self.tags[TILE_HEIGHT][0], self.tags[TILE_WIDTH][0]) if tiled else (min(self.tags.get(STRIP_ROWS, (self.height,))[0], self.height), self.width)
        offsets, sizes = (self.tags[TILE_OFFSETS], self.tags[TILE_SIZES]) if tiled else (self.tags[STRIP_OFFSETS], self.tags[STRIP_SIZES])
        apart = self.tags.get(PLANAR, (1,))[0] == 2
        down, across = -(-self.height // h), -(-self.width // w)
        for i, (offset, size) in enumerate(zip(offsets, sizes, strict=True)):
            if not size:
                continue
            raw = self.data[offset : offset + size]
            if self.tags.get(COMPRESSION, (1,))[0] != NONE:
                raw = zlib.decompress(raw)
            plane, place = divmod(i, down * across)
            y, x = place // across * h, place % across * w
            values = np.frombuffer(raw, self.kind)
            values = values.reshape(-1, w, 1 if apart else self.bands)[: self.height - y, : self.width - x]
            for b in range(values.shape[2]):
                yield (plane if apart else b) + 1, y, x, values[:, :, b]


def read(spark: SparkSession, path: str) -> DataFrame:
    """(name, band, y, x, v) of all files under path, nodata as null and left out; a file is one task's, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                f = File(data)
                for band, y, x, values in f.blocks():
                    v = values.astype(np.float64)
                    ok = ~np.isnan(v) if f.nodata is None else ~np.isnan(v) & (v != f.nodata)
                    py, px = np.nonzero(ok)
                    columns = [pa.array([name] * len(py), pa.string()), pa.array(np.full(len(py), band, np.int64)), pa.array((py + y).astype(np.int32)), pa.array((px + x).astype(np.int32)), pa.array(v[ok])]
                    yield pa.RecordBatch.from_arrays(columns, ["name", "band", "y", "x", "v"])

    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return files.mapInArrow(run, "name string, band long, y int, x int, v double")
