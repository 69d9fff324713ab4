"""Declared schemas, and how missing values enter and leave."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of bands and manifest fields, and nodata, that files to read and write have.
#: Reflectance bands in the order in which they are exported.
BANDS = ("B02", "B03", "B04", "B08", "B11", "B12")
#: Their names in recovery analysis, in the same order.
COMMON_BANDS = ("blue", "green", "red", "nir", "swir16", "swir22")
#: Numeric nodata by kind of raster.
NODATA = {"breaks": -1e6, "classes": 1.0, "raw": 0.0}

_strings = T.ArrayType(T.StringType())
ENTRY = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("period_label", T.StringType()),
        T.StructField("time_label", T.StringType()),
        T.StructField("temporal_extent", _strings),
        T.StructField("export_profile", T.StringType()),
        T.StructField("compositing_mode", T.StringType()),
        T.StructField("export_payload", T.StringType()),
        T.StructField("reflectance_bands", _strings),
        T.StructField("indices", _strings),
        T.StructField("spatial_resolution", T.IntegerType()),
        T.StructField("score_weights", T.StructType([T.StructField(n, T.DoubleType()) for n in ("distance_to_cloud", "date", "coverage")])),
    ]
)
MANIFEST = T.StructType([*(T.StructField(n, T.StringType()) for n in ("schema_version", "generated_at", "export_profile", "compositing_mode", "export_payload")), T.StructField("entries", T.ArrayType(ENTRY))])
GRID_META = T.StructType([*(T.StructField(n, T.DoubleType()) for n in "abcdef"), T.StructField("crs", T.StringType()), T.StructField("nodata", T.DoubleType()), T.StructField("height", T.IntegerType()), T.StructField("width", T.IntegerType())])


def to_null(value: Column, nodata: float | None = None) -> Column:
    """NaN, and the raster's nodata, as NULL."""
    clean = F.when(~F.isnan(value), value)
    return clean if nodata is None else F.nullif(clean, F.lit(nodata))


def from_null(value: Column, nodata: float) -> Column:
    """NULL as the raster's nodata."""
    return F.coalesce(value, F.lit(nodata))
