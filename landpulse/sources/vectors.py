"""GeoJSON layers as tables."""

from __future__ import annotations

import json
from collections.abc import Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import feature_collection, need

_POLYGON = "array<array<array<double>>>"


def layer_crs(obj: Mapping[str, Any]) -> str:
    return ((obj.get("crs") or {}).get("properties") or {}).get("name") or "EPSG:4326"


def payload(parameters: Mapping[str, Any], inline: str, file: str) -> dict[str, Any] | None:
    """The inline GeoJSON, else that in the file, else None."""
    if parameters.get(inline):
        return feature_collection(parameters[inline])
    return feature_collection(json.loads(Path(parameters[file]).read_text())) if parameters.get(file) else None


def zones(spark: SparkSession, path: str, attributes: str) -> DataFrame:
    """(attributes, rings) of polygons and multipolygons in a GeoJSON file, or in all files of a folder; attributes is their schema."""
    return parsed(spark.read.text(path, wholetext=True), attributes)


def parsed(texts: DataFrame, attributes: str) -> DataFrame:
    """As zones(), of FeatureCollections as text (value)."""
    schema = f"struct<features:array<struct<properties:struct<{attributes}>,geometry:struct<type:string,coordinates:string>>>>"
    features = texts.select(F.explode(F.from_json("value", schema)["features"]).alias("f"))
    one = F.array(F.from_json("f.geometry.coordinates", _POLYGON))
    many = F.from_json("f.geometry.coordinates", f"array<{_POLYGON}>")
    parts = F.flatten(F.when(F.col("f.geometry.type") == "Polygon", one).otherwise(many))
    rings = F.transform(parts, lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return features.select("f.properties.*", rings.alias("rings"))


def points(spark: SparkSession, path: str) -> DataFrame:
    schema = "features array<struct<geometry:struct<type:string,coordinates:array<double>>>>"
    at = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("features.geometry.coordinates").alias("c"))
    return at.select(F.col("c")[0].alias("px"), F.col("c")[1].alias("py"))


def relabelled(crs: str | None, of: str | None) -> str | None:
    """The reference system under which a target is combined with series in another one: that of the series, where it is known; the values stay as they are."""
    return of or crs


def same_crs(*names: str | None) -> str:
    """The layers' common reference system; a missing or another one is an error."""
    need(all(names), "a layer has no reference system")
    need(len(set(names)) == 1, f"reference systems differ: {sorted(set(names))}")
    return names[0]
