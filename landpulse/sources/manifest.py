"""Manifests of composites, and the files, bands and years that they name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import need
from ..schema import MANIFEST


def read(spark: SparkSession, path: str) -> DataFrame:
    """(pos, entry fields) of a manifest file; an empty one is an error."""
    entries = of(spark.read.schema(MANIFEST).json(path, multiLine=True))
    need(not entries.isEmpty(), f"no entries in {path}")
    return entries


def of(manifests: DataFrame) -> DataFrame:
    return manifests.select(F.posexplode("entries").alias("pos", "e")).select("pos", "e.*")


def select(entries: DataFrame, profile: str | None = None, mode: str | None = None, payloads: Iterable[str] | None = None) -> DataFrame:
    for column, values in (("export_profile", profile and [profile]), ("compositing_mode", mode and [mode]), ("export_payload", payloads and list(payloads))):
        if values:
            entries = entries.where(F.col(column).isin(*values))
    return entries


def file_name(prefer: str = "file") -> Column:
    """The name without folders of the preferred field, else of the other one; null if both are blank."""
    other = "path" if prefer == "file" else "file"
    full = F.coalesce(*(F.when(F.trim(c) != "", F.trim(c)) for c in (prefer, other)))
    return F.element_at(F.split(full, "/"), -1)


def band_position(index: str, strict: bool = True) -> Column:
    """The 1-based band of an index in an entry's indices, after the reflectance bands if both were written; null if it isn't there."""
    order = F.coalesce("indices", F.array().cast("array<string>"))
    at = F.array_position(order, index)
    before = F.when(F.col("export_payload") == "both", F.size(F.coalesce("reflectance_bands", F.array().cast("array<string>")))).otherwise(0)
    return F.when(at > 0, at + before)


def band_order() -> Column:
    """The names of an entry's bands as its payload says."""
    empty = F.array().cast("array<string>")
    bands, indices = F.coalesce("reflectance_bands", empty), F.coalesce("indices", empty)
    payload = F.coalesce("export_payload", F.lit("indices"))
    return F.when(payload == "reflectance", bands).when(payload == "indices", indices).otherwise(F.concat(bands, indices))


def locate_band(entries: DataFrame, index: str, given: int | None = None) -> DataFrame:
    """One row: band, the one given or that in the first entry that has the index; no row if none has it."""
    if given is not None:
        return entries.sparkSession.range(1).select(F.lit(given).cast("long").alias("band"))
    at = F.array_position(band_order(), index)
    return entries.where(at > 0).orderBy("pos").limit(1).select(at.alias("band"))


def yearly(entries: DataFrame, files: DataFrame | None = None, prefer: str = "file") -> DataFrame:
    """(year, name) by the label's leading year; of several entries of a year the last that has a file. files (name): those that exist."""
    rows = entries.select("pos", F.regexp_extract("period_label", r"^(\d{4})", 1).alias("y"), file_name(prefer).alias("name")).where("y <> '' and name is not null")
    if files is not None:
        rows = rows.join(files, "name", "left_semi")
    return rows.groupBy(F.col("y").cast("int").alias("year")).agg(F.max_by("name", "pos").alias("name"))


def yearly_files(files: DataFrame) -> DataFrame:
    """(year, name) where there is no manifest: files named by a year."""
    year = F.regexp_extract("name", r"^(\d{4})\.tif$", 1)
    return files.where(year != "").groupBy(year.cast("int").alias("year")).agg(F.max("name").alias("name"))


def monthly(entries: DataFrame, index: str, files: DataFrame | None = None, prefer: str = "file") -> DataFrame:
    """(t, name, band) of the entries with a time label and a file, in order of time; entries whose file is absent are skipped if files are given."""
    rows = entries.select(F.to_date("time_label").alias("t"), file_name(prefer).alias("name"), band_position(index).alias("band")).where("t is not null and name is not null")
    if files is not None:
        rows = rows.join(files, "name", "left_semi")
    return rows.orderBy("t")


def completeness(entries: DataFrame, files: DataFrame) -> DataFrame:
    """One row: ok and reason. Entries without a file name come before absent files, an empty manifest before both."""
    rows = entries.select("pos", file_name("path").alias("name")).join(files.select("name", F.lit(True).alias("there")).distinct(), "name", "left")
    first = lambda c: F.min(F.when(c, F.col("pos")))
    found = rows.agg(F.count(F.lit(1)).alias("n"), first(F.col("name").isNull()).alias("blank"), F.min_by("name", F.when(F.col("name").isNotNull() & F.col("there").isNull(), F.col("pos"))).alias("x"), first(F.col("name").isNotNull() & F.col("there").isNull()).alias("absent"))
    reason = F.when(F.col("n") == 0, "no entries").when(F.col("blank").isNotNull(), "entry without path and file").when(F.col("absent").isNotNull(), F.concat(F.lit("missing file: "), F.col("x"))).otherwise("ok")
    return found.select((reason == "ok").alias("ok"), reason.alias("reason"))
