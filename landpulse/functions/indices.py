"""Spectral indices as Column builders, and the payload of an export."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import PAYLOADS, TCW, need
from ..schema import BANDS


def _ratio(a: str, b: str) -> Column:
    return F.try_divide(F.col(a) - F.col(b), F.col(a) + F.col(b))


def savi(nir: Column, red: Column, soil: float = 0.5) -> Column:
    return F.try_divide(nir - red, nir + red + soil) * (1 + soil)


def tcw(coefficients: Mapping[str, float] = TCW) -> Column:
    return reduce(lambda a, b: a + b, (F.col(b) * coefficients[b] for b in BANDS))


def builders(savi_l: float = 0.5, coefficients: Mapping[str, float] = TCW) -> dict[str, Callable[[], Column]]:
    return {
        "NBR": lambda: _ratio("B08", "B12"),
        "NDVI": lambda: _ratio("B08", "B04"),
        "NDMI": lambda: _ratio("B08", "B11"),
        "NBR2": lambda: _ratio("B11", "B12"),
        "SAVI": lambda: savi(F.col("B08"), F.col("B04"), savi_l),
        "TCW": lambda: tcw(coefficients),
    }


def index(name: str, **options) -> Column:
    """The index of that name; a denominator of 0 gives NULL."""
    found = builders(**options)
    need(name in found, f"unknown index: {name}")
    return found[name]().alias(name)


def add_indices(cube: DataFrame, names: Iterable[str], keep: bool = True, keys: Iterable[str] = ("t", "y", "x"), **options) -> DataFrame:
    own = [c for c in cube.columns if keep or c in set(keys)]
    return cube.select(*own, *(index(n, **options) for n in names))


def payload(cube: DataFrame, kind: str, names: Iterable[str], bands: Iterable[str], keys: Iterable[str], **options) -> DataFrame:
    """The keys with the bands, the indices, or both. One projection, so a scan below reads no other column."""
    need(kind in PAYLOADS, f"unknown payload: {kind}")
    parts = [*(bands if kind != "indices" else []), *(index(n, **options) for n in (names if kind != "reflectance" else []))]
    return cube.select(*keys, *parts)
