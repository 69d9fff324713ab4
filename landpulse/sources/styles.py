"""How catalogue items are shown: colour expressions over a raster's bands, as JSON."""

from __future__ import annotations

import json

# Colours, the limits that go with a trend's metrics, and the steps of two recovery metrics.
WHITE, BLACK, CLEAR = [255, 255, 255, 1], [0, 0, 0, 1], [52, 52, 52, 0]
RED_YELLOW_GREEN = ((215, 25, 28), (253, 174, 97), (255, 255, 191), (166, 217, 106), (26, 150, 65))
LIMITS = {"r80p": 1.5, "delta_ir": 0.5, "percent_change": 100}
BY_YEAR = (-0.6, -0.000001)
CLEAR_AT_ZERO = ("R80P", "YrYr", "Y2R")


def _steps(band: int, stops: list) -> list:
    return ["interpolate", ["linear"], ["band", band], *stops]


def _text(color: list) -> str:
    return json.dumps({"color": color}, separators=(",", ":"))


def grey(low: float, high: float, band: int = 1, clear_at_zero: bool = False) -> str:
    """From white to black; with clear_at_zero, 0 isn't shown."""
    return _text(_steps(band, [low, WHITE, high, BLACK, *([0, CLEAR] if clear_at_zero else [])]))


def diverging(limit: float | None = None) -> str:
    """Red to green between minus limit and limit, or grey between -1 and 1 without one; nodata and missing values aren't shown."""
    at = [-1, 1] if limit is None else [-limit, -limit / 2, 0, limit / 2, limit]
    channels = [[0, 255]] * 3 if limit is None else list(zip(*RED_YELLOW_GREEN, strict=True))
    seen = ["case", ["==", ["band", 1], "noDataValue"], 0, ["!=", ["band", 1], ["band", 1]], 0, 1]
    return _text(["color", *(_steps(1, [x for pair in zip(at, c, strict=True) for x in pair]) for c in channels), seen])


def trend(metric: str) -> str:
    return diverging(LIMITS.get(metric))


def recovered(metric: str, low: float, high: float) -> str:
    """Of a recovery metric with those least and greatest values."""
    return grey(*(BY_YEAR if metric in ("YrYr", "Y2R") else (low, high)), clear_at_zero=metric in CLEAR_AT_ZERO)
