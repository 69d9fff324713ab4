"""Parameters of the pipelines, their checks and what follows from them."""

from __future__ import annotations

import calendar
import dataclasses
import re
from collections.abc import Iterable, Mapping
from typing import Any

from .schema import BANDS

# Coefficients, classes, names and defaults that results depend on.
TCW = {"B02": 0.1509, "B03": 0.1973, "B04": 0.3279, "B08": 0.3406, "B11": -0.7112, "B12": -0.4572}
INDEX_BANDS = {
    "NBR": ("B08", "B12"),
    "NDVI": ("B08", "B04"),
    "NDMI": ("B08", "B11"),
    "NBR2": ("B11", "B12"),
    "SAVI": ("B08", "B04"),
    "TCW": ("B02", "B03", "B04", "B08", "B11", "B12"),
}
CLOUD_CLASSES = (3, 8, 9, 10)
EXCLUDED_CLASSES = (1, 2, 3, 7, 8, 9, 10)
METRIC_ALIASES = {
    "r80p": "r80p",
    "deltair": "deltair",
    "percentchange": "percent_change",
    "pctchange": "percent_change",
    "slopeintercept": "slope_intercept",
    "slopeandintercept": "slope_intercept",
}
RECOVERY_METRICS = ("deltaIR", "R80P", "YrYr", "Y2R", "RRI")
MODES = ("yearly", "monthly")
PAYLOADS = ("reflectance", "indices", "both")
#: Profile: the mode and the payloads that it goes with, the first of which it sets.
PROFILES: dict[str, tuple[str, tuple[str, ...]] | None] = {
    "custom": None,
    "spectral_recovery": ("yearly", ("reflectance",)),
    "seasonal_sen": ("monthly", ("indices", "both")),
    "breaks": ("yearly", ("indices",)),
}


def need(ok: bool, what: str) -> None:
    if not ok:
        raise ValueError(what)


@dataclasses.dataclass(frozen=True)
class Composite:
    """A best-available-pixel run."""

    years: tuple[int, ...] = (2017, 2018, 2019)
    mode: str = "yearly"
    season_start: str = "01-01"
    season_end: str = "03-30"
    months: tuple[int, ...] = (1, 2, 3)
    indices: tuple[str, ...] = ("NBR", "SAVI", "TCW")
    savi_l: float = 0.5
    tcw: Mapping[str, float] = dataclasses.field(default_factory=lambda: dict(TCW))
    profile: str = "custom"
    payload: str = "indices"
    naming: str = "profiled"
    max_cloud_cover: float = 70
    resolution: int = 10
    max_distance: int = 30
    buffer_px: int = 2
    excluded: tuple[int, ...] = EXCLUDED_CLASSES
    weights: tuple[float, float, float] = (1.0, 0.8, 0.5)
    end_inclusive: bool = False
    resume: bool = True

    def for_profile(self) -> Composite:
        """With the mode and payload that the profile asks for; breaks keeps one index."""
        if PROFILES.get(self.profile) is None:
            return self
        mode, payloads = PROFILES[self.profile]
        indices = (self.indices or ("SAVI",))[:1] if self.profile == "breaks" else self.indices
        return dataclasses.replace(self, mode=mode, payload=payloads[0], indices=indices)

    def check(self) -> Composite:
        need(self.mode in MODES, f"mode must be one of {MODES}")
        need(set(self.indices) <= set(INDEX_BANDS), f"indices must be among {sorted(INDEX_BANDS)}")
        if self.mode == "monthly":
            need(bool(self.months), "monthly composites need months")
            need(all(1 <= m <= 12 for m in self.months), "months must be from 1 to 12")
        need(self.savi_l >= 0, "savi_l must be 0 or more")
        need("TCW" not in self.indices or set(self.tcw) == set(BANDS), f"tcw needs the bands {BANDS}")
        need(self.payload in PAYLOADS, f"payload must be one of {PAYLOADS}")
        need(self.profile in PROFILES, f"profile must be one of {sorted(PROFILES)}")
        need(len(self.weights) == 3 and min(self.weights) >= 0 and sum(self.weights) > 0, "three weights, none below 0 and not all 0")
        if PROFILES[self.profile]:
            mode, payloads = PROFILES[self.profile]
            need(self.mode == mode, f"{self.profile} needs {mode} composites")
            need(self.payload in payloads, f"{self.profile} needs a payload of {payloads}")
            need(self.profile != "breaks" or len(self.indices) == 1, "breaks needs one index")
        return self

    def bands(self) -> list[str]:
        """Reflectance bands to read."""
        if self.profile == "spectral_recovery":
            return list(BANDS)
        found = required_bands(self.indices)
        return found or (list(BANDS) if self.payload != "indices" else [])

    def periods(self) -> list[dict[str, str]]:
        """label, start, end and time_label of each period, year by year."""
        if self.mode == "yearly":
            a, b = self.season_start, self.season_end
            return [{"label": f"{y}_{a}_{b}".replace("-", ""), "start": f"{y}-{a}", "end": f"{y}-{b}", "time_label": f"{y}-{a}"} for y in self.years]
        days = [(y, m, calendar.monthrange(y, m)[1]) for y in self.years for m in self.months]
        return [{"label": f"{y}_{m:02d}", "start": f"{y}-{m:02d}-01", "end": f"{y}-{m:02d}-{d:02d}", "time_label": f"{y}-{m:02d}-01"} for y, m, d in days]

    def output_name(self, label: str) -> str:
        if self.profile == "spectral_recovery":
            return f"{label.split('_')[0]}.tif"
        joined = lambda names: "-".join(names).lower() or "none"
        if self.naming == "legacy":
            return f"bap_{self.mode}_{label}_{joined(self.indices)}.tif"
        content = joined(self.bands()) if self.payload == "reflectance" else joined(self.indices)
        return f"bap_{self.profile}_{self.mode}_{label}_{self.payload}_{content}.tif"


def required_bands(indices: Iterable[str]) -> list[str]:
    return sorted({b for i in indices for b in INDEX_BANDS[i]})


@dataclasses.dataclass(frozen=True)
class Trend:
    """A seasonal Sen run."""

    index: str = "SAVI"
    metrics: tuple[str, ...] = ("R80P", "DeltaIR")
    target_fraction: float = 0.8
    baseline_year: int | None = None
    years_before: int = 3
    start_year: int | None = None
    end_year: int | None = None
    period: int | None = None
    all_touched: bool = False

    def check(self) -> Trend:
        need(self.period is None or self.period >= 1, "period must be 1 or more")
        return dataclasses.replace(self, metrics=tuple(metric_names(self.metrics)))


def metric_names(metrics: Iterable[str]) -> list[str]:
    """Names without case and punctuation, each once, in order."""
    keys = [re.sub("[^a-z0-9]", "", str(m).lower()) for m in metrics]
    need(bool(keys), "at least one metric is needed")
    unknown = [m for m, k in zip(metrics, keys, strict=True) if k not in METRIC_ALIASES]
    need(not unknown, f"unknown metrics: {unknown}")
    return list(dict.fromkeys(METRIC_ALIASES[k] for k in keys))


def recovery_metric(name: str) -> str:
    known = {m.lower(): m for m in RECOVERY_METRICS}
    need(name.lower() in known, f"unknown recovery metric: {name}")
    return known[name.lower()]


@dataclasses.dataclass(frozen=True)
class Breaks:
    threshold: float = 0.025
    scale: float = 1000.0
    index: str = "SAVI"
    nodata: float = -1e6


@dataclasses.dataclass(frozen=True)
class Disturbance:
    mmu: float = 5000.0
    filter_size: int = 7
    connectivity: int = 8
    weights: tuple[float, float, float] = (0.7, 0.3, 0.9)
    cap_percentile: float = 99.0
    magnitude: float = -200.0

    def check(self) -> Disturbance:
        check_filter_size(self.filter_size)
        check_sieve(self.mmu, self.connectivity)
        need(len(self.weights) == 3, "exactly three weights are needed")
        return self


def check_filter_size(size: Any) -> None:
    need(isinstance(size, int) and not isinstance(size, bool) and size > 0 and size % 2 == 1, "the filter size must be a positive odd integer")


def check_sieve(mmu: Any, connectivity: int) -> None:
    good = isinstance(mmu, (int, float)) and not isinstance(mmu, bool) and 0 < mmu < float("inf")
    need(good, "the minimum mapping unit must be a positive finite number")
    need(connectivity in (4, 8), "connectivity must be 4 or 8")


def range_defaults(parameters: Mapping[str, Any]) -> dict[str, Any]:
    """What a range of years implies: its first is the baseline, the next the restoration, its last the evaluation. Keys that are set stay."""
    given = dict(parameters)
    if not (given.get("rangestart") and given.get("rangeend")):
        return given
    first, last = (int(str(given[k])[:4]) for k in ("rangestart", "rangeend"))
    need(last >= first + 2, "rangeend must be two years after rangestart or later")
    implied = {"years": list(range(first, last + 1)), "sr_dist_rest_years": {0: [first, first + 1]}, "sr_reference_start": str(first + 1), "sr_reference_end": str(last), "metric_timestep": last - first - 1}
    return implied | given


def timestep(value: Any) -> int:
    need(isinstance(value, int) and not isinstance(value, bool) and value >= 1, "the timestep must be an integer of 1 or more")
    return value


def feature_collection(obj: Mapping[str, Any] | None) -> dict[str, Any]:
    """A FeatureCollection from one, from a Feature or from a Polygon."""
    kind = (obj or {}).get("type")
    if kind == "FeatureCollection":
        return dict(obj)
    if kind in ("Polygon", "MultiPolygon"):
        obj, kind = {"type": "Feature", "properties": {}, "geometry": dict(obj)}, "Feature"
    need(kind == "Feature", "expected a FeatureCollection, a Feature or a Polygon")
    return {"type": "FeatureCollection", "features": [dict(obj)]}
