"""Scores, guards, labels and names as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import CLOUD_CLASSES, EXCLUDED_CLASSES, need

# The peak and width of the date score, the day it favours, and the smallest divisor.
DATE_PEAK, DATE_WIDTH, BEST_DAY = 0.07978845, 5.0, 15
TINY = 1e-12


def date_score(t: Column) -> Column:
    """A Gaussian of the day of the month about its middle."""
    z = (F.dayofmonth(t) - BEST_DAY) * (1 / DATE_WIDTH)
    return F.exp(-0.5 * z * z) * DATE_PEAK


def weighted(scores: Sequence[Column], weights: Sequence[float]) -> Column:
    need(len(scores) == len(weights) and sum(weights) != 0, "as many weights as scores, with a sum other than 0")
    total = F.lit(0.0)
    for s, w in zip(scores, weights, strict=True):
        total = total + s * float(w)
    return total / float(sum(weights))


def is_cloud(scl: Column, classes: Iterable[int] = CLOUD_CLASSES) -> Column:
    return F.coalesce(scl, F.lit(0)).isin(*classes)


def is_excluded(scl: Column, classes: Iterable[int] = EXCLUDED_CLASSES) -> Column:
    return F.coalesce(scl, F.lit(0)).isin(*classes)


def positive(value: Column) -> Column:
    """Raw values of 0 or less are missing."""
    return F.when(value > 0, value)


def baseline_offset(value: Column, t: Column, since: str = "2022-01-25", offset: float = 1000.0) -> Column:
    """Values of later dates without the offset that processing has added since."""
    return F.when(t > F.lit(since).cast("timestamp"), value - offset).otherwise(value)


def guarded_ratio(value: Column, divisor: Column) -> Column:
    return F.when(F.abs(divisor) > TINY, value / divisor)


def span_years(end: Column, restored: Column, start: Column) -> Column:
    return F.greatest(F.lit(0), end - F.coalesce(restored, start) + 1)


def parse_year(text: Column) -> Column:
    """The year of a date or timestamp, else the first 19.. or 20.. in the text."""
    found = F.regexp_extract(text, r"(19|20)\d{2}", 0)
    return F.coalesce(F.year(F.try_to_timestamp(text)), F.when(found != "", found).cast("int"))


def sanitize(value: Column, default: Column) -> Column:
    """A name for files: each run of other signs is an underscore; blank takes the default."""
    bare = F.trim(value)
    return F.regexp_replace(F.coalesce(F.when(bare != "", bare), default), "[^A-Za-z0-9._-]+", "_")


def capped(log_value: Column, cap: Column) -> Column:
    """Share of the cap, from 0 to 1; a cap of 0 counts as 1."""
    return F.least(F.greatest(log_value / F.when(cap == 0, F.lit(1.0)).otherwise(cap), F.lit(0.0)), F.lit(1.0))


def break_class(year: Column, magnitude: Column, threshold: float) -> Column:
    """1 where nothing was detected, 0 where the magnitude is above the threshold, else the year."""
    return F.when(year.isNull() | magnitude.isNull(), 1).when(magnitude <= threshold, year.cast("int")).otherwise(0)


def item_datetime(label: Column, file: Column | None = None, now: Column | None = None) -> Column:
    """When an item dates from: the middle of a year, an ISO date, else a year with which the file's name begins, else now; NULL if none of them is given."""
    year = F.when(label.rlike(r"^\d{4}$"), label.cast("int"))
    middle = lambda y: F.make_date(y, F.lit(7), F.lit(1))
    found = [middle(year), F.to_date(F.try_to_timestamp(label))]
    if file is not None:
        stem = F.regexp_extract(F.element_at(F.split(file, "/"), -1), r"^(\d{4})(?!\d)", 1)
        found.append(middle(F.when(stem != "", stem.cast("int"))))
    return F.coalesce(*found, *([now.cast("date")] if now is not None else []))


def line_value(x: Column, slope: Column, intercept: Column) -> Column:
    return intercept + slope * x
