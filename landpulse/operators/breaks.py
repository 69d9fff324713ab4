"""Piecewise-linear break detection, for many series at a time.

Neighbouring pairs of observations are merged bottom-up, cheapest first, until
the cheapest merge costs more than a threshold; the segment with the steepest
fall is the change. All series of one length go through each step together as
rows of a matrix. What a merge costs, which costs are renewed and where
connecting segments stand in the list are fixed by the results to match, and
noted where they surprise.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ("pre_duration", "pre_magnitude", "pre_slope", "change_year", "change_duration", "change_magnitude", "change_slope", "post_duration", "post_magnitude", "post_slope")
#: The greatest slope that still counts as the steepest fall.
START = 99.0


def _fits(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slope, intercept, cost) of regressions over places a to b, b not included; cost is the slope's squared standard error times n - 1."""
    at = np.arange(y.shape[1])
    use = (at >= a[:, None]) & (at < b[:, None])
    n = use.sum(axis=1)
    mx = np.where(use, x, 0).sum(axis=1) / n
    my = np.where(use, y, 0).sum(axis=1) / n
    dx, dy = np.where(use, x - mx[:, None], 0), np.where(use, y - my[:, None], 0)
    sxx, sxy, syy = ((p * q).sum(axis=1) / n for p, q in ((dx, dx), (dx, dy), (dy, dy)))
    r = np.where((sxx == 0) | (syy == 0), 0.0, np.clip(sxy / np.where(sxx * syy > 0, np.sqrt(sxx * syy), 1), -1, 1))
    slope = sxy / sxx
    return slope, my - slope * mx, (1 - r * r) * syy / sxx / np.maximum(n - 2, 1) * (n - 1)


def segments(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, count): places of each row's segments, of which the first count are used. y: a row for each series, without missing values; x, y of even length."""
    rows, n = y.shape
    m = n // 2
    start, end = (np.tile(np.arange(k, n, 2), (rows, 1)) for k in (0, 1))
    count = np.full(rows, m)
    # The last place isn't part of a merge's regression.
    cost = np.full((rows, max(m - 1, 0)), np.inf)
    for i in range(m - 1):
        cost[:, i] = _fits(x, y, start[:, i], end[:, i + 1])[2]
    live = np.arange(rows) if m > 1 else np.arange(0)
    while len(live):
        left = np.arange(cost.shape[1]) < (count[live] - 1)[:, None]
        own = np.where(left, cost[live], np.inf)
        go = (count[live] > 1) & ~(own.min(axis=1) > threshold)
        live, own = live[go], own[go]
        if not len(live):
            break
        k = own.argmin(axis=1)
        end[live, k] = end[live, k + 1]
        for grid in (start, end):  # close the gap after k + 1
            shifted = np.concatenate((grid[live, 1:], grid[live, -1:]), axis=1)
            grid[live] = np.where(np.arange(m) > k[:, None], shifted, grid[live])
        shifted = np.concatenate((cost[live, 1:], np.full((len(live), 1), np.inf)), axis=1)
        cost[live] = np.where(np.arange(m - 1) >= k[:, None], shifted, cost[live])
        count[live] -= 1
        # The cost to the right is renewed unless that neighbour is the last segment.
        right = k + 1 < count[live] - 1
        for some, at in ((right, k), (k > 0, k - 1)):
            r, c = live[some], at[some]
            if len(r):
                cost[r, c] = _fits(x, y[r], start[r, c], end[r, c + 1])[2]
    return start, end, count


def change_metrics(years: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """METRICS for each row of y; NaN where there is none. A row with a missing value has none at all."""
    out = np.full((len(y), len(METRICS)), np.nan)
    whole = np.flatnonzero(np.isfinite(y).all(axis=1))
    if len(years) % 2:  # the first observation is left out
        years, y = years[1:], y[:, 1:]
    if not len(whole) or y.shape[1] < 2:
        return out
    y = y[whole]
    x = years.astype(np.float64)
    start, end, count = segments(x, y, threshold)
    m = start.shape[1]
    row = np.arange(len(y))[:, None]
    used = np.arange(m) < count[:, None]
    x0, x1 = x[start], x[end]
    rise = (y[row, end] - y[row, start]) / (x1 - x0)
    slope, icpt = rise, y[row, start] - rise * x0
    for i in range(m):
        long = np.flatnonzero(used[:, i] & (end[:, i] - start[:, i] > 1))
        if len(long):
            slope[long, i], icpt[long, i], _ = _fits(x, y[long], start[long, i], end[long, i])
    # Connecting segments come after the first segment, all in a row; the others follow.
    link = used[:, 1:]
    a, b = x1[:, :-1], x0[:, 1:]
    ya, yb = icpt[:, :-1] + slope[:, :-1] * a, icpt[:, 1:] + slope[:, 1:] * b
    gap = np.where(b > a, b - a, 1)
    ls = (yb - ya) / gap
    order = lambda first, links: np.concatenate((first[:, :1], links, first[:, 1:]), axis=1)
    valid = order(used, link)
    seq = np.argsort(~valid, axis=1, kind="stable")
    s0, s1, sl, ic = (np.take_along_axis(order(p, q), seq, axis=1) for p, q in ((x0, a), (x1, b), (slope, ls), (icpt, ya - ls * a)))
    total = valid.sum(axis=1)
    falls = np.where((np.arange(sl.shape[1]) < total[:, None]) & (sl < START), sl, np.inf)
    change = np.where(np.isfinite(falls.min(axis=1)), falls.argmin(axis=1), 0)
    found = total > 1
    for k, offset in ((0, -1), (4, 0), (7, 1)):
        i = change + offset
        ok = found & (i >= 0) & (i < total)
        r, c = np.flatnonzero(ok), i[ok]
        d0, d1 = s0[r, c], s1[r, c]
        out[whole[r], k] = d1 - d0
        out[whole[r], k + 1] = (ic[r, c] + sl[r, c] * d1) - (ic[r, c] + sl[r, c] * d0)
        out[whole[r], k + 2] = sl[r, c]
        if offset == 0:
            out[whole[r], 3] = d1
    return out


def detect(series: DataFrame, keys: Iterable[str], year: str = "year", value: str = "v", threshold: float = 0.025, scale: float = 1.0) -> DataFrame:
    """(keys, METRICS) of series with one row for each pixel and year; all null where a value is missing or there is one segment.

    Years must follow one another without a gap, and each have one row.
    """
    keys = list(keys)
    packed = series.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(year).cast("int").alias("t"), (F.col(value) * scale).cast("double").alias("v")))).alias("s"))
    flat = packed.select(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)), F.col("s.t").alias("t"), F.col("s.v").alias("v"))
    schema = ", ".join([*(f"k{i} {series.schema[k].dataType.simpleString()}" for i, k in enumerate(keys)), *(f"{m} double" for m in METRICS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            times, values = batch.column(len(keys)).to_pylist(), batch.column(len(keys) + 1).to_pylist()
            result = np.full((batch.num_rows, len(METRICS)), np.nan)
            spans: dict[tuple[int, int], list[int]] = {}
            for i, t in enumerate(times):
                if t != list(range(t[0], t[0] + len(t))):
                    raise ValueError(f"the years of a series must follow one another: {t[:20]}")
                spans.setdefault((t[0], len(t)), []).append(i)
            for (first, n), at in spans.items():
                y = np.array([[np.nan if v is None else v for v in values[i]] for i in at], np.float64)
                result[at] = change_metrics(np.arange(first, first + n), y, threshold)
            columns = [pa.array(result[:, j], mask=np.isnan(result[:, j])) for j in range(len(METRICS))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *columns], [f"k{i}" for i in range(len(keys))] + list(METRICS))

    return flat.mapInArrow(run, schema).toDF(*keys, *METRICS)


def segment_regression(rows: DataFrame, keys: Iterable[str], x: str, y: str) -> DataFrame:
    """(keys, n, slope, intercept, cost): regressions by group, the cost as in a merge."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    fit = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.regr_slope(b, a).alias("slope"), F.regr_intercept(b, a).alias("intercept"), F.regr_sxx(b, a).alias("sxx"), F.regr_syy(b, a).alias("syy"), F.regr_r2(b, a).alias("r2"))
    cost = F.try_divide((1 - F.col("r2")) * F.col("syy"), F.col("sxx")) / (F.col("n") - 2) * (F.col("n") - 1)
    return fit.select(*keys, "n", "slope", "intercept", F.when(F.col("n") > 2, cost).alias("cost"))


def strong(breaks: DataFrame, threshold: float = -200.0, magnitude: str = "change_magnitude") -> DataFrame:
    """Breaks at or below the magnitude."""
    return breaks.where(F.col(magnitude) <= threshold)
