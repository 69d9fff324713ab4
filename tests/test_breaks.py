"""Breaks against a plain restatement, one series at a time."""

import random

import numpy as np
import pytest

from landpulse.operators import breaks


def line(points):
    x, y = np.array([p[0] for p in points], float), np.array([p[1] for p in points], float)
    dx, dy = x - x.mean(), y - y.mean()
    slope = (dx * dy).sum() / (dx * dx).sum()
    left = ((dy - slope * dx) ** 2).sum()
    return slope, y.mean() - slope * x.mean(), left / (dx * dx).sum() / max(len(x) - 2, 1) * (len(x) - 1)


def plain(years, values, threshold):
    pts = list(zip(years, values, strict=True))
    if len(pts) % 2:
        pts = pts[1:]
    parts = [[i, i + 1] for i in range(0, len(pts), 2)]
    cost = lambda i: line(pts[parts[i][0] : parts[i + 1][1]])[2]
    costs = [cost(i) for i in range(len(parts) - 1)]
    while costs and min(costs) <= threshold:
        k = costs.index(min(costs))
        parts[k : k + 2] = [[parts[k][0], parts[k + 1][1]]]
        del costs[k]
        if k + 1 < len(parts) - 1:
            costs[k] = cost(k)
        if k > 0:
            costs[k - 1] = cost(k - 1)
    segs = []
    for a, b in parts:
        if b - a > 1:
            slope, icpt, _ = line(pts[a:b])
        else:
            slope = (pts[b][1] - pts[a][1]) / (pts[b][0] - pts[a][0])
            icpt = pts[a][1] - slope * pts[a][0]
        segs.append((pts[a][0], pts[b][0], slope, icpt))
    links = []
    for p, q in zip(segs, segs[1:], strict=False):
        ya, yb = p[3] + p[2] * p[1], q[3] + q[2] * q[0]
        slope = (yb - ya) / (q[0] - p[1])
        links.append((p[1], q[0], slope, ya - slope * p[1]))
    all_ = segs[:1] + links + segs[1:]
    if len(all_) == 1:
        return [None] * 10
    best, at = 99, 0
    for i, s in enumerate(all_):
        if s[2] < best:
            best, at = s[2], i
    out = []
    for i in (at - 1, at, at + 1):
        if 0 <= i < len(all_):
            a, b, slope, icpt = all_[i]
            m = [b - a, (icpt + slope * b) - (icpt + slope * a), slope]
        else:
            m = [None] * 3
        out += ([b] if i == at else []) + m
    return out


@pytest.mark.parametrize("n", [2, 3, 4, 7, 8, 20])
@pytest.mark.parametrize("threshold", [0.0, 0.025, 5.0, 1e9])
def test_as_plain(n, threshold):
    rng = random.Random(n)
    years = np.arange(2000, 2000 + n)
    y = np.array([[rng.uniform(0, 60) + (30 if i < n // 2 else 0) for i in range(n)] for _ in range(40)])
    got = breaks.change_metrics(years, y, threshold)
    for row, series in zip(got, y, strict=True):
        want = plain(years.tolist(), series.tolist(), threshold)
        assert [None if np.isnan(v) else pytest.approx(v, abs=1e-6) for v in row] == want


def test_missing_and_gaps(spark):
    rows = [(1, y, None if y == 2003 else 5.0) for y in range(2000, 2008)] + [(2, y, float((y * 7) % 5)) for y in range(2000, 2008)]
    out = {r[0]: r for r in breaks.detect(spark.createDataFrame(rows, "k int, year int, v double"), ["k"], threshold=0.01).collect()}
    assert all(v is None for v in out[1][1:]) and out[2]["change_year"] is not None
    with pytest.raises(Exception, match="follow one another"):
        breaks.detect(spark.createDataFrame([(1, 2000, 1.0), (1, 2002, 1.0)], "k int, year int, v double"), ["k"]).collect()
    assert breaks.detect(spark.createDataFrame([], "k int, year int, v double"), ["k"]).count() == 0
