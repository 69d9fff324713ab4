"""Suffix-array dedup over bytes, the suffix arrays built by two-stage sorting.

Only suffixes smaller than their successors are sorted directly; a scan over
the buckets of first bytes induces the places of all others. Common prefixes
of neighbours in the array then show the repeats.

Texts come in lots: groups of runs of windows (see anchors.py), each different
run once, with the number of its copies, so copies are neither sorted nor sent
again. Every run whose anchor repeats goes through an array; groups beyond a
lot are split by longer prefixes until they fit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import anchors
from .bpe import texts_of
from .common import keyed, table, tidy

#: Bytes of a repeat, and of an anchor.
LENGTH, K = 200, 32
#: Bytes of runs in one suffix array.
LOT = 1 << 20
#: A random number for each byte.
_RANDOM = np.random.default_rng(20240501).integers(1, 1 << 63, 256, np.uint64)


def suffix_array(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """The suffixes of text (uint8) in the order of their first depth bytes; a suffix is smaller than those that it begins."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    # Whether a suffix is smaller than its successor: by the first byte that differs, the end below all.
    change = np.flatnonzero(text[1:] != text[:-1])
    upto = np.searchsorted(change, np.arange(n))
    small = np.zeros(n, bool)
    has = upto < len(change)
    edge = change[upto[has]]
    small[has] = text[edge] < text[edge + 1]
    # First stage: the smaller ones, sorted directly.
    direct = np.flatnonzero(small)
    padded = np.concatenate((text, np.zeros(depth, np.uint8)))
    keys = np.lib.stride_tricks.sliding_window_view(padded, depth)[direct]
    direct = direct[np.argsort(np.ascontiguousarray(keys).view(f"S{depth}").reshape(-1), kind="stable")]
    cuts = np.searchsorted(text[direct], np.arange(257))
    # Second stage: bucket by bucket, each suffix in order puts its predecessor, if that is larger, next in the bucket of its byte.
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([n - 1]))
    done = []

    def put(found: np.ndarray, byte: int) -> np.ndarray:
        """Files the predecessors in later buckets; returns those of this one."""
        before = found[found > 0] - 1
        before = before[~small[before]]
        own = text[before]
        later = before[own > byte]
        if len(later):
            later = later[np.argsort(text[later], kind="stable")]
            values, begin = np.unique(text[later], return_index=True)
            for v, part in zip(values.tolist(), np.split(later, begin[1:]), strict=True):
                waiting[v].append(part)
        return before[own == byte]

    for byte in range(256):
        now = np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, np.int64)
        while len(now):
            done.append(now)
            now = put(now, byte)
        now = direct[cuts[byte] : cuts[byte + 1]]
        if len(now):
            done.append(now)
            put(now, byte)
    return np.concatenate(done)


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """How many bytes, at most `most`, each suffix of order shares with the one before it; 0 for the first."""
    padded = np.concatenate((text, np.zeros(most + 8, np.uint8)))
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    out = np.zeros(len(order), np.int64)
    live, depth = np.arange(1, len(order)), 0
    while len(live) and depth < most:
        differ = eight[order[live] + depth] ^ eight[order[live - 1] + depth]
        equal = differ == 0
        low = differ[~equal] & -differ[~equal]
        out[live[~equal]] = depth + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
        live, depth = live[equal], depth + 8
    out[live] = depth
    return np.minimum(out, most)


def _solve(lot: pa.Table) -> pa.RecordBatch:
    """The windows of runs that stand more than once: in copies of the run, or elsewhere in the suffix array."""
    n, times = lot["n"].to_numpy().astype(np.int64), lot["times"].to_numpy()
    text = np.frombuffer(b"".join(lot["body"].to_pylist()), np.uint8)
    length = n + LENGTH - 1
    begin = np.cumsum(length) - length
    owner = np.repeat(np.arange(len(n)), length)
    order = suffix_array(text)
    order = order[order - begin[owner[order]] < n[owner[order]]]  # suffixes with a whole window in their run
    same = common_prefixes(text, order) >= LENGTH
    hit = np.zeros(len(text), bool)
    hit[order[same]] = True
    hit[order[np.flatnonzero(same) - 1]] = True
    seg = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(seg)) - np.repeat(np.cumsum(n) - n, n)
    keep = hit[begin[seg] + at] | (times[seg] > 1)
    return anchors.marks(lot, seg[keep], at[keep], np.zeros(int(keep.sum()), np.int64))


def _values(texts: list[bytes]) -> Iterator[np.ndarray]:
    for t in texts:
        yield _RANDOM[np.frombuffer(t, np.uint8)]


KIND = anchors.Kind(LENGTH, K, 0, LOT, lambda text: text, lambda raw: None, _values)


def suffix_dedup(docs: DataFrame, digest: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, or with digest its SHA-256 in place of it) for each row of docs.

    kept is binary: what is left needn't be whole characters. Every copy goes,
    the first included, overlapping ones and those within one text too; rows
    that are given twice are copies of each other. A null text is empty; texts
    of fewer than LENGTH bytes lose nothing. Other columns of docs aren't
    looked at.
    """
    base = keyed(docs)
    joined = base.join(anchors.marked_runs(base, KIND, _solve, "suffixes", across=False), ["key", "th"], "left").select("doc_id", "text", "runs")
    last = "kept_sha256" if digest else "kept"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, gone in zip(texts_of(batch.column(1)), anchors.spans(batch.column(2), LENGTH), strict=True):
                ends = [0, *(x for s in gone for x in s), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
                rows.append((len(text), len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest() if digest else kept))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string() if digest else pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", last])
            tidy()

    return joined.mapInArrow(run, f"doc_id long, n_bytes long, n_removed long, n_spans long, {last} {'string' if digest else 'binary'}")


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), digest=True)


#: Bytes as two hexadecimal digits each. Strings are told apart by MD5, which keeps the query within memory.
OP6_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rn, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT rn, i, md5(substr(x, 2 * i + 1, {2 * LENGTH})) AS m FROM (SELECT rn, x, unnest(range(0, length(x) // 2 - {LENGTH - 1})) AS i FROM d)),
h AS (SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY m) AS c FROM w) WHERE c > 1),
g AS (SELECT rn, i, lag(i) OVER v AS before, lead(i) OVER v AS after FROM h WINDOW v AS (PARTITION BY rn ORDER BY i)),
n AS (SELECT rn, sum(least({LENGTH}, coalesce(after - i, {LENGTH})))::BIGINT AS n_removed, count(*) FILTER (before IS NULL OR i > before + {LENGTH}) AS n_spans FROM g GROUP BY rn),
p AS (SELECT rn, coalesce(before + {LENGTH}, 0) AS lo, i AS hi FROM g WHERE before IS NULL OR i > before + {LENGTH}
      UNION ALL SELECT rn, i + {LENGTH}, 2000000000 FROM g WHERE after IS NULL),
k AS (SELECT p.rn, string_agg(substr(x, 2 * lo + 1, 2 * (hi - lo)), '' ORDER BY lo) AS kept FROM p JOIN d ON d.rn = p.rn GROUP BY p.rn)
SELECT doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN n.rn IS NULL THEN x ELSE kept END)) AS kept_sha256
FROM d LEFT JOIN n ON n.rn = d.rn LEFT JOIN k ON k.rn = d.rn"""
