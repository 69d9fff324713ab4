"""Substring dedup by prefix-partitioned suffix trees over words.

Suffixes are filed under prefixes of variable length, split into groups that
fit in memory, and each group's subtree is built by itself: suffixes in
lexicographic order and what neighbours have in common, which are the leaves
and the internal nodes of a tree. Internal nodes as deep as a window are the
repeats, and their leaves the places that hold them.

A prefix is read from a window's anchor on (see anchors.py), so many suffixes
that begin near one another share one and travel as one run of words. It has
K words at first; prefixes with too many suffixes grow, to both sides of the
anchor, until each group fits.
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
from .words import edges, split_words

#: Words of a window, and of a short prefix. Fixed by the contract and by taste.
WINDOW, K = 50, 8
#: Words of a group for which a subtree is built.
LOT = 200_000


def _starts(raw: bytes) -> np.ndarray:
    """Where words begin in raw, which has one space between them."""
    data = np.frombuffer(raw, np.uint8)
    return np.concatenate(([0], np.flatnonzero(data == 32) + 1, [len(data) + 1] if len(data) else [])).astype(np.int64)


def _values(texts: list[bytes]) -> Iterator[np.ndarray]:
    hashes, _, counts = split_words(texts)
    yield from np.split(hashes, np.cumsum(counts)[:-1])


KIND = anchors.Kind(WINDOW, K, 1, LOT, lambda text: b" ".join(text.split()), _starts, _values)


class Subtree:
    """The suffixes of codes that begin at places, down to a string depth, as the leaves (order) and branchings (shared) of a tree.

    order lists places, by number, as their suffixes sort; shared is what each
    has in common with the next. Suffixes are sorted by doubling: the rank at
    depth 2d is that of the rank at depth d and the rank d places on, so equal
    ranks mean equal elements. Each place needs depth codes from there on.
    """

    def __init__(self, codes: np.ndarray, places: np.ndarray, depth: int) -> None:
        levels, at = [codes.astype(np.int64)], 1
        spans = [1]
        while at < depth:
            step, level = min(at, depth - at), levels[-1]
            key = level[:-step] * (int(level.max(initial=0)) + 1) + level[step:] if len(level) > step else level[:0]
            levels.append(np.unique(key, return_inverse=True)[1])
            at += step
            spans.append(at)
        rank = levels[-1][places]
        self.order = np.argsort(rank, kind="stable")
        a, b = places[self.order[:-1]], places[self.order[1:]]
        self.shared = np.where(levels[-1][a] == levels[-1][b], depth, 0)
        differ = np.flatnonzero(self.shared == 0)
        for span, level in zip(spans[-2::-1], levels[-2::-1], strict=True):  # the longest whole levels first
            x, y = a[differ] + self.shared[differ], b[differ] + self.shared[differ]
            inside = np.maximum(x, y) < len(level)
            same = inside & (level[np.where(inside, x, 0)] == level[np.where(inside, y, 0)])
            self.shared[differ[same]] += span

    def tops(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(from, to) of the internal nodes of that string depth or more with none such above them: their leaves are order[from:to]."""
        begin, end = edges(np.append(self.shared >= least, False))
        return begin, end + 1

    def internal(self, least: int) -> Iterator[tuple[int, int, int]]:
        """(depth, from, to) of all internal nodes of that string depth or more, the deeper ones first; each is a repeat of that length that can't be longer to the right in all its leaves."""
        for begin, end in zip(*self.tops(least), strict=True):
            path: list[tuple[int, int]] = []
            for i, d in enumerate([*self.shared[begin : end - 1].tolist(), -1], int(begin)):
                left = i
                while path and path[-1][0] > d:
                    depth, left = path.pop()
                    yield depth, left, i + 1
                if d >= 0 and (not path or path[-1][0] < d):
                    path.append((d, left))


def _solve(lot: pa.Table) -> pa.RecordBatch:
    """For each window of each run that is a repeat, the least key of a document that has it: the least among the leaves of its internal node."""
    words = pa.array(b" ".join(lot["body"].to_pylist()).split(b" "), pa.binary())
    codes = words.dictionary_encode().indices.to_numpy()
    n, first, times = lot["n"].to_numpy().astype(np.int64), lot["first"].to_numpy(), lot["times"].to_numpy()
    length = n + WINDOW - 1
    seg = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(seg)) - np.repeat(np.cumsum(n) - n, n)
    tree = Subtree(codes, (np.cumsum(length) - length)[seg] + at, WINDOW)
    least = first[seg]
    begin, end = tree.tops(WINDOW)
    if len(begin):
        ends = np.stack((begin, end), axis=1).reshape(-1)
        low = np.minimum.reduceat(np.append(least[tree.order], np.iinfo(np.int64).max), ends)[::2]
        size = end - begin
        leaves = tree.order[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        least[leaves] = np.repeat(low, size)
    keep = (least < first[seg]) | (times[seg] > 1)
    return anchors.marks(lot, seg[keep], at[keep], least[keep])


def substring_dedup(docs: DataFrame, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, or with digest its SHA-256 in place of it) for each row of docs.

    Words are what ASCII white space separates, unchanged; the kept ones are
    joined by a space. Windows count as they stand in docs, also where an
    earlier document loses them. A null text has no words; texts of fewer than
    WINDOW words lose none; repeats within one document, or in rows with the
    same doc_id, don't count. A null doc_id is smaller than all. Other columns
    of docs aren't looked at.
    """
    base = keyed(docs)
    joined = base.join(anchors.marked_runs(base, KIND, _solve, "substring", across=True), ["key", "th"], "left").select("doc_id", "text", "key", "runs")
    last = "kept_sha256" if digest else "kept_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, gone in zip(texts_of(batch.column(1)), anchors.spans(batch.column(3), WINDOW, batch.column(2).to_numpy()), strict=True):
                words = text.split()
                counts.append(len(words))
                removed.append(sum(b - a for a, b in gone))
                for a, b in reversed(gone):
                    del words[a:b]
                text = b" ".join(words)
                kept.append(hashlib.sha256(text).hexdigest() if digest else text.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", last])
            tidy()

    return joined.mapInArrow(run, f"doc_id long, n_words long, n_removed long, {last} string")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), digest=True)


#: A window's place follows the one before it by less than WINDOW within a removed run, so runs and what lies between them come from places alone.
OP4_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(doc_id, -9223372036854775808) AS key, row_number() OVER () AS rn,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws FROM documents),
w AS (SELECT key, rn, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS win FROM (SELECT key, rn, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM d)),
h AS (SELECT rn, i FROM (SELECT key, rn, i, min(key) OVER (PARTITION BY win) AS least FROM w) WHERE least < key),
g AS (SELECT rn, i, lag(i) OVER v AS before, lead(i) OVER v AS after FROM h WINDOW v AS (PARTITION BY rn ORDER BY i)),
n AS (SELECT rn, sum(least({WINDOW}, coalesce(after - i, {WINDOW})))::BIGINT AS n_removed FROM g GROUP BY rn),
p AS (SELECT rn, coalesce(before + {WINDOW}, 1) AS lo, i - 1 AS hi FROM g WHERE before IS NULL OR i > before + {WINDOW}
      UNION ALL SELECT rn, i + {WINDOW}, 9223372036854775807 FROM g WHERE after IS NULL),
k AS (SELECT p.rn, string_agg(array_to_string(ws[lo:least(hi, len(ws))], ' '), ' ' ORDER BY lo) FILTER (lo <= least(hi, len(ws))) AS kept FROM p JOIN d ON d.rn = p.rn GROUP BY p.rn)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(CASE WHEN n.rn IS NULL THEN array_to_string(ws, ' ') ELSE coalesce(kept, '') END) AS kept_sha256
FROM d LEFT JOIN n ON n.rn = d.rn LEFT JOIN k ON k.rn = d.rn"""
