"""Where equal windows of documents can be: runs of windows, grouped by prefixes of variable length.

Every window of `width` elements (words or bytes) has an anchor, the gram of
`gram` elements in it with the least hash, the leftmost of equals. Equal
windows have equal anchors at equal offsets, so all copies of a window meet
under one anchor, and neighbouring windows with the same anchor travel
together as one run. An anchor that stands once rules its windows out,
whatever they hold; equal runs (by 128 bits of BLAKE2 over their bytes) are
read once, with their number.

Runs of one anchor are a group. A group that is too large for one task is
split: the windows of a run whose anchor lies in the front half of the
offsets have more in common behind it, those of the rear half before it, so
the part that all windows of a half share, anchor included, is a longer
prefix by which they are filed anew. Halves are split again until groups fit;
at the last step the prefix is the window itself, and a group one row.
"""

from __future__ import annotations

import dataclasses
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import sliced, texts_of
from .common import HOT, discard, join_split, keyed, tidy, written
from .words import STEPS, mixed_up

#: Elements taken at a time; longer texts go piece by piece. Positions have PLACE bits beside a hash's upper ones.
PIECE, PLACE = 1 << 20, 21


@dataclasses.dataclass(frozen=True)
class Kind:
    """What windows consist of: elements that lie one after another in bytes, gap bytes apart."""

    width: int
    gram: int
    gap: int
    #: The most elements of a group.
    lot: int
    #: The bytes of a text.
    normal: Callable[[bytes], bytes]
    #: Where elements begin, and where one more would; None where bytes are the elements.
    starts: Callable[[bytes], np.ndarray | None]
    #: Hashes of the elements of each of several normal texts.
    values: Callable[[list[bytes]], Iterator[np.ndarray]]

    @property
    def reach(self) -> int:
        """Offsets that an anchor can have."""
        return self.width - self.gram + 1

    def cut(self, raw: bytes, starts: np.ndarray | None, at: int, n: int) -> bytes:
        return raw[at : at + n] if starts is None else raw[starts[at] : starts[at + n] - self.gap]


def grams(values: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k values (k a power of two) from each place on; shorter by k - 1 than values."""
    out, span, step = values, 1, 0
    while span < k:
        out = out[:-span] * STEPS[step] + out[span:] if len(out) > span else out[:0]
        span, step = 2 * span, step + 1
    return mixed_up(out)


def runs_in(values: np.ndarray, width: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, number of windows, anchor's hash, its offset in the first window) of the runs in one sequence of fewer than 2^PLACE values."""
    n = len(values) - width + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), none
    h = grams(values, k)
    mask = np.uint64((1 << PLACE) - 1)
    least = (h & ~mask) | np.arange(len(h), dtype=np.uint64)
    reach, span = width - k + 1, 1
    while 2 * span <= reach:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:n], least[reach - span : reach - span + n]) & mask
    start = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
    place = least[start].astype(np.int64)
    return start, np.diff(np.concatenate((start, [n]))), h[place], place - start


def pieces(n: int, width: int) -> Iterator[tuple[int, int]]:
    """Parts of a sequence of n elements that between them hold each window once."""
    for a in range(0, max(n - width + 1, 0), PIECE):
        yield a, min(n, a + PIECE + width - 1)


def digests(bodies: Iterator[bytes]) -> np.ndarray:
    """128 bits of each body, as a row of two longs."""
    return np.frombuffer(b"".join(hashlib.blake2b(b, digest_size=16).digest() for b in bodies), "<i8").reshape(-1, 2)


RUNS = "key long, th long, anchor long, s1 long, s2 long, start int, n int, at int"
#: What tells equal runs of a group.
RUN = ["group", "s1", "s2"]


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields, strict=True)], [f for f, _ in fields])


def candidates(docs: DataFrame, kind: Kind, name: str, across: bool) -> DataFrame:
    """Runs whose anchor stands more than once (across: in documents with different keys), as a written table: RUNS, with anchor as group.

    Anchors that hold more than 1/HOT of all runs, HOT of them at most, are
    looked up where their runs are; the runs of all others move to their anchor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, hashes, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), texts_of(batch.column(2))
            for part in sliced(texts, PIECE):
                rows = []
                raws = [kind.normal(texts[i]) for i in part]
                for i, raw, values in zip(part, raws, kind.values(raws), strict=True):
                    starts = kind.starts(raw)
                    for a, b in pieces(len(values), kind.width):
                        start, n, anchor, at = runs_in(values[a:b], kind.width, kind.gram)
                        start += a
                        s = digests(kind.cut(raw, starts, x, y + kind.width - 1) for x, y in zip(start.tolist(), n.tolist(), strict=True))
                        rows.append((np.full(len(start), keys[i]), np.full(len(start), hashes[i]), anchor.view(np.int64), s[:, 0], s[:, 1], start.astype(np.int32), n.astype(np.int32), at.astype(np.int32)))
                if rows:
                    yield _batch(RUNS, [np.concatenate(c) for c in zip(*rows, strict=True)])
            tidy()

    runs = written(keyed(docs).select("key", "th", "text").mapInArrow(run, RUNS), f"{name}-runs")
    known = runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("times"), *([F.min("key").alias("lo"), F.max("key").alias("hi")] if across else []))
    repeated = written(known.where("lo < hi" if across else "times > 1").select("anchor", "times"), f"{name}-anchors")
    hot = repeated.where(F.col("times") * HOT > runs.count()).select("anchor")
    found = written(join_split(runs, repeated.select("anchor"), ["anchor"], hot).withColumnRenamed("anchor", "group"), f"{name}-candidates")
    discard(runs, repeated)
    return found


PARTS = "group long, s1 long, s2 long, times long, first long, at int, n int, body binary"


def _bodies(docs: DataFrame, different: DataFrame, kind: Kind) -> DataFrame:
    """different (RUN, times, at, n, rep: a place; large, if it has that) with the bytes of each run: PARTS (and large); first is the place's key."""
    flags = [c for c in different.columns if c == "large"]
    schema = ", ".join([PARTS, *(f"{c} boolean" for c in flags)])
    runs = F.collect_list(F.struct(*RUN, "times", "at", "n", F.col("rep.start").alias("start"), *flags))
    by_doc = different.groupBy(F.col("rep.key").alias("key"), F.col("rep.th").alias("th")).agg(runs.alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = texts_of(batch.column(1)), batch.column(2)
            for i, key in enumerate(batch.column(0).to_pylist()):
                raw, rows = kind.normal(texts[i]), lists[i].values
                starts = kind.starts(raw)
                cuts = zip(rows.field("start").to_pylist(), rows.field("n").to_pylist(), strict=True)
                yield _batch(schema, [*(rows.field(c) for c in (*RUN, "times")), np.full(len(rows), key), rows.field("at"), rows.field("n"), [kind.cut(raw, starts, x, y + kind.width - 1) for x, y in cuts], *(rows.field(c) for c in flags)])
            tidy()

    # One row for a text, however often it is given.
    one = docs.select("key", "th", "text").join(by_doc, ["key", "th"]).dropDuplicates(["key", "th"])
    return one.select("key", "text", "runs").mapInArrow(run, schema)


def _extended(rows: DataFrame, kind: Kind, halves: list[tuple[int, int]], name: str) -> DataFrame:
    """Parts of rows (PARTS) for each range of offsets in halves, filed under what all windows of a range share: PARTS, then of: the row that they are of, and shift: their place in it. A written table."""
    schema = f"{PARTS}, of_group long, of_s1 long, of_s2 long, shift int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n, bodies = batch.column("at").to_numpy(), batch.column("n").to_numpy(), batch.column("body").to_pylist()
            for lo, hi in halves:
                most, least = np.minimum(at, hi - 1), np.maximum(at - n + 1, lo)
                own = np.flatnonzero(most >= least)
                shift, size = at[own] - most[own], most[own] - least[own] + 1
                parts, prefixes = [], []
                for i, a, m in zip(own.tolist(), shift.tolist(), size.tolist(), strict=True):
                    starts = kind.starts(bodies[i])
                    parts.append(kind.cut(bodies[i], starts, a, m + kind.width - 1))
                    place = int(at[i])
                    prefixes.append(b"%d:%d:" % (lo, hi) + kind.cut(bodies[i], starts, place - lo, kind.width - (hi - 1 - lo)))
                parent = batch.take(pa.array(own))
                s = digests(parts)
                yield _batch(schema, [digests(prefixes)[:, 0], s[:, 0], s[:, 1], parent.column("times"), parent.column("first"), most[own], size, parts, *(parent.column(c) for c in RUN), shift])
            tidy()

    return written(rows.mapInArrow(run, schema), f"{name}-parts")


def _sizes(rows: DataFrame, kind: Kind, name: str) -> tuple[DataFrame, DataFrame] | None:
    """Groups of rows beyond kind.lot elements, and those of them with more than 1/HOT of all rows; None if there are none."""
    sizes = rows.groupBy("group").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("n") + kind.width - 1).alias("size"))
    large = written(sizes.where(F.col("size") > kind.lot), f"{name}-large")
    if large.isEmpty():
        return None
    return large.select("group"), large.where(F.col("rows") * HOT > rows.count()).select("group")


def _inside(rows: DataFrame, large: tuple[DataFrame, DataFrame] | None) -> DataFrame:
    return join_split(rows, large[0], ["group"], large[1])


def _outside(rows: DataFrame, large: tuple[DataFrame, DataFrame] | None) -> DataFrame:
    return rows if large is None else rows.join(F.broadcast(large[1]), "group", "left_anti").join(large[0], "group", "left_anti")


def _cuts(whole: pa.Table, kind: Kind) -> list[int]:
    """Where lots of whole groups begin: each has kind.lot elements at most, or one group. The last one may go on."""
    group = whole["group"].to_numpy()
    begin = np.concatenate(([0], np.flatnonzero(group[1:] != group[:-1]) + 1))
    upto = np.cumsum(np.add.reduceat(whole["n"].to_numpy().astype(np.int64) + kind.width - 1, begin))
    cuts, at = [0], 0
    while (to := max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + kind.lot, "right")))) < len(begin):
        at = to
        cuts.append(int(begin[at]))
    return cuts


def _lots(rows: DataFrame, kind: Kind, solve: Callable[[pa.Table], pa.RecordBatch]) -> DataFrame:
    """solve's MARKS over whole groups, as many at a time as a lot holds, however many come in one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += pc.sum(batch.column("n")).as_py() + batch.num_rows * (kind.width - 1)
            if size < kind.lot:
                continue
            whole = pa.Table.from_batches(held)
            cuts = _cuts(whole, kind)
            for a, b in zip(cuts, cuts[1:], strict=False):
                yield solve(whole.slice(a, b - a))
                tidy()
            rest = whole.slice(cuts[-1])
            # A copy: a slice would keep all of its batches.
            held = rest.take(pa.array(range(len(rest)))).to_batches()
            size = sum(pc.sum(b.column("n")).as_py() + b.num_rows * (kind.width - 1) for b in held)
            del whole, rest
        if held:
            whole = pa.Table.from_batches(held)
            cuts = _cuts(whole, kind)
            for a, b in zip(cuts, [*cuts[1:], len(whole)], strict=True):
                yield solve(whole.slice(a, b - a))
                tidy()

    return rows.repartition("group").sortWithinPartitions("group").mapInArrow(run, MARKS)


def marks(lot: pa.Table, seg: np.ndarray, at: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
    """MARKS: stretches of neighbouring windows (at) of a run (seg, by its place in the lot), with equal first."""
    if len(seg):
        new = np.concatenate(([True], (seg[1:] != seg[:-1]) | (at[1:] != at[:-1] + 1) | (first[1:] != first[:-1])))
        begin = np.flatnonzero(new)
        n = np.diff(np.concatenate((begin, [len(seg)])))
        seg, at, first = seg[begin], at[begin], first[begin]
    else:
        n = at
    return _batch(MARKS, [*(lot[c].to_numpy()[seg] for c in RUN), at.astype(np.int32), n.astype(np.int32), first.astype(np.int64)])


MARKS = "group long, s1 long, s2 long, at int, n int, first long"


def marked_runs(docs: DataFrame, kind: Kind, solve: Callable[[pa.Table], pa.RecordBatch], name: str, across: bool) -> DataFrame:
    """(key, th, runs): for each document its runs with marks, as start and marks (at, n, first). docs: as of keyed().

    solve sees groups whole (PARTS), each different run once, with times, how
    often it stands, and first, the least key that has it; it returns MARKS.
    """
    found = candidates(docs, kind, name, across)
    different = written(found.groupBy(*RUN, "at", "n").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("key", "th", "start")).alias("rep")), f"{name}-different")
    large = _sizes(different, kind, name)
    if large is None:
        solved = _lots(_bodies(docs, different, kind), kind, solve)
    else:  # texts move once, for both kinds of groups
        flagged = _outside(different, large).withColumn("large", F.lit(False)).unionByName(_inside(different, large).withColumn("large", F.lit(True)))
        bodies = written(_bodies(docs, flagged, kind), f"{name}-bodies")
        solved = _lots(bodies.where("not large").drop("large"), kind, solve).unionByName(_split(bodies.where("large").drop("large"), kind, solve, [(0, kind.reach)], name))
    solved = written(solved, f"{name}-marks")
    if large is not None:
        discard(bodies)
    of_run = solved.groupBy(*RUN).agg(F.collect_set(F.struct("at", "n", "first")).alias("marks"))
    hot = different.where(F.col("times") * HOT > found.count()).select(*RUN)
    parts = join_split(found, of_run, RUN, hot).select("key", "th", "start", "marks")
    return parts.groupBy("key", "th").agg(F.collect_list(F.struct("start", "marks")).alias("runs"))


def _split(rows: DataFrame, kind: Kind, solve: Callable[[pa.Table], pa.RecordBatch], ranges: list[tuple[int, int]], name: str) -> DataFrame:
    """MARKS of rows (PARTS) of groups that are too large, whose windows have offsets in one of ranges."""
    halves = [x for lo, hi in ranges for x in ((lo, (lo + hi) // 2), ((lo + hi) // 2, hi)) if x[0] < x[1]]
    parts = _extended(rows, kind, halves, name)
    merged = written(parts.groupBy(*RUN, "at", "n").agg(F.sum("times").alias("times"), F.min("first").alias("first"), F.first("body").alias("body")), f"{name}-merged")
    large = _sizes(merged, kind, name) if any(hi - lo > 1 for lo, hi in halves) else None
    columns = [x.split()[0] for x in PARTS.split(", ")]
    solved = _lots(_outside(merged, large).select(columns), kind, solve)
    if large is not None:
        solved = solved.unionByName(_split(_inside(merged, large).select(columns), kind, solve, halves, name))
    # A part's marks, as marks of the runs that it is of.
    solved = written(solved, f"{name}-marks")
    discard(merged)
    hot = parts.groupBy(*RUN).count().where(F.col("count") * HOT > parts.count()).select(*RUN)
    own = join_split(parts.select(*RUN, "of_group", "of_s1", "of_s2", "shift"), solved, RUN, hot)
    return own.select(*(F.col(f"of_{c}").alias(c) for c in RUN), (F.col("at") + F.col("shift")).cast("int").alias("at"), "n", "first")


def spans(runs: pa.Array, width: int, keys: np.ndarray | None = None) -> list[list[tuple[int, int]]]:
    """The maximal spans (from, to) that each document's marks cover; with keys, only marks whose first is less than the document's key count."""
    counts = pc.fill_null(pc.list_value_length(runs), 0).to_numpy(zero_copy_only=False)
    run = runs.flatten()
    start, lists = run.field("start").to_numpy(), run.field("marks")
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    mark = lists.flatten()
    doc = np.repeat(np.repeat(np.arange(len(runs)), counts), sizes)
    begin = np.repeat(start, sizes) + mark.field("at").to_numpy()
    end = begin + mark.field("n").to_numpy() + width - 1
    if keys is not None:
        keep = mark.field("first").to_numpy() < keys[doc]
        doc, begin, end = doc[keep], begin[keep], end[keep]
    order = np.lexsort((begin, doc))
    doc, begin, end = doc[order], begin[order], end[order]
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(runs))]
    if len(doc):
        wide = int(end.max()) + 1
        reach = np.maximum.accumulate(end + doc * wide)
        new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (begin[1:] + doc[1:] * wide > reach[:-1])))
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:], [len(doc)])) - 1
        for d, a, b in zip(doc[first].tolist(), begin[first].tolist(), (reach[last] - doc[last] * wide).tolist(), strict=True):
            out[d].append((a, b))
    return out
