"""Benchmark decontamination: passages within an edit distance of benchmark items.

Edits count words. The random walk of CGK turns a word sequence into a longer
one of fixed length, such that sequences at a small edit distance end up at a
small Hamming distance. Repeated bit-sampling LSH over windows of an item's
length then finds windows near it: each item stands in one bucket for each
repetition, windows are looked up in the buckets, and there are as many
repetitions as reach the target recall. An exact edit distance decides.

Which windows are embedded: an item of n words that d edits changed still has
a run of (n - d) / (d + 1) of its words, rounded up, untouched. So windows are
laid only where a document has such a run of an item, at its place in it;
that loses none within d edits. A run that many items share asks for one
window for each length and place, not for each item, and walks are shared by
all windows that begin at one place.

Items longer than LONGEST words are indexed by parts: d edits of the whole
leave one of c parts with at most d / c.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import sliced, texts_of
from .common import folded, table, tidy
from .toxicity import _WORD
from .words import PADDING, STEPS, edges, hashes, mixed_up

#: Edits allowed for a hundred words of an item, and the share of such passages that the LSH must find.
EDITS, RECALL = 20, 0.99
#: Walks tried at a time until the share is reached, and passages that are simulated for it.
LOT, SAMPLES = 16, 500
#: Benchmark items, and bytes of their texts, that go to the tasks at a time; more of them take several passes.
BLOCK, BLOCK_BYTES = 20_000, 8 << 20
#: Longest untouched run that a window needs, and longest window.
RUN, LONGEST = 4, 256
#: Places between texts that lie side by side: a window reaches less than LONGEST beyond its text, its edits less than that again.
GAP = 2 * LONGEST
#: Rows that are looked at together.
PAIRS = 1 << 21
_PAD = np.uint64(0)


def normal_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of words: runs of letters (lower-cased), digits and signs beyond ASCII."""
    texts = [folded(t) for t in texts]
    low = _WORD[np.frombuffer(b" ".join(texts) + b" " + PADDING, np.uint8)]
    begin, end = edges(low > 0)
    upto = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return hashes(low, begin, end), np.diff(np.concatenate(([0], np.searchsorted(begin, upto))))


def edit_distance(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the part of region nearest to item, the first of equals: words inserted, deleted or replaced."""
    m = len(region)
    cost, begin = np.zeros(m + 1, np.int64), np.arange(m + 1)
    places = np.arange(m + 1)
    for x in item:
        below = cost + 1  # the item's word is missing
        match = cost[:-1] + (region != x)
        new, src = below.copy(), begin.copy()
        better = match < new[1:]
        new[1:][better], src[1:][better] = match[better], begin[:-1][better]
        # words of the region beside it: the least cost to the left plus the distance
        base = new - places
        least = np.minimum.accumulate(base)
        origin = np.maximum.accumulate(np.where(base == least, places, 0))
        cost, begin = least + places, src[origin]
    end = int(cost.argmin())
    return int(cost[end]), int(begin[end]), end


def _salts(times: int, steps: int) -> np.ndarray:
    """The random choices of so many walks (columns), the same for every caller."""
    walk, step = np.arange(times, dtype=np.uint64), np.arange(steps, dtype=np.uint64)
    return mixed_up((step[:, None] << np.uint64(32)) + walk + STEPS[3])


def _walk(words: np.ndarray, begin: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """The place that each walk (column) has in words at each step (row), for each begin (last axis). A walk stays or moves on by the word that it sees."""
    at = np.repeat(begin[None], salts.shape[1], axis=0)
    out = np.empty((len(salts), *at.shape), np.int32)
    for j, salt in enumerate(salts):
        out[j] = at
        at = at + (((words[at] ^ salt[:, None]) * STEPS[2]) >> np.uint64(63)).astype(np.int64)
    return out


class Sampled:
    """Of each walk over a window of n words, the two steps whose words are hashed."""

    def __init__(self, n: int, times: int) -> None:
        # A walk moves at every other step or so, hence 2n steps see most of the window.
        rng = np.random.default_rng((n, 20240501))
        self.n, self.steps = n, rng.integers(0, 2 * n, (times, 2))

    def hashes(self, words: np.ndarray, begin: np.ndarray, places: np.ndarray, walked: np.ndarray | slice = slice(None)) -> np.ndarray:
        """A hash for each walk (row) and window (column), told apart by n and walk; 0 if a word lies behind the window. places: of _walk(), whose column walked is a window's."""
        times = len(self.steps)
        out = mixed_up(np.arange(times, dtype=np.uint64) + (np.uint64(self.n) << np.uint64(32)))[:, None]
        seen = True
        for k in (0, 1):
            at = places[self.steps[:, k], np.arange(times)][:, walked]
            x = np.where(at < begin + self.n, words[at], _PAD)
            seen = seen & (x != _PAD)
            out = mixed_up(out ^ x)
        return np.where(seen, np.maximum(out, np.uint64(1)), _PAD)


def _run(n: int, d: int) -> int:
    """Words of an untouched run that d edits leave of n words, RUN at most."""
    return min(RUN, -(-(n - d) // (d + 1)))


def _tuned(n: int, d: int, recall: float) -> int:
    """As many walks as find that share of simulated passages, and half of the others, to be on the safe side.

    A passage is n words after d random edits, among other words; it is found
    if a window that its untouched runs ask for shares a hash with the n words.
    """
    rng = np.random.default_rng((n, d))
    q, wide = _run(n, d), 5 * n + 2
    plain = np.zeros((SAMPLES, 3 * n + 1), np.uint64)
    plain[:, :n] = rng.integers(1, 1 << 63, (SAMPLES, n), np.uint64)
    text = rng.integers(1, 1 << 63, (SAMPLES, wide), np.uint64)
    begin, owner = [], []
    for i in range(SAMPLES):
        w = list(range(n))  # which of the words stands there, or -1 for another
        for _ in range(d):
            kind, at = rng.integers(3), int(rng.integers(len(w))) if w else 0
            w[at : at + (kind < 2 and bool(w))] = [-1] if kind else []
        e = np.array(w, np.int64)
        text[i, n + np.flatnonzero(e >= 0)] = plain[i, e[e >= 0]]
        run = e[: max(len(e) - q + 1, 0)] >= 0
        for j in range(1, q):
            run &= e[j : len(e) - q + 1 + j] == e[: len(e) - q + 1] + j
        starts = np.unique(np.flatnonzero(run) - e[: len(run)][run])
        begin.append(i * wide + n + starts)
        owner.append(np.full(len(starts), i))
    begin, owner = np.concatenate(begin), np.concatenate(owner)
    first = np.arange(SAMPLES) * plain.shape[1]
    hit, times = np.zeros(SAMPLES, bool), 0
    while hit.mean() < (1 + recall) / 2:
        times += LOT
        sampled = Sampled(n, times)
        sampled.steps, salts = sampled.steps[times - LOT :], _salts(times, 2 * n)[:, times - LOT :]
        own, other = (sampled.hashes(x.reshape(-1), at, _walk(x.reshape(-1), at, salts)) for x, at in ((plain, first), (text, begin)))
        hit[owner[((own[:, owner] == other) & (other != 0)).any(axis=0)]] = True
    return times


def _grams(words: np.ndarray, q: int) -> np.ndarray:
    out = words[: max(len(words) - q + 1, 0)]
    for j in range(1, q):
        out = out * STEPS[j + 1] + words[j : len(words) - q + 1 + j]
    return mixed_up(out)


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers of all ranges (begin, count) in a row."""
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


class Index:
    """Seeds and LSH buckets of a block of items."""

    def __init__(self, items: list[tuple[int | None, str | None]], edits: int = EDITS, recall: float = RECALL) -> None:
        found, counts = normal_words([(text or "").encode() for _, text in items])
        has = counts > 0
        self.ids = [i for (i, _), ok in zip(items, has.tolist(), strict=True) if ok]
        self.words = np.split(found, np.cumsum(counts[has])[:-1]) if self.ids else []
        self.allowed = [len(w) * edits // 100 for w in self.words]
        #: Parts: item, offset in it, and the kind (words, edits) of window that finds it.
        self.kinds: list[tuple[int, int]] = []
        numbers: dict[tuple[int, int], int] = {}
        parts, kinds = [], []
        for i, (w, d) in enumerate(zip(self.words, self.allowed, strict=True)):
            n = -(-len(w) // LONGEST)
            for a, b in zip([len(w) * k // n for k in range(n)], [len(w) * (k + 1) // n for k in range(n)], strict=True):
                kind = (b - a, min(d // n, (b - a) - 1))
                parts.append((i, a))
                kinds.append(numbers.setdefault(kind, len(numbers)))
        self.kinds = list(numbers)
        self.parts, self.kind_of = np.array(parts, np.int64).reshape(-1, 2), np.array(kinds, np.int64)
        self.sampled = [Sampled(n, _tuned(n, d, recall)) for n, d in self.kinds]
        self.salts = _salts(max((len(s.steps) for s in self.sampled), default=0), 2 * max((n for n, _ in self.kinds), default=0))
        self._fill()

    def _fill(self) -> None:
        seeds: dict[int, list[np.ndarray]] = {}
        keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for k, ((n, d), sampled) in enumerate(zip(self.kinds, self.sampled, strict=True)):
            own = np.flatnonzero(self.kind_of == k)
            texts = np.stack([self.words[i][a : a + n] for i, a in self.parts[own].tolist()])
            q = _run(n, d)
            grams = np.stack([_grams(t, q) for t in texts])
            offset = np.broadcast_to(np.arange(grams.shape[1], dtype=np.uint64), grams.shape)
            distinct = np.unique(np.stack((grams.reshape(-1), offset.reshape(-1)), axis=1), axis=0)
            seeds.setdefault(q, []).append(np.column_stack((distinct, np.full(len(distinct), k, np.uint64))))
            padded = np.concatenate((texts, np.zeros((len(texts), 2 * n + 1), np.uint64)), axis=1)
            begin = np.arange(len(texts)) * padded.shape[1]
            places = _walk(padded.reshape(-1), begin, self.salts[: 2 * n, : len(sampled.steps)])
            found = sampled.hashes(padded.reshape(-1), begin, places)
            keys.append(found.reshape(-1))
            owners.append(np.broadcast_to(own, found.shape).reshape(-1))
        key, owner = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(key, kind="stable")
        order = order[key[order] != 0]
        self.buckets, self.owners = key[order], owner[order]
        self.seeds = {}
        for q, lots in seeds.items():
            rows = np.concatenate(lots)
            rows = rows[np.argsort(rows[:, 0], kind="stable")]
            maybe = np.zeros(1 << 20, bool)
            maybe[rows[:, 0] >> np.uint64(44)] = True
            self.seeds[q] = (rows[:, 0].copy(), rows[:, 1].astype(np.int64), rows[:, 2].astype(np.int64), maybe)
        # Words as numbers from 1, and where each part begins among them.
        self.vocabulary, codes = np.unique(np.concatenate([np.zeros(1, np.uint64), *self.words]), return_inverse=True)
        self.codes = codes[1:]
        self.code_at = np.cumsum([0, *map(len, self.words)])[self.parts[:, 0]] + self.parts[:, 1]

    def _windows(self, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, kind) of the windows that seeds ask for, in texts that lie GAP words apart."""
        found = [np.zeros(0, np.int64)]
        for q, (grams, offset, kind, maybe) in self.seeds.items():
            own = _grams(words, q)
            at = np.flatnonzero(maybe[own >> np.uint64(44)])
            lo, hi = np.searchsorted(grams, own[at]), np.searchsorted(grams, own[at], "right")
            text = np.searchsorted(bounds, at, "right") - 1
            ok = (hi > lo) & (at + q <= bounds[text + 1])
            at, lo, count = (at + GAP * (text + 1))[ok], lo[ok], (hi - lo)[ok]
            for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(np.cumsum(count) // PAIRS)) + 1) if len(at) else []:
                of = _ranges(lo[part], count[part])
                found.append(np.unique((np.repeat(at[part], count[part]) - offset[of]) * len(self.kinds) + kind[of]))
        both = np.unique(np.concatenate(found))
        return both // max(len(self.kinds), 1), both % max(len(self.kinds), 1)

    def _alike(self, words: np.ndarray, begin: np.ndarray, kind: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, part): pairs that share a bucket and enough words for a match."""
        sizes, slack = np.array([n for n, _ in self.kinds]), np.array([d for _, d in self.kinds])
        times = np.array([len(s.steps) for s in self.sampled])
        starts, of = np.unique(begin, return_inverse=True)
        step = max(1, PAIRS // max(1, self.salts.size // 4))
        for a in range(0, len(starts), step):
            own = np.flatnonzero((of >= a) & (of < a + step))
            longest, most = int(sizes[kind[own]].max()), int(times[kind[own]].max())
            places = _walk(words, starts[a : a + step], self.salts[: 2 * longest, :most])
            keys, window = [], []
            for k in np.unique(kind[own]).tolist():
                w = own[kind[own] == k]
                found = self.sampled[k].hashes(words, begin[w], places, of[w] - a)
                keys.append(found.reshape(-1))
                window.append(np.broadcast_to(w, found.shape).reshape(-1))
            key, window = np.concatenate(keys), np.concatenate(window)
            lo, hi = np.searchsorted(self.buckets, key), np.searchsorted(self.buckets, key, "right")
            ok = (hi > lo) & (key != 0)
            lo, count, window = lo[ok], (hi - lo)[ok], window[ok]
            order = np.argsort(window, kind="stable")
            lo, count, window = lo[order], count[order], window[order]
            cuts = np.flatnonzero(np.diff(np.cumsum(count) // PAIRS) & np.diff(window).astype(bool)) + 1 if len(window) else []
            for part in np.split(np.arange(len(window)), cuts) if len(window) else []:
                pair = np.unique(np.repeat(window[part], count[part]) * len(self.parts) + self.owners[_ranges(lo[part], count[part])])
                yield self._sharing(words, begin, pair // len(self.parts), pair % len(self.parts), sizes[kind], slack[kind])

    def _sharing(self, words: np.ndarray, begin: np.ndarray, window: np.ndarray, part: np.ndarray, size: np.ndarray, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs in which all words of the part but as many as edits are allowed stand in or beside the window: each other word costs an edit."""
        ok = np.zeros(len(window), bool)
        wide = len(self.vocabulary)
        own, row = np.unique(window, return_inverse=True)
        step = max(1, (1 << 24) // wide)
        for a in range(0, len(own), step):
            rows = own[a : a + step]
            count = size[rows] + 2 * slack[rows]
            near = words[_ranges(begin[rows] - slack[rows], count)]
            code = np.minimum(np.searchsorted(self.vocabulary, near), wide - 1)
            there = np.zeros((len(rows), wide), bool)
            there[np.repeat(np.arange(len(rows)), count), np.where(self.vocabulary[code] == near, code, 0)] = True
            there[:, 0] = False
            pairs = np.flatnonzero((row >= a) & (row < a + step))
            for at in np.split(pairs, range(1 << 16, len(pairs), 1 << 16)):
                n = size[window[at]]
                shared = there[np.repeat(row[at] - a, n), self.codes[_ranges(self.code_at[part[at]], n)]]
                ok[at] = np.add.reduceat(shared.astype(np.int64), np.cumsum(n) - n) >= n - slack[window[at]] if len(at) else False
        return window[ok], part[ok]

    def matches(self, words: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, edits, start, words) of the best match for each text and item; bounds: where texts begin and the last one ends."""
        begin, kind = self._windows(words, bounds)
        if not len(begin):
            return []
        counts = np.diff(bounds)
        edge = bounds[:-1] + GAP * (np.arange(len(counts)) + 1)
        apart = np.zeros(len(words) + GAP * (len(counts) + 2), np.uint64)
        apart[_ranges(edge, counts)] = words
        # Windows of equal words, with what is beside them, are looked up once.
        content = self._contents(apart, begin, kind)
        _, one, of = np.unique(content, return_index=True, return_inverse=True)
        copies, times = begin[np.argsort(of, kind="stable")], np.bincount(of)
        rows = [np.zeros((0, 3), np.int64)]
        for window, part in self._alike(apart, begin[one], kind[one]):
            n = times[window]
            at = copies[_ranges((np.cumsum(times) - times)[window], n)]
            rows.append(np.column_stack((np.searchsorted(edge + counts, at, "right"), np.repeat(self.parts[part, 0], n), at - np.repeat(self.parts[part, 1], n))))
        rows = np.concatenate(rows)
        rows = rows[np.lexsort(rows.T[::-1])]
        out = []
        for lot in np.split(rows, np.flatnonzero((np.diff(rows[:, :2], axis=0) != 0).any(axis=1)) + 1) if len(rows) else []:
            t, i, at = int(lot[0, 0]), int(lot[0, 1]), lot[:, 2]
            n, d = len(self.words[i]), self.allowed[i]
            # Regions are searched together, with more between them than edits are allowed.
            lots = np.split(at, np.flatnonzero(np.diff(at) > n + 2 * d) + 1)
            begins = np.maximum([x[0] - d for x in lots], edge[t])
            ends = np.minimum([x[-1] + n + d for x in lots], edge[t] + counts[t])
            size = ends - begins + d + 1
            where, upto = _ranges(begins, size), np.repeat(ends, size)
            edits, x, y = edit_distance(self.words[i], np.where(where < upto, apart[where], _PAD))
            if edits <= d:
                own = np.flatnonzero(where[x:y] < upto[x:y]) + x
                out.append((t, i, edits, int(where[own[0]] - edge[t]), len(own)))
        return out

    def _contents(self, words: np.ndarray, begin: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """A hash of each window's words and kind, and of as many words on both sides as edits are allowed."""
        sizes, slack = (np.array(x) for x in zip(*self.kinds, strict=True))
        factors = mixed_up(np.arange(2 * LONGEST, dtype=np.uint64) + STEPS[4])
        out = [np.zeros(0, np.uint64)]
        for a in range(0, len(begin), PAIRS // LONGEST):
            b, k = begin[a : a + PAIRS // LONGEST], kind[a : a + PAIRS // LONGEST]
            wide = sizes[k] + 2 * slack[k]
            held = words[_ranges(b - slack[k], wide)] * factors[_ranges(np.zeros(len(wide), np.int64), wide)]
            out.append(mixed_up(np.add.reduceat(mixed_up(held), np.cumsum(wide) - wide) + k.astype(np.uint64)))
        return np.concatenate(out)


def _blocks(benchmark: DataFrame, edits: int, recall: float, block: int) -> Iterator[Index]:
    """Indexes of about `block` items or BLOCK_BYTES of text each, whichever is less: what the driver and a task hold at a time."""
    items = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].cast("string").alias("text"))
    count, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    lots = max(-(-count // block), -(-size // BLOCK_BYTES))
    for lot in range(lots):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(lots)) == lot).collect()
        yield Index(sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")), edits, recall)


def _found(index: Index, texts: list[bytes]) -> Iterator[tuple[int, list[tuple]]]:
    """(first text, matches) for slices of texts."""
    for part in sliced(texts, 1 << 20):
        words, counts = normal_words([texts[i] for i in part])
        yield part.start, index.matches(words, np.concatenate(([0], np.cumsum(counts))))
    tidy()


def contaminated(docs: DataFrame, benchmark: DataFrame, edits: int = EDITS, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, edits, start, n_words): for each row of docs and each item that it holds within the edits allowed, the best place; words count from 0.

    Case, punctuation and line breaks don't count as words. A null or empty
    text holds nothing, an item without words is in nothing; rows of docs that
    are given twice are reported twice, items given twice once each. doc_id
    and item_id may be null. Other columns aren't looked at.

    Whole texts are searched, each by itself and without a shuffle; the index
    of at most about `block` items is what tasks hold of the benchmark.
    """
    spark = docs.sparkSession
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    schema = "doc_id long, item_id long, edits long, start long, n_words long"
    out = None
    for built in _blocks(benchmark, edits, recall, block):
        index = spark.sparkContext.broadcast(built)

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, found in _found(index.value, texts_of(batch.column(1))):
                    if found:
                        text, item, *rest = zip(*found, strict=True)
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([first + t for t in text])), pa.array([index.value.ids[i] for i in item], pa.int64()), *(pa.array(x, pa.int64()) for x in rest)], ["doc_id", "item_id", "edits", "start", "n_words"])

        lot = own.mapInArrow(run, schema)
        out = lot if out is None else out.unionByName(lot)
    return spark.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, edits: int = EDITS, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """The rows of docs, with all their columns, that hold no item of the benchmark (see contaminated)."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    out, at = docs.toDF(*names), docs.columns.index("text")
    for built in _blocks(benchmark, edits, recall, block):
        index = docs.sparkSession.sparkContext.broadcast(built)

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for first, found in _found(index.value, texts_of(batch.column(at))):
                    keep[[first + t for t, *_ in found]] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(run, out.schema)
    return out.toDF(*docs.columns)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
