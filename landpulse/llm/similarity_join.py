"""N-gram Jaccard join by token-combination prefixes.

A text is the set of its word shingles. Tokens are put in one global order,
rare ones before frequent ones and by hash within either class. Of each set a
prefix is indexed: its rare tokens singly, its frequent ones in combinations
of two from one range of hashes. The prefix reaches so far that no similar
set can avoid all of its signatures:

With t the threshold, a set s differs from a similar one in at most
tau = |s| - ceil(t |s|) of its tokens. If its prefix has m rare tokens and n_b
frequent ones in range b, then m + sum(max(0, n_b - 1)) > tau means that a
rare token or two of one range are shared; by the global order they lie in the
other set's prefix too. Ranges are cut by size class, and a set that may be
similar to one of the next class is indexed for both: with a threshold over
one half, no similar set is further off.

Candidates pass exact bounds (sizes, then counts or shortened tokens) and are
verified on whole sets. Connected components of the links are the result.

A signature that more than 1/HOT of all are (and more than BLOCK) is split:
each part has a pivot of its own, which is compared with the first. Where
pairs need what is known of both sets, that of the hub, a pivot that stands in
many, moves once for all its pairs, or once to each of SPREAD parts of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import sliced, texts_of
from .common import HOT, NO_ID, hot_keys, join_split, keyed, table, tidy, written
from .graph import components
from .words import STEPS, mixed_up, split_words

#: Words of a shingle and least similarity in percent where no contract says otherwise.
WORDS, PERCENT = 5, 80
#: Tokens of a lot of sets whose repeats are counted together.
LOT = 2_000_000
#: A token counted more often than FREQUENT_FROM is frequent; at most FREQUENT_MOST tokens, the commonest, get that class (the list goes to all tasks). Which tokens have it changes costs, never links.
FREQUENT_FROM, FREQUENT_MOST = 8, 200_000
#: Sets under one signature whose pairs are compared as they are; larger groups go by a pivot first.
GROUP = 16
#: Besides the pivot, a member of a larger group is compared with those so many places on in order of size.
NEIGHBOURS = (1, 2)
#: Members of such a group that one task compares with one another, or with as many others, at a time.
BLOCK = 4096
#: Tokens that such a block has at most, or hardly more, and one set at least.
TOKENS = 2_000_000
#: Parts into which the pairs of a hub with more than 1/HOT of all are dealt.
SPREAD = 256
#: One in so many sets is counted to find signatures that must be split.
SAMPLED = 16


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Each text's shingles as sorted distinct 64-bit hashes; with fewer than k words, one for the whole sequence."""
    hashes, _, counts = split_words([t.lower() for t in texts])
    ends = np.cumsum(counts)
    grams = hashes
    for j in range(1, k):
        grams = grams[: len(hashes) - j] * STEPS[j % len(STEPS)] + hashes[j:] if len(hashes) > j else hashes[:0]
    grams = mixed_up(grams)
    out = []
    for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            out.append(np.array([xxhash.xxh3_64_intdigest(hashes[a:b].tobytes(), seed=b - a)], np.uint64))
        else:
            out.append(hashes[:0])
    return out


def slack(n: int, percent: int) -> int:
    """Tokens of a set of n that a similar set may lack."""
    return n - (percent * n + 99) // 100


def scales(n: int, percent: int) -> set[int]:
    """Size classes (powers of two) of a set of n tokens and of the largest similar one."""
    return {n.bit_length() - 1, (100 * n // percent).bit_length() - 1}


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The set's signatures; frequent: the sorted list of frequent tokens."""
    n = len(tokens)
    need = slack(n, percent) + 1
    head = tokens[: 2 * need + 8]
    rare = head[~_among(head, frequent)]
    if len(rare) < need and len(head) < n:
        rare = tokens[~_among(tokens, frequent)]
    if len(rare) >= need:
        return rare[:need]
    often = tokens[_among(tokens, frequent)]
    out = [rare]
    for scale in scales(n, percent):
        ranges = (often >> np.uint64(32)) * np.uint64(_ranges(scale, percent)) >> np.uint64(32)
        # A token after the first of its range adds one to the sum.
        gained = np.cumsum(np.concatenate(([False], ranges[1:] == ranges[:-1])))
        upto = np.searchsorted(gained, need - len(rare)) + 1
        for part in np.split(often[:upto], np.flatnonzero(np.diff(ranges[:upto].astype(np.int64))) + 1):
            for d in range(1, len(part)):
                out.append(mixed_up(part[:-d] * STEPS[scale % 8] + part[d:] + np.uint64(scale)))
    return np.unique(np.concatenate(out))


def _ranges(scale: int, percent: int) -> int:
    """How many ranges of hashes a size class has: two to eight tokens of a set each, and fewer where the smallest set of the class would run out of pairs."""
    least = -(-percent * (1 << scale) // 100)
    return max(1, min((1 << scale) >> (2 if scale < 6 else 1), -(-percent * least // 100) - 1))


def _among(tokens: np.ndarray, listed: np.ndarray) -> np.ndarray:
    if not len(listed):
        return np.zeros(len(tokens), bool)
    return listed[np.minimum(np.searchsorted(listed, tokens), len(listed) - 1)] == tokens


def sketch(tokens: np.ndarray) -> bytes:
    """Counts of tokens by the upper bits of their hash, half a byte each, in a power of two of ranges, half the set's size to all of it; empty if a count is over 15."""
    bits = max(1, len(tokens).bit_length() - 1)
    counts = np.bincount((tokens >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return (counts[::2] << 4 | counts[1::2]).astype(np.uint8).tobytes() if counts.max() < 16 else b""


def sketch_bound(a: np.ndarray, b: np.ndarray) -> int:
    """At least as many as two sets with these sketches share."""
    if not len(a) or not len(b):
        return 1 << 60
    x, y = (np.stack((z >> 4, z & 15), axis=1).reshape(-1) for z in (a, b))
    if len(x) > len(y):
        x, y = y, x
    return int(np.minimum(x, y.reshape(len(x), -1).sum(axis=1)).sum())


def tags(tokens: np.ndarray) -> bytes:
    """The upper 16 bits of each token, in order."""
    return (tokens >> np.uint64(48)).astype("<u2").tobytes()


def tag_bound(a: np.ndarray, b: np.ndarray) -> int:
    """At least as many as two sets with these tags share, and hardly more."""
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    same = int((both[1:] == both[:-1]).sum())
    own = int((a[1:] == a[:-1]).sum()) + int((b[1:] == b[:-1]).sum())
    # Equal neighbours are common values or repeats within a set; repeats may be common again.
    return same - own + min(own, len(a), len(b)) if own else same


def linked(shared: int, n: int, m: int, percent: int) -> bool:
    return 100 * shared >= percent * (n + m - shared)


def _each(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[tuple[int, int]]]]:
    """Slices of batches (text last), their sets and 63 and 64 more bits of a hash of the sets (0 without words)."""
    for batch in batches:
        texts = texts_of(batch.columns[-1])
        for part in sliced(texts, 1 << 20):
            sets = shingle_sets([texts[i] for i in part], k)
            both = [xxhash.xxh3_128_intdigest(s.tobytes()) if len(s) else 0 for s in sets]
            yield batch.slice(part.start, len(part)), sets, [(x >> 65, (x & (1 << 64) - 1) - (1 << 63)) for x in both]
        tidy()


def _views(column: pa.Array, kind: str) -> Iterator[np.ndarray]:
    """Binary values as arrays, without a copy."""
    return (np.frombuffer(x.as_buffer(), kind) for x in column)


def _counted(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(token, n): tokens of first prefixes, each time they stand in a set, and of what lies behind them those that sets of one lot share.

    Tokens behind a first prefix matter where frequent ones in it push the
    prefix on; most of them are alone, and never leave their task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[tuple[int, int], np.ndarray] = {}

        def close() -> pa.RecordBatch:
            cuts = [slack(len(s), percent) + 2 for s in own.values()]
            first = np.concatenate([s[:c] for s, c in zip(own.values(), cuts, strict=True)])
            behind, times = np.unique(np.concatenate([s[c:] for s, c in zip(own.values(), cuts, strict=True)]), return_counts=True)
            tokens = np.concatenate((first, behind[times > 1]))
            counts = np.concatenate((np.ones(len(first), np.int64), times[times > 1]))
            own.clear()
            return pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(counts)], ["token", "n"])

        size = 0
        for _, sets, ids in _each(batches, k):
            own |= {i: s for i, s in zip(ids, sets, strict=True) if len(s)}
            size += sum(map(len, sets))
            if size >= LOT:
                if own:
                    yield close()
                size = 0
        if own:
            yield close()

    return docs.select("text").mapInArrow(run, "token long, n long")


def frequent_tokens(docs: DataFrame, k: int, percent: int, name: str) -> np.ndarray:
    """Sorted; counted over all documents. Counts are classed by size, and so many of the upper classes come as FREQUENT_MOST has room for."""
    often = _counted(docs, k, percent).groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") > FREQUENT_FROM)
    often = written(often.withColumn("class", F.floor(F.log2("n") * 8).cast("int")), f"{name}-frequent")
    least, room = None, FREQUENT_MOST
    for row in sorted(often.groupBy("class").count().collect(), reverse=True):  # some hundred classes at most
        room -= row["count"]
        if room < 0:
            break
        least = row["class"]
    if least is None:
        return np.zeros(0, np.uint64)
    return np.sort(often.where(F.col("class") >= least).select("token").toArrow()["token"].to_numpy().view(np.uint64))


def _sets(docs: DataFrame, k: int, percent: int, name: str) -> DataFrame:
    """A written row for each row of docs: key, th, n, sid (the set's id), sigs, sketch, tags; the last three are empty for copies within a slice.

    sid is 63 bits of a 127-bit hash; where sets that differ in the rest share them, all but those with the least rest get another id.
    """
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_tokens(docs, k, percent, name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets, ids in _each(batches, k):
            seen: set[tuple[int, int]] = set()
            sigs, sketches, tagged = [], [], []
            for s, i in zip(sets, ids, strict=True):
                new = len(s) > 0 and i not in seen
                seen.add(i)
                sigs.append(signatures(s, frequent.value, percent).view(np.int64) if new else np.zeros(0, np.int64))
                sketches.append(sketch(s) if new else None)
                tagged.append(tags(s) if new else None)
            ends = np.cumsum([0, *map(len, sigs)], dtype=np.int32)
            sid, rest = (pa.array([i[x] for i in ids], pa.int64()) for x in (0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([len(s) for s in sets], pa.int64()), sid, rest, pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*sigs, np.zeros(0, np.int64)]))), pa.array(sketches, pa.binary()), pa.array(tagged, pa.binary())], ["key", "th", "n", "sid", "rest", "sigs", "sketch", "tags"])

    sets = written(docs.select("key", "th", "text").mapInArrow(run, "key long, th long, n long, sid long, rest long, sigs array<long>, sketch binary, tags binary"), f"{name}-sets")
    shared = sets.where("n > 0").groupBy("sid").agg(F.min("rest").alias("lo"), F.max("rest").alias("hi")).where("lo <> hi").select("sid", "lo")
    return _told_apart(sets, shared, name).drop("rest")


def _told_apart(sets: DataFrame, shared: DataFrame, name: str) -> DataFrame:
    if shared.isEmpty():
        return sets
    other = F.when(F.col("lo") != F.col("rest"), F.xxhash64("sid", "rest").bitwiseAND(F.lit(2**63 - 1))).otherwise(F.col("sid"))
    return written(sets.join(shared, "sid", "left").withColumn("sid", other).drop("lo").select(sets.columns), f"{name}-sets")


def _split_signatures(sets: DataFrame, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sig, part, n, sid) for all signatures, part being -1 but for those that are split; pairs (a, b, hub) of the parts' pivots with the first of them; and that (sig, pivot)."""
    rows = sets.where("size(sigs) > 0").select(F.explode("sigs").alias("sig"), "n", "sid")
    total = sets.agg(F.sum(F.size("sigs"))).first()[0] or 0
    most = max(total // HOT, BLOCK)
    # Counted over every SAMPLED-th set: what is split changes costs, never links.
    counts = rows.where(F.expr(f"pmod(xxhash64(sid), {SAMPLED}) = 0")).groupBy("sig").count()
    hot = counts.where(F.col("count") * SAMPLED > most)  # 2 * HOT or so at most
    parts = F.ceil(F.col("count") * SAMPLED / most).cast("int")
    dealt = rows.join(F.broadcast(hot.select("sig", parts.alias("parts"))), "sig", "left").select("sig", F.coalesce(F.expr("pmod(xxhash64(sid), parts)").cast("long"), F.lit(-1).cast("long")).alias("part"), "n", "sid")
    pivots = written(dealt.where("part >= 0").groupBy("sig", "part").agg(F.min(F.struct("n", "sid")).alias("pivot")), f"{name}-pivots")
    first = pivots.groupBy("sig").agg(F.min("pivot")["sid"].alias("hub"))
    pairs = pivots.join(first, "sig").select(F.col("pivot.sid").alias("sid"), "hub").where("sid <> hub")
    return dealt, pairs.select(F.least("sid", "hub").alias("a"), F.greatest("sid", "hub").alias("b"), "hub"), first.select("sig", F.col("hub").alias("pivot"))


def _compare(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b, sig, n): candidates as a < b with the hub, a pivot, as sig, else null, and n null; of groups beyond GROUP, pairs with a pivot and with neighbours, and each member as (sid, pivot, sig, n), pivot null where the signature is split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 4), np.int64)
        big: tuple[int, int, int, int] | None = None  # signature, part and pivot of a large group that goes on

        def solve(x: np.ndarray, ended: bool) -> tuple[np.ndarray, pa.RecordBatch | None]:
            nonlocal big
            new = np.concatenate(([True], (x[1:] != x[:-1]).any(axis=1))) if len(x) else np.zeros(0, bool)
            x = x[new]
            begin = np.flatnonzero(np.concatenate(([True], (x[1:, :2] != x[:-1, :2]).any(axis=1)))) if len(x) else np.zeros(0, np.int64)
            size = np.diff(np.concatenate((begin, [len(x)])))
            keep = x[:0]
            large = (size > GROUP) | (x[begin, 1] >= 0)
            if len(x):
                if big and tuple(x[0, :2].tolist()) == big[:2]:
                    large[0] = True
                if not ended and not large[-1]:
                    keep, x, begin, size, large = x[begin[-1] :], x[: begin[-1]], begin[:-1], size[:-1], large[:-1]
            pairs, hubs, members, pivots = [], [], [], []
            whole = np.repeat(large, size)
            small = x[~whole]
            for d in range(1, GROUP):
                if len(small) <= d:
                    break
                at = np.flatnonzero((small[:-d, :2] == small[d:, :2]).all(axis=1))
                if not len(at):
                    break
                ok = at[100 * small[at, 2] >= percent * small[at + d, 2]]
                pairs.append(np.stack((small[ok, 3], small[ok + d, 3]), axis=1))
            for g in np.flatnonzero(large).tolist():
                own = x[begin[g] : begin[g] + size[g]]
                if not big or big[:2] != tuple(own[0, :2].tolist()):
                    big = tuple(own[0].tolist())
                members.append(own)
                pivots.append(np.full(len(own), big[3] if big[1] < 0 else -1))
                ok = (100 * big[2] >= percent * own[:, 2]) & (own[:, 3] != big[3])
                hubs.append(np.stack((np.full(int(ok.sum()), big[3]), own[ok, 3]), axis=1))
                for d in NEIGHBOURS:  # those next in size, who are the likeliest to be linked
                    ok = 100 * own[:-d, 2] >= percent * own[d:, 2]
                    pairs.append(np.stack((own[:-d, 3][ok], own[d:, 3][ok]), axis=1))
            none = np.zeros((0, 2), np.int64)
            plain = np.unique(np.sort(np.concatenate([none, *pairs]), axis=1), axis=0)
            hub = np.unique(np.concatenate([none, *hubs]), axis=0)
            member, pivot = np.concatenate([x[:0], *members]), np.concatenate([np.zeros(0, np.int64), *pivots])
            if not len(plain) + len(hub) + len(member):
                return keep, None
            pair = np.concatenate((plain, np.sort(hub, axis=1)))
            lacks = [np.repeat(v, (len(plain), len(hub), len(member))) for v in ([False, False, False], [True, False, False], [True, True, False])]
            lacks[0][len(pair) :] = pivot < 0
            values = [np.concatenate((pair[:, 0], member[:, 3])), np.concatenate((pair[:, 1], pivot)), np.concatenate((plain[:, 0], hub[:, 0], member[:, 0])), np.concatenate((pair[:, 0], member[:, 2]))]
            return keep, pa.RecordBatch.from_arrays([pa.array(values[0]), *(pa.array(v, mask=m) for v, m in zip(values[1:], lacks, strict=True))], ["a", "b", "sig", "n"])

        for batch in batches:
            x = np.concatenate((held, np.stack([c.to_numpy() for c in batch.columns], axis=1)))
            held, out = solve(x, False)
            if out is not None:
                yield out
        held, out = solve(held, True)
        if out is not None:
            yield out

    return rows.repartition("sig", "part").sortWithinPartitions("sig", "part", "n", "sid").mapInArrow(run, "a long, b long, sig long, n long")


def _where(pairs: DataFrame, known: DataFrame, linkable: Callable[[np.ndarray, np.ndarray], bool], kind: str) -> DataFrame:
    """The pairs (a, b; hub, one of them or null) for which linkable holds; known: sid, data (binary, read as arrays of that kind)."""
    hub = F.coalesce("hub", "a")
    sided = pairs.select(hub.alias("hub"), F.when(hub == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("other"))
    hot = hot_keys(sided.groupBy("hub").count(), "hub", "count").withColumn("parts", F.lit(SPREAD))
    dealt = sided.join(F.broadcast(hot), "hub", "left").select("hub", "other", F.expr("pmod(xxhash64(other), coalesce(parts, 1))").alias("part"))
    hubs = dealt.select("hub", "part").distinct().join(known, F.col("hub") == known["sid"]).select("hub", "part", F.lit(None).cast("long").alias("other"), "data")
    others = dealt.join(known, F.col("other") == known["sid"]).select("hub", "part", "other", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, of = None, None
        for batch in batches:
            hub, other = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            ok = []
            for i, (h, o, data) in enumerate(zip(hub, other, batch.column(3), strict=True)):
                x = np.frombuffer(data.as_buffer(), kind)
                if o is None:  # the hub's own data, before all others
                    own, of = x.copy(), h
                elif h == of and linkable(own, x):
                    ok.append(i)
            found = np.array([(hub[i], other[i]) for i in ok], np.int64).reshape(-1, 2)
            found.sort(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1]), pa.array([hub[i] for i in ok], pa.int64())], ["a", "b", "hub"])
            tidy()

    return hubs.unionByName(others).repartition("hub", "part").sortWithinPartitions("hub", "part", F.col("other").asc_nulls_first()).mapInArrow(run, "a long, b long, hub long")


def _likely(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, hub) whose sketches don't rule a link out."""
    known = sets.where("sketch is not null").groupBy("sid").agg(F.first(F.concat(F.expr("cast(reverse(unhex(lpad(hex(n), 8, '0'))) as binary)"), "sketch")).alias("data"))

    def linkable(x: np.ndarray, y: np.ndarray) -> bool:
        n, m = (int(z[:4].view("<u4")[0]) for z in (x, y))
        return linked(min(sketch_bound(x[4:], y[4:]), n, m), n, m, percent)

    return _where(pairs, known, linkable, "u1")


def _counts(sketches: np.ndarray, bits: int) -> np.ndarray:
    """A row of counts by the upper bits for each sketch."""
    return np.stack([np.bincount(s >> np.uint16(16 - bits) if bits else np.zeros(len(s), np.int64), minlength=1 << bits) for s in sketches]).astype(np.uint16)


def _near(x: dict[str, np.ndarray], y: dict[str, np.ndarray], percent: int, wanted: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """(k, c): members of one block and, of those of another that are wanted when the first one's turn comes, all whose sizes and counts of tokens allow a link; both by their place, at."""
    for bits in sorted(set(x["bits"].tolist())):
        for other in sorted(set(y["bits"].tolist())):
            p, q = np.flatnonzero(x["bits"] == bits), np.flatnonzero(y["bits"] == other)
            if abs(bits - other) > 1:
                continue  # one is more than twice as large, or just too large
            # Counts of tokens by ranges of hashes, a few tokens each, then fewer.
            fine = max(1, min(bits, other, 10))
            levels = [[_counts(z["tags"][at], b) for z, at in ((x, p), (y, q))] for b in (max(0, fine - 2), fine)]
            n, place = y["n"][q], y["at"][q]
            for row, k in enumerate(p.tolist()):
                m = x["n"][k]
                at = np.flatnonzero(100 * np.minimum(m, n) >= percent * np.maximum(m, n))
                at = at[wanted(int(x["at"][k]), place[at])]
                for left, right in levels:
                    if len(at):
                        shared = np.minimum(np.minimum(right[at], left[row]).sum(axis=1, dtype=np.int64), np.minimum(m, n[at]))
                        at = at[100 * shared >= percent * (m + n[at] - shared)]
                if len(at):
                    yield int(x["at"][k]), place[at]


def _in_blocks(rows: DataFrame, data: DataFrame, solve: Callable[[pa.Table, dict[str, np.ndarray], tuple[dict, dict], bool], pa.RecordBatch], kind: str, schema: str) -> DataFrame:
    """What solve makes of members (pivot, sid, n, part and more) of more than one part and their data (sid, data: arrays of that kind), dealt to pairs of blocks in which each two with one pivot meet once.

    A block has about BLOCK members or TOKENS tokens, whichever are fewer. solve
    gets its rows, columns of them (data as tags too), the two blocks, each
    with its members' places as at, and whether they are one.
    """
    groups = rows.groupBy("pivot").agg(F.min("part").alias("x"), F.max("part").alias("y"), F.count(F.lit(1)).alias("m"), F.sum("n").alias("tokens")).where("x < y")
    sizes = groups.select("pivot", F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("tokens") / TOKENS)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    dealt = join_split(rows, sizes, ["pivot"], hot_keys(groups, "pivot", "m")).join(data, "sid").withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("pivot", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", *rows.drop("pivot").columns, "data")

    def solved(group: pa.Table) -> pa.RecordBatch:
        x = {c: group[c].to_numpy() for c in ("block", "sid", "n", "part")} | {"at": np.arange(len(group))}
        x["data"] = np.array([*(np.frombuffer(v, kind) for v in group["data"].to_pylist()), None], object)[:-1]
        x["tags"] = x["data"] if kind == "<u2" else np.array([*((v >> np.uint64(48)).astype("<u2") for v in x["data"]), None], object)[:-1]
        x["bits"] = np.array([len(v).bit_length() for v in x["tags"]])
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        sides = tuple({c: v[x["block"] == b] for c, v in x.items() if c in ("at", "n", "tags", "bits")} for b in (i, j))
        return solve(group, x, sides, i == j)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def ready(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            whole = pa.Table.from_batches(held)
            key = np.stack([whole[c].to_numpy() for c in ("pivot", "i", "j")], axis=1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
            for a, b in zip(cuts, cuts[1:] if last else cuts[1:-1], strict=False):
                if b - a > 1:
                    yield solved(whole.slice(a, b - a))
            held = [] if last else whole.slice(cuts[-2]).to_batches()

        for batch in batches:
            held.append(batch)
            yield from ready(False)
        if held:
            yield from ready(True)
        tidy()

    return dealt.repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j").mapInArrow(run, schema)


def _cross_parts(of: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(pivot, sid, n, part): those members (pivot, sid, n, sigs, part) that have one with a common signature, but in another part, to whom sizes and tags allow a link.

    Signatures with the same first member, the pivot, have mostly the same
    members, so they are taken together: a row for each of their members, with
    its list of signatures. Members come out, never their pairs, of which
    near copies have as many as the square of their number.
    """
    tagged = sets.where("tags is not null").groupBy("sid").agg(F.first("tags").alias("data"))

    def solve(group: pa.Table, x: dict[str, np.ndarray], sides: tuple[dict, dict], same: bool) -> pa.RecordBatch:
        lists = group["sigs"].combine_chunks()
        which = np.unique(lists.flatten().to_numpy(), return_inverse=True)[1]
        masks = np.zeros((len(x["sid"]), int(which.max()) // 64 + 1), np.uint64)
        member = np.repeat(x["at"], pc.list_value_length(lists).to_numpy())
        np.bitwise_or.at(masks, (member, which // 64), np.uint64(1) << (which % 64).astype(np.uint64))
        n, part, tagged, hit = x["n"], x["part"], x["data"], np.zeros(len(x["sid"]), bool)

        def wanted(k: int, c: np.ndarray) -> np.ndarray:
            ok = (part[c] != part[k]) & ~(hit[c] & hit[k]) & ((c > k) | (not same))
            ok[ok] = (masks[c[ok]] & masks[k]).any(axis=1)
            return ok

        for k, found in _near(*sides, percent, wanted):
            for c in found[np.argsort(hit[found], kind="stable")].tolist():
                if not (hit[k] and hit[c]) and linked(min(tag_bound(tagged[k], tagged[c]), int(n[k]), int(n[c])), int(n[k]), int(n[c]), percent):
                    hit[[k, c]] = True
        return pa.RecordBatch.from_arrays([pa.array(group["pivot"].to_numpy()[hit]), *(pa.array(x[c][hit]) for c in ("sid", "n", "part"))], ["pivot", "sid", "n", "part"])

    return _in_blocks(of, tagged, solve, "<u2", "pivot long, sid long, n long, part long").distinct()


def _cross_links(docs: DataFrame, of: DataFrame, sets: DataFrame, k: int, percent: int, name: str, every: bool = False) -> DataFrame:
    """Linked pairs (a, b) of members (see _cross_parts()) of different parts, by their whole sets: all of them, or so many as join whatever parts they join.

    Without every, a link that is found makes one part of two where it is
    found, and members of one part aren't compared. So each pair of blocks
    gives fewer links than it has members.
    """
    rows = written(_cross_parts(of, sets, percent), f"{name}-likely")
    tokens = _tokens(docs, sets, rows.select("sid").distinct(), k)

    def solve(group: pa.Table, x: dict[str, np.ndarray], sides: tuple[dict, dict], same: bool) -> pa.RecordBatch:
        part, sid, data, found = x["part"].copy(), x["sid"], x["data"], []
        wanted = lambda one, c: (part[c] != part[one]) & ((c > one) | (not same))
        for one, at in _near(*sides, percent, wanted):
            while len(at):
                c, at = int(at[0]), at[1:]
                if not _similar(data[one], data[c], percent):
                    continue
                found.append((min(sid[one], sid[c]), max(sid[one], sid[c])))
                if not every:
                    part[part == part[c]] = part[one]
                    at = at[part[at] != part[one]]
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return _in_blocks(rows, tokens, solve, "<u8", "a long, b long").distinct()


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets are linked."""
    both = np.concatenate((x, y))
    both.sort(kind="stable")
    return linked(int((both[1:] == both[:-1]).sum()), len(x), len(y), percent)


def _tokens(docs: DataFrame, sets: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(sid, data): the whole sets, as 64-bit tokens, whose sid is wanted."""
    reps = sets.where("n > 0").groupBy("sid").agg(F.min(F.struct("key", "th")).alias("rep")).join(wanted, "sid").select("sid", "rep.key", "rep.th")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found, _ in _each(batches, k):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in found], pa.binary())], ["sid", "data"])

    texts = docs.select("key", "th", "text").join(reps, ["key", "th"]).dropDuplicates(["key", "th"])
    return texts.select("sid", "text").mapInArrow(read, "sid long, data binary")


def _verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b; hub, one of them or null) that are linked, by their whole sets."""
    known = _tokens(docs, sets, pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct(), k)
    return _where(pairs, known, lambda x, y: _similar(x, y, percent), "<u8").select("a", "b")


def _first_links(base: DataFrame, k: int, percent: int, name: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Sets, members (pivot, sid, n, sigs) of large groups, _compare()'s pairs (a, b) and those of them that are linked.

    Signatures with one pivot have mostly the same members: each is one row, with its signatures.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50 and at most 100")
    sets = _sets(base, k, percent, name)
    rows, pivots, first = _split_signatures(sets, name)
    found = written(_compare(rows, percent), f"{name}-candidates")
    pairs = found.where("n is null").select("a", "b", F.col("sig").alias("hub")).unionByName(pivots).groupBy("a", "b").agg(F.min("hub").alias("hub"))
    links = written(_verified(base, sets, written(_likely(pairs, sets, percent), f"{name}-likely"), k, percent), f"{name}-links")
    large = found.where("n is not null").select("sig", F.col("a").alias("sid"), "n", F.col("b").alias("pivot"))
    of_split = large.where("pivot is null").drop("pivot").join(F.broadcast(first), "sig")  # first has 2 * HOT rows or so at most
    members = large.where("pivot is not null").unionByName(of_split).groupBy("pivot", "sid", "n").agg(F.collect_set("sig").alias("sigs"))
    return sets, written(members, f"{name}-members"), pairs.select("a", "b"), links


def similarity_links(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, name: str = "jaccard") -> DataFrame:
    """(key_a, th_a, key_b, th_b): every linked pair of different sets, once; each set by its least row (see similarity_join()).

    In large groups each set is a part of its own, so all their pairs meet in
    the blocks of _cross_links(). There are as many rows as links: up to half
    the square of a group of near copies.
    """
    base = keyed(docs)
    sets, members, _, links = _first_links(base, k, percent, name)
    if not members.isEmpty():
        links = links.unionByName(_cross_links(base, members.withColumn("part", F.col("sid")), sets, k, percent, name, every=True)).distinct()
    reps = sets.where("n > 0").groupBy("sid").agg(F.min(F.struct("key", "th")).alias("rep"))
    side = lambda c: reps.select(F.col("sid").alias(c), F.col("rep.key").alias(f"key_{c}"), F.col("rep.th").alias(f"th_{c}"))
    return links.join(side("a"), "a").join(side("b"), "b").select("key_a", "th_a", "key_b", "th_b")


def similarity_join(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, name: str = "jaccard") -> DataFrame:
    """(key, th, n, component, class): for each row of docs, its set's size, the least key that links reach, and the id of its class of linked sets.

    Words are lower-cased (A-Z) and separated by ASCII white space; two texts
    link if 100 * |intersection| >= percent * |union|. Texts with equal sets
    are copies and take part once. A null text, like one without words, has
    size 0 and stays alone. Null doc_ids have the key NO_ID, which is smaller
    than all; rows with one doc_id are linked only if their texts are, so
    classes may share a component; class is a class's own, 0 without words. Other
    columns of docs aren't looked at. percent must be over 50. Shingles are told
    apart by 64-bit hashes, sets of them by 127 bits.

    A signature's group of at most GROUP sets is compared pair by pair, within
    the sizes that can link. In a larger one, members are compared with a
    pivot and with those next in size, which joins near copies. After that,
    only members of different components are left to compare: they are so
    where they meet, by sizes and tags, and only members that may be linked go
    on, to be compared by whole sets where they meet again. A link found there
    joins two components at once. So groups of near copies cost rows by their size.
    """
    base = keyed(docs)
    sets, members, pairs, links = _first_links(base, k, percent, name)
    labels = components(links, name)
    if not members.isEmpty():
        of = members.join(labels, members["sid"] == labels["v"], "left").select("pivot", "sid", "n", "sigs", F.coalesce("label", "sid").alias("part"))
        links = written(links.unionByName(_cross_links(base, of, sets, k, percent, name)), f"{name}-links")
        labels = components(links, name)
    worded = sets.where("n > 0").select("key", "th", "n", "sid")
    reps = written(worded.groupBy("sid").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("copies")), f"{name}-classes")
    named = labels.join(reps, labels["v"] == reps["sid"]).select("sid", "label", "rep")
    least = named.groupBy("label").agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("size"))
    joined = join_split(named, least.select("label", "least"), ["label"], hot_keys(least, "label", "size")).select("sid", "label", "least")
    of_set = reps.join(joined, "sid", "left").select("sid", F.coalesce("least", "rep").alias("component"), F.coalesce("label", "sid").alias("class"))
    out = join_split(worded, of_set, ["sid"], hot_keys(reps, "sid", "copies"))
    alone = sets.where("n = 0").select("key", "th", "n", F.col("key").alias("component"), F.col("sid").alias("class"))
    return out.select("key", "th", "n", "component", "class").unionByName(alone)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = similarity_join(table(spark, sf_dir, "documents"), k=4, percent=85)
    doc_id = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select(doc_id("key").alias("doc_id"), F.col("n").alias("n_shingles"), doc_id("component").alias("component_id"))


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OP8_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, row_number() OVER () AS rn,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws FROM documents),
s AS (SELECT DISTINCT rn, sh FROM (SELECT rn, array_to_string(ws[i:i + 3], ' ') AS sh FROM (SELECT rn, ws, unnest(range(1, len(ws) - 2)) AS i FROM d)
      UNION ALL SELECT rn, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 3)),
c AS (SELECT rn, count(*) AS n FROM s GROUP BY rn),
p AS (SELECT a.rn AS a, b.rn AS b, count(*) AS n FROM s a JOIN s b ON a.sh = b.sh AND a.rn < b.rn GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN c x ON x.rn = a JOIN c y ON y.rn = b WHERE 100 * p.n >= 85 * (x.n + y.n - p.n)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT rn AS a, rn AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT r.a AS rn, min(coalesce(d.doc_id, -9223372036854775808)) AS least FROM r JOIN d ON d.rn = r.b GROUP BY r.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, nullif(least, -9223372036854775808) AS component_id FROM d JOIN m ON m.rn = d.rn LEFT JOIN c ON c.rn = d.rn"""
