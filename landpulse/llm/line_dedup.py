"""Line dedup by content-defined chunks of lines (DataFrame functions only).

A rolling hash over the hashes of neighbouring lines chooses chunk ends, so an
inserted line moves only the boundaries near it. A chunk of two or more lines
that occurs again anywhere is removed there; its first occurrence stays.
Chunks are grouped by their whole text, which is the byte comparison.

Boundaries depend on the lines before a passage, and chunks of one line stay,
so much of what repeats isn't found (README). In the pipeline an exact pass
follows: each two neighbouring lines that no removed chunk holds are compared
too, which finds the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HOT, join_split, keyed, table, written

#: A line ends a chunk if the rolling hash over it and the line before it is 0 modulo this, so chunks have three lines on average.
DIVISOR = 3
#: Multiplier of the rolling hash.
BASE = 1_000_003


def _line_hash(line: Column) -> Column:
    """32 bits of the line's MD5 as a long."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _chunks(docs: DataFrame, divisor: int) -> DataFrame:
    """(key, th, first, n, h) of the chunks with two lines or more; h hashes their lines."""
    lines = docs.select("key", "th", F.split("text", "\n", -1).alias("lines"))
    hashed = lines.withColumn("lh", F.transform("lines", _line_hash))
    last = F.size("lh")
    ends = F.filter(F.sequence(F.lit(1), last), lambda i: (i == last) | ((F.get("lh", i - 1) + F.coalesce(F.get("lh", i - 2), F.lit(0)) * BASE) % divisor == 0))
    ended = hashed.withColumn("ends", ends)
    bounds = F.transform("ends", lambda e, k: F.struct((F.coalesce(F.get("ends", k - 1), F.lit(0)) + 1).alias("first"), (e - F.coalesce(F.get("ends", k - 1), F.lit(0))).alias("n")))
    wide = F.transform(F.filter(bounds, lambda b: b["n"] >= 2), lambda b: F.struct(b["first"].alias("first"), b["n"].alias("n"), F.xxhash64(F.slice("lines", b["first"], b["n"])).alias("h")))
    return ended.select("key", "th", F.explode(wide).alias("c")).select("key", "th", "c.*")


def _pairs(docs: DataFrame) -> DataFrame:
    """(key, th, first, n, h) of each two neighbouring lines; n is 2, h hashes them."""
    lines = docs.select("key", "th", F.split("text", "\n", -1).alias("lines"))
    pairs = F.transform(F.sequence(F.lit(1), F.size("lines") - 1), lambda i: F.struct(i.alias("first"), F.lit(2).alias("n"), F.xxhash64(F.slice("lines", i, 2)).alias("h")))
    return lines.where(F.size("lines") > 1).select("key", "th", F.explode(pairs).alias("c")).select("key", "th", "c.*")


def _in_twos(run: Column) -> Column:
    """The pairs (first, 2) of a run (first, n)."""
    return F.transform(F.sequence(run["first"], run["first"] + run["n"] - 2), lambda i: F.struct(i.cast("int").alias("first"), F.lit(2).alias("n")))


def _runs(pairs: Column) -> Column:
    """The runs (first, n) that sorted pairs (first, 2) cover together."""
    at = lambda k: F.get(pairs, k)["first"]
    begins = F.filter(pairs, lambda p, k: (k == 0) | (at(k - 1) + 2 < p["first"]))
    ends = F.filter(pairs, lambda p, k: (k == F.size(pairs) - 1) | (at(k + 1) > p["first"] + 2))
    return F.transform(begins, lambda p, k: F.struct(p["first"].alias("first"), (F.get(ends, k)["first"] + 2 - p["first"]).alias("n")))


def _repeats(base: DataFrame, places: DataFrame, known: DataFrame | None, pairs: bool) -> DataFrame:
    """(key, th, first, n) of the places that repeat an earlier one; known: (key, th, first) of pairs that are known to, which aren't looked at.

    With pairs, what would depend on the order of texts under one doc_id or overlaps
    its first place is left out: of chunks the former, of pairs, for which known is given, the latter.
    """
    follow = known is not None
    places = written(places, "line-chunks")
    place = F.struct("key", "first", "th")
    repeated = written(places.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "line-repeats")
    hot = repeated.where(F.col("c") * HOT > places.count()).select("h")
    again = join_split(places, repeated.select("h"), ["h"], hot)
    if follow:
        again = again.join(known, ["key", "th", "first"], "left_anti")
    by_doc = again.groupBy("key", "th").agg(F.collect_set(F.struct("first", "n", "h")).alias("suspects"))
    with_text = base.join(by_doc, ["key", "th"]).select("key", "th", F.split("text", "\n", -1).alias("lines"), F.explode("suspects").alias("c"))
    chunk = F.array_join(F.slice("lines", F.col("c.first"), F.col("c.n")), "\n")
    suspects = with_text.select("key", "th", "c.*", chunk.alias("chunk"))
    digest = F.unhex(F.sha2("chunk", 256)).alias("digest")
    found = written(suspects.select("key", "th", "first", "n", "h", digest), "line-suspects")
    # Chunks are grouped by their bytes; places then find their group by its digest.
    groups = (found.groupBy("h", "digest") if follow else suspects.groupBy("h", "chunk")).agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.count(F.lit(1)).alias("times")).where("lo != hi")
    firsts = written(groups.select("h", "digest" if follow else digest, "lo", "times"), "line-firsts")
    total = firsts.agg(F.sum("times")).first()[0] or 0
    many = firsts.where(F.col("times") * HOT > total).select("h", "digest")
    later = place != F.col("lo")
    if follow:
        later = later & ~((F.col("key") == F.col("lo.key")) & (F.col("th") == F.col("lo.th")) & (F.col("first") < F.col("lo.first") + F.col("n")))
    elif pairs:
        later = later & ((F.col("key") != F.col("lo.key")) | (F.col("th") == F.col("lo.th")))
    return join_split(found, firsts.drop("times"), ["h", "digest"], many).where(later).select("key", "th", "first", "n")


def line_dedup(docs: DataFrame, divisor: int = DIVISOR, carry: bool = False, pairs: bool = False) -> DataFrame:
    """docs' rows as (key, th, doc_id, text, n_lines, removed, kept_text), with carry also rest (see keyed()): removed lists (first, n) of the removed runs of lines.

    The occurrence with the smallest doc_id, then the first in the text, stays;
    a null doc_id comes before all. A null text counts as empty: one empty
    line. Rows that repeat doc_id and text are one document given twice: each
    keeps what the other keeps. Other columns of docs are not looked at. Blank
    lines are lines. Single-line chunks always stay, so an empty text, or one
    of a single line, is returned as it is.

    With pairs, an exact pass over each two neighbouring lines follows that of chunks: a line goes
    if it and a neighbour stand together at an earlier place too, one that
    overlaps them not counted. So of each passage of two lines or more that
    stood before nothing stays, and no line goes whose text isn't kept earlier.
    Pairs overlap: a pair's first occurrence stays but for what is itself a repeat
    of something before it. Pairs are compared by their SHA-256.

    Scale: chunk hashes are counted with partial aggregation before any text
    moves; only chunks whose hash repeats are compared, again with partial
    aggregation by text, so a chunk that a third of all documents share is
    summed up where it is read, and its places look it up there: neither its
    rows nor its text move.
    """
    base = keyed(docs, carry)
    again = _repeats(base, _chunks(base, divisor), None, pairs)
    if pairs:
        chunks = written(again, "line-chunks-again")
        inside = chunks.select("key", "th", F.explode(F.sequence("first", F.col("first") + F.col("n") - 2)).alias("first"))
        again = chunks.unionByName(_repeats(base, _pairs(base), inside, True))
    removed = again.groupBy("key", "th").agg(F.sort_array(F.collect_set(F.struct("first", "n"))).alias("removed"))
    if pairs:
        removed = removed.select("key", "th", _runs(F.sort_array(F.array_distinct(F.flatten(F.transform("removed", _in_twos))))).alias("removed"))
    joined = base.join(removed, ["key", "th"], "left").withColumn("removed", F.coalesce("removed", F.expr("cast(array() as array<struct<first:int,n:int>>)")))
    lines = joined.withColumn("lines", F.split("text", "\n", -1))
    # The kept stretches lie between the removed runs.
    gaps = F.transform(
        F.concat("removed", F.array(F.struct((F.size("lines") + 1).alias("first"), F.lit(0).alias("n")))),
        lambda r, k: F.struct(F.coalesce(F.get("removed", k - 1)["first"] + F.get("removed", k - 1)["n"], F.lit(1)).alias("first"), r["first"].alias("to")),
    )
    kept = F.array_join(F.flatten(F.transform(gaps, lambda g: F.slice("lines", g["first"], g["to"] - g["first"]))), "\n")
    return lines.select("key", "th", "doc_id", "text", *["rest"] * carry, F.size("lines").cast("long").alias("n_lines"), "removed", F.when(F.size("removed") == 0, F.col("text")).otherwise(kept).alias("kept_text"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, r: a + r["n"])
    return out.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_chunks_removed"), gone.alias("n_lines_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))


OP1_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rn, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, rn, i, ls[i] AS line, ('0x' || substr(md5(ls[i]), 1, 8))::BIGINT AS lh FROM (SELECT doc_id, rn, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
e AS (SELECT *, CASE WHEN lead(i) OVER w IS NULL OR (lh + coalesce(lag(lh) OVER w, 0) * {BASE}) % {DIVISOR} = 0 THEN 1 ELSE 0 END AS is_end FROM l WINDOW w AS (PARTITION BY rn ORDER BY i)),
k AS (SELECT *, sum(is_end) OVER (PARTITION BY rn ORDER BY i) - is_end AS chunk_no FROM e),
c AS (SELECT doc_id, rn, chunk_no, min(i) AS first, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS chunk FROM k GROUP BY ALL),
f AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, first) AS nth FROM c WHERE n >= 2),
r AS (SELECT rn, chunk_no FROM f WHERE nth > 1),
kept AS (SELECT k.*, r.rn IS NOT NULL AS gone FROM k LEFT JOIN r ON k.rn = r.rn AND k.chunk_no = r.chunk_no)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(DISTINCT chunk_no) FILTER (gone)::BIGINT AS n_chunks_removed, (count(*) FILTER (gone))::BIGINT AS n_lines_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM kept GROUP BY doc_id, rn"""
