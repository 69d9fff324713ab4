"""Quality rules as a bitmask ledger (DataFrame functions only).

``ledger`` evaluates every rule once for each document and stores the failed
rules as bits of one number beside the measurements. ``apply_policy`` and
``ablation`` never look at the text again: a policy is a versioned mask, and
what each rule costs follows from counts by bit pattern.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Fixed values of the query's contract.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3

#: Rule names in the order of their bits; each is SQL over the measurements and true where a document fails.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 30 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 60 * n_lines",
    "short_words": "10 * word_chars < 20 * n_words",
    "long_words": "word_chars > 25 * n_words",
    "shouting": "100 * n_bangs > 50 * n_words",
}
#: Policy versions: the rules that reject. A released version never changes.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("few_words", "repeated_words"),
    "web-1": ("few_words", "repeated_words", "symbols", "duplicate_lines"),
    "web-2": ("few_words", "repeated_words", "symbols", "duplicate_lines", "short_words", "long_words", "shouting"),
}
LATEST = "web-2"


def mask(policy: str, rules: Mapping[str, str] = RULES, policies: Mapping[str, tuple[str, ...]] = POLICIES) -> int:
    names = list(rules)
    return sum(1 << names.index(r) for r in policies[policy])


def _let(value: Column, body) -> Column:
    """body(value) with value evaluated once."""
    return F.transform(F.array(value), body)[0]


def _repeated(words: Column) -> Column:
    """Words within windows of WINDOW words that occur twice or more in the text."""
    grams = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.struct(F.xxhash64(*(F.get(words, i + j) for j in range(WINDOW))).alias("h"), i.alias("i")),
    )
    same = lambda s, x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
    starts = _let(F.sort_array(grams), lambda s: F.filter(s, lambda x, j: same(s, x, j - 1) | same(s, x, j + 1)))
    # in order of position, each start covers what the one before it left over
    covered = F.aggregate(
        F.sort_array(F.transform(starts, lambda x: x["i"])),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(covered)


def ledger(docs: DataFrame, rules: Mapping[str, str] = RULES) -> DataFrame:
    """doc_id, the measurements (long) and fail_bits (long, bit i for the i-th rule).

    A row for each row of docs; other columns of docs, whatever their names,
    are left out. A null text, like an empty one, has no words: all
    measurements are 0. doc_id may be null or repeated. Windows are compared
    by a 64-bit hash of their words, within one text only. No shuffle: a text
    of any length is measured within its row.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    parts = docs.select(
        docs["doc_id"].alias("doc_id"),
        text.alias("text"),
        F.filter(F.split(text, SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    n = lambda c: c.cast("long")
    measured = parts.select(
        "doc_id",
        n(F.size("words")).alias("n_words"),
        n(F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.length(w))).alias("word_chars"),
        n(F.regexp_count("text", F.lit(SYMBOLS))).alias("n_symbols"),
        n(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        _repeated(F.col("words")).alias("n_repeat_words"),
        n(F.size("lines")).alias("n_lines"),
        n(F.regexp_count("text", F.lit("!"))).alias("n_bangs"),
    )
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(rules.values())]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measured.withColumn("fail_bits", total.cast("long"))


def apply_policy(book: DataFrame, policy: str = LATEST, rules: Mapping[str, str] = RULES, policies: Mapping[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """book with kept (boolean): no rule of the policy failed."""
    return book.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(mask(policy, rules, policies))) == 0)


def ablation(book: DataFrame, rules: Mapping[str, str] = RULES, policies: Mapping[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """For each policy and rule of it: failed (documents that fail the rule), only (documents it alone rejects), kept_without (documents kept if it were dropped).

    One aggregation to at most 2^rules bit patterns; the rest is on those. An empty book gives no rows.
    """
    names = list(rules)
    patterns = book.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    cases = F.array(*(F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(mask(p, rules, policies)).cast("long").alias("mask"), F.lit(1 << names.index(r)).cast("long").alias("bit")) for p in policies for r in policies[p]))
    flat = patterns.select("n", "fail_bits", F.explode(cases).alias("c")).select("n", "fail_bits", "c.*")
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    some = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0)).alias
    return flat.groupBy("policy", "rule").agg(
        some(F.col("fail_bits").bitwiseAND(F.col("bit")) != 0)("failed"),
        some(hit == F.col("bit"))("only"),
        some(hit.bitwiseAND(F.bitwise_not("bit")) == 0)("kept_without"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = apply_policy(ledger(table(spark, sf_dir, "documents")))
    base = F.col("fail_bits").bitwiseAND(F.lit(mask("base-1"))) != 0
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), (~base & F.col("kept")).alias("kept"), "n_lines", "n_bangs", "fail_bits")


def _oracle() -> str:
    bits = " + ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(RULES.values()))
    return rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rn, coalesce(text, '') AS text,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
           FROM documents),
g AS (SELECT rn, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
      FROM (SELECT rn, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
r AS (SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, gram) AS c FROM g) WHERE c > 1),
v AS (SELECT rn, count(DISTINCT j)::BIGINT AS n FROM (SELECT rn, unnest([i, i + 1, i + 2]) AS j FROM r) GROUP BY rn),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(v.n, 0)::BIGINT AS n_repeat_words,
             len(ls)::BIGINT AS n_lines, (length(text) - length(replace(text, '!', '')))::BIGINT AS n_bangs
      FROM d LEFT JOIN v USING (rn)),
b AS (SELECT *, ({RULES["few_words"]}) OR ({RULES["repeated_words"]}) AS base_failed, ({bits})::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (fail_bits & {mask(LATEST)}) = 0 AS kept, n_lines, n_bangs, fail_bits
FROM b"""


OP5_SQL = _oracle()
