"""From raw documents to token ids: the stages of a training corpus, each by one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landpulse.llm import bpe, decontamination, line_dedup, similarity_join, toxicity
from landpulse.llm.common import keyed, table, written


#: What a word is made of.
_WORD = r"[^\x20\x09-\x0D]"


def _given(docs: DataFrame, keyed_docs: DataFrame, text: str = "text") -> DataFrame:
    """keyed_docs (with rest, see keyed()) with the columns of docs; that of text is their text, and n_chars, if there is one, counts it."""
    made = {"text": F.col(text), "n_chars": F.length(text)}
    return keyed_docs.select(*(made[c].cast(docs.schema[c].dataType).alias(c) if c in made else F.col("rest")[c].alias(c) for c in docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, learned from their own labelled rows, doesn't reject."""
    return toxicity.clean(docs, *toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, by content-defined chunks of lines and an exact pass after them, without the passages of two lines or more that an earlier place has; one of which nothing is left has an empty text. n_chars, if there, is counted anew; a null text becomes empty."""
    return _given(docs, line_dedup.line_dedup(docs, carry=True, pairs=True), "kept_text")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least doc_id, null before all. A row whose doc_id and text come again stays once; all rows without words stay."""
    found = similarity_join.similarity_join(docs, name="pipeline-jaccard")
    stays = found.where("n > 0").groupBy("class").agg(F.min(F.struct("key", "th")).alias("one")).select("one.key", "one.th")
    rows = keyed(docs, carry=True)
    kept = rows.where(F.col("text").rlike(_WORD)).join(stays, ["key", "th"], "left_semi").dropDuplicates(["key", "th"])
    return _given(docs, kept.unionByName(rows.where(~F.col("text").rlike(_WORD))))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no passage of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and what they decode to."""
    return bpe.bpe_encode(docs, bpe.tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
