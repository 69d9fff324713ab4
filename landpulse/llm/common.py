"""What the corpus operators share: inputs, keys and the shared work folder."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a missing doc_id in keys: joins find it and it sorts first.
NO_ID = -(2**63)
#: A key is hot if more than one in so many rows have it, hence there are fewer hot keys than that.
HOT = 1000

_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder that the cluster shares.

    ``spark.checkpoint.dir`` names it. Where that is unset, a temporary folder
    of this machine takes its place if all executors are on it, else it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='landpulse-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: lost executors can't take it along, and its lineage ends there."""
    path = work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes tables made by written() that nothing reads any more, so that they don't add up on disk."""
    for t in tables:
        context = t.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(t.written_to)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def join_split(left: DataFrame, right: DataFrame, on: list[str], hot: DataFrame) -> DataFrame:
    """The inner join of left with right, whose keys are unique, without moving left's rows of the hot keys.

    hot holds keys that more than 1/HOT of the rows of a table share, so there
    are at most HOT of them: they and their rows of right are broadcast. All
    other rows meet by a shuffle, in which no key is large.
    """
    hot = F.broadcast(hot)
    cold = left.join(hot, on, "left_anti").join(right, on)
    return cold.unionByName(left.join(F.broadcast(right.join(hot, on, "left_semi")), on))


def hot_keys(counts: DataFrame, key: str, count: str) -> DataFrame:
    """The keys whose count is more than 1/HOT of all counts together: HOT at most."""
    total = counts.agg(F.sum(count)).first()[0] or 0
    return counts.where(F.col(count) * HOT > total).select(key)


def keyed(docs: DataFrame, carry: bool = False) -> DataFrame:
    """(key, th, doc_id, text): one row for each row of docs, whatever other columns it has; with carry, those as a struct, rest.

    key is doc_id with NO_ID for null, th a hash of the text (null counts as
    empty). Rows that agree in both are copies of one another, so results by
    (key, th) hold for each of them and joins on it don't multiply rows.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rest = [F.struct(*(docs[c] for c in docs.columns if c != "text")).alias("rest")] if carry else []
    return docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("key"), F.xxhash64(text).alias("th"), docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), *rest)


def folded(text: bytes) -> bytes:
    """A UTF-8 text in lower case."""
    return text.lower() if text.isascii() else text.decode("utf-8", "replace").lower().encode()


def tidy() -> None:
    """Gives memory that a batch no longer needs back to the system, where that can be asked for."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)
