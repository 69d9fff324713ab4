"""WARC archives and the merge of their indexes.

Pages become WARC records in gzip members; records whose payload another one
has too point to it instead. Reading an archive back gives a run of captures,
sorted by URL key and time; runs are written before they are merged. A range partition
hands each task its stretch of keys from all runs, of about CAPTURED captures,
which a loser tree of k leaves merges, so that captures come out in global
order.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HOT, table, work_path, written
from .files import read_file, write_file

#: Payloads below so many bytes are never revisits. Fixed by the contract.
LEAST = 100
#: An archive is closed once its records, uncompressed, have so many bytes.
ARCHIVE = 32 << 20
#: Pages without a capture time are taken to follow one another by a second, by page_id, from here.
EPOCH = datetime(2024, 1, 1, tzinfo=UTC)
#: Captures that one task of a merge holds, as ranges are cut by a sample.
CAPTURED = 200_000
_ID = "urn:page:"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """The URL for sorting: host labels from the last to the first, then path and query; scheme, www., default port and fragment go. Null is empty."""
    try:
        parts = urlsplit((url or "").strip())
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return (url or "").lower()
    host = re.sub(r"^www\d*\.", "", host)
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return (",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "") + ")" + path) if host else (url or "").lower()


def record(page_id: int | None, url: str | None, date: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response, or with refers_to a revisit: the HTTP head alone, which still says the payload's length."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Refers-To: <{_ID}{refers_to}>", f"WARC-Profile: {_REVISIT}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header fields in lower case, block) of each gzip member of an archive."""
    at = 0
    while at < len(data):
        raw, length = _member(data, at)
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "surrogateescape").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        yield at, length, fields, rest[: int(fields["content-length"])]
        at += length


def _member(data: bytes, at: int) -> tuple[bytes, int]:
    """The gzip member there and its length. It is fed in steps, so that what follows isn't copied each time."""
    unzip, out, step, begin = zlib.decompressobj(31), [], 1 << 14, at
    while not unzip.eof:
        if at >= len(data):
            raise ValueError("the archive ends within a record")
        out.append(unzip.decompress(data[at : at + step]))
        at = min(at + step, len(data))
    return b"".join(out), at - begin - len(unzip.unused_data)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes pages as archives under folder; returns their written list: path, n_records.

    Of records with equal payloads of at least LEAST bytes, that with the
    least page_id is the response and all with another page_id revisit it;
    with a null page_id they do too if any has one. A null html is empty, a
    null url left out. Rows given twice are two records. Other columns aren't
    looked at, but for captured_at (a timestamp) if there is one. A repeated
    attempt of a task writes new files; only listed ones count.
    """
    time = pages["captured_at"].cast("timestamp") if "captured_at" in pages.columns else F.lit(None).cast("timestamp")
    base = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), F.encode(F.coalesce(pages["html"].cast("string"), F.lit("")), "UTF-8").alias("payload"), time.alias("captured_at"))
    base = base.withColumn("digest", F.sha2("payload", 256))
    # Payloads are told apart by SHA-256. Those that many pages share, like empty ones, are looked up where the pages are.
    known = written(base.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("times"), F.max(F.length("payload")).alias("size")).where("times > 1"), "payloads")
    firsts = known.select("digest", F.when(F.col("size") >= LEAST, F.col("first")).alias("first"))
    hot = F.broadcast(known.where(F.col("times") * HOT > pages.count()).select("digest"))
    usual = base.join(hot, "digest", "left_anti").join(firsts, "digest", "left")
    plan = usual.unionByName(base.join(F.broadcast(firsts.join(hot, "digest", "left_semi")), "digest"))
    plan = plan.withColumn("refers_to", F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"path": [write_file(folder, ".warc.gz", b"".join(lot))], "n_records": pa.array([len(lot)], pa.int64())})

        for batch in batches:
            for page_id, url, payload, digest, when, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                when = (when.astimezone(UTC) if when.tzinfo else when.replace(tzinfo=UTC)) if when else EPOCH + timedelta(seconds=(page_id or 0) % (1 << 32))
                raw = record(page_id, url, when.strftime("%Y-%m-%dT%H:%M:%SZ"), payload, digest, first)
                zipper = zlib.compressobj(4, zlib.DEFLATED, 31)
                lot.append(zipper.compress(raw) + zipper.flush())
                size += len(raw)
                if size >= ARCHIVE:
                    yield close()
                    lot, size = [], 0
        if lot:
            yield close()

    return written(plan.select("page_id", "url", "payload", "digest", "captured_at", "refers_to").mapInArrow(run, "path string, n_records long"), "archives")


CAPTURES = "url_key string, captured_at string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, path string, offset long, length long"
_NAMES = [x.split()[0] for x in CAPTURES.split(", ")]
_TYPES = [pa.int64() if x.endswith("long") else pa.string() for x in CAPTURES.split(", ")]


def _key(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0


def _page(field: str | None) -> int | None:
    text = (field or "").strip("<>").removeprefix(_ID)
    return int(text) if text else None


def _batches(rows: Iterator[tuple], most: int = 10_000) -> Iterator[pa.RecordBatch]:
    lot: list[tuple] = []
    for row in rows:
        lot.append(row)
        if len(lot) == most:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*lot, strict=True), _TYPES, strict=True)], _NAMES)
            lot = []
    if lot:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*lot, strict=True), _TYPES, strict=True)], _NAMES)


def capture_runs(archives: DataFrame) -> DataFrame:
    """The captures in the listed archives (CAPTURES), those of each archive in the order of URL key, time and page_id.

    What a response says of its payload is checked against it: a record whose digest is wrong is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                for offset, length, fields, block in records(read_file(path)):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", head)[1])
                    digest, kind, url = fields["warc-payload-digest"].removeprefix("sha256:"), fields["warc-type"], fields.get("warc-target-uri")
                    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"{path}: the record at {offset} isn't what it says")
                    rows.append((url_key(url), fields["warc-date"], _page(fields["warc-record-id"]), url, kind, size, digest, _page(fields.get("warc-refers-to")), path, offset, length))
                yield from _batches(iter(sorted(rows, key=_key)))

    n = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("path").repartition(n, "path").mapInArrow(run, CAPTURES)


def loser_tree(runs: list[list[tuple]]) -> Iterator[tuple]:
    """The rows of sorted runs in order, by one comparison for each level of a tree that keeps the losers; of equals, those of the earlier run first."""
    k = len(runs)
    if not k:
        return
    heads = [(_key(r[0]), i) if r else None for i, r in enumerate(runs)]
    at = [0] * k
    beats = lambda a, b: heads[a] is not None and (heads[b] is None or heads[a] < heads[b])
    tree = [0] * (2 * k)
    win = [0] * (2 * k)
    for i in range(k):
        win[k + i] = i
    for node in range(k - 1, 0, -1):
        a, b = win[2 * node], win[2 * node + 1]
        win[node], tree[node] = (a, b) if beats(a, b) else (b, a)
    best = win[1] if k > 1 else 0
    while heads[best] is not None:
        yield runs[best][at[best]]
        at[best] += 1
        heads[best] = (_key(runs[best][at[best]]), best) if at[best] < len(runs[best]) else None
        node = (k + best) >> 1
        while node >= 1:
            if beats(tree[node], best):
                tree[node], best = best, tree[node]
            node >>= 1


def merge_runs(runs: DataFrame) -> DataFrame:
    """The captures in global order of URL key, time and page_id (null first).

    The keys' ranges include time and page_id, so a URL captured very often is
    spread over several tasks. A task receives its stretch of each run in one
    piece and in order; where keys fall, the next run begins.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lots: list[list[tuple]] = []
        last = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = _key(row)
                if last is None or key < last:
                    lots.append([])
                lots[-1].append(row)
                last = key
        yield from _batches(loser_tree(lots))

    least = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return runs.repartitionByRange(max(least, -(-runs.count() // CAPTURED)), "url_key", "captured_at", "page_id").mapInArrow(run, CAPTURES)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(table(spark, sf_dir, "pages"), work_path(spark, "warc"))
    captures = merge_runs(written(capture_runs(archives), "capture-runs"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= {LEAST} THEN min(page_id) OVER (PARTITION BY html) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM f"""
