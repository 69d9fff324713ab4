"""BPE and the token store against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import pytest
from corpora import corpus, frame, with_odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from landpulse.llm import bpe, token_store
from landpulse.llm.common import work_path

PATH = bpe.tokenizer_path()
LIBRARY = Tokenizer.from_file(PATH)
ODD = st.lists(st.sampled_from([*"aaabbeEéÉßΣς 's't'reİ<|endoftext|>,.;-_#0٣日😀ﬁ×ªº", "\u0301", "\u3000", "\xa0", "\n", "\x85", "\x1c", "\x00", "<|startoftext|>", "Word,"]), max_size=60).map("".join)


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_text_as_library(text):
    cache, raw = bpe.chunk_cache(PATH), text.encode()
    cache.learn([raw])
    assert np.frombuffer(cache.encode(raw), "<u4").tolist() == ids(text)
    assert cache.decode(raw).decode() == LIBRARY.decode(ids(text), skip_special_tokens=False)
    assert np.frombuffer(bpe.library_cache(PATH).encode(raw), "<u4").tolist() == ids(text)


def test_merges_that_make_earlier_pairs():
    """A merge whose product stands in a pair of lower rank: as if word by word."""
    vocab = {s: i for i, s in enumerate(["a", "b", "c", "d", "ab", "bc", "abc", "abcd", "aa", "aaaa"])}
    index = bpe.PairIndex(vocab, [("abc", "d"), ("a", "a"), ("a", "b"), ("b", "c"), ("ab", "c"), ("aa", "aa"), ("a", "bc")])
    assert index.early.any()
    words = ["abcd", "aabcd", "aaaaa", "aaa", "bcd", "", "abcabcd", "d"]
    assert index.encode(words) == [index.one(w) if w else [] for w in words]


def test_encode(spark):
    rows = with_odd_rows(corpus(5))
    df = frame(spark, rows).withColumn("ids", F.lit(1)).withColumn("n_tokens", F.lit("x"))
    got = sorted((str(r.doc_id), r.n_tokens, r.ids, r.decoded) for r in bpe.bpe_encode(df, PATH).collect())
    assert got == sorted((str(d), len(ids(t)), ids(t), LIBRARY.decode(ids(t), skip_special_tokens=False)) for d, t, *_ in rows)
    back = bpe.bpe_decode(bpe.bpe_encode(df, PATH), PATH)
    assert sorted(r.decoded for r in back.collect()) == sorted(x[3] for x in got)
    assert bpe.bpe_encode(frame(spark, []), PATH).count() == 0


def test_digests(spark):
    rows = corpus(6, 30)
    for r in bpe.bpe_encode(frame(spark, rows), PATH, digest=True).collect():
        own = ids(rows[r.doc_id][1])
        assert r.ids_sha256 == hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(own, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("shard", [1, 500, 10**9])
def test_token_store(spark, shard):
    rows = with_odd_rows(corpus(7))
    listed = token_store.write_shards(frame(spark, rows).withColumn("path", F.lit(1)), PATH, work_path(spark, "t"), shard=shard)
    got = token_store.read_shards(listed, full=True).orderBy("start").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for r, (d, t, *_) in zip(got, order, strict=True):
        own = [*ids(t), 1]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (d, start, len(own), own)
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        start += len(own)
    empty = token_store.write_shards(frame(spark, []), PATH, work_path(spark, "t"))
    assert empty.count() == 0 and token_store.read_shards(empty).count() == 0


@pytest.mark.parametrize("shard", [500, 10**9])
def test_tokens_are_found_without_decoding(spark, shard):
    rows = corpus(7, 60) + [(None, "w1 w1", None, None, 0)]
    listed = token_store.write_shards(frame(spark, rows), PATH, work_path(spark, "t"), shard=shard)
    wanted = [*ids("w1 the"), 1, 49_000_000]
    got = sorted((str(r.doc_id), r.token, r.n, r.places) for r in token_store.find_tokens(listed, wanted).collect())
    want = []
    for d, t, *_ in rows:
        own = np.array([*ids(t), 1])
        want += [(str(d), x, int((own == x).sum()), np.flatnonzero(own == x).tolist()) for x in set(wanted) if (own == x).any()]
    assert got == sorted(want)


def test_only_needed_parts_of_a_shard_are_read():
    seq = np.random.default_rng(3).integers(0, 300, 50_000)
    data, read = token_store.Shard.encode([1], [len(seq)], seq), []
    shard = token_store.Shard(lambda offset, length: read.append(length) or data[offset : offset + length])
    assert shard.n == len(seq) and sum(read) < len(data) / 10
    m = shard.matrix()
    assert sum(read) < len(data) / 10 and m.access(7) == seq[7]


def test_tokenizers_that_keep_white_space_are_refused(spark):
    other = PATH.replace("word_bpe_49k", "byte_bpe_50k")
    for use in (lambda: bpe.bpe_encode(frame(spark, []), other), lambda: token_store.write_shards(frame(spark, []), other, work_path(spark, "t")), lambda: bpe.Model(other)):
        with pytest.raises(ValueError, match="white space"):
            use()


@pytest.mark.parametrize("n", [0, 1, 9, 5000, 20000])
def test_wavelet_matrix(n):
    rng = np.random.default_rng(n)
    seq = (rng.zipf(1.4, n) % 3000).astype(np.uint32)
    m = token_store.Shard(token_store.Shard.encode([1], [n], seq)).matrix()
    assert m.ids().tolist() == seq.tolist()
    for i in rng.integers(0, n, 20).tolist() if n else []:
        assert m.access(i) == seq[i]
    for token in {*seq[:6].tolist(), 2999, 99_999}:
        at = np.flatnonzero(seq == token)
        assert m.count(token) == len(at) and m.rank(token, n // 2) == int((at < n // 2).sum())
        for k in {0, len(at) // 2, len(at) - 1} if len(at) else ():
            assert m.select(token, k) == at[k]
        if len(at) < 60:
            assert list(m.occurrences(token)) == at.tolist()
    with pytest.raises(IndexError):
        m.access(n)
    with pytest.raises(IndexError):
        m.select(99_999, 0)
    with pytest.raises(ValueError):
        token_store.Shard(b"something else")
