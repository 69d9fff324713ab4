"""BPE encoding and decoding by a pair occurrence index.

All distinct words of a batch lie side by side in one symbol array. Each pair
of neighbours is mapped to the positions where it stands, the merge ranks in
use are taken in ascending order, and each merge is applied to all positions
of its pair at once, which updates the lists of the pairs that it makes.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, tidy

NONE = np.iinfo(np.int32).max
#: Chunks whose ids a worker remembers, bytes of text whose new chunks are encoded together, and bytes put out at a time: bounds on memory, not on what is encoded.
CACHE, LIBRARY_CACHE, LEARN, SLICE = 300_000, 2_000_000, 16 << 20, 4 << 20


class PairIndex:
    """The merges of a BPE model (vocabulary and ranked pairs), applied to many words at once."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = "") -> None:
        self.vocab, self.suffix = vocab, suffix
        self.rank, made = {}, []
        for r, (a, b) in enumerate(merges):
            self.rank[vocab[a] << 32 | vocab[b]] = r
            made.append(vocab[a + b])
        keys = np.fromiter(self.rank, np.int64, len(self.rank))
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.fromiter(self.rank.values(), np.int32, len(self.rank))[order]
        self.made = np.array(made, np.int64)
        self.left, self.right = (keys >> 32, keys & 0xFFFFFFFF)
        # A merge whose product stands in an earlier pair: its words can't be taken rank by rank for all at once.
        first = np.full(max(vocab.values(), default=0) + 1, NONE, np.int64)
        own = np.fromiter(self.rank.values(), np.int64, len(self.rank))
        for side in (self.left, self.right):
            np.minimum.at(first, side, own)
        self.early = first[self.made] < np.arange(len(made)) if made else np.zeros(0, bool)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.int64) << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def symbols(self, word: str) -> list[int]:
        found = [self.vocab.get(c) for c in word[:-1]] + [self.vocab.get(word[-1] + self.suffix)]
        return [x for x in found if x is not None]  # as the library does without an unknown token

    def one(self, word: str) -> list[int]:
        """The word by itself: the lowest rank first, leftmost on ties."""
        s = self.symbols(word)
        while len(s) > 1:
            r, i = min((self.rank.get(a << 32 | b, NONE), i) for i, (a, b) in enumerate(zip(s, s[1:], strict=False)))
            if r == NONE:
                break
            s[i : i + 2] = [int(self.made[r])]
        return s

    def encode(self, words: list[str]) -> list[list[int]]:
        """The ids of each word."""
        if not words or not len(self.keys):
            return [self.symbols(w) if w else [] for w in words]
        lists = [self.symbols(w) if w else [] for w in words]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        n = int(sizes.sum())
        sym = np.fromiter((x for s in lists for x in s), np.int64, n)
        ends = np.cumsum(sizes)
        # Position n stands for no neighbour.
        nxt, prv, rank = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32), np.full(n + 1, NONE, np.int32)
        full = sizes > 0
        nxt[ends[full] - 1] = n
        prv[(ends - sizes)[full]] = n
        alive = np.ones(n + 1, bool)
        alive[n] = False
        sym = np.append(sym, -1)
        inner = np.flatnonzero(nxt[:n] < n)
        rank[inner] = self._ranks(sym[inner], sym[inner + 1])
        where: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(places: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for r, part in zip(ranks[np.concatenate(([0], cuts))].tolist() if len(ranks) else [], np.split(places, cuts), strict=False):
                if r in where:
                    where[r].append(part)
                else:
                    where[r] = [part]
                    heapq.heappush(heap, r)

        known = inner[rank[inner] != NONE]
        add(known, rank[known])
        odd: set[int] = set()
        while heap:
            r = heapq.heappop(heap)
            lots = where.pop(r)
            at = np.unique(lots[0] if len(lots) == 1 else np.concatenate(lots))
            at = at[alive[at] & (rank[at] == r)]
            if not len(at):
                continue
            if self.left[r] == self.right[r] and len(at) > 1:  # in a run of one symbol, from the left
                taken, free = [], -1
                for p in at.tolist():
                    if p != free:
                        taken.append(p)
                        free = nxt[p]
                    else:
                        free = -1
                at = np.array(taken)
            if self.early[r]:
                odd.update(np.searchsorted(ends, at, "right").tolist())
            gone = nxt[at]
            after = nxt[gone]
            sym[at], alive[gone], rank[gone] = self.made[r], False, NONE
            nxt[at], prv[after] = after, at
            before = prv[at]
            touched = np.concatenate((at, before[before < n]))
            beside = nxt[touched]
            new = np.where(beside < n, self._ranks(sym[touched], sym[beside]), NONE)
            rank[touched] = new
            keep = new != NONE
            add(touched[keep], new[keep])
        ids = sym[:n][alive[:n]].tolist()
        counts = np.add.reduceat(alive[:n].astype(np.int64), (ends - sizes)[full]) if n else np.zeros(0, np.int64)
        out, start = [], 0
        sizes_left = iter(counts.tolist())
        for has in full.tolist():
            size = next(sizes_left) if has else 0
            out.append(ids[start : start + size])
            start += size
        for i in odd:
            out[i] = self.one(words[i])
        return out


#: A word of Latin letters and what punctuation follows it: pre-tokenized here where _as_known holds, as these are two pieces that no normal form changes but for their case.
SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:|#*$%&]*)")
#: Byte-level BPE's name of each byte, by code: printable ones stand for themselves, the others for 256 and what follows.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LEVEL = {b: b for b in _PRINTED} | {b: 256 + i for i, b in enumerate(sorted({*range(256)} - {*_PRINTED}))}


def _as_known(spec: dict) -> bool:
    """Whether the file lower-cases text in NFC, splits runs of letters from runs of other signs, and names bytes as above."""
    normal, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    kinds = [x.get("type") for x in normal.get("normalizers", [normal])], [x.get("type") for x in pre.get("pretokenizers", [pre])]
    if kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]):
        return False
    split, level = pre["pretokenizers"]
    pattern = split["pattern"].get("Regex", "")
    return normal["normalizers"][1]["pattern"] == {"Regex": r"\s+"} and pattern.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+") and pattern.startswith("'") and split["invert"] and split["behavior"] == "Removed" and not level["use_regex"] and not level["add_prefix_space"]


def check_tokenizer(path: str) -> dict:
    """The file's contents; an error if its texts can't be encoded chunk by chunk between white space.

    They can if the pre-tokenizer drops white space before all else and no
    added token holds any: then no token reaches over a gap.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    first = pre.get("pretokenizers", [pre])[0]
    drops = first.get("type") in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer") or _as_known(spec)
    if not drops or any(t["content"].split() != [t["content"]] for t in spec["added_tokens"]):
        raise ValueError(f"{path}: white space is part of this tokenizer's tokens, which isn't supported")
    return spec


class Model:
    """A tokenizer file's BPE: its added tokens and normalizer as the library reads them, its merges by a PairIndex."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        spec = check_tokenizer(path)
        m = spec["model"]
        if m["type"] != "BPE" or m.get("dropout") or m.get("continuing_subword_prefix") or m.get("byte_fallback") or m.get("ignore_merges") or m.get("unk_token"):
            raise ValueError(f"{path}: this kind of BPE model isn't supported")
        self.library = Tokenizer.from_file(path)
        self.pairs = PairIndex(m["vocab"], [tuple(x.split(" ") if isinstance(x, str) else x) for x in m["merges"]], m.get("end_of_word_suffix") or "")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.splits = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        self.simple = _as_known(spec)
        names = {i: s for s, i in (m["vocab"] | self.added).items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]

    def encode_chunks(self, chunks: list[bytes]) -> list[np.ndarray]:
        """The ids of each chunk, a text without white space of ASCII."""
        normal, pre = self.library.normalizer, self.library.pre_tokenizer
        index: dict[str, int] = {}
        plans: list[list[int]] = []  # for each chunk, ~id of an added token or the number of a word
        for chunk in chunks:
            text, plan, at = chunk.decode("utf-8", "replace"), [], 0
            if self.simple and (m := SIMPLE.fullmatch(text)):
                plans.append([index.setdefault(w, len(index)) for w in (m[1].lower().encode().decode("latin-1").translate(BYTE_LEVEL), m[2]) if w])
                continue
            for m in [*self.splits.finditer(text), None] if "<" in text else [None]:
                part = text[at : m.start() if m else None]
                if part:
                    part = normal.normalize_str(part) if normal else part
                    plan += [index.setdefault(w, len(index)) for w, _ in pre.pre_tokenize_str(part)] if part else []
                if m:
                    plan.append(~self.added[m[0]])
                    at = m.end()
            plans.append(plan)
        ids = self.pairs.encode(list(index))
        return [np.array([y for x in plan for y in ([~x] if x < 0 else ids[x])], "<u4") for plan in plans]

    def decode(self, ids: Iterable[int]) -> str:
        """As decode(ids, skip_special_tokens=False) of a tokenizer file without a decoder."""
        if self.library.decoder is not None:
            return self.library.decode(list(ids), skip_special_tokens=False)
        return " ".join(self.names[i] for i in ids)


class LibraryCache(dict):
    """Ids (little-endian unsigned 32-bit) of chunks between ASCII white space by the tokenizers library; a missing chunk is encoded when asked for.

    Simple chunks go to the library's BPE model, which spares its normalizer's
    bookkeeping; all others go through the whole library. A full cache becomes
    the older half, so that common chunks stay.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model, self.older = self.library.model, {}
        self.simple = _as_known(check_tokenizer(path))

    def _ids(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8", "replace")
        m = SIMPLE.fullmatch(text) if self.simple else None
        if not m:
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        word, rest = m.groups()
        low = word.lower()
        if rest or low != word:
            own = self[low.encode()]
            return own + self[rest.encode()] if rest else own
        return array("I", [t.id for t in self.model.tokenize(low if chunk.isascii() else chunk.decode("latin-1").translate(BYTE_LEVEL))]).tobytes()

    def __missing__(self, chunk: bytes) -> bytes:
        found = self.older.get(chunk)
        if found is None:
            found = self._ids(chunk)
        if len(self) >= LIBRARY_CACHE // 2:
            self.older = dict(self)
            self.clear()
        self[chunk] = found
        return found

    def encode(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    return Model(path)


class ChunkCache:
    """Ids of texts by the ids of their chunks between ASCII white space, each chunk encoded once.

    That is exact for models whose pre-tokenizer drops white space and whose
    added tokens hold none: no token then reaches over a gap.
    """

    def __init__(self, coder, text: Callable[[np.ndarray], bytes] | None = None) -> None:
        self.coder, self.text = coder, text
        self.ids: dict[bytes, bytes] = {}
        self.texts: dict[bytes, bytes] = {}

    def learn(self, texts: Iterable[bytes]) -> None:
        new: set[bytes] = set()
        for t in texts:
            new.update(t.split())
        fresh = [c for c in new if c not in self.ids]
        if len(self.ids) + len(fresh) > CACHE:
            for known in (self.ids, self.texts):
                kept = {c: known[c] for c in new if c in known}
                known.clear()
                known.update(kept)
        # A word in capitals or with punctuation is put together from its parts, which are often known.
        parts: dict[bytes, tuple[bytes, bytes]] = {}
        for chunk in fresh if self.coder.simple else []:
            if m := SIMPLE.fullmatch(chunk.decode("utf-8", "replace")):
                part = m[1].lower().encode(), m[2].encode()
                if part != (chunk, b""):
                    parts[chunk] = part
        plain = {c for c in fresh if c not in parts} | {c for pair in parts.values() for c in pair if c and c not in self.ids}
        for chunk, ids in zip(plain, self.coder.encode_chunks(list(plain)), strict=True):
            self.ids[chunk] = ids.tobytes()
            if self.text:
                self.texts[chunk] = self.text(ids)
        for chunk, (word, rest) in parts.items():
            self.ids[chunk] = self.ids[word] + (self.ids[rest] if rest else b"")
            if self.text:
                self.texts[chunk] = b" ".join((self.texts[word], self.texts[rest])) if rest else self.texts[word]

    def encode(self, text: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return b"".join(map(self.ids.__getitem__, text.split()))

    def decode(self, text: bytes) -> bytes:
        """What the ids of the text decode to, joined by a space as they are."""
        return b" ".join(filter(None, map(self.texts.__getitem__, text.split())))


@lru_cache(maxsize=1)
def chunk_cache(path: str) -> ChunkCache:
    """A worker's cache, kept from task to task."""
    m = model(path)
    return ChunkCache(m, lambda ids: m.decode(ids.tolist()).encode())


@lru_cache(maxsize=1)
def library_cache(path: str) -> LibraryCache:
    return LibraryCache(path)


def sliced(texts: list[bytes], most: int = SLICE) -> Iterator[range]:
    """Ranges of texts of at most that many bytes together, or of one text."""
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > most:
            yield range(start, i)
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield range(start, len(texts))


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 texts, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def bpe_encode(docs: DataFrame, tokenizer: str, digest: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids array<int>, decoded), or digests in place of the last two.

    A row for each row of docs, nulls and repeats of doc_id included; a null
    text, like an empty one, has no ids and decodes to the empty text. Special
    tokens' strings in a text become those tokens, as in the library. Other
    columns of docs are not looked at. No shuffle; memory holds a batch of
    rows and a bounded cache of chunks. tokenizer: a path that each executor
    can open.
    """
    check_tokenizer(tokenizer)
    schema = "doc_id long, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, cache = model(tokenizer), chunk_cache(tokenizer)
        if m.library.decoder is not None:
            raise ValueError("texts of chunks can only be joined where the tokenizer has no decoder")
        for batch in batches:
            texts = texts_of(batch.column(1))
            for lot in sliced(texts, LEARN):
                cache.learn(texts[i] for i in lot)
                tidy()
                for part in sliced(texts[lot.start : lot.stop]):
                    start = lot.start + part.start
                    own = texts[start : start + len(part)]
                    ids = [cache.encode(t) for t in own]
                    back = [cache.decode(t) for t in own]
                    counts = pa.array([len(x) // 4 for x in ids], pa.int64())
                    if digest:
                        rest = [pa.array([hashlib.sha256(x).hexdigest() for x in y]) for y in (ids, back)]
                    else:
                        ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
                        rest = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4"))), pa.array([x.decode("utf-8") for x in back])]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(part)), counts, *rest], ["doc_id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digest else ["ids", "decoded"])])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(run, schema)


def bpe_decode(rows: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, decoded) from doc_id and ids array<int>; null ids decode to the empty text, an id outside the vocabulary is an error."""
    schema = "doc_id long, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(tokenizer)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m.decode(ids or []) for ids in batch.column(1).to_pylist()], pa.string())], ["doc_id", "decoded"])

    return rows.select(rows["doc_id"].cast("long").alias("doc_id"), rows["ids"].cast("array<int>").alias("ids")).mapInArrow(run, schema)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode(table(spark, sf_dir, "documents"), tokenizer_path(), digest=True)
