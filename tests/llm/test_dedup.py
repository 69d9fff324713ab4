"""Substring, suffix-array and similarity operators against brute force."""

import collections
import dataclasses
import hashlib

import numpy as np
import pytest
from corpora import corpus, frame, with_odd_rows
from pyspark.sql import functions as F

from landpulse.llm import anchors, decontamination, similarity_join, substring_dedup, suffix_array, words
from landpulse.llm.common import NO_ID, keyed
from landpulse.llm.graph import components


def plain_windows(rows):
    first = {}
    key = lambda d: NO_ID if d is None else d
    for d, t, *_ in sorted(rows, key=lambda r: key(r[0])):
        w = (t or "").encode().split()
        for i in range(len(w) - 49):
            first.setdefault(tuple(w[i : i + 50]), key(d))
    out = collections.Counter()
    for d, t, *_ in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < key(d):
                gone[i : i + 50] = [True] * 50
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def plain_strings(rows):
    n = suffix_array.LENGTH
    texts = [(d, (t or "").encode()) for d, t, *_ in rows]
    seen = collections.Counter(t[i : i + n] for _, t in texts for i in range(len(t) - n + 1))
    out = collections.Counter()
    for d, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - n + 1):
            if seen[t[i : i + n]] > 1:
                gone[i : i + n] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~gone[: len(t)]].tobytes()
        out[d, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("small", [False, True])
def test_substrings(spark, monkeypatch, small):
    if small:  # groups beyond so many words and bytes are split, down to single windows
        for m, lot in zip((substring_dedup, suffix_array), (120, 500), strict=True):
            monkeypatch.setattr(m, "KIND", dataclasses.replace(m.KIND, lot=lot))
        monkeypatch.setattr(anchors, "HOT", 1)  # no key is hot
    rows = with_odd_rows(corpus(3))
    df = frame(spark, rows).withColumn("key", F.lit("k")).withColumn("spans", F.lit(0))
    assert collections.Counter(map(tuple, substring_dedup.substring_dedup(df, True).collect())) == plain_windows(rows)
    assert collections.Counter(map(tuple, suffix_array.suffix_dedup(df, True).collect())) == plain_strings(rows)


def test_lots_are_bounded_whatever_a_batch_holds(spark):
    """Many small groups in one batch: each call gets whole groups, of a lot at most unless one group is larger."""
    kind = dataclasses.replace(suffix_array.KIND, lot=5000)
    rows = [(g, i, 0, 1, g, 0, 1 + g % 7, b"x") for g in range(900) for i in range(1 if g % 50 else 40)]
    seen = lambda lot: anchors._batch(anchors.MARKS, [[len(set(lot["group"].to_pylist()))], [sum(lot["n"].to_pylist()) + len(lot) * (kind.width - 1)], [len(lot)], [0], [0], [0]])
    lots = anchors._lots(spark.createDataFrame(rows, anchors.PARTS), kind, seen).collect()
    assert sum(r.s2 for r in lots) == len(rows) and sum(r.group for r in lots) == 900
    assert all(r.s1 <= kind.lot or r.group == 1 for r in lots) and len(lots) < 150


def thue_morse(letters, swap=False):
    return "".join("ab"[(i.bit_count() + swap) % 2] for i in range(letters))


@pytest.mark.parametrize("letters", [1024, 2048])
def test_words_that_polynomial_hashes_take_for_one(spark, letters):
    """Thue-Morse words and their complements agree in every such hash modulo a power of two."""
    a, b = thue_morse(letters), thue_morse(letters, True)
    filled = lambda x: " ".join([x] + [f"w{i}" for i in range(58)] + [x])
    rows = [(0, filled(a), None, None, 0), (1, filled(b), None, None, 0), (2, " ".join([a] * 60), None, None, 0), (3, " ".join([b] * 60), None, None, 0)]
    df = frame(spark, rows)
    assert collections.Counter(map(tuple, substring_dedup.substring_dedup(df, True).collect())) == plain_windows(rows)
    got = collections.Counter((r.key, r.n, r.component) for r in similarity_join.similarity_join(df, 4, 85).collect())
    assert got == plain_links(rows, 4, 85)
    assert len(set(decontamination.normal_words([a.encode(), b.encode()])[0].tolist())) == 2


def test_word_hashes():
    rng = np.random.default_rng(4)
    texts = [b"", b" ", b"a", rng.bytes(5000), b"x" * 700 + b" " + b"x" * 701 + b"\x00 \x00\x00", b"tail " * 3]
    found, sizes, counts = words.split_words(texts)
    plain = [w for t in texts for w in t.split()]
    assert counts.tolist() == [len(t.split()) for t in texts] and sizes.tolist() == [len(w) for w in plain]
    by_word = dict(zip(plain, found.tolist(), strict=True))
    assert [by_word[w] for w in plain] == found.tolist() and len(set(by_word.values())) == len(by_word)


def test_empty_and_texts(spark):
    assert substring_dedup.substring_dedup(frame(spark, [])).count() == 0
    assert suffix_array.suffix_dedup(frame(spark, [])).count() == 0
    text = " ".join(f"v{i}" for i in range(60))
    rows = [(0, text, None, None, 0), (1, "x " + text + " y", None, None, 0)]
    assert {r.doc_id: r.kept_text for r in substring_dedup.substring_dedup(frame(spark, rows)).collect()} == {0: text, 1: "x y"}


def test_pieces_cover_each_window_once(monkeypatch):
    monkeypatch.setattr(anchors, "PIECE", 64)
    seq = np.random.default_rng(0).integers(0, 4, 500).astype(np.uint64)
    found = sorted((a + int(s) + j) for a, b in anchors.pieces(len(seq), 20) for s, n, _, _ in zip(*anchors.runs_in(seq[a:b], 20, 4), strict=True) for j in range(n))
    assert found == list(range(len(seq) - 19))


@pytest.mark.parametrize("letters", [1, 2, 4, 200])
@pytest.mark.parametrize("n", [0, 1, 2, 40, 2000])
def test_suffix_array(n, letters):
    text = np.random.default_rng(n + letters).integers(0, letters, n).astype(np.uint8)
    if n > 1000:
        text[500:900] = text[:400]
    b, order = text.tobytes(), suffix_array.suffix_array(text).tolist()
    assert sorted(order) == list(range(n))
    assert [b[i : i + 200] for i in order] == sorted(b[i : i + 200] for i in range(n))
    for x, got in enumerate(suffix_array.common_prefixes(text, np.array(order, np.int64)).tolist()):
        p, q = (b[order[x - 1] : order[x - 1] + 200], b[order[x] : order[x] + 200]) if x else (b"", b"")
        same = next((k for k, (u, v) in enumerate(zip(p, q, strict=False)) if u != v), min(len(p), len(q)))
        assert got == same or (got > same and same == min(len(p), len(q)))


@pytest.mark.parametrize("depth", [1, 2, 3, 7, 50])
def test_subtree(depth):
    codes = np.random.default_rng(1).integers(0, 2, 300)
    codes[200:260] = codes[20:80]
    places = np.flatnonzero(np.random.default_rng(2).integers(0, 4, 300 - depth + 1))
    tree = substring_dedup.Subtree(codes, places, depth)
    grams = [tuple(codes[p : p + depth]) for p in places[tree.order].tolist()]
    assert grams == sorted(tuple(codes[p : p + depth]) for p in places.tolist())
    common = lambda x, y: next((k for k, (u, v) in enumerate(zip(x, y, strict=True)) if u != v), depth)
    assert tree.shared.tolist() == [common(x, y) for x, y in zip(grams, grams[1:], strict=False)]
    least = max(1, depth // 2)
    # Nodes: prefixes that at least two suffixes have and no longer one has with just as many.
    have = collections.Counter(g[:d] for g in grams for d in range(1, depth + 1))
    want = {(g, have[g]) for g in have if have[g] > 1 and len(g) >= least and not any(have.get(g + (c,)) == have[g] for c in (0, 1))}
    assert {(grams[a][:d], b - a) for d, a, b in tree.internal(least)} == want
    tops = {tuple(x) for x in np.stack(tree.tops(depth), axis=1).tolist()}
    assert tops == {(a, b) for d, a, b in tree.internal(depth)}


def plain_links(rows, k, percent):
    """For each row (doc_id, set size, least key reached)."""
    sets = []
    for _, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    key = [NO_ID if r[0] is None else r[0] for r in rows]
    least = {}
    for i, x in enumerate(key):
        least[find(i)] = min(least.get(find(i), x), x)
    return collections.Counter((x, len(s), least[find(i)] if s else x) for i, (x, s) in enumerate(zip(key, sets, strict=True)))


@pytest.mark.parametrize("often,group,block,k,percent", [(8, 16, 4096, 4, 85), (0, 2, 7, 4, 85), (2, 3, 4096, 5, 80), (0, 16, 20, 1, 55)])
def test_similarity_join(spark, monkeypatch, often, group, block, k, percent):
    for name, value in (("FREQUENT_FROM", often), ("GROUP", group), ("BLOCK", block)):
        monkeypatch.setattr(similarity_join, name, value)
    rows = with_odd_rows(corpus(4, 160))
    df = frame(spark, rows).withColumn("sig", F.lit(1)).withColumn("n", F.lit(1))
    got = collections.Counter((r.key, r.n, r.component) for r in similarity_join.similarity_join(df, k, percent).collect())
    assert got == plain_links(rows, k, percent)


@pytest.mark.parametrize("group,block", [(16, 4096), (2, 7)])
def test_similarity_links(spark, monkeypatch, group, block):
    for name, value in (("FREQUENT_FROM", 0), ("GROUP", group), ("BLOCK", block)):
        monkeypatch.setattr(similarity_join, name, value)
    near = [(500 + i, " ".join(f"n{j if j != 3 * i else -i}" for j in range(150)), None, None, 0) for i in range(30)]
    rows = [r for r in corpus(4, 90) if r[0] is not None] + near
    sets = {}
    for d, t, *_ in rows:
        w = (t or "").encode().lower().split()
        if w:
            s = frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)])
            sets[s] = min(sets.get(s, d), d)
    of = list(sets.items())
    want = sorted(tuple(sorted((x, y))) for i, (a, x) in enumerate(of) for b, y in of[:i] if 100 * len(a & b) >= 85 * len(a | b))
    got = sorted(tuple(sorted((r.key_a, r.key_b))) for r in similarity_join.similarity_links(frame(spark, rows), 4, 85).collect())
    assert got == want and len(want) > 400
    assert similarity_join.similarity_links(frame(spark, [])).count() == 0


def test_members_of_large_groups_are_rows_once(spark):
    """Near copies share many signatures, and one row for each of their pivots."""
    near = [(i, " ".join(f"n{j if j != 5 * i else -i}" for j in range(200)), None, None, 0) for i in range(40)]
    _, members, _, _ = similarity_join._first_links(keyed(frame(spark, near)), 4, 85, "members")
    rows = members.collect()
    assert len({(r.pivot, r.sid) for r in rows}) == len(rows) and 40 <= len(rows) < sum(len(r.sigs) for r in rows)


def test_cross_links_grow_with_members_not_with_pairs(spark):
    """Near copies, each a part of its own: what is compared gives rows by members, and links that join them all."""
    near = [(i, " ".join(f"n{j if j != 3 * i else -i}" for j in range(200)), None, None, 0) for i in range(60)]
    base = keyed(frame(spark, near))
    sets, members, _, _ = similarity_join._first_links(base, 4, 85, "cross")
    of = members.withColumn("part", F.col("sid"))
    assert 60 <= similarity_join._cross_parts(of, sets, 85).count() <= of.count()
    links = similarity_join._cross_links(base, of, sets, 4, 85, "cross").collect()
    assert 59 <= len(links) <= of.count() - of.select("pivot").distinct().count()
    assert len({r.label for r in components(spark.createDataFrame(links)).collect()}) == 1


@pytest.mark.parametrize("group,block,tokens", [(2, 4096, 2_000_000), (2, 9, 2_000_000), (4, 4096, 900)])
def test_near_copies_of_near_copies(spark, monkeypatch, group, block, tokens):
    """Each text has some words of an earlier one changed, so links are a part of a large group's pairs, and chains of them join it in pieces."""
    for name, value in (("FREQUENT_FROM", 0), ("GROUP", group), ("BLOCK", block), ("TOKENS", tokens)):
        monkeypatch.setattr(similarity_join, name, value)
    rng = np.random.default_rng(7)
    texts = [[f"w{j}" for j in range(120)]]
    for i in range(1, 150):
        text = list(texts[int(rng.integers(len(texts)))])
        for j in rng.integers(0, 100, int(rng.integers(1, 4))).tolist():
            text[j] = f"e{i}"
        texts.append(text)
    rows = [(i, " ".join(t), None, None, 0) for i, t in enumerate(texts)]
    got = collections.Counter((r.key, r.n, r.component) for r in similarity_join.similarity_join(frame(spark, rows), 4, 85).collect())
    assert got == plain_links(rows, 4, 85) and 2 < len({c for _, _, c in got}) < 150


def test_components(spark):
    """A path, a star with a large centre, cliques and single edges; each round's edges are only those between trees."""
    edges = [(i, i + 1) for i in range(40)] + [(99, i) for i in range(60, 99)] + [(a, b) for a in range(100, 112) for b in range(100, a)] + [(200, 201), (300, 300), (201, 200)]
    got = {r.v: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {**{i: 0 for i in range(41)}, **{i: 60 for i in range(60, 100)}, **{i: 100 for i in range(100, 112)}, 200: 200, 201: 200, 300: 300}
    assert got == want and components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sets_that_share_an_id(spark):
    sets = spark.createDataFrame([(1, 5, 1), (2, 5, 2), (3, 5, 2), (4, 6, 9)], "key long, sid long, rest long")
    got = {r.key: r.sid for r in similarity_join._told_apart(sets, spark.createDataFrame([(5, 1)], "sid long, lo long"), "ids").collect()}
    assert got[1] == 5 and got[4] == 6 and got[2] == got[3] not in (5, 6) and got[2] > 0


@pytest.mark.parametrize("percent", [51, 60, 75, 80, 85, 99, 100])
def test_signatures_reach_every_similar_set(percent):
    """Frequent tokens only, down to sets of one and two, with hashes as uneven as can be."""
    rng = np.random.default_rng(percent)
    for size in (1, 2, 3, 4, 5, 7, 12, 30, 70, 200):
        for spread in (1, 20, 63):
            a = np.unique(rng.integers(0, 1 << spread, size, np.uint64) << np.uint64(63 - spread) | rng.integers(0, 1 << 20, size, np.uint64))
            for cut in range(4):
                b = np.unique(np.concatenate((a[: len(a) - cut], rng.integers(0, 1 << 63, cut * 2, np.uint64)))) if cut < len(a) else a
                often = np.unique(np.concatenate((a, b)))
                shared = len(np.intersect1d(a, b))
                if similarity_join.linked(shared, len(a), len(b), percent) and not np.array_equal(a, b):
                    assert len(np.intersect1d(*(similarity_join.signatures(x, often, percent) for x in (a, b)))), (size, spread, cut)


def test_similarity_join_of_nothing(spark):
    with pytest.raises(ValueError):
        similarity_join.similarity_join(frame(spark, []), percent=50)
    assert similarity_join.similarity_join(frame(spark, [])).count() == 0


def test_bounds():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 40, 700):
        a = np.unique(rng.integers(0, 1 << 63, n, np.uint64) << np.uint64(1))
        b = np.unique(np.concatenate((a[: n // 2 + 1], rng.integers(0, 1 << 63, n // 3 + 1, np.uint64))))
        shared = len(np.intersect1d(a, b))
        read = lambda f, kind, s: np.frombuffer(f(s), kind)
        assert similarity_join.sketch_bound(*(read(similarity_join.sketch, "u1", s) for s in (a, b))) >= shared
        assert similarity_join.tag_bound(*(read(similarity_join.tags, "<u2", s) for s in (a, b))) >= shared
