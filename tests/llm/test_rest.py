"""Toxicity, decontamination, WARC and the pipeline."""

import collections
import random
import re
import time

import numpy as np
import pytest
from corpora import corpus, frame, with_odd_rows
from pyspark.sql import functions as F

import corpus_pipeline
from landpulse.llm import bpe, common, decontamination, toxicity, warc
from landpulse.llm.common import work_path

DATA = "/root/testdata/sf0.1"


def test_toxicity_on_held_out_rows(spark):
    from landpulse.llm.registry import QUERIES

    out = QUERIES["op2_toxicity"](spark, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "toxic")
    rows = out.join(labels, "doc_id").where("held_out").collect()
    hit = sum(r.predicted == 1 and r.toxic == 1 for r in rows)
    assert hit >= 0.85 * sum(r.toxic for r in rows) and hit >= 0.9 * sum(r.predicted for r in rows)
    assert out.count() == 10_000 and out.where("score < 0 or score > 1 or score is null").count() == 0


def test_toxicity_cases(spark):
    rng = random.Random(0)
    word = lambda: f"w{rng.randrange(300)}"
    rows = [(i, " ".join([word() for _ in range(40)] + (["vile"] if i % 4 == 0 else [])), "en", "s", 1) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(None, 1), (900, None)], "doc_id long, toxic int")
    docs = frame(spark, rows)
    net, marks = toxicity.fit(docs, labels)
    scored = {r.doc_id: r.score for r in toxicity.score(docs, net, marks).collect()}
    assert all((scored[i] >= 0.5) == (i % 4 == 0) for i in range(200))
    odd = toxicity.score(frame(spark, with_odd_rows(corpus(1))).withColumn("score", F.lit(5)), net, marks, ["doc_id", "score"])
    assert odd.columns == ["doc_id", "score_given", "score", "lang_threshold", "rejected"] and odd.count() == 123
    clashing = docs.withColumn("rejected", F.lit("x")).withColumn("lang_threshold", F.lit(1)).withColumn("score", F.lit(2)).drop("lang")
    kept = toxicity.clean(clashing, net, marks)
    assert kept.columns == clashing.columns and {r.doc_id for r in kept.collect()} == {i for i in range(200) if scored[i] < marks[None]}
    assert toxicity.score(frame(spark, []), net, marks).count() == 0
    none, marks = toxicity.fit(docs, labels.limit(0))
    assert {round(r.score, 6) for r in toxicity.score(docs, none, marks).collect()} == {0.01} and marks == {None: 0.5}


def test_training_learns_word_order():
    """Both classes have the same words; only their order tells. The start, which knows words alone, is no better than chance."""
    rng = random.Random(3)

    def text(toxic):
        w = [f"w{rng.randrange(200)}" for _ in range(30)]
        i, j = rng.sample(range(0, 30, 3), 2)
        w[i : i + 2], w[j : j + 2] = (["red", "fox"], ["blue", "dog"]) if toxic else (["red", "dog"], ["blue", "fox"])
        return " ".join(w).encode()

    y = np.array([k % 2 for k in range(1200)], np.float32)
    rows = [toxicity.features([text(k)])[0] for k in y]
    share = {}
    for epochs in (0, 8):
        net = toxicity.train([r[: -toxicity.PAD] for r in rows[:900]], y[:900], epochs=epochs)
        share[epochs] = np.mean([(net.scores(r, np.array([0]))[0] >= 0.5) == k for r, k in zip(rows[900:], y[900:], strict=True)])
    assert share[0] < 0.65 and share[8] > 0.95


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MOST_CHARS", 2000)
    docs = frame(spark, [(i, "good word " * 10 + ("vile" if i % 4 == 0 else ""), "en", "s", 0) for i in range(200)] + [(7, "x" * 1500, None, None, 0)] * 3)
    net, marks = toxicity.fit(docs, spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int"))
    assert 0 <= marks[None] <= 1 and toxicity.score(docs, net, marks).count() == 203


def test_every_labelled_row_is_learned_from(spark, monkeypatch):
    """In several shards, with texts of any length: all are counted, and what only long texts say is learned."""
    counts = []
    monkeypatch.setattr(toxicity, "MOST_CHARS", 200_000)
    monkeypatch.setattr(toxicity, "begun", lambda share, seen, rng, plain=toxicity.begun: counts.append((share, seen)) or plain(share, seen, rng))
    rng = random.Random(5)
    rows = [(i, " ".join(["all"] + [f"w{rng.randrange(300)}" for _ in range(13_000 if i % 10 == 0 else 30)] + ["vile"] * (i % 20 == 0)), "en", "s", 0) for i in range(400)]
    assert len(rows[0][1]) > 50_000
    docs = frame(spark, rows)
    net, marks = toxicity.fit(docs, spark.createDataFrame([(i, int(i % 20 == 0)) for i in range(400)], "doc_id long, toxic int"))
    learned = docs.select("doc_id", toxicity.fold(F.col("doc_id")).alias("part")).where("part > 1").count()
    ((share, seen),) = counts
    assert seen[0].max() == learned and 0 < share < 0.1
    scored = {r.doc_id: r.score for r in toxicity.score(docs, net, marks).collect()}
    assert all((scored[i] >= 0.5) == (i % 20 == 0) for i in range(400))


def test_features():
    rows, starts = toxicity.features([b"abc defghijkl", b"", b"abc, ABC"])
    assert starts.tolist() == [0, 4, 6] and (rows[0] == rows[6]).all() and (rows[6] == rows[7]).all() and not rows[4:6].any()
    net = toxicity.Net.constant(0.3)
    assert net.scores(rows, starts) == pytest.approx([0.3] * 3)


def norm(text):
    return re.findall(r"\w+", (text or "").lower())


def nearest(item, words):
    """Edits from the item to the nearest part of words."""
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(words, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(150):
        a, b = [rng.randrange(1, 5) for _ in range(rng.randint(1, 10))], [rng.randrange(1, 5) for _ in range(rng.randint(0, 20))]
        edits, x, y = decontamination.edit_distance(np.array(a, np.uint64), np.array(b, np.uint64))
        assert edits == nearest(a, b) == nearest(a, b[x:y])


@pytest.mark.parametrize("longest,pairs", [(256, 1 << 21), (12, 600)])
def test_decontamination(spark, monkeypatch, longest, pairs):
    for name, value in (("LONGEST", longest), ("GAP", 2 * longest), ("PAIRS", pairs)):
        monkeypatch.setattr(decontamination, name, value)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)] + ["éa", "ÑB"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 4, 8, 15, 30, 60])))) for i in range(25)] + [(50, ""), (51, None), (None, "only here once more")]
    rows = []
    for i in range(250):
        text = [rng.choice(words) for _ in range(rng.randint(0, 120))]
        if i % 2:
            part = rng.choice(items[:25])[1].split()
            for _ in range(rng.randint(0, len(part) // 5)):
                j = rng.randrange(len(part))
                part[j : j + 1] = rng.choice([[], [rng.choice(words)], [part[j], rng.choice(words)]])
            at = rng.randint(0, len(text))
            text[at:at] = part
        rows.append((i, (" ".join(text).upper() if i % 3 == 0 else ", ".join(text)), "en", "s", 0))
    rows += [(None, "Only here ONCE more", None, None, 0), (300, None, None, None, 0), rows[1]]
    want = {(d, i): e for d, t, *_ in rows for i, y in items if norm(y) for e in [nearest(norm(y), norm(t))] if e <= len(norm(y)) // 5}
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, rows).withColumn("item_id", F.lit(1))
    got = {(r.doc_id, r.item_id): r.edits for r in decontamination.contaminated(docs, bench).collect()}
    assert set(got) <= set(want) and all(got[k] == want[k] for k in got) and len(got) >= 0.99 * len(want)
    blocks = {(r.doc_id, r.item_id): r.edits for r in decontamination.contaminated(docs, bench, block=7).collect()}
    assert len(blocks) >= 0.99 * len(want)
    clean = decontamination.clean(docs, bench)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {r[0] for r in rows} - {d for d, _ in got}
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0 and decontamination.clean(frame(spark, []), bench).count() == 0


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        j = rng.randrange(len(out))
        out[j : j + 1] = rng.choice([[], [f"x{rng.getrandbits(40)}"], [out[j], f"x{rng.getrandbits(40)}"]])
    return out


def found_in(index, words):
    hashed, counts = decontamination.normal_words([" ".join(words).encode()])
    return {i for _, i, *_ in index.matches(hashed, np.array([0, int(counts[0])]))}


@pytest.mark.parametrize("n", [15, 60, 600])
def test_recall_on_fresh_edits(n):
    rng = random.Random(n)
    items = [(i, " ".join(f"v{rng.randrange(3000)}" for _ in range(n))) for i in range(40)]
    index = decontamination.Index(items)
    around = lambda: [f"v{rng.randrange(3000)}" for _ in range(40)]
    hit = [i in found_in(index, around() + edited(rng, t.split(), n // 5) + around()) for i, t in items for _ in range(5)]
    assert np.mean(hit) >= 0.98


def test_items_with_one_stem():
    """Work on a stem that all items share doesn't grow with items times places."""
    rng = random.Random(5)
    stem = [f"s{i}" for i in range(20)]
    items = [(i, " ".join(stem + [f"v{rng.randrange(5000)}" for _ in range(rng.randint(10, 50))])) for i in range(2000)]
    index = decontamination.Index(items)
    begin = time.process_time()
    assert found_in(index, stem * (2**20 // 74)) == set() and time.process_time() - begin < 20
    assert found_in(index, items[7][1].split() + stem * 50 + items[9][1].split()) == {7, 9}


def test_warc(spark):
    rng = random.Random(3)
    big = ["é" * 60, "x" * 100, "y" * 99, "", None, "z\r\n\r\n" * 50]
    rows = [(i, rng.choice(["http://www.a.com/p?q=1", "https://b.org:444/", None, "not a url", "http://A.com/p#f"]), rng.choice(big), "k") for i in range(60)]
    rows += [rows[0], (None, "http://a.com/", "x" * 100, "k")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    captures = warc.merge_runs(warc.capture_runs(warc.write_archives(pages, work_path(spark, "w")))).collect()
    assert len(captures) == len(rows)
    keys = [(r.url_key, r.captured_at, r.page_id is not None, r.page_id or 0) for r in captures]
    assert keys == sorted(keys)
    first = {}
    for i, _, html, _ in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    by_id = {i: (html or "") for i, _, html, _ in rows}
    for r in captures:
        html = by_id[r.page_id]
        again = len(html.encode()) >= warc.LEAST and first[html] != r.page_id
        assert (r.record_type, r.refers_to, r.payload_bytes) == (("revisit", first[html]) if again else ("response", None)) + (len(html.encode()),)
    none = warc.write_archives(pages.limit(0), work_path(spark, "w"))
    assert none.count() == 0 and warc.merge_runs(warc.capture_runs(none)).count() == 0


def test_url_keys():
    assert warc.url_key("http://www.Example.com:80/a?b=1#c") == "com,example)/a?b=1"
    assert warc.url_key("https://x.org:8443") == "org,x:8443)/"
    assert warc.url_key(None) == "" and warc.url_key("http://[bad") == "http://[bad"


@pytest.mark.parametrize("k", [0, 1, 2, 3, 8, 13])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted([(rng.choice("ab"), str(rng.randrange(9)), rng.choice([None, 1, 2])) for _ in range(rng.randint(0, 20))], key=warc._key) for _ in range(k)]
    assert [warc._key(r) for r in warc.loser_tree(runs)] == sorted(warc._key(r) for run in runs for r in run)


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    rows = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
        rows.append(docs.count())
    assert rows == sorted(rows, reverse=True) and rows[-1] > 0.5 * rows[0]
    assert corpus_pipeline.run(spark, sf).count() == rows[-1]


def plain_score(net, text):
    """The net's score of a text, word by word."""
    rows = toxicity.features([text.encode()])[0][: -toxicity.PAD].tolist()
    words = [sum(net.embed[b] for b in row) for row in rows] + [np.zeros(toxicity.DIM)] * (2 * toxicity.PAD)
    total, tap = net.intercept, 0
    for i, width in enumerate(toxicity.WIDTHS):
        for f in range(toxicity.FILTERS):
            at = i * toxicity.FILTERS + f
            answers = [sum(words[p + k] @ net.filters[:, (tap + k) * toxicity.FILTERS + f] for k in range(width)) for p in range(len(words) - toxicity.PAD)]
            total += max(max(answers) + net.bias[at], 0) * net.out[at]
        tap += width
    return 1 / (1 + np.exp(-total))


def plain_line_dedup(rows):
    """rows: (key, th, text, rest); a place is (key, first line, th)."""
    least = {}
    for key, th, text, _ in rows:
        lines = text.split("\n")
        for i in range(len(lines) - 1):
            pair = (lines[i], lines[i + 1])
            least[pair] = min(least.get(pair, (key, i, th)), (key, i, th))
    out = []
    for key, th, text, rest in rows:
        lines = text.split("\n")
        gone = set()
        for i in range(len(lines) - 1):
            k, first, h = least[lines[i], lines[i + 1]]
            if (k, first, h) != (key, i, th) and not ((k, h) == (key, th) and i < first + 2):
                gone |= {i, i + 1}
        left = "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text
        out.append((key, th, left, rest))
    return out


def plain_jaccard(rows, k=5, percent=80):
    sets = []
    for _, _, text, _ in rows:
        w = text.encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                group[find(i)] = find(j)
    best = {}
    for i, (key, th, *_) in enumerate(rows):
        best[find(i)] = min(best.get(find(i), (key, th)), (key, th))
    out, seen = [], set()
    for i, row in enumerate(rows):
        if not sets[i]:
            out.append(row)
        elif best[find(i)] == row[:2] and row[:2] not in seen:
            seen.add(row[:2])
            out.append(row)
    return out


def test_pipeline_against_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    rng = random.Random(11)
    vile = [(300 + i, " ".join(rng.choice(["vile", f"w{rng.randrange(80)}"]) if j % 9 == 0 else f"w{rng.randrange(80)}" for j in range(40)), "en", "s", 7) for i in range(60)]
    bench = [(i, " ".join(f"b{rng.randrange(400)}" for _ in range(rng.choice([8, 20, 40])))) for i in range(12)] + [(None, None), (13, "")]
    leaks = [(400 + i, " ".join(["zz"] * 5 + edited(rng, bench[i][1].split(), len(bench[i][1].split()) // 8) + [f"w{i}"]), None, None, 3) for i in range(12)]
    several = [(None if i % 2 else 500, f"only {i} here\nand {i} there " + " ".join(f"u{i}v{j}" for j in range(12)), "de", None, 1) for i in range(20)]
    wordless = [(None, None, "en", "a", 0), (None, None, "de", "b", 0), (None, " ", "de", "b", 0), (501, "", "en", "a", 0), (501, "", "en", "c", 0)]
    rows = with_odd_rows(corpus(9, 100)) + vile + leaks + several + wordless + [several[0], leaks[0]]
    docs = frame(spark, rows).withColumn("score", F.lit(1)).withColumn("class", F.lit("c"))
    for name, df in (
        ("documents", docs),
        ("benchmark", spark.createDataFrame(bench, "item_id long, text string")),
        ("labels", spark.createDataFrame([(r[0], int("vile" in (r[1] or "").split())) for r in rows if r[0] is not None], "doc_id long, toxic int")),
    ):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    sf = str(tmp_path)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    net, marks = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rest = lambda r: tuple(x for c, x in r.asDict().items() if c not in ("text", "n_chars"))
    rows_of = lambda df: [(x.key, x.th, x.text, rest(x.rest)) for x in common.keyed(df, carry=True).collect()]
    given = rows_of(docs)
    langs = [r[3][docs.columns.index("lang") - docs.columns.index("text")] for r in given]
    clean = [r for r, lang in zip(given, langs, strict=True) if plain_score(net, r[2]) < marks.get(lang, marks[None])]
    assert {r[3][0] for r in given} - {r[3][0] for r in clean} >= {300 + i for i in range(60) if vile[i][1].split().count("vile") > 1}
    once = lambda want: collections.Counter((t, r) for _, _, t, r in want)
    got, want = docs, clean
    stages = [lambda x: x, plain_line_dedup, plain_jaccard, lambda x: [r for r in x if not any(norm(t) and nearest(norm(t), norm(r[2])) <= len(norm(t)) // 5 for _, t in bench)]]
    for (name, stage), plain in zip(corpus_pipeline.STAGES, stages, strict=False):
        want = plain(want)
        got = common.written(stage(spark, got, sf), "stage")
        assert got.columns == docs.columns
        assert once(rows_of(got)) == once(want), name
        # Texts have changed, and with them their hashes.
        want = rows_of(got)
    library = Tokenizer.from_file(bpe.tokenizer_path())
    ids = collections.Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, sf).collect())
    assert ids == collections.Counter((r[3][0], tuple(library.encode(r[2], add_special_tokens=False).ids)) for r in want)
    assert len(want) >= 60 and sum(not r[2].split() for r in want) >= 5 and sum(r[3][0] in (None, 500) for r in want) >= 20


def test_stages_take_other_columns(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.createDataFrame([(1, "a b\nc d\na b\nc d", 5), (2, "x y", 6), (None, None, 7)], "doc_id long, text string, rest int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.count() == 3, name


def test_stages_take_odd_rows(spark):
    sf = "/root/testdata/sf0.001"
    docs = frame(spark, with_odd_rows(corpus(8)))
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() > 0 and stage(spark, docs.limit(0), sf).count() == 0
    kept = corpus_pipeline.one_of_each_group(spark, docs, sf).collect()
    assert len({r.doc_id for r in kept if r.text and r.text.split()}) == len([r for r in kept if r.text and r.text.split()])
    lines = corpus_pipeline.drop_repeated_lines(spark, docs, sf)
    assert lines.count() == docs.count() and lines.where("n_chars <> length(text)").count() == 0
    assert bpe.bpe_encode(lines, bpe.tokenizer_path()).count() == docs.count()


def test_unlinked_documents_with_one_id_stay(spark):
    text = lambda i: " ".join(f"t{i}w{j}" for j in range(30))
    rows = [(d, text(i), "en", "s", 0) for i, d in enumerate([None, None, None, 7, 7, 8])]
    linked = [(9, text(0), "en", "s", 0), (10, text(4), "en", "s", 0), rows[0], rows[3]]
    kept = corpus_pipeline.one_of_each_group(spark, frame(spark, rows + linked), "/root/testdata/sf0.001").collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted((r[0] or 0, r[1]) for r in rows)
