import pytest
from corpora import corpus, frame, with_odd_rows
from pyspark.sql import functions as F

import corpus_pipeline
from landpulse.llm import line_dedup, quality_rules, registry
from oracle import same

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_as_duckdb(spark, name):
    same(registry.QUERIES[name](spark, DATA), registry.ORACLES[name], DATA)


@pytest.mark.parametrize("name", ["op4_substring_dedup", "op6_suffix_array", "op8_jaccard_join"])
def test_odd_rows_as_duckdb(spark, tmp_path, name):
    """Nulls, repeated rows, empty texts and white space alone."""
    frame(spark, with_odd_rows(corpus(12, 80))).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    same(registry.QUERIES[name](spark, str(tmp_path)), registry.ORACLES[name], str(tmp_path))


@pytest.mark.parametrize("name", ["op1_line_dedup", "op5_quality_rules"])
def test_native_plans(spark, name):
    plan = registry.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def chunks(text):
    """(first, lines) of content-defined chunks."""
    import hashlib

    lines = (text or "").split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    out, start = [], 0
    for i in range(len(lines)):
        if i == len(lines) - 1 or (h[i] + (h[i - 1] if i else 0) * line_dedup.BASE) % line_dedup.DIVISOR == 0:
            out.append((start, lines[start : i + 1]))
            start = i + 1
    return out


def test_line_dedup(spark):
    rows = corpus(1)
    seen, want = set(), {}
    for doc_id, text, *_ in rows:
        kept = []
        for _, lines in chunks(text):
            if len(lines) > 1 and tuple(lines) in seen:
                continue
            seen.add(tuple(lines))
            kept += lines
        want[doc_id] = "\n".join(kept)
    got = {r.doc_id: r.kept_text for r in line_dedup.line_dedup(frame(spark, rows)).collect()}
    assert got == want
    odd = line_dedup.line_dedup(frame(spark, with_odd_rows(rows)).withColumn("removed", F.lit(1)).withColumn("th", F.lit(2))).collect()
    assert len(odd) == len(rows) + 3
    assert line_dedup.line_dedup(frame(spark, [])).count() == 0


def plain_pairs(rows):
    """For each row, its text without the lines that stand with a neighbour at an earlier place."""
    key = lambda r: (-(2**63) if r[0] is None else r[0])
    split = [(r[1] or "").split("\n") for r in rows]
    first = {}
    for r, x in sorted(zip(rows, split, strict=True), key=lambda p: key(p[0])):
        for i in range(len(x) - 1):
            at, place = (x[i], x[i + 1]), (key(r), i, r[1])
            first[at] = min(first.get(at, place), place, key=lambda p: p[:2])
    out = []
    for r, x in zip(rows, split, strict=True):
        gone = set()
        for i in range(len(x) - 1):
            k, j, text = first[x[i], x[i + 1]]
            if (k, j) != (key(r), i) and not (k == key(r) and i < j + 2):
                gone |= {i, i + 1}
        out.append("\n".join(y for i, y in enumerate(x) if i not in gone))
    return out


def test_no_repeated_passage_stays(spark):
    rows = corpus(1)
    rows += [(900 + i, f"before {i}\nshort one\nshort two\nafter {i}\nsame\nsame\nsame", None, None, 0) for i in range(12)]
    got = {r.doc_id: r.kept_text for r in line_dedup.line_dedup(frame(spark, rows), pairs=True).collect()}
    assert got == {r[0]: t for r, t in zip(rows, plain_pairs(rows), strict=True)}
    assert got[900].endswith("after 0\nsame\nsame\nsame") and all(got[900 + i] == f"before {i}\nafter {i}" for i in range(1, 12))
    staged = corpus_pipeline.drop_repeated_lines(spark, frame(spark, rows), DATA).collect()
    assert {r.doc_id: r.text for r in staged} == got
    odd = with_odd_rows(rows)
    assert line_dedup.line_dedup(frame(spark, odd), pairs=True).count() == len(odd)
    assert line_dedup.line_dedup(frame(spark, []), pairs=True).count() == 0


def test_pairs_follow_chunks(spark, monkeypatch):
    """The stage finds repeats by chunks; pairs of lines are compared only where no removed chunk holds them."""
    calls = []
    plain = line_dedup._repeats
    monkeypatch.setattr(line_dedup, "_repeats", lambda base, places, known, pairs: calls.append((places, known, plain(base, places, known, pairs))) or calls[-1][2])
    text = "\n".join(f"line number {i}" for i in range(60))
    rows = [(1, text, None, None, 0), (2, "new\n" + text + "\nend", None, None, 0), (2, text, None, None, 0)]
    out = corpus_pipeline.drop_repeated_lines(spark, frame(spark, rows), DATA)
    assert sorted(r.text for r in out.collect() if r.doc_id == 2) == ["", "new\nend"]
    (_, none, by_chunks), (_, known, by_pairs) = calls
    place = lambda df: {(r.key, r.th, r.first) for r in df.collect()}
    assert none is None and by_chunks.count() > 20 and place(known) and not place(known) & place(by_pairs) and by_pairs.count() < known.count()


def test_inserted_line_moves_few_boundaries():
    text = "\n".join(f"line number {i}" for i in range(200))
    before = {tuple(x) for _, x in chunks(text)}
    after = {tuple(x) for _, x in chunks("new\n" + text)}
    assert len(before - after) <= 2


def test_quality(spark):
    rows = with_odd_rows(corpus(2))
    book = quality_rules.ledger(frame(spark, rows).withColumn("words", F.lit(1)))
    assert book.count() == len(rows) and quality_rules.ledger(frame(spark, [])).count() == 0
    by_text = {r.doc_id: r for r in book.collect()}
    for doc_id, text, *_ in rows:
        w = (text or "").encode().split()
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        hit = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 3)}
        r = by_text[doc_id]
        assert (r.n_words, r.n_repeat_words) == (len(w), len(hit))


def test_policies_and_ablation(spark):
    book = spark.createDataFrame([(1, 0), (2, 1), (3, 3), (4, 2), (5, 1)], "doc_id long, fail_bits long")
    rules, policies = {"a": "true", "b": "true"}, {"one": ("a",), "two": ("a", "b")}
    kept = {r.doc_id for r in quality_rules.apply_policy(book, "one", rules, policies).where("kept").collect()}
    assert kept == {1, 4}
    out = {(r.policy, r.rule): (r.failed, r.only, r.kept_without) for r in quality_rules.ablation(book, rules, policies).collect()}
    assert out == {("one", "a"): (3, 3, 5), ("two", "a"): (3, 2, 3), ("two", "b"): (2, 1, 2)}
