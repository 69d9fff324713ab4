"""Small corpora with the cases that operators must take: nulls, empty texts, copies, repeats."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed: int = 0, n: int = 120) -> list[tuple]:
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(80)] + ["é", "ÀB", "the", "x\x00y"]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(55, 110))) for _ in range(5)]
    texts: list = ["", None, " \t\n", "a", "a", "A  b", "zz " * 300, "-" * 900, "\n".join(["same line here"] * 12), "<|endoftext|> x<|startoftext|>"]
    while len(texts) < n:
        kind = rng.random()
        if kind < 0.2:
            texts.append(rng.choice(texts))
        elif kind < 0.4:
            near = (rng.choice(texts) or "b").split(" ")
            near[rng.randrange(len(near))] = rng.choice(words)
            texts.append(" ".join(near))
        else:
            texts.append("\n".join(rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(1, 6))))
    rng.shuffle(texts)
    return [(i, t, rng.choice(["en", "de", None]), f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]


def with_odd_rows(rows: list[tuple]) -> list[tuple]:
    """Rows given twice, and one without doc_id."""
    return [*rows, rows[3], rows[15], (None, rows[20][1], None, None, None)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)
