"""Small documents with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, label string, kept string, h string, score string"


def sentence(rnd, n, words=400):
    return " ".join(f"w{rnd.randrange(words)}" for _ in range(n))


def edge_rows():
    rnd = random.Random(3)
    base, passage = sentence(rnd, 120), sentence(rnd, 60)
    edited = base.split(" ")
    edited[40] = "changed"
    texts = [(1, base), (2, base), (3, base.upper().replace("W", "w")), (4, " ".join(edited)), (5, None), (6, ""), (7, "one two three"),
             (8, "One  two\tthree"), (9, sentence(rnd, 50) + " " + passage + " " + sentence(rnd, 40)), (10, passage + "\n" + sentence(rnd, 30)),
             (11, sentence(rnd, 20_000, 10 ** 6)), (12, "  \n "), (13, "ok ok " * 60), (None, base), (None, None), (7, "one two three"), (14, "é ü ñ " * 20)]
    return [(i, t, None, "s" if i else None, None, "x", "x", "x", "x", "x") for i, t in texts]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
