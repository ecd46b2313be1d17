from __future__ import annotations

import random

import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def texts() -> list[tuple]:
    """Rows (doc_id, text, source) with nulls, empty, long and repeated texts, ties, near copies and shared passages."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(300)] + ["été", "Größe", "the", "The", "😀"]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, other = say(60), say(45)
    rows = [(k, say(rng.randint(1, 120)), f"s{k % 5}") for k in range(60)]
    base = say(200).split()
    for k in range(60, 75):
        near = list(base)
        for _ in range(k % 4):
            near[rng.randrange(200)] = "changed"
        rows.append((k, " ".join(near), "s0"))
    rows += [(75 + k, f"{say(30)}\n{passage} {say(20)}", None) for k in range(6)]
    rows += [(81, passage + " " + passage, "s1"), (82, f"{other}\n{other}\n{other}", "s1"), (83, "a" * 700, "s2"), (84, "ab " * 400, "s2"), (85, None, "s3"), (86, "", None), (87, " \n\t", "s3"), (88, say(6000), "s4"), (None, say(50), "s4"), (89, passage, "s1"), (89, passage, "s1")]
    rows += [(90, rows[3][1], "s0"), (91, rows[3][1], "s0"), (92, "one two", "s0"), (93, "one two", "s1"), (94, f"x {other} y", "s1")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in texts], DDL).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="session")
def clashing(docs):
    """docs with more columns, named as operators name theirs."""
    from pyspark.sql import functions as F

    names = ("n", "code", "twin", "key", "bucket", "size", "row", "held_out", "score", "n_words", "component_id", "file", "kept", "target", "copies", "_id", "_source", "part", "kind")
    return docs.select("*", *(F.lit("x").alias(c) for c in names))
