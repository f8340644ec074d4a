import random

import pytest

WORDS = "the of and to river stone winter paper light garden window table quiet morning letter".split()


def prose(n: int, seed: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + pick.choice(["", "", "s", "ing", "ed"]) + str(pick.randint(0, 9)) * (i % 7 == 0) for i in range(n))


ODD = [None, "", " ", "\n\t \x0b", "a", "Two  words\n", "same line\nsame line\n\nsame line", "x" * 30_000, "1 2 " * 4000, "é" * 700,
       prose(120, 1), prose(120, 1), prose(120, 1) + " tail", prose(300, 2), prose(6000, 3), "<|endoftext|> a <|endoftext|>",
       "it's  we'll\n\n  'sfoo \x1c 日本 🙂", "# $ % " * 30 + prose(60, 4)]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with null ids and texts, repeated rows, and columns that clash with names used inside."""
    rows = [(i, t, "en", "s", None) for i, t in enumerate(ODD)] + [(3, ODD[3], "en", "s", 1), (10, ODD[10], "en", "s", 1), (None, prose(80, 9), "en", "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("n_words", "_id", "id", "kept", "spans", "fp", "score", "_text", "group"):
        docs = docs.withColumn(name, docs["lang"])
    return docs.repartition(3).checkpoint()


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return odd_docs.limit(0)
