import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, copy int, `a.b` string, score double, hash string"
WORDS = [a + b for a in "ba de fi go hu ja ke li mo nu".split() for b in "ra se ti vo xu la".split()]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Rows (doc_id, text, lang, source): families of near copies, and every kind of odd row."""
    rng = random.Random(7)
    rows, i = [], 0
    for f in range(12):
        base = prose(rng, rng.choice((12, 30, 60, 200))).split()
        for c in range(rng.choice((1, 2, 5, 9))):
            w = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 4)) if c else 0):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            rows.append((i, rng.choice((" ", "\n", "\t ")).join(w) if c % 2 else " ".join(w).upper(), rng.choice(("en", "de", None)), rng.choice(("a", "b", "é", None)), 1))
            i += 1
    rows += [(i, None, "en", "a", 0), (i + 1, "", "en", "a", 0), (i + 2, " \n\t", None, None, 3), (i + 3, "one two", "en", "b", 7), (i + 4, "ONE  two", "de", "b", 8), (None, "no id at all but some words here", "en", "c", 5)]
    rows += [(i + 5, prose(rng, 30000), "en", "a", 9), (i + 6, "ünï 123 …", "fr", "d", 2), rows[0], rows[0], (i + 7, "12 34 56", "en", "d", 2)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    made = spark.createDataFrame([(*r, "k", 1, "dot", 0.5, "h") for r in corpus], SCHEMA)
    return made.repartition(3)


@pytest.fixture(scope="session")
def none(docs):
    return docs.where(F.lit(False))
