import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside
        T.StructField("key", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("kept", T.StringType()),
    ]
)
VOCABULARY = "tion ing the of ré ä ß er qu on an 你好 emoji😀 x".split()


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(VOCABULARY) for _ in range(rng.randint(1, 3))) for _ in range(n))


def corpus() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and long texts, copies, near copies, shared passages, repeated rows."""
    rng = random.Random(5)
    base, passage = words(rng, 120), words(rng, 60)
    rows: list[tuple[int | None, str | None]] = [(i, words(rng, rng.randint(0, 60))) for i in range(40)]
    rows += [(40 + i, base) for i in range(5)] + [(46, "  " + base.replace(" ", "\t") + "\n")]
    for i in range(12):  # near copies of one text, at various distances
        w = base.split()
        for _ in range(i):
            w[rng.randrange(len(w))] = rng.choice(VOCABULARY)
        rows.append((50 + i, " ".join(w)))
    rows += [(70 + i, words(rng, 10) + " " + passage + " " + words(rng, 10)) for i in range(6)]
    rows += [(80, None), (81, ""), (82, " \n\t"), (83, "one"), (84, "one two"), (85, "One  TWO"), (86, "\x1c a\x1db")]
    rows += [(87, words(rng, 6000)), (88, "a" * 300), (89, "a" * 200), (90, "<|endoftext|> x<|startoftext|>y <|endoftext|>")]
    rows += [(3, rows[3][1]), (None, base), (None, "lonely text without an id at all"), (None, None)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, "k", "i", "p", "q") for i, t in rows], DOCS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
