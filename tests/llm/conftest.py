import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n)]


def corpus(seed: int = 1) -> list[tuple]:
    """Documents with exact and near copies, shared passages, empty, null, short, repeated-word and long texts."""
    rng = random.Random(seed)
    base = [words(rng, rng.randint(5, 120)) for _ in range(30)]
    texts = [" ".join(b) for b in base]
    passage = " ".join(words(rng, 30))
    for i in range(8):
        near = list(base[i])
        near[rng.randrange(len(near))] = "changed"
        texts += [" ".join(near), texts[i], texts[i].upper()]
    texts += [f"{' '.join(words(rng, 10))} {passage}  {' '.join(words(rng, 10))}\n{passage}" for _ in range(6)]
    texts += [None, "", " \t\n", "one", "ONE", "two words", "again " * 60, "a b " * 50, "x" * 5000, "é ü ñ 日本 " * 12, " ".join(words(rng, 3000))]
    return [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark):
    """With extra columns whose names clash with what operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(corpus(), SCHEMA)
    return df.withColumns({"component_id": F.lit("x"), "fp": F.lit(1), "score": F.lit(0), "h": F.lit(None).cast("string"), "rank": F.lit(1)})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
