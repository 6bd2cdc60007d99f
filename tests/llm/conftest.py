import random

import pytest

from quality_lake.llm.common import ship

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, score string, rank string, n string, kept string, block string"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


def words(n, seed, pool=400):
    r = random.Random(seed)
    return [f"w{r.randrange(pool)}" for _ in range(n)]


def odd_rows():
    """Nulls in every column, empty and blank texts, a very long one, ties and repeated rows, clashing column names."""
    long = "\n".join(" ".join(words(50, i)) for i in range(800))
    texts = [(1, "one two three four five six seven"), (2, None), (3, ""), (4, " \n\t "), (5, long), (6, "ONE two three four five six seven"),
             (7, "one two three four five six seven"), (7, "one two three four five six seven"), (None, "one two three four five six seven"),
             (None, None), (8, "short text"), (9, "short text"), (10, "Ünï ©ode ½ 漢字   wide space x"), (11, "a\0b <|endoftext|> c"),
             (12, " ".join(words(300, "x"))), (13, " ".join(words(300, "x")[:-3] + ["q", "r", "s"])), (14, "line\n" * 200)]
    return [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}", None if t is None else len(t), "s", "x", "r", "n", "k", "b")
            for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
