import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("n", T.LongType()), T.StructField("token", T.StringType()),
    T.StructField("_range", T.LongType()),
])


def prose(rng: random.Random, words: int) -> list[str]:
    return [rng.choice("the of and was hill river stone light over under garden winter morning letter".split())
            + rng.choice(["", "", "s", "ed", "ing", "!"]) for _ in range(words)]


def texts() -> list[str | None]:
    """Copies, near copies, ties, empty, null, odd and long texts."""
    rng = random.Random(3)
    out: list[str | None] = [None, "", " \n\t ", "one", "One two", "one two", "a  b\x0bc", "é x 日本 語。"]
    for _ in range(6):
        base = prose(rng, rng.randint(30, 160))
        out.append(" ".join(base))
        for changes in (0, 1, 2, 6):
            copy = list(base)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(1000)}"
            out.append(" ".join(copy))
    out.append("\n".join(" ".join(prose(rng, 9)) for _ in range(900)))
    out.append("Orre " * 3000)
    out.append("w" * 20_000 + "+@" + "1" * 3000)
    out.append("\n".join(["the same line of text here"] * 12))
    return out


@pytest.fixture(scope="session")
def rows():
    all_texts = texts()
    made = [(i * 3, t, ["en", "de", None][i % 3], ["b", None, "a"][i % 3], None if t is None else len(t), i, "x", 1)
            for i, t in enumerate(all_texts)]
    return made


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("documents") / "documents.parquet")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def with_repeats(spark, docs, rows, tmp_path_factory):
    """The documents, some rows twice, and rows without an id."""
    path = str(tmp_path_factory.mktemp("repeats") / "documents.parquet")
    extra = spark.createDataFrame([rows[10], rows[10], rows[4], (None, "no id at all here", None, None, 3, 0, "t", 2),
                                   (None, None, None, None, None, None, None, None)], SCHEMA)
    docs.union(extra).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty") / "documents.parquet")
    docs.limit(0).write.parquet(path)
    return spark.read.parquet(path)
