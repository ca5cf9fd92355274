import random

import duckdb
import pytest
from pyspark.sql import types as T

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
    # Names that the operators use themselves.
    *[T.StructField(n, T.StringType()) for n in ("row", "id", "kept", "shard", "group", "block", "words", "key", "n", "score")],
])


@pytest.fixture(scope="session")
def database(sf):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return connection


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of (doc_id, text[, source]) with further columns of clashing names, in several partitions."""
    def make(rows, partitions=3):
        full = [(*r, *["s"] * (3 - len(r)), *["x"] * 10) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions, "doc_id")

    return make


def sentence(draw, n):
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def hostile():
    """Null and empty texts, white space, very long texts, copies, repeated rows, null ids, ties."""
    draw = random.Random(5)
    long_text = "\n".join(sentence(draw, 60) for _ in range(400))
    line = "this line stands in very many of the documents here"
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "One  two"), (6, long_text), (7, long_text.replace(" ", "  ")),
        (8, long_text + " z"), (None, "no id"), (None, "no id"), (9, "é Σ 你好 👍🏽 \x00 \x85x"), (10, "same same same same"), (10, "same same same same"),
        (11, f"a\n{line}\nb"), (12, f"{line.upper()}  \n{line}"), (13, f" {line}"), (14, line), (15, f"x\r\n{line}\r\n"), (16, f"{line}\n\n"),
    ]
    base = sentence(draw, 120).split()
    for i in range(20, 60):
        words = list(base)
        for _ in range(draw.choice([0, 1, 1, 2, 3, 6])):
            words[draw.randrange(len(words))] = sentence(draw, 1)
        rows.append((i, " ".join(words)))
    rows += [(i, sentence(draw, draw.randint(1, 80)), f"s{i % 3}") for i in range(60, 100)]
    return rows
