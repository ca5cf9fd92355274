"""Texts with bytes that are no UTF-8 go through every operator, as those with U+FFFD in their place."""

import pytest

from brooklet.llm import html_text, near_dedup, packing, quality
from brooklet.llm.catalog import tokenizer_definition

ODD = "concat('some words before ', cast(X'ff' AS string), ' and some after them, ', cast(X'c3' AS string))"
PLAIN = "'some words before � and some after them, �'"


@pytest.fixture(scope="module")
def both(spark):
    def make(name="doc_id", text="text", wrap="{}"):
        return [spark.sql(f"SELECT 1L AS {name}, {wrap.format(t)} AS {text}, 'u' AS url UNION ALL SELECT 2L, {wrap.format(t)}, 'u'") for t in (ODD, PLAIN)]

    return make


def rows(df):
    return sorted(map(str, df.drop("text_key").collect()))


def test_extraction(both):
    odd, plain = (html_text.extract(d) for d in both("page_id", "html", "concat('<body><article><p>', {}, '</p></article></body>')"))
    assert rows(odd) == rows(plain) and "�" in odd.first()["text"]


def test_near_duplicates(both):
    odd, plain = (near_dedup.near_duplicates(d, words=3, part=85, rows=3) for d in both())
    assert rows(odd) == rows(plain) and {r["component_id"] for r in odd.collect()} == {1}


def test_scores(spark, both):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    odd, plain = (quality.score(d, labels) for d in both())
    assert rows(odd) == rows(plain)


def test_packing(both):
    odd, plain = (packing.pack(d, tokenizer_definition()) for d in both())
    assert rows(odd) == rows(plain)
