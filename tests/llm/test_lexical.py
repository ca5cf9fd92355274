"""Lexical search against a plain reading of its formula."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brooklet.llm import lexical


def terms_of(text):
    small = (text or "").translate({b: b + 32 for b in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", small)


def brute(docs, items, k):
    counts = [(i, Counter(terms_of(t))) for i, t, *_ in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    total, df = sum(n for *_, n in counts), Counter(t for _, c, _ in counts for t in c)
    rows = []
    for item, text in items:
        scored = []
        for i, c, n in counts:
            m = 25 + 75 * n * len(counts) // total
            score = sum(
                times * math.floor(1000 * math.log((2 * len(counts) + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t, times in Counter(terms_of(text)).items() if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        rows += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(rows, key=str)


ITEMS = [
    (1, "this line stands in very many of the documents here"), (2, "One two ONE"), (3, None), (4, ""), (5, " ., "), (6, "no id same"),
    (7, "é Σ 你好 👍🏽"), (7, "x y"), (None, "same line same"), (8, "z " * 40 + "b a"),
]


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame_of_items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("score", F.lit("x")).withColumn("doc_id", F.lit(1))


@pytest.mark.parametrize(("entries", "items", "k"), [(1 << 18, 1 << 12, 10), (12, 2, 3)])
def test_against_formula(spark, frame, hostile, monkeypatch, entries, items, k):
    """Also with many small blocks of items."""
    monkeypatch.setattr(lexical, "ENTRIES", entries)
    monkeypatch.setattr(lexical, "ITEMS", items)
    docs = frame(hostile, 5)
    assert found(lexical.rank_documents(docs, frame_of_items(spark, ITEMS), k=k)) == brute(hostile, ITEMS, k)


def test_ties_and_equal_rows(spark, frame):
    rows = [(i % 7, "apple pie") for i in range(21)] + [(None, "apple pie"), (50, "pear tree")]
    items = [(1, "apple"), (2, "apple apple pear")]
    assert found(lexical.rank_documents(frame(rows, 4), frame_of_items(spark, items), k=5)) == brute(rows, items, 5)
    assert found(lexical.rank_documents(frame(rows, 4), frame_of_items(spark, items), k=50)) == brute(rows, items, 50)


def test_empty_tables(spark, frame):
    none = frame_of_items(spark, []), frame([])
    assert found(lexical.rank_documents(frame([(1, "a")]), none[0])) == []
    assert found(lexical.rank_documents(none[1], frame_of_items(spark, ITEMS))) == []
    assert found(lexical.rank_documents(frame([(1, None), (2, " ")]), frame_of_items(spark, ITEMS))) == []


def test_bytes_that_are_no_text(spark):
    docs = spark.sql("SELECT 1L AS doc_id, cast(X'61ff2062' AS string) AS text UNION ALL SELECT 2L, 'b'")
    assert [r["doc_id"] for r in lexical.rank_documents(docs, frame_of_items(spark, [(1, "b")])).collect()] == [2, 1]


def test_length_factors_beyond_64_bits():
    n = np.array([10**9, 3])
    assert lexical.length_factors(n, 10**12, 10**13).tolist() == [25 + 75 * int(x) * 10**12 // 10**13 for x in n]


def test_lists_of_the_best_over_many_adds():
    draw = random.Random(1)
    best, rows = lexical.Best(3, 4), []
    for _ in range(30):
        scores = np.array([[draw.randrange(6) for _ in range(3)] for _ in range(5)])
        doc = np.array([draw.randrange(20) for _ in range(5)])
        null = np.array([draw.random() < 0.1 for _ in range(5)])
        best.add(scores, doc, null)
        rows += [(j, -int(scores[i, j]), bool(null[i]), int(doc[i])) for i in range(5) for j in range(3) if scores[i, j] > 0]
    want = [r for j in range(3) for r in sorted(r for r in rows if r[0] == j)[:4]]
    assert list(zip(best.item.tolist(), (-best.score).tolist(), best.null.tolist(), best.doc.tolist(), strict=True)) == want
