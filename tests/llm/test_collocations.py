"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brooklet.llm import collocations


def brute(rows, longest, least, share, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        small = (text or "").translate({b: b + 32 for b in range(65, 91)})
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", small):
            words = re.findall("[^ \t]+", piece)
            if words:
                n[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                f.update((lang or "und", tuple(words[i:i + size])) for i in range(len(words) - size + 1))
    found = []
    often = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    inside = Counter()
    for (lang, p), a in often.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                inside[lang, p[i:i + size]] = max(inside[lang, p[i:i + size]], a)
    for (lang, p), a in often.items():
        if 100 * inside[lang, p] < share * a:
            score, _, l, r = min(
                (10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            found.append((lang, -score, -a, " ".join(p).encode(), l, r))
    out = []
    for lang in n:
        for rank, (_, s, a, p, l, r) in enumerate(sorted(x for x in found if x[0] == lang)[:top]):
            out.append((lang, rank + 1, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def corpus(seed=1, size=150):
    draw = random.Random(seed)
    words = ["the", "of", "New", "york", "é", "Σ", "a|b", "x1", "\x85", "house", "tree", "city"]
    rows = []
    for _ in range(size):
        text = "".join(draw.choices(words, weights=range(len(words), 0, -1))[0] + draw.choice([" ", " ", " ", "\t", ". ", "\n", ", ", "  "]) for _ in range(draw.randrange(60)))
        rows.append((text.replace("york", "york city of") if draw.random() < 0.3 else text, draw.choice(["en", "en", "de", None])))
    return rows + [(None, "en"), ("", None), (" .,", "de"), ("same " * 3000, "en"), ("only once here", "xx")]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4, "text")
    for name in ("word", "h", "f", "key", "n", "rank", "w0"):
        df = df.withColumn(name, F.lit("x"))
    return df


def found(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("ranked", "longest", "least", "top"), [(1 << 17, 3, 10, 2000), (5, 3, 10, 2000), (0, 2, 3, 4), (9, 4, 5, 2000)])
def test_against_counting(spark, monkeypatch, ranked, longest, least, top):
    """Also where few or no words and phrases are ranked, and for phrases of four words."""
    monkeypatch.setattr(collocations, "RANKED", ranked)
    rows = corpus()
    got = found(collocations.mine_phrases(frame(spark, rows), longest=longest, least=least, top=top))
    want = brute(rows, longest, least, 50, top)
    assert want and got == want


def test_no_phrases(spark):
    assert found(collocations.mine_phrases(frame(spark, []))) == []
    assert found(collocations.mine_phrases(frame(spark, [("a b c", "en"), (None, None)]))) == []


def test_bytes_that_are_no_text(spark):
    docs = spark.sql("SELECT cast(X'61ff2062' AS string) AS text, 'en' AS lang FROM range(12)")
    assert found(collocations.mine_phrases(docs)) == [("en", 1, "a� b", 12, 12, 12, 24, 1000000)]


def test_equal_hashes_take_another_seed(spark, monkeypatch):
    real = collocations._vocabulary

    def clash(docs, seed):
        return real(docs, seed).withColumn("h", F.lit(7).cast("long") if seed == 0 else F.col("h"))

    monkeypatch.setattr(collocations, "_vocabulary", clash)
    words, seed = collocations.vocabulary(frame(spark, [("a b", "en")]).select("text", "lang"))
    assert seed == 1 and words.count() == 2


def test_tiles_count_all_pairs(monkeypatch):
    """Full tiles, sorted coordinates, and coordinates that are given away early."""
    monkeypatch.setattr(collocations, "FULL", 8)
    monkeypatch.setattr(collocations, "TILES", 2)
    monkeypatch.setattr(collocations, "SIDE", 8)
    monkeypatch.setattr(collocations, "COORDINATES", 300)
    draw = np.random.default_rng(2)
    hashes = draw.integers(-(1 << 62), 1 << 62, 1000)
    known = collocations.Level(np.sort(hashes[:40]), np.argsort(np.argsort(hashes[:40]))[np.argsort(hashes[:40])], np.zeros((40, 1), np.int64), np.zeros(8, np.uint8))
    known.numbers = np.argsort(hashes[:40])
    known.words = hashes[:40][:, None].copy()
    assert (known.find(hashes[:40], hashes[:40, None]) == np.arange(40)).all()
    tiles, got, want = collocations.Tiles(known, known), Counter(), Counter()

    def take(given):
        for words, counts in given:
            for w, c in zip(map(tuple, words.tolist()), counts.tolist(), strict=True):
                got[w] += c

    for _ in range(20):
        pair = np.minimum(draw.geometric(0.1, (200, 2)) - 1 + draw.integers(0, 2, (200, 2)) * draw.integers(0, 900, (200, 2)), 999)
        number = np.where(pair < 40, pair, collocations.UNRANKED)
        want.update(map(tuple, hashes[pair].tolist()))
        take(tiles.add(number[:, 0], number[:, 1], hashes[pair]))
    assert len(tiles.arrays) == 2
    take(tiles.rest())
    assert got == want
