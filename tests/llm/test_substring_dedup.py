"""Repeated passages against plain comparison of all windows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from brooklet.llm.substring_dedup import drop_repeated_passages
from tests.llm.conftest import sentence


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(spark, rows, size):
    """Rows of (id, kept text, words, removed), documents in the order of the operator."""
    ids = [r[0] for r in rows]
    keys = [r[0] for r in spark.createDataFrame([(t or "",) for _, t, *_ in rows], "t string").select(F.xxhash64("t")).collect()]
    order = sorted(range(len(rows)), key=lambda i: (ids[i] is not None, ids[i] or 0, keys[i]))
    first, gone = {}, {}
    for i in order:
        words = words_of(rows[i][1])
        gone[i] = set()
        for s in range(len(words) - size + 1):
            at = (ids[i], keys[i], s)
            if first.setdefault(tuple(words[s:s + size]), at) != at:
                gone[i].update(range(s, s + size))
    out = []
    for i, (n, text, *_) in enumerate(rows):
        words = words_of(text)
        out.append((n, " ".join(w for p, w in enumerate(words) if p not in gone[i]), len(words), len(gone[i])))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["doc_id"], r["text"], r["n_words"], r["n_removed"]) for r in df.collect()), key=str)


def passages(seed=8):
    """Texts that share passages with different neighbours, are cut from one another, or repeat themselves."""
    draw = random.Random(seed)
    shared = [sentence(draw, draw.randint(15, 60)) for _ in range(6)]
    rows = []
    for i in range(80):
        parts = [sentence(draw, draw.randint(0, 40)) if draw.random() < 0.6 else draw.choice(shared) for _ in range(draw.randint(1, 6))]
        words = " ".join(parts).split()
        if draw.random() < 0.3 and words:
            words[draw.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words)))
    rows += [(200 + i, " ".join(rows[i][1].split()[3:])) for i in range(10)]
    rows += [(300, "ab " * 100), (301, "ab " * 30 + "cd " * 30), (302, "ab cd " * 40), (303, " ".join(str(i) for i in range(19))), (304, " ".join(str(i) for i in range(20)))]
    return rows + [(-1, rows[0][1]), (None, rows[1][1]), (305, " ".join(str(i) for i in range(20)))]


@pytest.mark.parametrize(("size", "anchor"), [(20, 8), (9, 8), (5, 2)])
def test_against_all_windows(spark, frame, size, anchor):
    rows = passages()
    assert found(drop_repeated_passages(frame(rows, 5), size=size, anchor=anchor)) == brute(spark, rows, size)


def test_hostile_rows(spark, frame, hostile):
    assert found(drop_repeated_passages(frame(hostile))) == brute(spark, hostile, 20)


def test_factors_are_copies_of_earlier_places(frame):
    rows = [r for r in passages() if r[0] is not None]
    words = {i: words_of(t) for i, t in rows}
    several = 0
    for r in drop_repeated_passages(frame(rows)).collect():
        covered = set()
        for f in r["factors"]:
            assert f["length"] >= 20 and (f["source_id"], f["source_start"]) < (r["doc_id"], f["start"])
            assert words[r["doc_id"]][f["start"]:f["start"] + f["length"]] == words[f["source_id"]][f["source_start"]:f["source_start"] + f["length"]]
            covered.update(range(f["start"], f["start"] + f["length"]))
        assert len(covered) == r["n_removed"]
        several += len(r["factors"]) > 1
    assert several


def test_a_copy_is_one_factor(frame):
    text = sentence(random.Random(1), 500)
    copy = drop_repeated_passages(frame([(1, text), (2, text)])).filter("doc_id = 2").first()
    assert [tuple(f) for f in copy["factors"]] == [(0, 500, 1, 0)] and copy["text"] == ""


def test_empty_tables_and_odd_bytes(spark, frame):
    assert drop_repeated_passages(frame([])).count() == 0
    assert found(drop_repeated_passages(frame([(1, None), (2, " ")]))) == [(1, "", 0, 0), (2, "", 0, 0)]
    docs = spark.sql("SELECT id AS doc_id, concat(cast(X'61ff' AS string), repeat(' b', 30)) AS text FROM range(2)")
    kept = drop_repeated_passages(docs).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in kept] == [29, 31] and kept[0]["text"] == "a� b"
