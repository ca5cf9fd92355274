import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from brooklet.llm import exact_dedup

WHITE = str.maketrans("", "", " \t\n\x0b\x0c\r")


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[(text or "").translate(WHITE)].append((-len(text or ""), doc_id is None, doc_id or 0))
    out = []
    for body, members in groups.items():
        first = min(members)
        for place, m in enumerate(sorted(members)):
            out.append((None if m[1] else m[2], None if first[1] else first[2], len(members), place == 0, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [3, 16, 4096])
def test_against_grouping_whole_texts(frame, hostile, block):
    rows = exact_dedup.dedup(frame(hostile), block_bytes=block)
    assert sorted(map(tuple, rows.collect()), key=str) == brute(hostile)


def test_texts_that_differ_in_one_block_or_in_length_only(frame):
    rows = [(1, "abcabcabc"), (2, "abcabcabd"), (3, "abcabc"), (4, "abc"), (5, "a b c"), (6, "abcabcabcabc"), (7, "abcabcabc")]
    found = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.dedup(frame(rows), block_bytes=3).collect()}
    assert found == {1: (1, 2), 2: (2, 1), 3: (3, 1), 4: (5, 2), 5: (5, 2), 6: (6, 1), 7: (1, 2)}


def test_keys_that_clash_are_replaced(frame, monkeypatch):
    real = exact_dedup._keys
    monkeypatch.setattr(exact_dedup, "_keys", lambda b, seed: [F.lit(0).cast("long"), F.lit(0).cast("long")] if seed == 0 else real(b, seed))
    rows = exact_dedup.dedup(frame([(1, "a"), (2, "b"), (3, "a")])).collect()
    assert sorted((r["doc_id"], r["keep_id"]) for r in rows) == [(1, 1), (2, 2), (3, 1)]


def test_empty_table(frame):
    assert exact_dedup.dedup(frame([])).count() == 0
