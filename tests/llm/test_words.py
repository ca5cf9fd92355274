"""The splitting of texts into words and pieces, against regular expressions."""

import random
import re

import numpy as np
import pyarrow as pa

from brooklet.llm import words
from brooklet.llm.bits import marked


def test_words_and_pieces_against_patterns():
    draw = random.Random(3)
    letters = ["a", "B", "é", "👍", " ", "\t", "\n", ".", ",", "\x00", "\x85"]
    kinds = words.kinds_of_bytes(b" \t", b".,\n")
    for _ in range(50):
        texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(30))) for _ in range(draw.randrange(8))]
        found = words.split_words(pa.array(["skipped", *texts], pa.string()).slice(1), kinds, small=True)
        values = [w.decode() for w in found.values.to_pylist()]
        want, opens, ends = [], [], []
        for text in texts:
            for piece in re.split(r"[.,\n]", text.replace("B", "b")):
                inside = re.findall(r"[^ \t]+", piece)
                want += inside
                opens += [i == 0 for i in range(len(inside))]
            ends.append(len(want))
        assert (values, found.opens.tolist(), found.ends.tolist()) == (want, opens, ends)


def test_slabs_keep_all_rows_in_order(monkeypatch):
    monkeypatch.setattr(words, "SLAB", 20)
    draw = random.Random(4)
    texts = ["x" * draw.choice([0, 1, 5, 19, 20, 21, 100]) for _ in range(200)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i:i + 7])], names=["text"]) for i in range(0, 200, 7)]
    tables = list(words.slabs(batches, "text"))
    assert [t for table in tables for t in table.column("text").to_pylist()] == texts
    assert all(len(table) == 1 or sum(map(len, table.column("text").to_pylist())) <= 20 for table in tables)
    assert list(words.slabs([], "text")) == []


def test_bit_table_finds_all(spark):
    from brooklet.llm.bits import bit_table

    draw = random.Random(5)
    known = [draw.randrange(-(1 << 63), 1 << 63) for _ in range(1000)]
    table = bit_table(spark.createDataFrame([(h,) for h in known], "hash long"))
    assert marked(table, np.array(known)).all()
    assert marked(table, np.array([draw.randrange(1 << 63) for _ in range(1000)])).mean() < 0.05
    assert not marked(bit_table(spark.createDataFrame([], "hash long")), np.array(known)).any()
