import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from brooklet.llm import packing
from brooklet.llm.catalog import QUERIES, tokenizer_definition


@pytest.fixture(scope="module")
def tokenizer():
    out = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out.encode_special_tokens = True
    return out


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(pieces, wanted, length):
    """Pieces give back all ids, and sequences are full but for the last."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in docs.values():
        parts.sort(key=lambda p: p["start"])
    for spans in sequences.values():
        spans.sort()
        assert [s for s, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
    filled = [sum(n for _, n in sequences[s]) for s in sorted(sequences)]
    assert sorted(sequences) == list(range(len(sequences))) and all(n == length for n in filled[:-1])
    assert sum(filled) == sum(len(w) for w in wanted)
    return docs


def test_query_on_its_whole_table(spark, sf, database, tokenizer):
    want = {i: ids_of(tokenizer, t) for i, t in database.execute("SELECT doc_id, text FROM documents").fetchall()}
    docs = check(QUERIES["op10_packing"](spark, sf).collect(), want.values(), 2048)
    assert docs.keys() == want.keys()
    for i, parts in docs.items():
        assert sum(p["length"] for p in parts) == len(want[i]) == parts[0]["doc_tokens"]
        for p in parts:
            ids = np.array(want[i][p["start"]:p["start"] + p["length"]], "<u4")
            assert zlib.crc32(ids.tobytes()) == p["ids_crc32"]


def test_hostile_texts_come_back_whole(frame, hostile, tokenizer):
    rows = [(1000 + n, t) for n, (_, t, *_) in enumerate(hostile)]
    pieces = packing.pack(frame(rows), tokenizer_definition(), 64)
    want = {i: ids_of(tokenizer, t) for i, t in rows}
    docs = check(pieces.collect(), want.values(), 64)
    for i, parts in docs.items():
        assert b"".join(p["ids"] for p in parts) == np.array(want[i], "<u4").tobytes()
    whole = packing.sequences(pieces, 64).collect()
    assert all(len(s["ids"]) == 256 for s in whole) and sum(s["used"] for s in whole) == sum(map(len, want.values()))


def test_words_of_any_make(tokenizer):
    import pyarrow as pa

    texts = [
        "it's DON'T'll '' ''s 's's a'sb ...abc… 12ab ab12", "x́ ́y é! é́, ÉCOLE Straße İstanbul ΣΑΣ ΟΔΟΣ!", "", " \t\n\x0b\x0c\r ",
        "a<|endoftext|>b", "nbsp x \x1cq  z 你好,世界! 👍🏽ok ǅ ª² ﬁn \x85y Ⅷ,", "\x00a\x01", "w" * 5000]
    words = packing.WordTokenizer(tokenizer_definition())
    for _ in range(2):
        ids, ends = words.ids(pa.array(texts))
        begin = 0
        for text, end in zip(texts, ends, strict=True):
            assert ids[begin:end].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
            begin = end


@pytest.mark.parametrize("texts", [["\xa0 12"], ["12 \u2003", "12", "\xa0 x 12"], ["\u200b1 \x85 34 12"]])
def test_words_without_ids_beside_words_of_several(tokenizer, texts):
    import pyarrow as pa

    words = packing.WordTokenizer(tokenizer_definition())
    for text in texts:
        assert words.ids(pa.array([text]))[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_forgetting_changes_nothing(frame, hostile, monkeypatch):
    definition = tokenizer_definition()
    want = packing.pack(frame(hostile), definition, 100).drop("ids").collect()
    monkeypatch.setattr(packing, "REMEMBERED_PARTS", 5)
    monkeypatch.setattr(packing, "LOOK_UP", 3)
    assert sorted(map(str, packing.pack(frame(hostile), definition, 100).drop("ids").collect())) == sorted(map(str, want))


def test_repeated_rows_null_ids_and_empty_tables(frame):
    definition = tokenizer_definition()
    rows = packing.pack(frame([(None, "a"), (1, None), (1, None)]), definition, 2).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) in ([(0, 2), (1, 1), (1, 1)], [(0, 1), (0, 1), (1, 1), (1, 1)])
    assert packing.pack(frame([]), definition).count() == 0
