"""Each stage of the pipeline against a plain version of what it does, on its own input."""

import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from brooklet.llm.common import written
from tests.llm import test_line_dedup, test_near_dedup
from tests.llm.test_mixing import plain_targets


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        out.append(written(stage(spark, out[-1], sf), f"test-{name}"))
    return [df.collect() for df in out], out


def test_all_but_the_last_keep_the_columns(stages):
    rows, frames = stages
    assert all(f.schema.simpleString() == frames[0].schema.simpleString() for f in frames[1:-1])
    assert all(r["n_chars"] == len(r["text"]) for r in rows[2])


def test_quality_drops_what_the_labels_call_poor(stages, database):
    rows = stages[0]
    before, kept = {r["doc_id"]: r for r in rows[0]}, {r["doc_id"]: r for r in rows[1]}
    assert all(before[i] == r for i, r in kept.items())
    labels = database.execute("SELECT doc_id, quality FROM labels").fetchall()
    held = [(i, q) for i, q in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((i in kept) == bool(q) for i, q in held) > 0.9 * len(held)


def test_lines(stages):
    rows = stages[0]
    want = test_line_dedup.brute([(r["doc_id"], r["text"]) for r in rows[1]], 40, 5)
    assert sorted((r["doc_id"], r["text"]) for r in rows[2]) == sorted((i, t) for i, t, *_ in want)


def test_near_copies(stages):
    rows = stages[0]
    want = test_near_dedup.brute([(r["doc_id"], r["text"]) for r in rows[2]], 5, 80, 100)
    assert sorted(r["doc_id"] for r in rows[3]) == sorted(i for i, _, c in want if i == c)
    texts = {r["doc_id"]: r for r in rows[2]}
    assert all(texts[r["doc_id"]] == r for r in rows[3])


def test_mix(stages):
    rows = stages[0]
    sizes, taken = {}, {}
    for given, out in ((rows[3], sizes), (rows[4], taken)):
        for r in given:
            out[r["source"]] = out.get(r["source"], 0) + len(r["text"].encode().split())
    want = plain_targets(sizes)
    assert all(abs(taken.get(s, 0) - t) <= 0.5 for s, t in want.items())
    texts = {r["doc_id"]: r["text"] for r in rows[3]}
    assert all(texts[r["doc_id"]].startswith(r["text"]) for r in rows[4])


def test_pack(stages):
    rows = stages[0]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    want = sum(len(e.ids) + 1 for e in tokenizer.encode_batch([r["text"] for r in rows[4]], add_special_tokens=False))
    assert sum(r["length"] for r in rows[5]) == want
    full = {}
    for r in rows[5]:
        full[r["sequence_id"]] = full.get(r["sequence_id"], 0) + r["length"]
    assert all(n == 2048 for s, n in full.items() if s != max(full))


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_hostile_and_empty_documents(spark, sf, name):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, row int"
    rows = [(1, None, None, None, None, 0.1, 1), (1, None, None, None, None, 0.1, 1), (None, "", "en", "a", 0, None, 2), (2, "a b\n c", "en", "a", 6, 0.5, None)]
    rows += [(i, "the same words in many documents over and over again " * 3, "en", "b", 0, 0.5, 3) for i in (3, 4, 5, 5)]
    stage = dict(pipeline.STAGES)[name]
    assert stage(spark, spark.createDataFrame([], schema), sf).count() == 0
    out = stage(spark, spark.createDataFrame(rows, schema), sf)
    assert out.count() >= (3 if name == "near_dedup" else 1 if name in ("quality", "mixing") else len(rows))


def test_columns_with_the_operators_names_stay(spark, sf):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, n_lines string, n_dropped int"
    docs = spark.createDataFrame(
        [(i, f"some words of document {i}", "en", "a", 0, f"own {i}", f"lines {i}", i) for i in range(20)], schema)
    out = docs
    for name, stage in pipeline.STAGES[:-1]:
        out = written(stage(spark, out, sf), f"clash-{name}")
        assert out.schema.simpleString() == docs.schema.simpleString()
        rows = out.collect()
        assert all((r["score"], r["n_lines"], r["n_dropped"]) == (f"own {r['doc_id']}", f"lines {r['doc_id']}", r["doc_id"]) for r in rows), name
        out = docs if name == "quality" else out  # Whatever its scores.
