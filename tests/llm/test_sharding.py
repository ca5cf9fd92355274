import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from brooklet.llm import sharding
from brooklet.llm.catalog import QUERIES


def jump(key, shards):
    """The published loop."""
    key, at, there = key & (1 << 64) - 1, -1, 0
    while there < shards:
        at = there
        key = (key * 2862933555777941757 + 1) & (1 << 64) - 1
        there = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def test_walk_equals_the_published_loop(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), 12345, -98765432123, *range(1000, 1200)]
    counts = [1, 2, 7, 40, 41, 1000]
    walked = spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding.jump_shards(F.col("k"), counts).alias("s"))
    for row in walked.collect():
        assert list(row["s"]) == [jump(row["k"], n) for n in counts], row["k"]


def test_rows_that_need_more_jumps_than_the_first(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_JUMPS", 2)
    walked = spark.range(300).select("id", sharding.jump_shards(F.col("id"), [30]).alias("s"))
    assert all(r["s"]["s0"] == jump(r["id"], 30) for r in walked.collect())


def test_query_on_its_whole_table(spark, sf, database):
    rows = QUERIES["op2_sharding"](spark, sf).collect()
    texts = dict(database.execute("SELECT doc_id, text FROM documents").fetchall())
    assert len(rows) == len(texts)
    slots = defaultdict(list)
    for r in rows:
        text = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text) + 16, zlib.crc32(text), "key")
        assert (r["shard"], r["grown_shard"]) == (jump(r["doc_id"], 40), jump(r["doc_id"], 41))
        assert r["grown_shard"] in (r["shard"], 40)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_slots_have_no_gap_over_many_blocks(frame, hostile):
    placed = sharding.assign_shards(frame(hostile), "doc_id", 3, "shard", grown="more")
    rows = sharding.number_slots(placed, "shard", ["doc_id", "text"], rows_per_task=4).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["more"] in (r["shard"], 3)
    assert len(rows) == len(hostile) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_null_keys_strings_and_empty_tables(frame, hostile):
    null = {r["shard"] for r in sharding.assign_shards(frame(hostile), "doc_id", 40).filter("doc_id IS NULL").collect()}
    assert null == {jump(0, 40)}
    by_text = sharding.assign_shards(frame(hostile), "source", 5).select("source", "shard").distinct()
    assert by_text.count() == len({r[2] if len(r) > 2 else "s" for r in hostile})
    empty = sharding.assign_shards(frame([]), "doc_id", 40)
    assert sharding.number_slots(empty, "shard", ["doc_id"]).count() == 0
