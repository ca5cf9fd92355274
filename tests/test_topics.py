"""File topics: offsets without gaps, replays, and micro-batches that are half written."""

import json

import pytest
from pyspark.sql import functions as F

from brooklet.sources import topics


def write(spark, folder, batch_id, values, topic="t", slices=3, partitions=1):
    rows = spark.createDataFrame([(v,) for v in values], "value string").repartition(slices) if values else spark.createDataFrame([], "value string")
    topics.write_batch_once(topics.to_records(rows, topic, F.col("value"), F.col("value")), folder, batch_id, partitions)


def read(spark, folder):
    rows = spark.read.schema(topics.ENVELOPE).json(folder).collect()
    return sorted((r["topic"], r["partition"], r["offset"], r["value"]) for r in rows)


@pytest.mark.parametrize("first", [0, 32_767, 10**6])
def test_offsets_have_no_gaps_whatever_the_batch(spark, tmp_path, first):
    folder = str(tmp_path / "t")
    for i in range(3):
        write(spark, folder, first + i, [f"{i}-{j}" for j in range(5)])
    rows = read(spark, folder)
    assert [r[2] for r in rows] == list(range(15))
    assert [int(r[3][0]) for r in rows] == sorted(int(r[3][0]) for r in rows)


def test_a_replay_changes_nothing_however_it_is_dealt(spark, tmp_path):
    folder = str(tmp_path / "t")
    write(spark, folder, 0, ["a", "b", "c", "d"])
    before = read(spark, folder)
    write(spark, folder, 0, ["d", "c", "b", "a"], slices=1)
    assert read(spark, folder) == before
    write(spark, folder, 1, ["e"])
    assert read(spark, folder)[-1][2:] == (4, "e")


def test_several_topics_and_partitions(spark, tmp_path):
    folder = str(tmp_path / "t")
    for batch_id in range(2):
        write(spark, folder, batch_id, [f"{batch_id}-{j}" for j in range(40)], partitions=4)
        write(spark, str(tmp_path / "u"), batch_id, [])
    by_partition = {}
    for _, partition, offset, _ in read(spark, folder):
        by_partition.setdefault(partition, []).append(offset)
    assert len(by_partition) == 4 and all(o == list(range(len(o))) for o in by_partition.values())
    assert not list((tmp_path / "u").glob("batch=*"))


def test_a_crash_before_the_manifest(spark, tmp_path):
    """Rows that were written aside are not seen, and are written again."""
    folder = tmp_path / "t"
    write(spark, str(folder), 0, ["a"])
    (folder / "_aside/batch=1/topic=t").mkdir(parents=True)
    (folder / "_aside/batch=1/topic=t/part-0.json").write_text('{"value": "half", "partition": 0, "offset": 1}')
    assert [r[3] for r in read(spark, str(folder))] == ["a"]
    write(spark, str(folder), 1, ["b", "c"])
    assert [r[2] for r in read(spark, str(folder))] == [0, 1, 2] and sorted(r[3] for r in read(spark, str(folder))) == ["a", "b", "c"]


def test_a_crash_after_the_manifest(spark, tmp_path):
    """The batch is shown as it was numbered, without looking at the replayed rows."""
    folder = tmp_path / "t"
    write(spark, str(folder), 0, ["a", "b"])
    (folder / "batch=0").rename(folder / "_aside/batch=0")
    assert read(spark, str(folder)) == []
    write(spark, str(folder), 0, ["b", "a"], slices=1)
    assert [r[2] for r in read(spark, str(folder))] == [0, 1]


def test_old_manifests_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(topics, "KEPT_MANIFESTS", 2)
    folder = tmp_path / "t"
    for i in range(4):
        write(spark, str(folder), i, ["x"], slices=1)
    kept = sorted(int(p.name) for p in (folder / "_manifest").iterdir() if p.name.isdigit())
    assert kept == [2, 3] and json.loads((folder / "_manifest/3").read_text())["next"] == {"t/0": 4}
