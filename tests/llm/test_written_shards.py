"""Shards as files: every row in the folder of its shard, within the limit, with all its columns."""

import collections
import pathlib

import pyarrow.parquet as pq

from tidelake.llm import sharding


def test_shards_are_written_whole(spark, tmp_path):
    rows = [(k, "ä" * (k % 40), f"more {k}", "clash") for k in range(1500)] + [(7, "y" * 90, None, None)] * 40 + [(None, None, "n", None), (2000, "z" * 900, "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, note string, shard string").repartition(5)
    folder = str(tmp_path / "shards")
    back = sharding.write_shards(docs, limit=700, path=folder)
    assert back.columns == ["doc_id", "text", "note", "row_bytes", "shard", "depth", "page"]
    got = back.collect()
    assert collections.Counter((r.doc_id, r.text, r.note) for r in got) == collections.Counter(r[:3] for r in rows)
    placed = collections.Counter((r.shard, r.depth) for r in sharding.assign_shards(docs, 700).collect())
    assert collections.Counter((r.shard, r.depth) for r in got) == placed
    files = list(pathlib.Path(folder).rglob("*.parquet"))
    assert len(files) == len({f.parent for f in files}) == len({(r.shard, r.page) for r in got}) > 30
    for file in files:
        sizes = [len((t or "").encode()) for t in pq.ParquetFile(file).read(columns=["text"]).column("text").to_pylist()]
        assert sum(sizes) <= 700 or len(sizes) == 1


def test_one_shard_and_none(spark):
    small = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert {(r.doc_id, r.shard, r.depth, r.page, r.row_bytes) for r in sharding.write_shards(small).collect()} == {(1, "", 0, 0, 1), (2, "", 0, 0, 0)}
    assert sharding.write_shards(small.limit(0)).count() == 0
