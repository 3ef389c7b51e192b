"""Shared files and ids, the parts that operators build on."""

import numpy as np
import pyarrow as pa
import pytest
from pyarrow import fs as pafs

from orderstream.llm import common
from orderstream.llm.id_sets import id_number, keep_members, write_id_set


def test_shared_arrays(tmp_path, monkeypatch):
    uri = f"file://{tmp_path}/a/b"
    common.write_file(uri, np.arange(5).tobytes())
    common.write_file(uri, np.arange(7).tobytes())  # a second attempt replaces the first
    s = common.SharedArrays()
    assert s.get(uri, np.int64).tolist() == list(range(7)) and isinstance(s.get(uri, np.int64), np.memmap)
    assert len(s.get(f"file://{tmp_path}/none", np.int64)) == 0
    assert [p.name for p in (tmp_path / "a").iterdir()] == ["b"]

    # a file system that isn't mounted: read, and given up beyond a bound
    other = pafs.SubTreeFileSystem(str(tmp_path), pafs.LocalFileSystem())
    monkeypatch.setattr(common, "filesystem", lambda u: (other, u.removeprefix("far://")))
    far = common.SharedArrays()
    far.READ_BYTES = 100
    for k in range(3):
        common.write_file(f"far://x/{k}", np.full(7, k).tobytes())
        assert far.get(f"far://x/{k}", np.int64).tolist() == [k] * 7
    assert list(far.read) == ["far://x/2"] and far.get("far://x/0", np.int64).tolist() == [0] * 7


def test_slices_keep_rows_and_bound():
    batch = pa.RecordBatch.from_arrays([pa.array([b"x" * n for n in (5, 0, 9, 30, 1, 1, 1)]), pa.array(range(7))], names=["text", "i"])
    parts = list(common.sliced(iter([batch]), "text", 10))
    assert [p.column("i").to_pylist() for p in parts] == [[0, 1], [2], [3], [4, 5, 6]]


@pytest.mark.parametrize("kind", ["long", "int", "string"])
def test_id_sets(spark, kind):
    ids = spark.range(-50, 400).selectExpr(f"cast(id AS {kind}) AS id").unionByName(spark.createDataFrame([(None,)], f"id {kind}"))
    members = ids.where("cast(id AS long) % 7 = 0").unionByName(ids.where("id IS NULL"))
    kind = ids.schema["id"].dataType.simpleString()
    numbered = ids.withColumn("n", id_number(ids["id"], kind))
    got = keep_members(numbered, "n", write_id_set(members, "id", "test-ids"))
    assert sorted(int(r["id"]) for r in got.collect()) == [i for i in range(-50, 400) if i % 7 == 0]
    assert keep_members(numbered, "n", write_id_set(members.where("false"), "id", "test-ids")).count() == 0


def test_unused_names():
    assert common.unused(["a", "B"], "c") == "c"
    assert common.unused(["place"], "Place").lower() != "place"
