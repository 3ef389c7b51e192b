"""The table that takes each record once, the job with one checkpoint, and watermarks by split."""

import pytest
from pyspark.sql import functions as F

from orderstream.functions.codec import encode_order_json
from orderstream.sources.files import read_value_stream, write_values
from orderstream.sources.once import OnceTable
from orderstream.sources.tables import KeyedTable
from orderstream.schema import TOPIC_RECORD
from orderstream.streaming.job import dropped_late_rows, order_stats_plan, start_split_job

SCHEMA = TOPIC_RECORD


def batch(spark, offsets, topic="t", partition=0):
    rows = [(None, f"v{o}".encode(), topic, partition, o, None, None) for o in offsets]
    return spark.createDataFrame(rows, SCHEMA)


def offsets(table, spark):
    return sorted((r["offset"] is None, r["offset"] or 0) for r in table.read(spark).collect())


def known(*n):
    return sorted((False, x) for x in n)


def test_replays_and_overlaps_are_dropped(spark, tmp_dir):
    t = OnceTable(f"{tmp_dir}/t", SCHEMA, offset_range=10, run="a")
    assert t.read(spark).count() == 0
    t.write_batch(batch(spark, [1, 2, 2, 3]), 0)
    t.write_batch(batch(spark, [1, 2, 99]), 0)  # a batch that is there is left alone
    t.write_batch(batch(spark, [3, 25, 4]), 1)
    other = OnceTable(f"{tmp_dir}/t", SCHEMA, offset_range=10, run="b")  # a new checkpoint: other numbers, old records
    other.write_batch(batch(spark, [1, 25, 26]), 0)
    other.write_batch(batch(spark, [3], partition=1), 1)  # another partition's offset
    other.write_batch(batch(spark, []), 2)
    assert offsets(t, spark) == known(1, 2, 3, 4, 25, 26, 3)
    assert sorted((r["run"], r["batch_id"], r["rows"]) for r in t.commits(spark).collect()) == [("a", 0, 3), ("a", 1, 2), ("b", 0, 1), ("b", 1, 1), ("b", 2, 0)]


@pytest.mark.parametrize("step", ["rows", "ledger", "commits"])
def test_batches_that_broke_off(spark, tmp_dir, step, monkeypatch):
    """Broken off after any step and never repeated, a batch isn't there; a later run takes its records."""
    t = OnceTable(f"{tmp_dir}/t", SCHEMA, run="a")
    t.write_batch(batch(spark, [1]), 0)
    t.write_batch(batch(spark, [2, 3]), 1)
    import shutil

    for later in ("ledger", "commits")[{"rows": 0, "ledger": 1, "commits": 2}[step]:]:
        shutil.rmtree(f"{tmp_dir}/t/{later}/run=a/batch_id=1")
    done = step == "commits"
    assert offsets(t, spark) == (known(1, 2, 3) if done else known(1))
    again = OnceTable(f"{tmp_dir}/t", SCHEMA, run="b")
    again.write_batch(batch(spark, [1, 2, 3, 4]), 0)
    assert offsets(t, spark) == known(1, 2, 3, 4)
    t.write_batch(batch(spark, [2, 3]), 1)  # and now the first run repeats it after all
    assert offsets(t, spark) == known(1, 2, 3, 4)


def test_records_without_coordinates_stay(spark, tmp_dir):
    t = OnceTable(f"{tmp_dir}/t", SCHEMA, run="a")
    t.write_batch(batch(spark, [None, None, 5]), 0)
    t.write_batch(batch(spark, [None, 5]), 1)
    assert offsets(t, spark) == [(False, 5)] + [(True, 0)] * 3


def test_the_ledger_is_read_by_ranges(spark, tmp_dir):
    t = OnceTable(f"{tmp_dir}/t", SCHEMA, offset_range=10, run="a")
    for i in range(5):
        t.write_batch(batch(spark, range(10 * i, 10 * i + 10)), i)
    plan = t._unknown(batch(spark, [41, 55]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "offset_range" in plan.split("PartitionFilters", 1)[1][:300]
    assert sorted(r["offset"] for r in t._unknown(batch(spark, [41, 55])).collect()) == [55]


def test_one_checkpoint_for_both_outputs(spark, tmp_dir):
    good, bad = '{"order_id":"o%d","user_id":"u","amount":1.0,"status":"PLACED","timestamp":5}', "{bad%d"
    rows = [(None, ((bad if o % 4 == 0 else good) % o).encode(), "t", 0, o, None, None) for o in range(12)]
    for i in range(3):
        spark.createDataFrame(rows[4 * i:4 * i + 4], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
    seen = {"valid": [], "dead": []}
    fail = [True]

    def sink(name):
        def write(df, batch_id):
            if name == "valid" and batch_id == 1 and fail:
                fail.clear()
                raise RuntimeError("between the outputs")
            assert df.columns[:5] == ["topic", "partition", "offset", "key", "headers"] and "value" in df.columns
            seen[name].append((batch_id, sorted(r["offset"] for r in df.collect())))
        return write

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(f"{tmp_dir}/in")
        start_split_job(spark, stream, sink("valid"), sink("dead"), checkpoint=f"{tmp_dir}/ck", trigger={"availableNow": True}).awaitTermination()

    with pytest.raises(Exception, match="between the outputs"):
        run()
    run()
    assert seen["dead"] == [(0, [0]), (1, [4]), (1, [4]), (2, [8])]  # the same batch again, as a whole
    assert seen["valid"] == [(0, [1, 2, 3]), (1, [5, 6, 7]), (2, [9, 10, 11])]


def _run_splits(spark, tmp_dir, name, together):
    """Split a runs ahead to 5 minutes; then split b delivers an order of the first minute."""
    def put(split, user, ms):
        src = f"{tmp_dir}/{name}/{'all' if together else split}"
        write_values(spark.range(1).select(encode_order_json(order_id=F.lit(f"{user}{ms}"), user_id=F.lit(user), amount=F.lit(1.0), status=F.lit("PLACED"),
                                                             timestamp=F.lit(ms)).alias("value")), src)

    put("a", "u", 1000)
    put("b", "u", 2000)
    table = KeyedTable(f"{tmp_dir}/{name}/out")
    streams = [read_value_stream(spark, f"{tmp_dir}/{name}/{s}") for s in (["all"] if together else ["a", "b"])]
    q = (order_stats_plan(streams if not together else streams[0]).writeStream.outputMode("append").foreachBatch(table.write_batch)
         .option("checkpointLocation", f"{tmp_dir}/{name}/ck").start())
    try:
        q.processAllAvailable()
        for split, user, ms in (("a", "u", 300_000), ("b", "lagging", 3000), ("b", "u", 301_000), ("b", "late", 4000), ("a", "end", 10**9), ("b", "end", 10**9),
                                ("a", "end", 10**9 + 1), ("b", "end", 10**9 + 1)):
            put(split, user, ms)
            q.processAllAvailable()
        late = dropped_late_rows(q)
    finally:
        q.stop()
    return {(r["user_id"], r["order_count"]) for r in table.read(spark).collect() if r["user_id"] != "end"}, late


def test_a_lagging_split_loses_no_rows(spark, tmp_dir):
    assert _run_splits(spark, tmp_dir, "by-split", False) == ({("u", 2), ("lagging", 1)}, 1)  # two windows of u have 2 orders each
    assert _run_splits(spark, tmp_dir, "global", True) == ({("u", 2)}, 2)
