"""The dead-letter loop and the delayed release."""

import json
import time

import pytest
from pyspark.sql import functions as F

from orderstream.functions.metric_names import parse_metric_names
from orderstream.operators.retry import decode_dlq_records, plan_retries
from orderstream.schema import TOPIC_RECORD
from orderstream.session import checkpoint_root, scratch_path
from orderstream.sources.kafka import as_dlq_records
from orderstream.streaming.job import dlq_plan
from orderstream.streaming.retry_release import ReleaseIncomplete, RetryRelease, run_release


def _records(spark, n, counts=6):
    """n dead-letter records with retry counts 0 .. counts-1; every tenth can't be decoded."""
    value = F.when(F.col("id") % 10 == 9, F.lit("{bad")).otherwise(
        F.concat(F.lit('{"order_id":"o'), F.col("id").cast("string"), F.lit('","user_id":"","amount":1.0,"status":"PLACED","timestamp":5}')))
    return spark.range(n).select(
        F.lit(None).cast("binary").alias("key"), value.cast("binary").alias("value"), F.lit("order-events-dlq").alias("topic"),
        F.lit(0).alias("partition"), F.col("id").alias("offset"), F.timestamp_millis(F.lit(0)).alias("timestamp"),
        F.array(F.struct(F.lit("retry-count").alias("key"), (F.col("id") % counts).cast("string").cast("binary").alias("value"))).alias("headers"))


def test_thousands_of_records_come_out_once(spark, tmp_dir):
    n = 6000
    _records(spark, n).write.parquet(f"{tmp_dir}/in")
    got = run_release(spark, f"{tmp_dir}/in", TOPIC_RECORD, f"{tmp_dir}/ck", f"{tmp_dir}/out", base_ms=50, max_files_per_trigger=2)
    rows = {r["offset"]: r for r in got.collect()}
    assert got.count() == len(rows) == n - n // 10
    for offset, r in rows.items():
        count = offset % 6
        assert r["decision"] == ("PERMANENT" if count >= 5 else "RETRY")
        assert r["retry_count"] == (count if count >= 5 else count + 1)
        assert count >= 5 or r["released_ms"] >= r["due_ms"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_early_stop_raises(spark, tmp_dir):
    _records(spark, 100, counts=3).write.parquet(f"{tmp_dir}/in")
    with pytest.raises(ReleaseIncomplete, match="90 records pending"):
        run_release(spark, f"{tmp_dir}/in", TOPIC_RECORD, f"{tmp_dir}/ck", f"{tmp_dir}/out", base_ms=3_600_000, stop=lambda: True)


def test_failing_ingest_raises(spark, tmp_dir):
    _records(spark, 10).write.parquet(f"{tmp_dir}/in")
    bad = TOPIC_RECORD.fields[:2]
    from pyspark.sql.types import StructType

    with pytest.raises(Exception):
        run_release(spark, f"{tmp_dir}/in", StructType(bad), f"{tmp_dir}/ck", f"{tmp_dir}/out")


def test_releases_follow_the_clock_and_repeat_safely(spark, tmp_dir):
    now = [1_000_000]
    t = RetryRelease(spark, f"{tmp_dir}/t", base_ms=1000, clock_ms=lambda: now[0])
    batch = _records(spark, 12)
    t.ingest(batch, 0)
    t.ingest(batch, 0)  # a replayed micro-batch
    ids = lambda: sorted(r["offset"] for r in t.released().collect())
    assert ids() == [5, 11] and t.pending() == 9  # 9 can't be decoded, 5 and 11 are permanent
    assert t.release() == 1_001_000 and ids() == [5, 11]
    now[0] = 1_002_000
    assert t.release() == 1_004_000 and ids() == [0, 1, 5, 6, 7, 11]
    assert t.release() == 1_004_000 and ids() == [0, 1, 5, 6, 7, 11]  # nothing new at the same time
    t.ingest(_records(spark, 1), 1)  # arrives later, due a second after its arrival
    now[0] = 1_003_000
    t.release()
    assert ids() == [0, 0, 1, 5, 6, 7, 11]
    now[0] = 2_000_000
    assert t.release() is None and t.pending() == 0
    assert ids() == [0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 11]


def test_dead_letters_keep_count_bytes_and_headers(spark):
    values = [(json.dumps({"order_id": "o", "user_id": "u", "amount": -1.0, "status": "PLACED", "timestamp": 5}).encode(), b"u", 4),
              (b'{bad \xff', b"k", 2), (b"", None, None)]
    rows = [(v, k, None if c is None else [("retry-count", str(c).encode()), ("trace", b"t")]) for v, k, c in values]
    df = spark.createDataFrame(rows, "value binary, key binary, headers array<struct<key:string,value:binary>>")
    out = as_dlq_records(dlq_plan(df)).collect()
    got = sorted((bytes(r["value"]), r["key"] and bytes(r["key"]), [(h["key"], bytes(h["value"])) for h in r["headers"]]) for r in out)
    assert got[0] == (b"", None, [("retry-count", b"0"), ("dlq-reason", b"MALFORMED_JSON")])
    assert got[1][0] == b'{"order_id":"o","user_id":"u","amount":-1.0,"status":"PLACED","timestamp":5}'
    assert got[1][2] == [("trace", b"t"), ("retry-count", b"4"), ("dlq-reason", b"NEGATIVE_AMOUNT")]
    assert got[2][:2] == (b'{bad \xff', b"k") and ("retry-count", b"2") in got[2][2]
    back = spark.createDataFrame(out).withColumn("timestamp", F.timestamp_millis(F.lit(0)))
    p = {bytes(r["value"]): r for r in plan_retries(decode_dlq_records(back)).collect()}
    assert p[b'{bad \xff']["undecodable"] and p[b'{bad \xff']["retry_count"] == 2
    assert sorted(r["retry_count"] for r in p.values()) == [0, 2, 4]


def test_metric_names_match_anywhere(spark):
    beans = {
        "kafka.server<type=BrokerTopicMetrics, name=MessagesInPerSec, topic=a-b><>OneMinuteRate":
            ("kafka_server_broker_topic_metrics_messages_in_per_sec", "a-b"),
        "jmx kafka.server<type=BrokerTopicMetrics, name=BytesOutPerSec, topic=t><>OneMinuteRate: 3.5":
            ("kafka_server_broker_topic_metrics_bytes_out_per_sec", "t"),
        "kafka.server<type=BrokerTopicMetrics, name=BytesInPerSec><>OneMinuteRate 7": ("kafka_server_broker_topic_metrics_bytes_in_per_sec", None),
        "x kafka.network<type=RequestMetrics, name=TotalTimeMs, request=FetchConsumer><>99thPercentile":
            ("kafka_network_request_metrics_fetch_total_time_ms_p99", None),
        "kafka.network<type=RequestMetrics, name=TotalTimeMs, request=Produce><>Mean": ("kafka_network_request_metrics_produce_total_time_ms_mean", None),
        "kafka.controller<type=KafkaController, name=OfflinePartitionsCount><>Value": ("kafka_controller_offline_partitions_count", None),
        "kafka.controller<type=KafkaController, name=OfflinePartitionsCount><>Count": None,
        "kafka.server<type=BrokerTopicMetrics, name=Other, topic=t><>OneMinuteRate": None,
        "kafka.server<type=ReplicaManager, name=PartitionCount, topic=t><>Value": None,
        "": None, "plain text": None,
    }
    df = spark.createDataFrame([(b,) for b in beans] + [(None,)], "mbean string")
    got = {r["mbean"]: (r["metric"], r["topic"]) for r in parse_metric_names(df).collect()}
    assert got == {b: want for b, want in beans.items() if want}


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    class Context:
        master = "yarn"
        getConf = lambda self: {}
        getCheckpointDir = lambda self: None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *a: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_settings_that_are_set_stay(spark):
    from orderstream.session import apply_core_conf

    new = spark.newSession()
    name = "spark.sql.adaptive.skewJoin.enabled"
    new.conf.set(name, "false")
    apply_core_conf(new)
    assert new.conf.get(name) == "false" and new.conf.get("spark.sql.session.timeZone") == "UTC"
    assert "RocksDB" in new.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_an_ingest_that_ends_after_a_release_loses_nothing(spark, tmp_dir):
    """Its rows fall due at 6 s, a release at 10 s comes before its folder is whole."""
    now, table = [1_000_000], None
    inside = []

    def clock():
        t = now[0]
        if inside:  # the ingest has read its clock; time goes on and a release comes in between
            inside.clear()
            now[0] = 1_010_000
            assert table.release() == 1_011_000  # the row of batch 0 fell due; another one has not
        return t

    table = RetryRelease(spark, f"{tmp_dir}/t", base_ms=1000, clock_ms=clock)
    table.ingest(_records(spark, 1), 0)
    now[0] = 1_010_000
    table.ingest(_records(spark, 1).withColumn("offset", F.lit(50)), 1)
    now[0] = 1_005_000
    inside.append(True)
    table.ingest(_records(spark, 1).withColumn("offset", F.lit(77)), 2)
    now[0] = 1_020_000
    assert table.release() is None and table.pending() == 0
    assert sorted(r["offset"] for r in table.released().collect()) == [0, 50, 77]


def test_broken_off_releases_are_done_again(spark, tmp_dir):
    now = [1_000_000]
    t = RetryRelease(spark, f"{tmp_dir}/t", base_ms=1000, clock_ms=lambda: now[0])
    t.ingest(_records(spark, 9, counts=3), 0)
    now[0] = 1_001_500
    close, t._close = t._close, lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError, match="lost"):
        t.release()  # its rows are written, the ledger isn't
    t._close = close
    now[0] = 1_002_500
    assert t.release() == 1_004_000
    assert sorted(r["offset"] for r in t.released().collect()) == [0, 1, 3, 4, 6, 7]
    now[0] = 999_000  # a clock that goes back releases nothing twice
    t.release()
    now[0] = 1_005_000
    assert t.release() is None
    assert sorted(r["offset"] for r in t.released().collect()) == list(range(9))


def test_publishing_keeps_keys_headers_and_order_and_repeats_safely(spark, tmp_dir):
    now, got = [1_000_000], []
    t = RetryRelease(spark, f"{tmp_dir}/t", base_ms=1000, clock_ms=lambda: now[0])
    value = b'{"order_id":"o","user_id":"u1","amount":1.0,"status":"PLACED","timestamp":5}'
    rows = [(b"old", value, "dlq", 0, i, None, None if n is None else [("trace", b"t"), ("retry-count", n)]) for i, n in enumerate([b"0", b"1", None, b"5"])]
    t.ingest(spark.createDataFrame(rows, TOPIC_RECORD), 0)

    def sink(df, n):
        got.extend((n, r["offset"], bytes(r["key"]), bytes(r["value"]), [(h["key"], bytes(h["value"])) for h in r["headers"]], r["to_topic"]) for r in df.collect())

    assert t.publish(sink) == 0
    now[0] = 1_001_000
    t.release()
    assert t.publish(sink) == 1 and t.publish(sink) == 0
    now[0] = 1_009_000
    t.release()
    with pytest.raises(ZeroDivisionError):
        t.publish(lambda df, n: 1 / 0)  # not handed on: comes again
    t.publish(sink)
    assert sorted(got) == [(1, 0, b"u1", value, [("trace", b"t"), ("retry-count", b"1")], "order-events"), (1, 2, b"u1", value, [("retry-count", b"1")], "order-events"),
                           (2, 1, b"u1", value, [("trace", b"t"), ("retry-count", b"2")], "order-events")]
    gave_up = t.released().where("decision = 'PERMANENT'").collect()
    assert [(r["offset"], bytes(r["key"]), r["retry_count"], len(r["headers"])) for r in gave_up] == [(3, b"old", 5, 2)]


def test_released_batches_can_be_dropped(spark, tmp_dir):
    now = [1_000_000]
    t = RetryRelease(spark, f"{tmp_dir}/t", base_ms=1000, clock_ms=lambda: now[0])
    for b in range(5):
        t.ingest(_records(spark, 3, counts=1 if b != 1 else 4).withColumn("offset", F.col("offset") + 10 * b), b)
    now[0] = 1_001_000
    t.release()
    t.drop_released()
    assert t._batches() == [1, 3, 4] and t.pending() == 2  # 1 has rows left, the newest two can be replayed
    t.ingest(_records(spark, 3, counts=1), 4)
    now[0] = 1_100_000
    t.release()
    t.drop_released()
    assert t.pending() == 0 and t.released().count() == 15 and t.publish(lambda df, n: None) == 2


def test_the_service_runs_until_it_is_stopped(spark, tmp_dir):
    """Records that arrive while it runs, a stop in between, a second start from the checkpoints."""
    from orderstream.sources.once import OnceTable
    from orderstream.streaming.retry_release import RETRY_RECORD, start_service

    _records(spark, 40, counts=2).write.parquet(f"{tmp_dir}/in")
    t = RetryRelease(spark, f"{tmp_dir}/t", base_ms=200)
    topic = OnceTable(f"{tmp_dir}/topic", RETRY_RECORD, run="retries")
    stream = lambda: spark.readStream.schema(TOPIC_RECORD).parquet(f"{tmp_dir}/in")

    def until(n):
        queries = start_service(spark, stream(), t, topic.write_batch, f"{tmp_dir}/ck", poll="200 milliseconds", name=f"r{n}")
        try:
            for _ in range(240):
                if topic.read(spark).count() >= n:
                    break
                assert all(q.isActive for q in queries), [q.exception() for q in queries]
                time.sleep(0.25)
        finally:
            for q in queries:
                q.stop()
        got = [r["offset"] for r in topic.read(spark).select("offset").collect()]
        assert len(got) == len(set(got)) == n

    until(36)
    _records(spark, 60, counts=2).where("offset >= 40").write.mode("append").parquet(f"{tmp_dir}/in")
    until(54)
