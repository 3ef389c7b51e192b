"""Source/sink contracts that cannot run here (no broker, no database)."""

from orderstream.sources import jdbc, kafka


def test_kafka_source_options():
    o = kafka.source_options("b1:9092,b2:9092", "order-events")
    assert o["startingOffsets"] == "latest" and o["includeHeaders"] == "true"
    assert o["subscribe"] == "order-events"
    d = kafka.source_options("b", "order-events-dlq", starting="earliest", group_id="g", min_partitions=24)
    assert d["startingOffsets"] == "earliest" and d["kafka.group.id"] == "g" and d["minPartitions"] == "24"
    s = kafka.sink_options("b", "order-events-dlq")
    assert s["kafka.enable.idempotence"] == "true" and s["kafka.acks"] == "all"


def test_record_builders(spark):
    from pyspark.sql import functions as F

    ev = spark.createDataFrame([("o", "u", 1.5, "PLACED", 7, "NEGATIVE_AMOUNT")],
                               "order_id string, user_id string, amount double, status string, timestamp long, dlq_reason string")
    r = kafka.as_dlq_records(ev).first()
    assert bytes(r["key"]) == b"u" and b'"amount":1.5' in bytes(r["value"])
    assert [(h["key"], bytes(h["value"])) for h in r["headers"]] == [("retry-count", b"0"), ("dlq-reason", b"NEGATIVE_AMOUNT")]
    null_key = kafka.as_dlq_records(ev.withColumn("user_id", F.lit(None).cast("string"))).first()
    assert null_key["key"] is None


def test_upsert_statements():
    cols = ["user_id", "order_count", "total_amount", "window_start", "window_end"]
    pg = jdbc.upsert_statement("user_order_stats", "stg", cols)
    assert "ON CONFLICT (user_id, window_start) DO UPDATE SET order_count = EXCLUDED.order_count, " \
           "total_amount = EXCLUDED.total_amount" in pg
    assert "window_end = " not in pg.split("DO UPDATE SET")[1]
    ansi = jdbc.upsert_statement("user_order_stats", "stg", cols, dialect="ansi")
    assert ansi.startswith("MERGE INTO user_order_stats t USING") and "WHEN NOT MATCHED THEN INSERT" in ansi
    assert any("PRIMARY KEY (user_id, window_start)" in d for d in jdbc.STATS_DDL)
    assert "order_count BIGINT NOT NULL DEFAULT 0" in jdbc.STATS_DDL[0] and "DEFAULT 0.0" in jdbc.STATS_DDL[0]


class RecordedSink(jdbc.JdbcUpsertSink):
    """The sink with its two ways to the database replaced by a record of them."""

    def __init__(self, **kw):
        super().__init__("jdbc:none", **kw)
        self.done, self.fail_at = [], None

    def _execute(self, spark, statements):
        if self.fail_at == len(self.done):
            self.fail_at = None
            raise RuntimeError("connection lost")
        self.done.append([s.split()[0] for s, _ in statements])

    def _stage(self, staged):
        assert "batch_id" in staged.columns
        self.done.append(["STAGE"])


def test_jdbc_replay_clears_what_an_earlier_attempt_staged(spark, monkeypatch):
    monkeypatch.setattr(jdbc.time, "sleep", lambda s: None)
    df = spark.createDataFrame([("u", 1, 2.0)], "user_id string, order_count long, total_amount double")
    sink = RecordedSink()
    sink(df, 4)
    assert sink.done == [["DELETE"], ["STAGE"], ["INSERT", "DELETE"]]
    sink = RecordedSink(dialect="ansi")
    sink.fail_at = 2
    sink(df, 4)
    assert sink.done == [["DELETE"], ["STAGE"], ["MERGE", "DELETE"]]
    sink = RecordedSink(max_retries=0)
    sink.fail_at = 0
    try:
        sink(df, 4)
        raise AssertionError("a failing statement must fail the batch")
    except RuntimeError:
        pass
    p = jdbc.JdbcUpsertSink("jdbc:x", user="u", password="p", driver="d", batch_size=7).properties()
    assert p == {"batchsize": "7", "user": "u", "password": "p", "driver": "d"}


def test_staging_has_the_result_columns_and_the_batch():
    names = lambda ddl: [line.split()[0] for line in ddl.splitlines()[1:-1] if "PRIMARY" not in line]
    assert names(jdbc.STAGING_DDL[0]) == [*names(jdbc.STATS_DDL[0]), "batch_id"]


def test_topic_readers_and_writers_pass_their_options(monkeypatch):
    class Chain:
        def __init__(self):
            self.calls = {}

        def __getattr__(self, name):
            def call(*a, **kw):
                self.calls[name] = kw or a
                return self
            return call

    class Session:
        readStream = Chain()

    assert kafka.read_dlq(Session, "b:9092").calls["options"]["startingOffsets"] == "earliest"
    assert Session.readStream.calls["options"]["subscribe"] == "order-events-dlq"
    kafka.read_order_events(Session, "b:9092")
    assert Session.readStream.calls["options"]["startingOffsets"] == "latest"

    class Frame:
        writeStream = Chain()
        select = lambda self, *c: self

    kafka.write_retries(Frame(), "b:9092", "/ck")
    assert Frame.writeStream.calls["options"]["topic"] == "order-events"
    assert Frame.writeStream.calls["option"] == ("checkpointLocation", "/ck")


def test_stats_records(spark):
    from pyspark.sql import functions as F

    s = spark.createDataFrame([("u", 2, 3.5)], "user_id string, order_count long, total_amount double").select(
        "*", F.timestamp_millis(F.lit(0)).alias("window_start"), F.timestamp_millis(F.lit(60000)).alias("window_end"))
    r = kafka.as_stats_records(s).first()
    assert bytes(r["key"]) == b"u" and '"order_count":2,"total_amount":3.5' in r["value"]


def test_partition_by_key_keeps_key_order_and_splits_hot_keys(spark):
    from conftest import SF001
    from orderstream.plans.fixtures import order_events
    from pyspark.sql import functions as F

    base = order_events(spark, SF001).select("user_id", "timestamp")
    hot = spark.range(3000).select(F.lit("user-hot").alias("user_id"), (F.col("id") * 7).alias("timestamp"))
    df = kafka.partition_by_key(base.unionByName(hot), 4).withColumn("pid", F.spark_partition_id())
    rows = df.collect()
    # partitions are contiguous, ordered slices of (key, timestamp)
    by_pid = sorted(rows, key=lambda r: (r["pid"],))
    keys = [(r["user_id"], r["timestamp"]) for r in by_pid]
    assert keys == sorted(keys)
    # the hot key (more than a third of the rows) spans more than one partition
    assert len({r["pid"] for r in rows if r["user_id"] == "user-hot"}) > 1
