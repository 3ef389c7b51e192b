"""Headers, backoff, retry decisions and alert texts."""

from pyspark.sql import functions as F

from orderstream.functions.alert_text import alert_payload, dlq_alert_text, permanent_failure_text
from orderstream.functions.codec import encode_order_json, header_int, retry_header, with_headers
from orderstream.functions.scalar import backoff_ms
from orderstream.operators.retry import decode_dlq_records, plan_retries, retry_records


def _h(*pairs):
    return [(k, None if v is None else v.encode()) for k, v in pairs]


def test_header_edges(spark):
    cases = [
        (None, 0), ([], 0), (_h(("retry-count", "0")), 0), (_h(("retry-count", "4")), 4),
        (_h(("retry-count", "6")), 6), (_h(("retry-count", "abc")), 0), (_h(("retry-count", "+2")), 2),
        (_h(("retry-count", " 3")), 0), (_h(("retry-count", "abc"), ("retry-count", "3")), 3),
        (_h(("other", "5")), 0), (_h(("other", "5"), ("retry-count", "1")), 1),
        (_h(("retry-count", "99999999999999999999")), 0),
    ]
    df = spark.createDataFrame([(c,) for c, _ in cases], "headers array<struct<key:string,value:binary>>")
    got = [r[0] for r in df.select(header_int("headers")).collect()]
    assert got == [e for _, e in cases]


def test_backoff_sequence(spark):
    df = spark.range(7).withColumnRenamed("id", "retry_count")
    df = df.withColumn("record_ts", F.timestamp_millis(F.lit(0)))
    p = plan_retries(df).orderBy("retry_count").collect()
    assert [r["backoff_ms"] for r in p] == [1000, 2000, 4000, 8000, 16000, None, None]
    assert [r["decision"] for r in p] == ["RETRY"] * 5 + ["PERMANENT"] * 2
    assert [r["next_retry_count"] for r in p] == [1, 2, 3, 4, 5, None, None]
    assert spark.range(1).select(backoff_ms(F.lit(3), 500)).first()[0] == 4000


def test_backoff_of_odd_counts(spark):
    df = spark.createDataFrame([(n,) for n in (-3, -1, 0, 52, 53, 60, 4_000_000_000_000)], "retry_count long")
    df = df.withColumn("record_ts", F.timestamp_millis(F.lit(0)))
    p = {r["retry_count"]: r for r in plan_retries(df, max_retries=10 ** 13).collect()}
    assert [p[n]["backoff_ms"] for n in (-3, -1, 0)] == [1000] * 3
    assert p[52]["backoff_ms"] == 1000 * 2 ** 52 and p[53]["backoff_ms"] == 1000 * 2 ** 53
    assert p[60]["backoff_ms"] == p[4_000_000_000_000]["backoff_ms"] == 2 ** 63 - 1
    assert p[60]["next_attempt_at"].year == 9999 and p[-3]["next_retry_count"] == -2
    assert p[0]["next_attempt_at"].timestamp() == 1


def test_headers_are_replaced_and_others_kept(spark):
    df = spark.createDataFrame([(_h(("retry-count", "1"), ("trace", "x"), ("retry-count", "2")),), (None,), ([],)],
                               "headers array<struct<key:string,value:binary>>")
    got = [[(h["key"], bytes(h["value"])) for h in r[0]] for r in df.select(with_headers(F.col("headers"), {"retry-count": F.lit(7)})).collect()]
    assert got == [[("trace", b"x"), ("retry-count", b"7")], [("retry-count", b"7")], [("retry-count", b"7")]]


def test_retry_record_roundtrip(spark):
    ev = spark.createDataFrame([("o1", "u1", 12.5, "PLACED", 1000)],
                               "order_id string, user_id string, amount double, status string, timestamp long")
    rec = ev.select(F.col("user_id").cast("binary").alias("key"), encode_order_json().cast("binary").alias("value"),
                    retry_header(F.lit(2)).alias("headers"), F.lit("order-events-dlq").alias("topic"),
                    F.lit(1).alias("partition"), F.lit(5).cast("bigint").alias("offset"),
                    F.timestamp_millis(F.lit(1000)).alias("timestamp"))
    d = decode_dlq_records(rec)
    row = d.first()
    assert row["retry_count"] == 2 and row["order_id"] == "o1" and not row["undecodable"]
    out = retry_records(plan_retries(d)).first()
    assert bytes(out["key"]) == b"u1"
    assert out["headers"][0]["key"] == "retry-count" and bytes(out["headers"][0]["value"]) == b"3"
    assert out["value"] == '{"order_id":"o1","user_id":"u1","amount":12.5,"status":"PLACED","timestamp":1000}'


def test_alert_texts(spark):
    df = spark.createDataFrame(
        [('{"order_id":"o1","user_id":null,"amount":12.50}', "order-events-dlq", 2), ("not json", "t", 0)],
        "value string, topic string, partition int")
    got = [r[0] for r in df.select(dlq_alert_text()).collect()]
    assert got[0] == (":red_circle: *DLQ Alert*\nOrder `o1` by user `null` routed to dead letter queue\n"
                      "Amount: $12.5 | Topic: `order-events-dlq` | Partition: 2")
    assert "Order `unknown` by user `unknown`" in got[1] and "Amount: $unknown" in got[1]
    p = spark.createDataFrame([("o", "u", 5, 3.005, "PLACED")],
                              "order_id string, user_id string, retry_count int, amount double, status string")
    txt = p.select(permanent_failure_text()).first()[0]
    assert txt.endswith("failed after 5 retries\nAmount: $3.01 | Status: PLACED") or txt.endswith("$3.00 | Status: PLACED")
    payload = p.select(alert_payload(F.lit('say "hi"\nnow'))).first()[0]
    assert payload == '{"text":"say \\"hi\\"\\nnow"}'


def test_retry_outcomes_conserve_dead_letter_records(spark):
    from conftest import SF01
    from orderstream.plans.catalog import QUERIES

    outcomes = {r["decision"]: r["records"] for r in QUERIES["retry_outcomes"](spark, SF01).collect()}
    dlq = QUERIES["dlq_events"](spark, SF01).count()
    assert sum(outcomes.values()) == dlq == 200
    assert set(outcomes) == {"RETRY", "PERMANENT", "REJECTED"}
    rate = QUERIES["dlq_rate"](spark, SF01).first()
    assert rate["valid"] + rate["dlq"] == rate["total"] == 10000
