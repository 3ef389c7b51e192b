"""Boundary goldens for decoding, the poison predicate, reasons and the split."""

import json

from pyspark.sql import functions as F

from orderstream.operators.validate import decode_events, is_poison, split_events, tag_events


def _decode(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return decode_events(df, keep=("value",))


def test_poison_edges(spark):
    rows = [
        (-0.01, "u", "o", True), (-0.0, "u", "o", False), (0.0, "u", "o", False),
        (float("nan"), "u", "o", False), (None, "u", "o", False),
        (1.0, "", "o", True), (1.0, " ", "o", False), (1.0, None, "o", True),
        (1.0, "u", "", True), (1.0, "u", " ", False), (1.0, "u", None, True),
    ]
    df = spark.createDataFrame([r[:3] for r in rows], "amount double, user_id string, order_id string")
    got = [r[0] for r in df.select(is_poison().alias("p")).collect()]
    assert got == [r[3] for r in rows]


def test_missing_fields_take_primitive_defaults(spark):
    d = _decode(spark, ['{"order_id":"o","user_id":"u","status":"PLACED"}']).collect()[0]
    assert d["amount"] == 0.0 and d["timestamp"] == 0 and not d["malformed"]
    assert str(d["event_time"]).startswith("1970-01-01")


def test_json_edges_are_malformed(spark):
    bad = ["{bad", "", "null", "[]", '{"amount":"12.5"}', '{"timestamp":"17"}', '{"timestamp":1.9}',
           '{"amount":true}']
    t = tag_events(_decode(spark, bad))
    assert [r["dlq_reason"] for r in t.collect()] == ["MALFORMED_JSON"] * len(bad)


def test_reason_order_and_status_variants(spark):
    vals = [
        json.dumps({"order_id": "", "user_id": "", "amount": -1.0, "status": "PLACED", "timestamp": 1}),
        json.dumps({"order_id": "", "user_id": "", "amount": 1.0, "status": "PLACED", "timestamp": 1}),
        json.dumps({"order_id": "", "user_id": "u", "amount": 1.0, "status": None, "timestamp": 1}),
        json.dumps({"order_id": "o", "user_id": "u", "amount": 1.0, "status": "placed", "timestamp": 1}),
        json.dumps({"order_id": 7, "user_id": "u", "amount": 1.0, "status": "X", "timestamp": 1, "extra": 1}),
    ]
    got = [r["dlq_reason"] for r in tag_events(_decode(spark, vals)).collect()]
    assert got == ["NEGATIVE_AMOUNT", "MISSING_USER_ID", "MISSING_ORDER_ID", None, None]


def test_split_conserves_rows(spark):
    from orderstream.plans.fixtures import order_events
    from conftest import SF01

    oe = order_events(spark, SF01)
    valid, dlq = split_events(oe, None)
    n, v, d = oe.count(), valid.count(), dlq.count()
    assert v + d == n == 10000
    counts = {r[0]: r[1] for r in dlq.groupBy("dlq_reason").count().collect()}
    assert counts == {"NEGATIVE_AMOUNT": 67, "MISSING_USER_ID": 67, "MISSING_ORDER_ID": 66}
    assert oe.where(F.col("status") == "PLACED").count() == 4113


def test_fail_fast_mode_raises(spark):
    import pytest

    df = spark.createDataFrame([("{bad",)], "value string")
    with pytest.raises(Exception):
        decode_events(df, on_malformed="fail").collect()
