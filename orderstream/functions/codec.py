"""Wire codec: JSON value <-> typed order event, record key and headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderstream.schema import CORRUPT_COL, ORDER_EVENT_WITH_CORRUPT, RETRY_HEADER


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_order_json(value="value") -> Column:
    """JSON bytes/string -> struct<order_id,user_id,amount,status,timestamp,_corrupt_record>.

    PERMISSIVE parsing; a record that is not a JSON object of the right field
    types keeps its raw text in ``_corrupt_record``.  An empty or null input
    yields a null struct (treated as malformed by ``validate``).
    """
    return F.from_json(
        _col(value).cast("string"),
        ORDER_EVENT_WITH_CORRUPT,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL},
    )


def decoded_columns(parsed="e") -> list[Column]:
    """Flatten a decoded struct with the reference's primitive defaults:
    a missing amount/timestamp reads as 0, a missing string stays null."""
    p = _col(parsed)
    return [
        p["order_id"].alias("order_id"),
        p["user_id"].alias("user_id"),
        F.coalesce(p["amount"], F.lit(0.0)).alias("amount"),
        p["status"].alias("status"),
        F.coalesce(p["timestamp"], F.lit(0).cast("bigint")).alias("timestamp"),
        (p.isNull() | p[CORRUPT_COL].isNotNull()).alias("malformed"),
    ]


def encode_order_json(*, order_id="order_id", user_id="user_id", amount="amount",
                      status="status", timestamp="timestamp") -> Column:
    """Typed event -> JSON string with snake_case names; nulls are written as null."""
    return F.to_json(
        F.struct(
            _col(order_id).alias("order_id"),
            _col(user_id).alias("user_id"),
            _col(amount).cast("double").alias("amount"),
            _col(status).alias("status"),
            _col(timestamp).cast("bigint").alias("timestamp"),
        ),
        {"ignoreNullFields": "false"},
    )


def event_time(ts_ms="timestamp") -> Column:
    """Epoch milliseconds -> event-time timestamp (missing = epoch 0)."""
    return F.timestamp_millis(F.coalesce(_col(ts_ms), F.lit(0).cast("bigint")))


def kafka_key(user_id="user_id") -> Column:
    """Record key = user id bytes; a null user keeps a null key."""
    return _col(user_id).cast("binary")


def header_int(headers="headers", name: str = RETRY_HEADER, default: int = 0) -> Column:
    """First header ``name`` whose value parses as an integer, else ``default``.

    Unparsable values are skipped (a later parsable one still counts), an
    absent header or a null header list gives the default.
    """
    matches = F.filter(_col(headers), lambda h: h["key"] == F.lit(name))
    parsed = F.transform(
        matches,
        lambda h: F.when(
            F.decode(h["value"], "UTF-8").rlike(r"^[+-]?[0-9]+$"),
            F.decode(h["value"], "UTF-8").try_cast("bigint"),
        ),
    )
    return F.coalesce(
        F.get(F.filter(parsed, lambda x: x.isNotNull()), 0),
        F.lit(default).cast("bigint"),
    )


def with_headers(headers: Column | None, values: dict[str, Column]) -> Column:
    """``headers`` with the named ones replaced by the given values as text; the
    others stay in place.  ``None`` or null headers count as none."""
    own = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").cast("binary").alias("value")) for k, v in values.items()])
    if headers is None:
        return own
    kept = F.filter(headers, lambda h: ~F.coalesce(h["key"].isin(list(values)), F.lit(False)))
    return F.when(headers.isNull(), own).otherwise(F.concat(kept, own))


def retry_header(next_count, name: str = RETRY_HEADER) -> Column:
    """Header list carrying ``name = next_count`` as ASCII digits."""
    return F.array(
        F.struct(
            F.lit(name).alias("key"),
            _col(next_count).cast("string").cast("binary").alias("value"),
        )
    )
