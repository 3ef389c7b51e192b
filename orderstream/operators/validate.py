"""Decode, validate and split order events (valid stream / dead-letter stream)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderstream.functions.codec import decode_order_json, decoded_columns, event_time
from orderstream.schema import (
    MALFORMED_JSON, MISSING_ORDER_ID, MISSING_USER_ID, NEGATIVE_AMOUNT, PLACED,
)


def decode_events(df: DataFrame, value: str = "value", keep: tuple[str, ...] = (),
                  on_malformed: str = "dlq") -> DataFrame:
    """JSON values -> typed events plus a ``malformed`` flag and ``event_time``.

    ``on_malformed='dlq'`` keeps unparsable records (tagged); ``'fail'``
    reproduces a fail-fast decoder by raising on the first one.
    """
    parsed = df.select(*[F.col(k) for k in keep], decode_order_json(value).alias("_e"))
    out = parsed.select(*[F.col(k) for k in keep], *decoded_columns("_e"))
    if on_malformed == "fail":
        out = out.withColumn(
            "malformed",
            F.when(F.col("malformed"), F.raise_error(F.lit("malformed order event"))).otherwise(F.lit(False)),
        )
    elif on_malformed != "dlq":
        raise ValueError("on_malformed must be 'dlq' or 'fail'")
    return out.withColumn("event_time", event_time("timestamp"))


def _blank(c: Column) -> Column:
    # null or empty; a string of spaces is *not* blank (reference semantics)
    return c.isNull() | (c == F.lit(""))


def is_poison(amount="amount", user_id="user_id", order_id="order_id") -> Column:
    """Null-safe poison predicate: negative amount (strict, so -0.0 and NaN pass),
    or a missing/empty user id or order id."""
    a = F.col(amount) if isinstance(amount, str) else amount
    u = F.col(user_id) if isinstance(user_id, str) else user_id
    o = F.col(order_id) if isinstance(order_id, str) else order_id
    return F.coalesce(a < 0, F.lit(False)) | _blank(u) | _blank(o)


def dlq_reason(malformed="malformed", amount="amount", user_id="user_id", order_id="order_id") -> Column:
    """First failing check, or null for a valid event."""
    a, u, o = F.col(amount), F.col(user_id), F.col(order_id)
    m = F.coalesce(F.col(malformed), F.lit(False)) if malformed else F.lit(False)
    return (
        F.when(m, F.lit(MALFORMED_JSON))
        .when(F.coalesce(a < 0, F.lit(False)), F.lit(NEGATIVE_AMOUNT))
        .when(_blank(u), F.lit(MISSING_USER_ID))
        .when(_blank(o), F.lit(MISSING_ORDER_ID))
    )


def tag_events(df: DataFrame, malformed: str | None = "malformed") -> DataFrame:
    """Add ``dlq_reason`` (null = valid).  One pass; the split is two filters on it."""
    if malformed and malformed not in df.columns:
        malformed = None
    return df.withColumn("dlq_reason", dlq_reason(malformed) if malformed else dlq_reason(None))


def valid_events(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("dlq_reason").isNull())


def dlq_events(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("dlq_reason").isNotNull())


def split_events(df: DataFrame, malformed: str | None = "malformed") -> tuple[DataFrame, DataFrame]:
    """(valid, dlq) from one tagged definition.  For batch reuse, persist the
    tagged frame first; in streaming run both sides inside one ``foreachBatch``."""
    tagged = tag_events(df, malformed)
    return valid_events(tagged), dlq_events(tagged)


def status_is(status: str = PLACED, col: str = "status") -> Column:
    """Null-safe, case-sensitive status predicate."""
    return F.col(col).eqNullSafe(F.lit(status))
