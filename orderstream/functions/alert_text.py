"""Notification texts for DLQ records and permanent failures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# The message texts, which receivers of the alerts rely on.
DLQ_TEXT = (":red_circle: *DLQ Alert*\nOrder `%s` by user `%s` routed to dead letter queue\n"
            "Amount: $%s | Topic: `%s` | Partition: %d")
PERMANENT_TEXT = (":red_circle: *DLQ Permanent Failure*\nOrder `%s` by user `%s` failed after %d retries\n"
                  "Amount: $%.2f | Status: %s")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _raw_field(fields: Column, name: str) -> Column:
    # Present with a value -> raw text; present but JSON null -> "null";
    # absent (or value not a JSON object) -> "unknown".
    return F.when(
        F.coalesce(F.map_contains_key(fields, F.lit(name)), F.lit(False)),
        F.coalesce(fields[name], F.lit("null")),
    ).otherwise(F.lit("unknown"))


def _java_number_text(raw: Column) -> Column:
    # A decimal JSON number is printed the way the JVM prints a double
    # (12.50 -> 12.5); integers and non-numbers keep their raw text.
    decimal = raw.rlike(r"^-?[0-9]+\.[0-9]+([eE][-+]?[0-9]+)?$")
    return F.when(decimal, raw.try_cast("double").cast("string")).otherwise(raw)


def dlq_alert_text(value="value", topic="topic", partition="partition") -> Column:
    """Alert line for a record routed to the dead-letter topic."""
    fields = F.from_json(_col(value).cast("string"), "map<string,string>")
    return F.format_string(
        DLQ_TEXT,
        _raw_field(fields, "order_id"),
        _raw_field(fields, "user_id"),
        _java_number_text(_raw_field(fields, "amount")),
        _col(topic),
        _col(partition),
    )


def permanent_failure_text(order_id="order_id", user_id="user_id", retry_count="retry_count",
                           amount="amount", status="status") -> Column:
    """Alert line for an event that exhausted its retries."""
    return F.format_string(
        PERMANENT_TEXT,
        _col(order_id), _col(user_id), _col(retry_count), _col(amount), _col(status),
    )


def alert_payload(text="text") -> Column:
    """Webhook body ``{"text": ...}`` with full JSON escaping."""
    return F.to_json(F.struct(_col(text).alias("text")))
