"""Column-expression building blocks (all JVM-side, no Python UDFs)."""

from orderstream.functions.codec import (  # noqa: F401
    decode_order_json, encode_order_json, event_time, kafka_key, header_int, retry_header,
)
from orderstream.functions.scalar import (  # noqa: F401
    backoff_ms, band, safe_ratio, severity_default, money_sum, to_epoch_ms, from_epoch_ms,
    label_default, naive,
)
from orderstream.functions.alert_text import (  # noqa: F401
    dlq_alert_text, permanent_failure_text, alert_payload,
)
