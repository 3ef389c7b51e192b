"""Alert notification sink: one text message per alerting row.

Messages are sent from the executors (``foreachPartition``), never collected to
the driver.  Failures are logged and never fail the job; a blank webhook URL
disables sending.  Without a webhook the alerts are appended to a table.
"""

from __future__ import annotations

import json
import logging
import urllib.request
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def webhook_sender(url: str | None, timeout_s: float = 5.0) -> Callable[[str], None] | None:
    if not url:
        return None

    def send(text: str) -> None:
        body = json.dumps({"text": text}).encode("utf-8")
        req = urllib.request.Request(url, data=body, headers={"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(req, timeout=timeout_s) as resp:  # noqa: S310
                if resp.status != 200:
                    log.warning("webhook returned %s", resp.status)
        except Exception as e:  # noqa: BLE001
            log.warning("alert send failed: %s", e)

    return send


class AlertSink:
    """``foreachBatch`` sink for rows with a text column."""

    def __init__(self, text_col: str = "alert_text", webhook_url: str | None = None,
                 table_path: str | None = None, sender: Callable[[str], None] | None = None):
        self.text_col = text_col
        self.sender = sender or webhook_sender(webhook_url)
        self.table_path = table_path

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        if self.table_path:
            (df.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint")).write.mode("overwrite")
               .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(self.table_path))
        send, col = self.sender, self.text_col
        if send is None:
            return

        def run(rows):
            for r in rows:
                try:
                    send(r[col])
                except Exception as e:  # noqa: BLE001
                    log.warning("alert send failed: %s", e)

        df.select(col).foreachPartition(run)
