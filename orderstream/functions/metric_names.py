"""Structured MBean names -> metric name and labels, by an ordered regex rule list."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The exporter rule list (pattern, metric name, has topic label),
# first match wins, patterns match anywhere in the MBean string.
EXPORTER_RULES = [
    ("kafka.server<type=BrokerTopicMetrics, name=MessagesInPerSec, topic=(.+)><>OneMinuteRate",
     "kafka_server_broker_topic_metrics_messages_in_per_sec", True),
    ("kafka.server<type=BrokerTopicMetrics, name=BytesInPerSec, topic=(.+)><>OneMinuteRate",
     "kafka_server_broker_topic_metrics_bytes_in_per_sec", True),
    ("kafka.server<type=BrokerTopicMetrics, name=BytesOutPerSec, topic=(.+)><>OneMinuteRate",
     "kafka_server_broker_topic_metrics_bytes_out_per_sec", True),
    ("kafka.server<type=BrokerTopicMetrics, name=MessagesInPerSec><>OneMinuteRate",
     "kafka_server_broker_topic_metrics_messages_in_per_sec", False),
    ("kafka.server<type=BrokerTopicMetrics, name=BytesInPerSec><>OneMinuteRate",
     "kafka_server_broker_topic_metrics_bytes_in_per_sec", False),
    ("kafka.server<type=BrokerTopicMetrics, name=BytesOutPerSec><>OneMinuteRate",
     "kafka_server_broker_topic_metrics_bytes_out_per_sec", False),
    ("kafka.network<type=RequestMetrics, name=TotalTimeMs, request=Produce><>50thPercentile",
     "kafka_network_request_metrics_produce_total_time_ms_p50", False),
    ("kafka.network<type=RequestMetrics, name=TotalTimeMs, request=Produce><>95thPercentile",
     "kafka_network_request_metrics_produce_total_time_ms_p95", False),
    ("kafka.network<type=RequestMetrics, name=TotalTimeMs, request=Produce><>99thPercentile",
     "kafka_network_request_metrics_produce_total_time_ms_p99", False),
    ("kafka.network<type=RequestMetrics, name=TotalTimeMs, request=Produce><>Mean",
     "kafka_network_request_metrics_produce_total_time_ms_mean", False),
    ("kafka.network<type=RequestMetrics, name=TotalTimeMs, request=FetchConsumer><>50thPercentile",
     "kafka_network_request_metrics_fetch_total_time_ms_p50", False),
    ("kafka.network<type=RequestMetrics, name=TotalTimeMs, request=FetchConsumer><>95thPercentile",
     "kafka_network_request_metrics_fetch_total_time_ms_p95", False),
    ("kafka.network<type=RequestMetrics, name=TotalTimeMs, request=FetchConsumer><>99thPercentile",
     "kafka_network_request_metrics_fetch_total_time_ms_p99", False),
    ("kafka.network<type=RequestMetrics, name=TotalTimeMs, request=FetchConsumer><>Mean",
     "kafka_network_request_metrics_fetch_total_time_ms_mean", False),
    ("kafka.server<type=ReplicaManager, name=UnderReplicatedPartitions><>Value",
     "kafka_server_replica_manager_under_replicated_partitions", False),
    ("kafka.server<type=ReplicaManager, name=PartitionCount><>Value",
     "kafka_server_replica_manager_partition_count", False),
    ("kafka.controller<type=KafkaController, name=ActiveControllerCount><>Value",
     "kafka_controller_active_controller_count", False),
    ("kafka.controller<type=KafkaController, name=OfflinePartitionsCount><>Value",
     "kafka_controller_offline_partitions_count", False),
]


# The parts of a bean string that the rules look at. The rules aren't anchored: text
# before and after is allowed. As in the rules, a topic runs up to the last match of what follows.
_BEAN = (r"(kafka.\w+)<type=(\w+), name=(\w+)(?:, request=(\w+?))?(?:, topic=(.+))?><>"
         r"(OneMinuteRate|[0-9]+thPercentile|Mean|Value)")
_SEP = "\x01"


def _parts(text: str):
    return re.search(_BEAN, text).groups("")


def _rule_key(pattern: str) -> tuple[str, ...]:
    """(domain, type, name, request, whether a topic, attribute) of a rule's pattern."""
    domain, kind, name, request, topic, attribute = _parts(pattern)
    return domain, kind, name, request, "topic" if topic else "", attribute


def _lookup(rules) -> Column:
    """Literal map from a rule's key to its metric name; the first rule of a key wins."""
    names: dict[str, str] = {}
    for pattern, name, _ in rules:
        names.setdefault(_SEP.join(_rule_key(pattern)), name.lower())
    return F.create_map(*[F.lit(x) for kv in names.items() for x in kv])


def parse_metric_names(df: DataFrame, mbean: str = "mbean", rules=EXPORTER_RULES) -> DataFrame:
    """Name + label extraction; beans no rule matches are not exported (dropped).

    A bean is taken apart by one expression; its name is then a map lookup."""
    # without a match the text stays as it is and has no separators
    parts = F.split(F.regexp_replace(F.col(mbean), r"(?s)^.*?" + _BEAN + r".*$", _SEP.join(f"${i}" for i in range(1, 7))), _SEP)
    names = _lookup(rules)

    def exported(p: Column) -> Column:
        topic = F.when(p[4] != "", F.lit("topic")).otherwise(F.lit(""))
        key = F.concat_ws(_SEP, p[0], p[1], p[2], p[3], topic, p[5])
        return F.struct(F.when(F.size(p) == 6, names[key]).alias("metric"), F.when(F.size(p) == 6, F.nullif(p[4], F.lit(""))).alias("topic"))

    # a generator of one row: the parts are taken once and not again by the filter
    return df.select("*", F.inline(F.transform(F.array(parts), exported))).where(F.col("metric").isNotNull())
