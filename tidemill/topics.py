"""The topic registry: three topics, two hourly jobs each."""

from __future__ import annotations

from tidemill.config import GoldJob, TopicConfig
from tidemill.contracts import (
    ORDER_EVENTS_SCHEMA,
    PRODUCT_EVENTS_SCHEMA,
    USER_ACTIVITY_SCHEMA,
)

# Topic, subject, job and column names, filters and aggregates.
USER_ACTIVITY = TopicConfig(
    name="user_activity",
    kafka_topic="user-activity",
    schema_subject="user-activity-value",
    payload_schema=USER_ACTIVITY_SCHEMA,
    message_key="user_id",
    topic_partitions=3,
    gold_jobs=(
        GoldJob(
            name="funnel_metrics_hourly",
            group_by=("event_type",),
            aggs={"event_count": "count(*)"},
        ),
        GoldJob(
            name="revenue_hourly",
            filter="event_type = 'payment'",
            aggs={"total_revenue": "sum(amount)", "payment_count": "count(*)"},
        ),
    ),
)

PRODUCT_EVENTS = TopicConfig(
    name="product_events",
    kafka_topic="product-events",
    schema_subject="product-events-value",
    payload_schema=PRODUCT_EVENTS_SCHEMA,
    message_key="product_id",
    topic_partitions=2,
    gold_jobs=(
        GoldJob(
            name="product_activity_hourly",
            group_by=("category", "event_type"),
            aggs={"event_count": "count(*)"},
        ),
        GoldJob(
            name="price_changes_hourly",
            filter="event_type = 'price_changed'",
            group_by=("category",),
            aggs={"avg_price": "avg(price)", "price_change_count": "count(*)"},
        ),
    ),
)

ORDER_EVENTS = TopicConfig(
    name="order_events",
    kafka_topic="order-events",
    schema_subject="order-events-value",
    payload_schema=ORDER_EVENTS_SCHEMA,
    message_key="order_id",
    topic_partitions=2,
    gold_jobs=(
        GoldJob(
            name="order_metrics_hourly",
            group_by=("event_type",),
            aggs={"order_count": "count(*)"},
        ),
        GoldJob(
            name="order_revenue_hourly",
            filter="event_type = 'order_placed'",
            group_by=("shipping_country",),
            aggs={"total_revenue": "sum(total_amount)", "order_count": "count(*)"},
        ),
    ),
)

TOPICS: dict[str, TopicConfig] = {t.name: t for t in (USER_ACTIVITY, PRODUCT_EVENTS, ORDER_EVENTS)}


def topics_at(root: str, table_format: str = "parquet") -> dict[str, TopicConfig]:
    """The registry with every table and checkpoint under one folder."""
    return {name: topic.at(root, table_format) for name, topic in TOPICS.items()}


def topics_in_catalog(
    namespace: str, checkpoint_root: str, table_format: str = "parquet"
) -> dict[str, TopicConfig]:
    """The registry with catalog tables in ``namespace``."""
    return {
        name: topic.in_catalog(namespace, checkpoint_root, table_format)
        for name, topic in TOPICS.items()
    }
