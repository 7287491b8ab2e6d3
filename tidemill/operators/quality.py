"""Rules about which nullable fields go with which event type."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rule name -> condition that a valid event fulfils.
RULES: dict[str, dict[str, str]] = {
    "user_activity": {
        "product_id null iff search": "(product_id IS NULL) = (event_type = 'search')",
        "search_query set iff search": "(search_query IS NOT NULL) = (event_type = 'search')",
        "amount set iff payment": "(amount IS NOT NULL) = (event_type = 'payment')",
    },
    "product_events": {
        "previous_price set iff price_changed": (
            "(previous_price IS NOT NULL) = (event_type = 'price_changed')"
        ),
        "previous_stock_quantity set iff stock_updated": (
            "(previous_stock_quantity IS NOT NULL) = (event_type = 'stock_updated')"
        ),
    },
    "order_events": {
        "cancellation_reason set iff order_cancelled": (
            "(cancellation_reason IS NOT NULL) = (event_type = 'order_cancelled')"
        ),
    },
}


def rule_violations(events: DataFrame, topic: str, rules: Mapping[str, str]) -> DataFrame:
    """Per rule: rows checked and rows that break it, in one pass over the events."""
    names = list(rules)
    counts = events.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        *(
            F.count_if(~F.coalesce(F.expr(rules[n]), F.lit(False))).alias(f"rule_{i}")
            for i, n in enumerate(names)
        ),
    )
    per_rule = F.array(
        *(
            F.struct(F.lit(n).alias("rule"), F.col(f"rule_{i}").alias("violations"))
            for i, n in enumerate(names)
        )
    )
    return counts.select(
        F.lit(topic).alias("topic"), "rows_checked", F.explode(per_rule).alias("r")
    ).select("topic", "r.rule", "rows_checked", "r.violations")
