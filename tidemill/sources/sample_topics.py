"""The three event topics derived from the provided tables.

events -> user_activity, lineitem -> product_events, orders -> order_events.
Each mapping is a narrow projection of the whole table: no join, no shuffle,
so a topic costs one column-pruned scan whatever the table's size. The same
mapping applies to a batch scan and to a streaming scan.

Besides the payload, every row gets the position it would have in the topic:
source_partition, source_offset and source_timestamp.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.config import TopicConfig
from tidemill.functions import epoch_millis, event_time
from tidemill.operators import encode_messages
from tidemill.sources.tables import file_options
from tidemill.topics import TOPICS

SOURCE_TABLES = {
    "user_activity": "events",
    "product_events": "lineitem",
    "order_events": "orders",
}

#: Writer schema id put in front of sample messages.
SCHEMA_IDS = {"user_activity": 1, "product_events": 2, "order_events": 3}

# Values of the sample data; nothing depends on them but the samples' SQL statements.
PRODUCTS = 211
QUERIES = 97
PRODUCT_NAMES = ["Anchor", "Bellows", "Compass", "Dinghy", "Fender", "Halyard", "Jib"]
CATEGORIES = ["rigging", "deck", "galley", "charts", "safety"]
DEVICES = ["kiosk", "laptop", "phone"]
COUNTRIES = ["NO", "PT", "CL", "KE", "NZ", "TH"]
CURRENCIES = {"NO": "NOK", "PT": "EUR", "CL": "CLP", "KE": "KES", "NZ": "NZD", "TH": "THB"}
MAX_PRODUCTS_PER_ORDER = 4
CANCELLATION_REASONS = ["changed_mind", "card_declined", "lost_in_transit"]

#: The broker's timestamp trails the event by this many milliseconds.
BROKER_DELAY_MS = 5
#: Distance in offsets and in time between a message and its redelivery.
REDELIVERY_OFFSET = 1_000_000_000_000
REDELIVERY_DELAY_MS = 60_000


def _pick(values: Sequence[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


def _lookup(mapping: Mapping[str, str], key: Column) -> Column:
    return F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))[key]


def _text(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _placed(df: DataFrame, payload: list[str], partition: Column, offset: Column) -> DataFrame:
    """Payload columns in order, then the position in the topic."""
    return df.select(
        *payload,
        partition.cast("int").alias("source_partition"),
        offset.alias("source_offset"),
        event_time(F.col("timestamp_ms") + BROKER_DELAY_MS).alias("source_timestamp"),
    )


def user_activity(events: DataFrame) -> DataFrame:
    """events -> user_activity; all seven event types occur."""
    number, user, kind = F.col("_id"), F.col("_user"), F.col("event_type")
    df = events.select(
        F.col("event_id").alias("_id"),
        F.col("user_id").alias("_user"),
        F.col("value"),
        epoch_millis(events, "ts").alias("timestamp_ms"),
        F.to_date("ts").cast("string").alias("_day"),
        F.when(
            F.col("event_type") == "view",
            F.when(F.col("event_id") % 4 == 0, "review").otherwise("product_view"),
        )
        .when(
            F.col("event_type") == "click",
            F.when(F.col("user_id") % 3 == 0, "checkout").otherwise("add_to_cart"),
        )
        .when(F.col("event_type") == "purchase", "payment")
        .when(F.col("event_type") == "signup", "login")
        .otherwise("search")
        .alias("event_type"),
    ).withColumns(
        {
            "event_id": number.cast("string"),
            "user_id": _text("user_", user),
            "session_id": F.concat_ws("_", F.lit("session"), user.cast("string"), F.col("_day")),
            "product_id": F.when(kind != "search", _text("prod_", number % PRODUCTS + 1)),
            "search_query": F.when(
                kind == "search", _text("query_", number % QUERIES + 1)
            ),
            "amount": F.when(kind == "payment", F.col("value")),
            "device_type": _pick(DEVICES, number),
            "geo_country": _pick(COUNTRIES, user),
        }
    )
    topic = TOPICS["user_activity"]
    return _placed(df, topic.payload_schema.names, user % topic.topic_partitions, number)


def product_events(lineitem: DataFrame) -> DataFrame:
    """lineitem -> product_events.

    ``orderkey-linenumber`` is not unique in the table, so event ids repeat
    with different payloads; offsets follow the ship date.
    """
    part, kind = F.col("_part"), F.col("event_type")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    stock = F.col("stock_quantity")
    df = lineitem.select(
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("event_id"),
        F.col("l_partkey").alias("_part"),
        F.col("l_suppkey").alias("_supplier"),
        F.col("l_linenumber").alias("_line"),
        F.col("l_quantity").alias("_quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("int").alias("stock_quantity"),
        epoch_millis(lineitem, "l_shipdate").alias("timestamp_ms"),
        F.when(flag == "R", "price_changed")
        .when(flag == "N", "stock_updated")
        .when(status == "F", "product_created")
        .otherwise("product_updated")
        .alias("event_type"),
    ).withColumns(
        {
            "product_id": _text("prod_", part),
            "product_name": _pick(PRODUCT_NAMES, part),
            "category": _pick(CATEGORIES, part),
            "previous_price": F.when(
                kind == "price_changed", F.col("price") + F.col("_quantity")
            ),
            "previous_stock_quantity": F.when(
                kind == "stock_updated", (stock + F.col("_line")).cast("int")
            ),
        }
    )
    topic = TOPICS["product_events"]
    days = F.expr("timestamp_ms div 86400000")
    return _placed(
        df,
        topic.payload_schema.names,
        part % topic.topic_partitions,
        days * 10_000_000 + F.col("_supplier"),
    )


def order_events(orders: DataFrame) -> DataFrame:
    """orders -> order_events; all five event types occur, one to four products each."""
    number, customer = F.col("_order"), F.col("_customer")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    df = orders.select(
        F.col("o_orderkey").alias("_order"),
        F.col("o_custkey").alias("_customer"),
        F.col("o_totalprice").alias("total_amount"),
        epoch_millis(orders, "o_orderdate").alias("timestamp_ms"),
        F.when(status == "O", "order_placed")
        .when(
            status == "P",
            F.when(priority.isin("1-URGENT", "2-HIGH"), "order_confirmed").otherwise(
                "order_shipped"
            ),
        )
        .otherwise(F.when(priority == "5-LOW", "order_cancelled").otherwise("order_delivered"))
        .alias("event_type"),
        _pick(COUNTRIES, F.col("o_custkey")).alias("shipping_country"),
    ).withColumns(
        {
            "event_id": number.cast("string"),
            "order_id": _text("ord_", number),
            "user_id": _text("user_", customer),
            "product_ids": F.transform(
                F.sequence(F.lit(0), (number % MAX_PRODUCTS_PER_ORDER).cast("int")),
                lambda i: _text("prod_", (number * 7 + i * 31) % PRODUCTS + 1),
            ),
            "currency": _lookup(CURRENCIES, F.col("shipping_country")),
            "cancellation_reason": F.when(
                F.col("event_type") == "order_cancelled", _pick(CANCELLATION_REASONS, number)
            ),
        }
    )
    topic = TOPICS["order_events"]
    return _placed(df, topic.payload_schema.names, customer % topic.topic_partitions, number)


_MAPPINGS = {
    "user_activity": user_activity,
    "product_events": product_events,
    "order_events": order_events,
}


def source_table(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """The table a topic is derived from."""
    return spark.read.parquet(f"{sf_dir}/{SOURCE_TABLES[topic]}.parquet")


def batch_events(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """Events of a topic as a batch DataFrame."""
    return _MAPPINGS[topic](source_table(spark, sf_dir, topic))


def stream_events(
    spark: SparkSession, sf_dir: str, topic: str, table_schema: StructType | None = None
) -> DataFrame:
    """Events of a topic as a stream over the same table."""
    schema = table_schema or source_table(spark, sf_dir, topic).schema
    # A streaming source wants a folder or a pattern; the pattern matches the
    # table whether it is one file or a folder of files.
    pattern = f"{sf_dir}/{SOURCE_TABLES[topic]}.parque[t]"
    return _MAPPINGS[topic](spark.readStream.schema(schema).options(**file_options()).parquet(pattern))


def as_messages(
    events: DataFrame,
    topic: str,
    columns: list[str] | None = None,
    schema_id: Column | int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Frame events as messages of their topic."""
    config: TopicConfig = TOPICS[topic]
    return encode_messages(
        events,
        columns or config.payload_schema.names,
        config.message_key,
        config.kafka_topic,
        SCHEMA_IDS[topic] if schema_id is None else schema_id,
        keep=keep,
    )


def redelivery(events: DataFrame) -> DataFrame:
    """The same events delivered again: later offsets, later broker timestamps."""
    return events.withColumns(
        {
            "source_offset": F.col("source_offset") + REDELIVERY_OFFSET,
            "source_timestamp": F.timestamp_millis(
                F.unix_millis("source_timestamp") + REDELIVERY_DELAY_MS
            ),
        }
    )


def delivered_twice(events: DataFrame) -> DataFrame:
    """Every event and its redelivery, from one scan."""
    copies = events.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1))))
    return copies.withColumns(
        {
            "source_offset": F.col("source_offset") + F.col("_copy") * F.lit(REDELIVERY_OFFSET),
            "source_timestamp": F.timestamp_millis(
                F.unix_millis("source_timestamp") + F.col("_copy") * REDELIVERY_DELAY_MS
            ),
        }
    ).drop("_copy")
