"""Message, table and serving schemas; topic names; table definitions."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Topic names, message keys, table columns, forum names.
TICK_TOPIC = "bitcoin_data"
POST_TOPIC = "reddit_data"
FORUMS = [
    "Bitcoin",
    "btc",
    "CryptoCurrency",
    "BitcoinIndia",
    "BitcoinMining",
    "BitcoinCA",
    "CryptoMarkets",
    "CryptoCurrencies",
]
TICK_KEYS = {
    # message key: (table column, type)
    "Name": ("name", "string"),
    "Symbol": ("symbol", "string"),
    "num_market_pairs": ("num_market_pairs", "integer"),
    "max_supply": ("max_supply", "long"),
    "infinite_supply": ("infinite_supply", "boolean"),
    "last_updated": ("last_updated", "timestamp"),
    "Price (USD)": ("price_usd", "double"),
    "Market Cap (USD)": ("market_cap_usd", "double"),
    "Volume 24h (USD)": ("volume_24h_usd", "double"),
    "Percent Change 24h": ("percent_change_24h", "double"),
    "percent_change_1h": ("percent_change_1h", "double"),
}
POST_KEYS = {
    "created_utc": ("created_utc", "timestamp"),
    "subreddit": ("subreddit", "string"),
    "selftext": ("selftext", "string"),
    "title": ("title", "string"),
    "subreddit_name_prefixed": ("subreddit_name_prefixed", "string"),
    "_comments_by_id": (None, "string"),
    "upvote_ratio": ("upvote_ratio", "float"),
    "category": ("category", "string"),
    "score": ("score", "integer"),
    "created": ("created", "timestamp"),
    "num_comments": ("num_comments", "integer"),
    "url": ("url", "string"),
    "view_count": ("view_count", "integer"),
    "send_replies": ("send_replies", "boolean"),
}
SELECTED_KEYS = {
    TICK_TOPIC: ["last_updated", "Price (USD)"],
    POST_TOPIC: ["selftext", "title"],
}
SPEED_COLUMNS = {
    "timestamp": "timestamp",
    "bitcoin_price": "double",
    "posts_last_5_minutes": "integer",
    "change_from_kafka": "double",
    "avg_sentiment_bullish": "double",
    "avg_sentiment_bearish": "double",
    "avg_sentiment_neutral": "double",
}
BATCH_COLUMNS = {
    "timestamp": "timestamp",
    "open_price": "double",
    "close_price": "double",
    "posts_last_day": "long",
    "change_from_kafka": "double",
    "avg_sentiment_bullish": "double",
    "avg_sentiment_bearish": "double",
    "avg_sentiment_neutral": "double",
    "predicted_bitcoin_price": "double",
    "Max_Price": "double",
    "Min_Price": "double",
}
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"
# End of fixed values.

TOPIC_KEYS = {TICK_TOPIC: TICK_KEYS, POST_TOPIC: POST_KEYS}

# A listing payload: one entry per asset.
LISTING_SCHEMA = (
    "data array<struct<name: string, symbol: string, num_market_pairs: int, max_supply: bigint, "
    "infinite_supply: boolean, last_updated: string, "
    "quote: struct<USD: struct<price: double, market_cap: double, volume_24h: double, "
    "percent_change_24h: double, percent_change_1h: double>>>>"
)

# A landed forum post: the forum is an object, the rest are plain attributes.
SUBMISSION_SCHEMA = T.StructType(
    [
        T.StructField(
            key,
            T.StructType([T.StructField("display_name", T.StringType())])
            if key == "subreddit"
            else T.DoubleType() if key == "created_utc" else T.StringType(),
        )
        for key in POST_KEYS
    ]
)

# Raw tables keep bad messages beside the rows, in folders of their own.
GOOD, BAD = "good", "bad"
CORRUPT = "_corrupt_record"
RAW_PARTITIONS = ("status", "event_day")

# Serving tables keep every run's days; the published ones are listed.
SERVING_TABLES = ("speed_layer", "batch_layer")
PUBLISHED = "published_days"
PUBLISHED_SCHEMA = T.StructType().add("event_day", "date").add("run_id", "long")

# What a message source delivers, whatever the connector.
MESSAGE_SCHEMA = T.StructType().add("topic", "string").add("value", "binary")


def struct(columns: dict[str, str]) -> T.StructType:
    schema = T.StructType()
    for name, kind in columns.items():
        schema.add(name, kind)
    return schema


def topic_keys(topic: str) -> dict[str, tuple[str | None, str]]:
    if topic not in TOPIC_KEYS:
        raise ValueError(f"Unsupported topic: {topic}")
    return TOPIC_KEYS[topic]


def raw_schema(topic: str) -> T.StructType:
    """All-text read schema: nothing is lost on a value of the wrong type."""
    return T.StructType([T.StructField(key, T.StringType()) for key in topic_keys(topic)])


def typed_schema(topic: str) -> T.StructType:
    columns = {column: kind for column, kind in topic_keys(topic).values() if column}
    return struct({"id": "string", **columns})


def raw_table_schema(topic: str) -> T.StructType:
    """Stored columns of a raw table, partition columns last."""
    schema = T.StructType([*typed_schema(topic).fields]).add(CORRUPT, "string")
    return schema.add("status", "string").add("event_day", "date")


def table_schemas() -> dict[str, T.StructType]:
    """Schemas of the two raw tables and the two serving tables."""
    return {
        TICK_TOPIC: raw_table_schema(TICK_TOPIC),
        POST_TOPIC: raw_table_schema(POST_TOPIC),
        "speed_layer": struct({"symbol": "string", **SPEED_COLUMNS, "event_day": "date"}),
        "batch_layer": struct({"symbol": "string", **BATCH_COLUMNS, "event_day": "date"}),
    }


def refresh_tables(spark: SparkSession, names: list[str]) -> None:
    """Make the catalog see the days that jobs have written since.

    Tables over a stream's folder have no partitions in the catalog; they list what
    the stream has committed.
    """
    for name in names:
        namespace, _, table = name.rpartition(".")
        stored = [f"{name}_runs", f"{namespace}.{PUBLISHED}"] if table in SERVING_TABLES else [name]
        for part in stored:
            if any(column.isPartition for column in spark.catalog.listColumns(part)):
                spark.sql(f"MSCK REPAIR TABLE {part}")
            spark.catalog.refreshTable(part)


def create_tables(
    spark: SparkSession, namespace: str = "market", fmt: str = "parquet", location: str | None = None
) -> list[str]:
    """Create the namespace, the raw tables by event day, and the serving tables.

    A serving table is a view: of every day the rows of the newest published run, out of
    ``<table>_runs``, which has a folder for each day and run.
    """
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{at}")

    def create(table: str, folder: str, schema: T.StructType, partitions: list[str]) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        at = f" LOCATION '{location}/{folder}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {namespace}.{table} ({columns}) USING {fmt}{by}{at}")

    create(PUBLISHED, PUBLISHED, PUBLISHED_SCHEMA, [])
    names = []
    for table, schema in table_schemas().items():
        names.append(f"{namespace}.{table}")
        if table not in SERVING_TABLES:
            create(table, table, schema, [name for name in RAW_PARTITIONS if name in schema.names])
            continue
        full = T.StructType([*schema.fields]).add("run_id", "long")
        create(f"{table}_runs", table, full, ["event_day", "run_id"])
        columns = ", ".join(f"`{name}`" for name in schema.fieldNames())
        spark.sql(
            f"""CREATE OR REPLACE VIEW {namespace}.{table} AS
                SELECT {columns} FROM {namespace}.{table}_runs
                JOIN (SELECT event_day, max(run_id) AS run_id FROM {namespace}.{PUBLISHED} GROUP BY event_day)
                USING (event_day, run_id)"""
        )
    return names
