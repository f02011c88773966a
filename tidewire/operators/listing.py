"""Listing payloads: a document with one entry per asset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.scalars import columns_of
from tidewire.schemas import LISTING_SCHEMA, TICK_KEYS

# Message key and where it stands in a listing entry.
ENTRY_PATHS = {
    "Name": "name",
    "Symbol": "symbol",
    "num_market_pairs": "num_market_pairs",
    "max_supply": "max_supply",
    "infinite_supply": "infinite_supply",
    "last_updated": "last_updated",
    "Price (USD)": "quote.USD.price",
    "Market Cap (USD)": "quote.USD.market_cap",
    "Volume 24h (USD)": "quote.USD.volume_24h",
    "Percent Change 24h": "quote.USD.percent_change_24h",
    "percent_change_1h": "quote.USD.percent_change_1h",
}


def extract_asset(payloads: DataFrame, symbol: str = "BTC", *keep: str) -> DataFrame:
    """First entry of one asset per payload; a payload without it gives no row."""
    entries = F.from_json("value", LISTING_SCHEMA)["data"]
    first = F.get(F.filter(entries, lambda entry: entry["symbol"] == symbol), F.lit(0))
    found = payloads.select(*keep, first.alias("entry")).filter(F.col("entry").isNotNull())
    return found.select(*keep, *_flat())


def extract_all(payloads: DataFrame, *keep: str) -> DataFrame:
    """Every entry of every payload."""
    entries = F.from_json("value", LISTING_SCHEMA)["data"]
    return payloads.select(*keep, F.explode(entries).alias("entry")).select(*keep, *_flat())


# Figures of a quote, in whatever currency.
QUOTE_FIGURES = ("price", "market_cap", "volume_24h", "percent_change_24h", "percent_change_1h")


def readable(value: Column) -> Column:
    """Whether a payload is JSON with a list of entries."""
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(value), "$.data", "variant"))
    return F.coalesce(kind.startswith("ARRAY"), F.lit(False))


def extract_currencies(payloads: DataFrame, *keep: str) -> DataFrame:
    """One row for each entry and currency of every payload, whichever currencies it quotes.

    A payload is parsed once, as a variant: its currencies are keys of an object and no
    schema names them. An entry without a quote, or with one that is no object, gives no
    row; a figure that is no number is NULL. What isn't ``readable`` is left out here.
    """
    spark = payloads.sparkSession

    def each(value: Column) -> DataFrame:
        return spark.tvf.variant_explode(value.outer())

    entries = F.try_variant_get(F.try_parse_json(F.col("value")), "$.data", "variant")
    listed = payloads.filter(readable(F.col("value"))).select(*keep, entries.alias("_data"))
    listed = listed.lateralJoin(each(F.col("_data"))).select(*keep, F.col("value").alias("_entry"))
    quote = F.try_variant_get("_entry", "$.quote", "variant")
    quoted = listed.filter(F.schema_of_variant(quote).startswith("OBJECT")).select(*keep, "_entry", quote.alias("_quote"))
    quoted = quoted.lateralJoin(each(F.col("_quote"))).select(
        *keep, "_entry", F.col("key").alias("currency"), F.col("value").alias("_figures")
    )
    return quoted.select(
        *keep,
        *[F.try_variant_get("_entry", f"$.{name}", "string").alias(name) for name in ("name", "symbol", "last_updated")],
        "currency",
        *[F.try_variant_get("_figures", f"$.{name}", "double").alias(name) for name in QUOTE_FIGURES],
    ).withColumn("last_updated", F.col("last_updated").try_cast("timestamp"))


def unreadable(payloads: DataFrame) -> DataFrame:
    """The payloads that go to quarantine. NULL payloads carry nothing and are dropped."""
    return payloads.filter(F.col("value").isNotNull() & ~readable(F.col("value")))


def _flat() -> list[Column]:
    return [F.col(f"entry.{path}").alias(key) for key, path in ENTRY_PATHS.items()]


def table_names(extracted: DataFrame, *keep: str) -> DataFrame:
    """Message keys to table column names; ``last_updated`` becomes a timestamp."""
    renamed = extracted.select(
        *keep, *[c.alias(TICK_KEYS[k][0]) for k, c in zip(TICK_KEYS, columns_of(list(TICK_KEYS)))]
    )
    return renamed.withColumn("last_updated", F.col("last_updated").try_cast("timestamp"))
