"""Hand-made messages: good, damaged, odd values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidewire.operators import listing, messages as M, posts as P
from tidewire.schemas import POST_TOPIC, TICK_TOPIC, raw_schema, typed_schema

GOOD = (
    '{"Name":"Bitcoin","Symbol":"BTC","num_market_pairs":10,"max_supply":21000000,'
    '"infinite_supply":false,"last_updated":"2024-01-17T10:00:00.000Z","Price (USD)":42000.5}'
)


def feed(spark, *values, topic=TICK_TOPIC):
    rows = [(topic, None if v is None else bytearray(v.encode())) for v in values]
    return spark.createDataFrame(rows, "topic string, value binary")


def test_good_tick(spark):
    row = M.conform(M.parse(feed(spark, GOOD), TICK_TOPIC), TICK_TOPIC).collect()[0]
    assert (row.name, row.symbol, row.num_market_pairs) == ("Bitcoin", "BTC", 10)
    assert (row.max_supply, row.infinite_supply, row.price_usd) == (21000000, False, 42000.5)
    assert row.last_updated == dt.datetime(2024, 1, 17, 10)
    assert row.market_cap_usd is None and row.percent_change_1h is None
    assert len(row.id) == 64


def test_schema_of_conformed_rows(spark):
    for topic in (TICK_TOPIC, POST_TOPIC):
        conformed = M.conform(spark.createDataFrame([], raw_schema(topic)), topic)
        assert conformed.dtypes == [
            (f.name, f.dataType.simpleString()) for f in typed_schema(topic).fields
        ]


def test_large_number_keeps_its_value(spark):
    message = '{"Symbol":"BTC","Market Cap (USD)":842000000000.12}'
    row = M.conform(M.parse(feed(spark, message), TICK_TOPIC), TICK_TOPIC).collect()[0]
    assert row.market_cap_usd == 842000000000.12


def test_bad_number_keeps_the_row(spark):
    row = M.conform(M.parse(feed(spark, '{"Symbol":"BTC","Price (USD)":"n/a"}'), TICK_TOPIC), TICK_TOPIC)
    assert [tuple(r) for r in row.select("symbol", "price_usd").collect()] == [("BTC", None)]


def test_quarantine(spark):
    flagged = M.parse_or_flag(feed(spark, GOOD, "not json", "[1]", None, '{"Symbol":'), TICK_TOPIC)
    assert rows_of(M.good(flagged).select("Symbol")) == [("BTC",)]
    assert rows_of(M.quarantined(flagged)) == [("[1]",), ("not json",), ('{"Symbol":',)]


def test_epoch_seconds(spark):
    message = '{"created_utc":"2024-01-17 00:00:00","title":"T","created":1705449600.0}'
    row = M.conform(M.parse(feed(spark, message), POST_TOPIC), POST_TOPIC).collect()[0]
    assert row.created == dt.datetime(2024, 1, 17) and row.created_utc == dt.datetime(2024, 1, 17)


def test_parse_reads_only_used_keys(spark):
    plan = M.parse(feed(spark, GOOD), TICK_TOPIC).select("Symbol")._jdf.queryExecution().optimizedPlan().toString()
    assert "Name" not in plan


def test_unknown_topic_is_an_error(spark):
    with pytest.raises(ValueError, match="Unsupported topic"):
        M.select_fields(feed(spark, GOOD), "other")
    with pytest.raises(ValueError, match="Unsupported topic"):
        M.of_topic(feed(spark, GOOD), "other")


def test_unsupported_branch_takes_null_topics(spark):
    mixed = feed(spark, GOOD).union(feed(spark, "{}", topic="x")).union(feed(spark, "{}", topic=None))
    assert M.unsupported(mixed).count() == 2
    assert M.of_topic(mixed, TICK_TOPIC).count() == 1


def test_selected_fields(spark):
    parsed = M.parse(feed(spark, GOOD), TICK_TOPIC)
    assert M.select_fields(parsed, TICK_TOPIC).columns == ["last_updated", "Price (USD)"]
    assert M.select_fields(M.parse(feed(spark), POST_TOPIC), POST_TOPIC).columns == ["selftext", "title"]


def test_roundtrip_of_a_post(spark):
    row = spark.sql(
        """SELECT timestamp '2024-01-02 03:04:05' AS created_utc, 'Bitcoin' AS subreddit,
           CAST(NULL AS STRING) AS selftext, 'a "quoted" | title' AS title, 'r/Bitcoin' AS subreddit_name_prefixed,
           CAST(0.5 AS FLOAT) AS upvote_ratio, CAST(NULL AS STRING) AS category, 3 AS score,
           timestamp '2024-01-02 03:04:05' AS created, 4 AS num_comments, 'u' AS url,
           CAST(NULL AS INT) AS view_count, true AS send_replies"""
    )
    back = M.conform(M.parse(M.post_message(row), POST_TOPIC), POST_TOPIC)
    assert back.drop("id").collect() == row.collect()


def test_ids_differ_where_joined_text_would_not(spark):
    rows = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "a"), ("a", None)], "x string, y string")
    from tidewire.functions.scalars import content_id

    assert rows.select(content_id(F.col("x"), F.col("y"))).distinct().count() == 4


def test_listing_without_the_asset(spark):
    payloads = spark.createDataFrame(
        [('{"data":[{"symbol":"X"}]}',), ('{"data":[]}',), ("{}",),
         ('{"data":[{"symbol":"X"},{"symbol":"BTC","name":"B","last_updated":"2024-01-01T00:00:00.000Z",'
          '"quote":{"USD":{"price":1.5}}},{"symbol":"BTC","name":"second"}]}',)],
        "value string",
    )
    found = listing.table_names(listing.extract_asset(payloads)).collect()
    assert [(r.name, r.price_usd, r.last_updated) for r in found] == [("B", 1.5, dt.datetime(2024, 1, 1))]
    assert listing.extract_all(payloads).count() == 4


def test_projected_submission(spark):
    line = '{"created_utc":1705449600.0,"subreddit":{"display_name":"btc","id":1},"title":"T","score":7,"extra":1}'
    from tidewire.schemas import SUBMISSION_SCHEMA

    landed = spark.createDataFrame([(line,)], "value string").select(
        F.from_json("value", SUBMISSION_SCHEMA).alias("s")
    ).select("s.*")
    row = P.project_submissions(landed).collect()[0]
    assert (row.created_utc, row.subreddit, row.title, row.score) == ("2024-01-17 00:00:00", "btc", "T", "7")
    assert len(row) == 14 and row.selftext is None


def test_listings_in_any_currency(spark):
    quote = '{"USD":{"price":1.5,"market_cap":7},"XAU":{"price":"n/a"},"EUR":null}'
    values = [
        f'{{"data":[{{"symbol":"A","name":"a","last_updated":"2024-01-17T10:00:00Z","quote":{quote}}},{{"symbol":"B"}}]}}',
        '{"data":[{"symbol":"C","last_updated":"x","quote":[1]},{"symbol":"D","quote":{"CHF":{"price":2}}},5]}',
        '{"data":[]}', '{"data":5}', '{"other":[]}', "not json", "[1]", "", '{"data":[{"symbol":"E"', None,
    ]
    payloads = spark.createDataFrame([(i, value) for i, value in enumerate(values)], "n int, value string")
    rows = listing.extract_currencies(payloads, "n").collect()
    got = sorted((r.n, r.symbol, r.currency, r.price, r.market_cap, r.last_updated is not None) for r in rows)
    assert got == [
        (0, "A", "EUR", None, None, True), (0, "A", "USD", 1.5, 7.0, True), (0, "A", "XAU", None, None, True),
        (1, "D", "CHF", 2.0, None, False),
    ]
    assert sorted(r.n for r in listing.unreadable(payloads).collect()) == [3, 4, 5, 6, 7, 8]


def test_needed_columns_only(spark):
    """The same rows and the same bad messages as with every key read."""
    values = [
        GOOD, None, "", "oops", "{}", "[]", "null", '{"Symbol":"A"', GOOD + "x", GOOD[:-9] + "}", '{"Symbol":"A","Name":01}',
        '{"Name":{"a":[1,{"b":2}]},"Symbol":"B","last_updated":"2024-01-17"}', '{"Name":"a\\q","Symbol":"C"}',
        '{"max_supply":1,"Symbol":"D","Symbol":"E","Price (USD)":"n/a"}', '{"num_market_pairs":NaN,"Symbol":7}',
    ]
    names = ["symbol", "last_updated", "price_usd"]
    sent = feed(spark, *values)
    every, some = (M.parse_or_flag(sent, TICK_TOPIC, only=only) for only in (None, names))
    assert some.columns == ["Symbol", "last_updated", "Price (USD)", M.CORRUPT]
    assert rows_of(some) == rows_of(every.select(*[f"`{name}`" for name in some.columns]))
    whole = M.conform(every, TICK_TOPIC, M.CORRUPT).select(M.CORRUPT, "id", *names)
    found = M.conform(some, TICK_TOPIC, M.CORRUPT, only=names)
    assert found.columns == whole.columns and rows_of(found) == rows_of(whole)
