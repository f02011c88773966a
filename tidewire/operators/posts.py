"""Forum posts: projection, allow-list, recency, newest per forum, repeats."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.scalars import timestamp_text
from tidewire.operators.topn import top_n
from tidewire.schemas import FORUMS, POST_KEYS

# Look-back and cap of one poll.
LOOK_BACK_MINUTES = 5
NEWEST_PER_FORUM = 30


def project_submissions(submissions: DataFrame, *keep: str) -> DataFrame:
    """The 14 attributes of a landed post; the forum object becomes its display name."""
    special = {
        "subreddit": F.col("subreddit.display_name"),
        "created_utc": timestamp_text(F.timestamp_seconds("created_utc")),
    }
    return submissions.select(
        *keep, *[special.get(key, F.col(key)).alias(key) for key in POST_KEYS]
    )


def recent(posts: DataFrame, as_of: dt.datetime, minutes: int = LOOK_BACK_MINUTES) -> DataFrame:
    """Posts no older than ``minutes`` at ``as_of``. Both bounds reach the scan."""
    earliest = as_of - dt.timedelta(minutes=minutes)
    return posts.filter((F.col("created_utc") >= F.lit(earliest)) & (F.col("created_utc") <= F.lit(as_of)))


def of_forums(posts: DataFrame, forums: Sequence[str] = FORUMS) -> DataFrame:
    return posts.filter(F.col("subreddit").isin(list(forums)))


def of_listed_forums(posts: DataFrame, listed: DataFrame) -> DataFrame:
    """Allow-list held in a table; Spark broadcasts it only while it is small."""
    return posts.join(listed.select("subreddit"), "subreddit", "left_semi")


def newest_per_forum(posts: DataFrame, tie_break: str, n: int = NEWEST_PER_FORUM) -> DataFrame:
    order = [F.col("created_utc").desc(), F.col(tie_break)]
    return top_n(posts, ["subreddit"], order, n, rank="newest_rank", spread=64)


def drop_repeats(posts: DataFrame, arrival: Column, ties: Sequence[Column], key: str = "id") -> DataFrame:
    """The newest copy of each post; of copies that arrived together the first by ``ties``.

    Copies are pruned inside each input partition first, so a post with very
    many copies ships at most one row per task.
    """
    return top_n(posts, [key], [arrival.desc(), *ties], 1).drop("rank")
