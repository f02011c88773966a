"""Posts: filters, newest per forum, repeats, texts and scores."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.catalog.inputs import (
    POLL_AT,
    POLL_AT_SQL,
    DOCUMENT_WORDS,
    FORUM_LIST,
    FORUM_LIST_SQL,
    POST_TEXT_SQL,
    POSTS_SQL,
    SCORED_SQL,
    events,
    ntz,
    posts,
    read,
    rounded,
)
from tidewire.functions import scalars as S
from tidewire.functions import sentiment as Z
from tidewire.operators import messages as M, posts as P
from tidewire.plans import speed
from tidewire.schemas import POST_TOPIC
from tidewire.session import configure

AVERAGES = [f"avg_sentiment_{label}" for label in Z.LABELS]
EMBEDDING_LABELS = {"bullish": 0, "bearish": 1, "neutral": 2}


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speed.scored_posts(posts(spark, sf_dir), Z.lexicon_scorer(DOCUMENT_WORDS))


def recent_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.recent(posts(spark, sf_dir), POLL_AT)
    return ntz(rows.select("post_id", "created_utc", "subreddit", "title"), "created_utc")


def forum_allow(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.of_forums(posts(spark, sf_dir), FORUM_LIST)
    return rows.select("post_id", "subreddit")


def forum_allow_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forums with at least one labelled document, as an allow-list held in a table."""
    documents = read(spark, sf_dir, "documents")
    listed = (
        documents.join(read(spark, sf_dir, "labels").filter("quality = 1"), "doc_id", "left_semi")
        .select(F.col("source").alias("subreddit"))
        .distinct()
    )
    return P.of_listed_forums(posts(spark, sf_dir), listed).select("post_id", "subreddit")


def newest30_per_forum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = posts(spark, sf_dir).select("post_id", "subreddit", "created_utc", "url")
    return ntz(P.newest_per_forum(rows, "post_id"), "created_utc")


def dedup_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every post polled twice, the second time by two producers at once that saw other scores."""
    rows = posts(spark, sf_dir)
    rows = rows.select("post_id", M.natural_id(POST_TOPIC).alias("id"), "created_utc", "score", "title")
    first = rows.withColumn("polled_at", F.col("created_utc"))
    later = rows.withColumn("polled_at", F.col("created_utc") + F.expr("INTERVAL 1 MINUTE"))
    again = later.withColumn("score", F.explode(F.array(F.col("score") - 1, F.col("score") + 1)))
    kept = P.drop_repeats(first.unionByName(again), F.col("polled_at"), [F.col("score").desc()])
    return ntz(kept.select("post_id", "title", "score", "polled_at"), "polled_at")


def post_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = S.post_text(F.col("title"), F.col("selftext"))
    return posts(spark, sf_dir).select("post_id", text.alias("text"))


def sentiment_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir).select("post_id", "sentiment.*")
    return rounded(rows, 4, *Z.LABELS)


def sentiment_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = speed.scored_posts(posts(spark, sf_dir), Z.constant_scorer())
    return rows.select("post_id", "sentiment.*")


def _load_length_model():
    """Stands in for a user model: scores from the length of the text."""

    def model(texts: pd.Series) -> pd.DataFrame:
        length = texts.str.len()
        up = length / (length + 1000)
        return pd.DataFrame({"bullish": up, "bearish": 1 - up, "neutral": 0.5})

    return model


def sentiment_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = speed.scored_posts(posts(spark, sf_dir), Z.model_scorer(_load_length_model))
    return rounded(rows.select("post_id", "sentiment.*"), 6, *Z.LABELS)


def map_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir).withColumn("sentiment_scores", Z.score_map(F.col("sentiment")))
    scores = F.col("sentiment_scores")
    missing = scores["Sentiment_Score_Unknown"].alias("missing_key")
    return rounded(rows.select("post_id", *Z.map_scores(scores), missing), 4, *Z.SCORE_KEYS.values())


def sentiment_global_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = scored(spark, sf_dir).select("sentiment.*").groupBy().avg()
    return rounded(means.toDF(*AVERAGES), 6, *AVERAGES)


def avg_scores_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean scores for every window with any event; 0.5 where it has no posts."""
    windows = events(spark, sf_dir).select(S.window_start(F.col("ts")).alias("window_start")).distinct()
    by_window = speed.post_windows(scored(spark, sf_dir))
    means = windows.join(by_window, "window_start", "left").select(
        "window_start", *[F.coalesce(name, F.lit(Z.NO_POSTS_SCORE)).alias(name) for name in AVERAGES]
    )
    return ntz(rounded(means, 6, *AVERAGES), "window_start")


def avg_scores_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean over a list per forum, of the posts of one five-minute poll or 0.5 without any."""
    in_poll = F.col("created_utc").between(F.lit(POLL_AT) - F.expr("INTERVAL 5 MINUTES"), F.lit(POLL_AT))
    kept = scored(spark, sf_dir).withColumn("sentiment", F.when(in_poll, F.col("sentiment")))
    rows = kept.groupBy("subreddit").agg(*Z.mean_scores(F.col("sentiment"), Z.NO_POSTS_SCORE))
    return rounded(rows, 6, *AVERAGES)


def zero_shot_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    vectors = read(spark, sf_dir, "embeddings")
    # One row of three vectors, read as a scalar subquery: no join.
    vectors = vectors.withColumn("prototypes", Z.label_prototypes(vectors, EMBEDDING_LABELS).scalar())
    score = Z.embedding_scorer(F.col("prototypes"))(F.col("embedding"))
    return rounded(vectors.select("vec_id", score.alias("s")).select("vec_id", "s.*"), 4, *Z.LABELS)


QUERIES = {
    "recent_posts": recent_posts,
    "forum_allow": forum_allow,
    "forum_allow_table": forum_allow_table,
    "newest30_per_forum": newest30_per_forum,
    "dedup_posts": dedup_posts,
    "post_text": post_text,
    "sentiment_lexicon": sentiment_lexicon,
    "sentiment_constant": sentiment_constant,
    "sentiment_model": sentiment_model,
    "map_access": map_access,
    "sentiment_global_avg": sentiment_global_avg,
    "avg_scores_default": avg_scores_default,
    "avg_scores_empty": avg_scores_empty,
    "zero_shot_embedding": zero_shot_embedding,
}

_AVERAGES_SQL = """round(coalesce(avg(bullish), 0.5) + 1e-10, 6) AS avg_sentiment_bullish,
       round(coalesce(avg(bearish), 0.5) + 1e-10, 6) AS avg_sentiment_bearish,
       round(coalesce(avg(neutral), 0.5) + 1e-10, 6) AS avg_sentiment_neutral"""

SQL = {
    "recent_posts": f"""WITH {POSTS_SQL}
SELECT post_id, created_utc, subreddit, title FROM posts
WHERE created_utc >= {POLL_AT_SQL} - INTERVAL 5 MINUTES AND created_utc <= {POLL_AT_SQL}""",
    "forum_allow": f"""WITH {POSTS_SQL}
SELECT post_id, subreddit FROM posts WHERE subreddit IN ({FORUM_LIST_SQL})""",
    "forum_allow_table": f"""WITH {POSTS_SQL}
SELECT post_id, subreddit FROM posts
WHERE subreddit IN (SELECT d.source FROM documents d JOIN labels l USING (doc_id) WHERE l.quality = 1)""",
    "newest30_per_forum": f"""WITH {POSTS_SQL}
SELECT post_id, subreddit, created_utc, url, CAST(newest_rank AS INTEGER) AS newest_rank
FROM (SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY created_utc DESC, post_id) AS newest_rank
      FROM posts)
WHERE newest_rank <= 30""",
    "dedup_posts": f"""WITH {POSTS_SQL}
SELECT post_id, title, score + 1 AS score, created_utc + INTERVAL 1 MINUTE AS polled_at FROM posts""",
    "post_text": f"WITH {POSTS_SQL} SELECT post_id, {POST_TEXT_SQL} AS text FROM posts",
    "sentiment_lexicon": f"""WITH {POSTS_SQL},
{SCORED_SQL}
SELECT post_id, round(bullish + 1e-10, 4) AS bullish, round(bearish + 1e-10, 4) AS bearish, round(neutral + 1e-10, 4) AS neutral
FROM scored""",
    "sentiment_constant": f"""WITH {POSTS_SQL}
SELECT post_id, CAST(0.5 AS DOUBLE) AS bullish, CAST(0.5 AS DOUBLE) AS bearish, CAST(0.5 AS DOUBLE) AS neutral
FROM posts""",
    "sentiment_model": f"""WITH {POSTS_SQL}
SELECT post_id, round(n / (n + 1000) + 1e-10, 6) AS bullish, round(1 - n / (n + 1000) + 1e-10, 6) AS bearish,
       CAST(0.5 AS DOUBLE) AS neutral
FROM (SELECT post_id, CAST(length({POST_TEXT_SQL}) AS DOUBLE) AS n FROM posts)""",
    "map_access": f"""WITH {POSTS_SQL},
{SCORED_SQL}
SELECT post_id, round(bullish + 1e-10, 4) AS Sentiment_Score_Bullish, round(bearish + 1e-10, 4) AS Sentiment_Score_Bearish,
       round(neutral + 1e-10, 4) AS Sentiment_Score_Neutral, CAST(NULL AS DOUBLE) AS missing_key
FROM scored""",
    "sentiment_global_avg": f"""WITH {POSTS_SQL},
{SCORED_SQL}
SELECT {_AVERAGES_SQL} FROM scored""",
    "avg_scores_default": f"""WITH {POSTS_SQL},
{SCORED_SQL}
SELECT w.window_start, {_AVERAGES_SQL}
FROM (SELECT DISTINCT time_bucket(INTERVAL '5 minutes', ts) AS window_start FROM events) w
LEFT JOIN (SELECT *, time_bucket(INTERVAL '5 minutes', created_utc) AS window_start FROM scored) s
  USING (window_start)
GROUP BY w.window_start""",
    "avg_scores_empty": f"""WITH {POSTS_SQL},
{SCORED_SQL}
SELECT subreddit, {_AVERAGES_SQL}
FROM (SELECT DISTINCT subreddit FROM posts)
LEFT JOIN (SELECT * FROM scored WHERE created_utc BETWEEN {POLL_AT_SQL} - INTERVAL 5 MINUTES AND {POLL_AT_SQL})
  USING (subreddit)
GROUP BY subreddit""",
    "zero_shot_embedding": """WITH prototypes AS (
  SELECT label, list(x ORDER BY pos) AS p
  FROM (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS x
        FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
        GROUP BY label, pos)
  GROUP BY label),
matches AS (
  SELECT vec_id, p.label,
         (list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), p.p) + 1) / 2 AS s
  FROM embeddings e JOIN prototypes p ON p.label IN (0, 1, 2))
SELECT vec_id, round(max(s) FILTER (label = 0) + 1e-10, 4) AS bullish, round(max(s) FILTER (label = 1) + 1e-10, 4) AS bearish,
       round(max(s) FILTER (label = 2) + 1e-10, 4) AS neutral
FROM matches GROUP BY vec_id""",
}
