"""Text scorers: a text column in, a struct of three scores in [0, 1] out.

A scorer is any function ``Column -> Column`` with that result type. Scores are
independent per label and always taken by label.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.scalars import cosine

LABELS = ("bullish", "bearish", "neutral")
SCORE_TYPE = "bullish double, bearish double, neutral double"
NO_POSTS_SCORE = 0.5

# Keys of the score map at the API edge.
SCORE_KEYS = {
    "bullish": "Sentiment_Score_Bullish",
    "bearish": "Sentiment_Score_Bearish",
    "neutral": "Sentiment_Score_Neutral",
}

MARKET_WORDS = {
    "bullish": (
        "accumulate adoption bounce breakout bull bullish buy climb gain gains green growth "
        "halving high hodl long moon pump rally rebound recover rise rising soar strong "
        "support surge up upside uptrend win"
    ).split(),
    "bearish": (
        "ban bear bearish bleed bubble collapse correction crash decline down downside "
        "downtrend drop dump fall falling fear fraud hack loss losses low panic plunge red "
        "resistance scam sell selloff short sink weak"
    ).split(),
    "neutral": (
        "analysis average consolidate consolidation explain flat guide hold holding how "
        "learn neutral news question range report sideways stable steady tutorial unchanged "
        "wait waiting watch what"
    ).split(),
}

Scorer = Callable[[Column], Column]


def constant_scorer(value: float = NO_POSTS_SCORE) -> Scorer:
    return lambda text: F.struct(*[F.lit(float(value)).alias(label) for label in LABELS])


def lexicon_scorer(words: Mapping[str, Sequence[str]] = MARKET_WORDS) -> Scorer:
    """Smoothed share of each label among all lexicon hits: ``(hits + 1) / (all hits + 2)``.

    Words are runs of the letters a to z in the lower-cased text. The counts are
    a narrow expression per row: no token rows, no join, no shuffle.
    """
    for word in (word for label in LABELS for word in words[label]):
        if not (word.isascii() and word.isalpha() and word == word.lower()):
            raise ValueError(f"not a run of the letters a to z: {word}")
    every = [word for label in LABELS for word in words[label]]

    def shares(hits: Column) -> Column:
        count = {
            label: F.array_size(F.filter(hits, lambda word: word.isin(list(words[label]))))
            for label in LABELS
        }
        total = (count["bullish"] + count["bearish"] + count["neutral"] + 2).cast("double")
        return F.struct(*[((count[label] + 1) / total).alias(label) for label in LABELS])

    def score(text: Column) -> Column:
        tokens = F.split(F.lower(text), "[^a-z]+")
        hits = F.filter(tokens, lambda word: word.isin(every))
        # The one-element array names the hits, so that the text is split only once.
        return F.transform(F.array(hits), shares)[0]

    return score


def model_scorer(load: Callable[[], Callable[[pd.Series], pd.DataFrame]]) -> Scorer:
    """Scores of a user model, loaded once per Python worker.

    ``load`` returns a function from a series of texts to a frame with the
    columns ``bullish``, ``bearish`` and ``neutral``.
    """

    @F.pandas_udf(SCORE_TYPE)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        for texts in batches:
            yield model(texts)[list(LABELS)]

    return score


def label_prototypes(vectors: DataFrame, labels: Mapping[str, int]) -> DataFrame:
    """One row with the mean vector of each label, as a struct of arrays.

    Vectors are summed whole, with map-side partial sums; the result holds
    ``len(labels)`` vectors whatever the input size.
    """

    def of(label: str) -> Column:
        return F.first(F.when(F.col("label") == labels[label], F.col("mean")), ignorenulls=True).alias(label)

    dense = vectors.filter(F.col("label").isin(list(labels.values()))).select(
        "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("vector")
    )
    means = dense.groupBy("label").agg(vector_to_array(Summarizer.mean(F.col("vector"))).alias("mean"))
    return means.agg(F.struct(*[of(label) for label in LABELS]).alias("prototypes"))


def embedding_scorer(prototypes: Column) -> Scorer:
    """Zero-shot by similarity: cosine to each label prototype, moved from [-1, 1] to [0, 1]."""

    def score(vector: Column) -> Column:
        return F.struct(
            *[((cosine(vector, prototypes[label]) + 1) / 2).alias(label) for label in LABELS]
        )

    return score


def score_map(scores: Column) -> Column:
    """The struct of scores as the map with the public key names."""
    pairs = [part for label in LABELS for part in (F.lit(SCORE_KEYS[label]), scores[label])]
    return F.create_map(*pairs)


def map_scores(scores: Column) -> list[Column]:
    """The three keys of a score map as columns; NULL for a missing key."""
    return [scores[SCORE_KEYS[label]].alias(SCORE_KEYS[label]) for label in LABELS]


def mean_scores(scores: Column, default: float | None = None) -> list[Column]:
    """Aggregates: mean per label, ``default`` over no rows."""
    means = [F.avg(scores[label]) for label in LABELS]
    if default is not None:
        means = [F.coalesce(mean, F.lit(default)) for mean in means]
    return [mean.alias(f"avg_sentiment_{label}") for mean, label in zip(means, LABELS)]
