"""Language identification: sparse multinomial regression on TF-IDF character n-grams.

Features are hashed character n-grams of the letters of a text, weighted by inverse
document frequency over every training document and scaled to unit length. The
weights come from follow-the-regularised-leader (proximal, per coordinate) with L1
and L2 penalties, on a sample of at most ``SAMPLE_DOCS`` documents (or two of each
language): of each language the same number, those with the smallest hashes of id and
text, whatever other languages there are. A fifth of the sample is kept apart for the
temperature that calibrates the probabilities. Everything else covers all rows. The
classifier knows the ``LANGUAGES`` most frequent languages of the table, ties in
alphabetical order, which bounds it and its sample.

Defined results
- Texts that are null or have no letter: ``und``, score 0. So is every text if there
  is nothing to learn from.
- Rows without a language or an id are not learned from. A row without an id counts
  as held out.
- Equal probabilities: the language that is first in alphabetical order.
- Repeated rows are learned from and labelled each; rows that share an id are told apart
  by their texts.
- A text of any length is read whole by one task; an empty table gives no rows.
- Other columns of the input, whatever their names, stay in ``row`` and take no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.operators.topn import top_n

ORDERS = (1, 2, 3)
BITS = 16
WIDTH = 1 << BITS
SAMPLE_DOCS = 2000
LANGUAGES = 200
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.001
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def n_grams(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Hashed n-grams of the letters and their dampened counts; None if there is no letter."""
    letters = " ".join(_LETTERS.findall((text or "").lower()))
    if not any(map(str.isalpha, letters)):
        return None
    codes = np.frombuffer(f" {letters} ".encode("utf-32-le", "replace"), np.uint32)
    keys = []
    for order in ORDERS:
        key = np.full(max(0, len(codes) - order + 1), order, np.uint32)
        for k in range(order):
            key = (key * np.uint32(0x01000193)) ^ codes[k : len(key) + k]
        keys.append((key * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))
    counts = np.bincount(np.concatenate(keys), minlength=WIDTH)
    at = np.flatnonzero(counts)
    return at, np.log1p(counts[at])


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # WIDTH x languages, idf included
    squares: np.ndarray  # idf squared, for the length of a document's vector
    bias: np.ndarray
    temperature: float

    def parts(self) -> tuple:
        """The fields: plain values can be broadcast to workers without this package."""
        return self.languages, self.weights, self.squares, self.bias, self.temperature

    def predict(self, text: str | None) -> tuple[str, float]:
        found = n_grams(text) if self.languages else None
        if found is None:
            return UNKNOWN, 0.0
        at, tf = found
        length = np.sqrt((tf * tf) @ self.squares[at])
        shares = softmax(((tf @ self.weights[at]) / length + self.bias) / self.temperature)
        best = int(np.argmax(shares))
        return self.languages[best], float(shares[best])


def softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


Vector = tuple[np.ndarray, np.ndarray]


class _Vectors(Sequence):
    """Unit vectors with a bias, made from the sample's bytes when they are asked for."""

    def __init__(self, rows: list, idf: np.ndarray) -> None:
        self.rows, self.idf = rows, idf

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, i: int) -> Vector:
        at = np.frombuffer(self.rows[i]["grams"], np.int32).astype(np.int64)
        x = np.frombuffer(self.rows[i]["tf"], np.float32) * self.idf[at]
        return np.append(at, WIDTH), np.append(x / np.sqrt(x @ x), 1.0)


def ftrl(rows: Sequence[Vector], labels: np.ndarray, classes: int) -> np.ndarray:
    """Weights (WIDTH + 1) x classes; the last row is the bias, which has no L1 penalty."""
    z = np.zeros((WIDTH + 1, classes))
    n = np.zeros((WIDTH + 1, classes))
    order = np.random.default_rng(0)

    def weights(at: np.ndarray) -> np.ndarray:
        l1 = np.where(at == WIDTH, 0.0, L1)[:, None]
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1, 0.0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            w = weights(at)
            slope = softmax(x @ w)
            slope[labels[i]] -= 1.0
            g = x[:, None] * slope
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    return weights(np.arange(WIDTH + 1))


def best_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden section over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        shares = softmax(scores / np.exp(log_t))
        return -np.log(np.maximum(shares[np.arange(len(labels)), labels], 1e-12)).mean()

    low, high, cut = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - cut * (high - low), low + cut * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a task by hashed n-gram; the sum over tasks follows in Spark."""
    found = np.zeros(WIDTH, np.int64)
    for batch in batches:
        for text in batch.column(0):
            grams = n_grams(text.as_py())
            if grams is not None:
                found[grams[0]] += 1
    at = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], names=["gram", "docs"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams, values, langs = [], [], []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = n_grams(text.as_py())
            if found is not None:
                grams.append(found[0].astype(np.int32).tobytes())
                values.append(found[1].astype(np.float32).tobytes())
                langs.append(lang)
        columns = [pa.array(langs, pa.string()), pa.array(grams, pa.binary()), pa.array(values, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "grams", "tf"])


def train(docs: DataFrame) -> Model:
    """Model from all rows (lang, text, draw); ``draw`` puts the rows of a language in order."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    languages = sorted(row["lang"] for row in sizes.orderBy(F.col("n").desc(), "lang").limit(LANGUAGES).collect())
    if not languages:
        return Model([], np.zeros((WIDTH, 0)), np.zeros(WIDTH), np.zeros(0), 1.0)
    found = known.select("text").mapInArrow(_frequencies, "gram bigint, docs bigint")
    # At most WIDTH rows.
    by_gram = found.groupBy("gram").agg(F.sum("docs").alias("docs")).toPandas()
    frequency = np.zeros(WIDTH)
    frequency[by_gram["gram"].to_numpy(np.int64)] = by_gram["docs"]
    idf = np.log((1 + total) / (1 + frequency)) + 1

    quota = max(2, SAMPLE_DOCS // len(languages))
    learned = known.filter(F.col("lang").isin(languages))
    # First the draws alone: at most LANGUAGES rows say how far a language's sample reaches.
    drawn = top_n(learned.select("lang", "draw"), ["lang"], [F.col("draw")], quota, spread=64)
    reach = drawn.groupBy("lang").agg(F.max("draw").alias("last")).collect()
    last = F.create_map(*[F.lit(x) for row in reach for x in (row["lang"], row["last"])])
    # Texts follow for these; of equal rows at the end, as many as there is room for.
    near = learned.filter(F.col("draw") <= F.element_at(last, F.col("lang")))
    sample = top_n(near, ["lang"], [F.col("draw")], quota, spread=64)
    rows = sample.select("lang", "text").mapInArrow(_features, "lang string, grams binary, tf binary").collect()
    rows.sort(key=lambda row: (row["lang"], row["grams"], row["tf"]))
    labels = np.array([languages.index(row["lang"]) for row in rows], np.int64)
    fit = [i for i in range(len(rows)) if i % 5]
    if len(set(labels[fit])) < len(set(labels)):
        fit = list(range(len(rows)))
    weights = ftrl(_Vectors([rows[i] for i in fit], idf), labels[fit], len(languages))
    apart = sorted(set(range(len(rows))) - set(fit))
    held = _Vectors([rows[i] for i in apart], idf)
    scores = np.array([x @ weights[at] for at, x in held]).reshape(len(apart), -1)
    return Model(
        languages,
        (weights[:WIDTH] * idf[:, None]).astype(np.float32),
        (idf * idf).astype(np.float32),
        weights[WIDTH],
        best_temperature(scores, labels[apart]),
    )


def predict_column(spark, model: Model, text: Column) -> Column:
    """Struct (lang_pred, score)."""
    # WIDTH x languages numbers, whatever the input.
    shared = spark.sparkContext.broadcast(model.parts())

    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Model(*shared.value)
        for batch in texts:
            yield pd.DataFrame([own.predict(text) for text in batch], columns=["lang_pred", "score"])

    # Otherwise a filter on the result would have Spark predict twice.
    return F.pandas_udf(predict, "lang_pred string, score double").asNondeterministic()(text)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(True))


def fit_and_predict(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Every row as struct ``row``, with held_out, lang_pred and score."""
    given = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        F.col(text_col).alias("text"),
        F.col(lang_col).alias("lang"),
        held_out(F.col(id_col)).alias("held_out"),
        F.xxhash64(F.col(id_col), F.col(text_col), F.lit("sample")).alias("draw"),
    )
    model = train(given.filter(~F.col("held_out")).select("lang", "text", "draw"))
    return given.select(
        "row", "held_out", predict_column(docs.sparkSession, model, F.col("text")).alias("p")
    ).select("row", "held_out", "p.lang_pred", "p.score")
