"""Toxicity by class-conditional Kneser-Ney models of words.

Two interpolated bigram models, of toxic and of ordinary labelled texts, share one
lowest order: the continuation counts of both classes together, that is before how many
different words a word stands. A pair is smoothed by its second word, a word by the
shared counts. A score is the logistic of the difference in log-likelihood per word,
fitted on the training rows.

Counts are of documents: however often a text repeats a word or pair, it counts once,
so that loops and copied lines weigh no more than a use. A word or pair has an estimate
of its own in a class from ``LEAST`` documents on, a fixed number at every corpus size,
if its shares in the classes really differ: by a factor ``RATIO``, and by ``CERTAIN``
standard deviations of a count dealt to the classes by chance. More rows make more
expressions certain, never fewer. All others, the rare ones among them, are left to the
shared counts, which then are alike in both classes: without this rule the many words
that some hundred documents have by chance outweigh the few that matter.

Counts are tables that grow with the labelled rows. What the models say about a text is a
sum over its words and pairs, so the models are a table of keys and values; only
expressions that differ are in it. Texts are scored by a sorted array while it has at
most ``MODEL_ROWS`` rows, and by a join beyond, with the same result. Labelled texts are
read twice and all texts once.

Defined results
- Texts that are null or have no word: the score of no difference between the models.
  With nothing to learn from, or one class only, every score is 0.5.
- A document with several labels is toxic if one of them says so. Null labels and
  rows without an id are not learned from; a row without an id counts as held out.
- Repeated documents are learned from and scored each.
- A text of any length is read whole by one task; an empty table gives no rows.
- Other columns of the input, whatever their names, take no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import skewed_join, written

LEAST = 5
DISCOUNT = 0.75
RATIO = 3.0
CERTAIN = 4.0
# Labelled ids up to this number go to the documents; beyond, documents are shuffled.
BROADCAST_ROWS = 2_000_000
# Rows of the model that are sent to every worker: 16 MB.
MODEL_ROWS = 1 << 20
# Differences per word are binned for the fit of the score.
BINS = 20_000
# Bits of the set of frequent words: 2 MB. Words outside it are one word before others.
BITS = 1 << 24
# Words or pairs that a task holds before it sums them; hashes that it remembers.
HELD = 1_000_000
KEEP_WORDS = 400_000

WORDS = "w bigint, t bigint, o bigint, ft bigint, fo bigint"
PAIRS = "v bigint, w bigint, t bigint, o bigint"
OTHER = 0  # any word before that is not frequent
_CONTEXT = 0x5DEECE66D1A2B3C5
_WORDS = re.compile(r"[^\W\d_]+")


def words_of_text(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


class _Hashes(dict):
    """Hashes of words; 0 is none of them."""

    def __missing__(self, word: str) -> int:
        found = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) or 1
        if len(self) < KEEP_WORDS:
            self[word] = found
        return found

    def of(self, text: str | None) -> np.ndarray:
        words = words_of_text(text)
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def pair_keys(v: np.ndarray, w: np.ndarray | int) -> np.ndarray:
    return ((v << np.uint64(21)) | (v >> np.uint64(43))) ^ np.uint64(w)


def _pair_key(v: Column, w: Column) -> Column:
    """``pair_keys`` in Spark."""
    turned = F.shiftleft(v, 21).bitwiseOR(F.shiftrightunsigned(v, 43))
    return turned.bitwiseXOR(w)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return hashes % np.uint64(BITS)


def _sums(keys: list[np.ndarray], weights: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """Rows of keys, one for each different one, with their weights added up."""
    rows, values = np.concatenate(keys, axis=1), np.concatenate(weights, axis=1)
    order = np.lexsort(rows)
    rows, values = rows[:, order], values[:, order]
    first = np.flatnonzero(np.r_[True, np.any(np.diff(rows.view(np.int64), axis=1) != 0, axis=0)])
    columns = [*rows[:, first].view(np.int64), *np.add.reduceat(values, first, axis=1)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)


def _counter(names: list[str], of_text):
    """Sums of what ``of_text`` finds in the hashes of each text, over ``HELD`` finds and by Spark over those."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, keys, weights, size = _Hashes(), [], [], 0
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found, values = of_text(hashes.of(text.as_py()), int(toxic))
                if found.shape[1]:
                    keys.append(found)
                    weights.append(values)
                    size += found.shape[1]
                if size >= HELD:
                    yield _sums(keys, weights, names)
                    keys, weights, size = [], [], 0
        if size:
            yield _sums(keys, weights, names)

    return count


def _words_in(hashes: np.ndarray, toxic: int) -> tuple[np.ndarray, np.ndarray]:
    """Different words, each with the number of different pairs that it begins."""
    words, place = np.unique(hashes, return_inverse=True)
    _, first = np.unique(pair_keys(hashes[:-1], hashes[1:]) if len(hashes) > 1 else hashes[:0], return_index=True)
    pairs = np.bincount(place[:-1][first], minlength=len(words)).astype(np.int64)
    ones = np.ones(len(words), np.int64)
    return words[None, :], np.stack([ones * toxic, ones * (1 - toxic), pairs * toxic, pairs * (1 - toxic)])


def _pairs_in(bits):
    def find(hashes: np.ndarray, toxic: int) -> tuple[np.ndarray, np.ndarray]:
        """Different pairs with a frequent second word; a first one that isn't frequent is ``OTHER``."""
        bucket = _bucket(hashes)
        frequent = bits.value[bucket >> np.uint64(6)] >> (bucket & np.uint64(63)) & np.uint64(1) == 1
        v, w = np.where(frequent, hashes, np.uint64(OTHER))[:-1][frequent[1:]], hashes[1:][frequent[1:]]
        _, first = np.unique(pair_keys(v, w) if len(v) else v, return_index=True)
        ones = np.ones(len(first), np.int64)
        return np.stack([v[first], w[first]]), np.stack([ones * toxic, ones * (1 - toxic)])

    return find


def _differ(t: Column, o: Column, total_t: Column, total_o: Column) -> Column:
    """Whether counts of the classes, out of totals, have shares that really differ."""
    toxic, ordinary = (t + 1) / (total_t + 1), (o + 1) / (total_o + 1)
    far = F.greatest(toxic, ordinary) >= RATIO * F.least(toxic, ordinary)
    expected = (t + o) * total_t / F.greatest(total_t + total_o, F.lit(1))
    sure = F.abs(t - expected) >= CERTAIN * F.sqrt(expected + 1)
    return (F.greatest(t, o) >= LEAST) & far & sure


def _cells(words: DataFrame) -> np.ndarray:
    """The bit set of the words' buckets, of at most BITS / 64 rows."""
    cell = F.shiftright(F.pmod(F.col("w"), F.lit(BITS).cast("bigint")), 6)
    bit = F.expr("shiftleft(1L, cast(pmod(w, 64) AS int))")
    found = words.groupBy(cell.alias("cell")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(BITS // 64, np.uint64)
    out[found["cell"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def train(docs: DataFrame) -> tuple[DataFrame, float] | None:
    """The models from all rows (toxic boolean, text); None unless there are words of both classes.

    That is a table (key, value) and the value of a word that is not in it. A text's
    difference is the sum over the keys of its words, of its words before others
    (``pair_keys`` with a constant) and of its pairs.
    """
    spark = docs.sparkSession
    sums = [F.sum(name).alias(name) for name in ("t", "o")]
    counted = docs.mapInArrow(_counter(["w", "t", "o", "ft", "fo"], _words_in), WORDS)
    by_word = counted.groupBy("w").agg(*sums, F.sum("ft").alias("ft"), F.sum("fo").alias("fo"))
    # Rows of words below the floor are summed up, not kept.
    frequent = F.greatest("t", "o") >= LEAST
    slim = by_word.groupBy(F.when(frequent, F.col("w")).alias("w")).agg(
        *sums, F.sum("ft").alias("ft"), F.sum("fo").alias("fo")
    )
    everything = written(slim, "toxic-words")
    total = everything.agg(*sums).first()
    if not total["t"] or not total["o"]:
        return None
    total_t, total_o = F.lit(float(total["t"])), F.lit(float(total["o"]))
    words = everything.filter(F.col("w").isNotNull())

    bits = spark.sparkContext.broadcast(_cells(words))
    pairs = docs.mapInArrow(_counter(["v", "w", "t", "o"], _pairs_in(bits)), PAIRS).groupBy("v", "w").agg(*sums)
    # Of every pair one row for its second word's types; frequent ones have a row of their own.
    nothing = F.lit(None).cast("bigint")
    own = F.when(frequent, F.struct(F.col("v").alias("v"), F.col("t").alias("t"), F.col("o").alias("o"), F.lit(0).alias("types")))
    typed = F.struct(nothing.alias("v"), nothing.alias("t"), nothing.alias("o"), F.lit(1).alias("types"))
    kept = pairs.select("w", F.explode(F.array_compact(F.array(typed, own))).alias("x")).select("w", "x.*")
    kept = written(kept.groupBy("w", "v").agg(*sums, F.sum("types").alias("types")), "toxic-pairs")

    types = kept.filter(F.col("v").isNull()).select("w", "types")
    all_types = F.lit(float(types.agg(F.sum("types")).first()[0] or 1))
    differs = _differ(F.col("t"), F.col("o"), total_t, total_o)
    taken = {
        "t": F.when(differs, F.greatest(F.col("t") - DISCOUNT, F.lit(0.0)) / total_t).otherwise(0.0),
        "o": F.when(differs, F.greatest(F.col("o") - DISCOUNT, F.lit(0.0)) / total_o).otherwise(0.0),
    }
    left = words.agg(F.sum(taken["t"]).alias("t"), F.sum(taken["o"]).alias("o")).first()
    # What the words of their own do not take goes to the shared lowest order.
    rest = {"t": max(1 - (left["t"] or 0.0), 1e-12), "o": max(1 - (left["o"] or 0.0), 1e-12)}
    base = float(np.log(rest["t"] / rest["o"]))
    share = F.coalesce("types", F.lit(1)) / all_types
    single = words.join(types, "w", "left").select(
        "w", *[(taken[c] + F.lit(rest[c]) * share).alias(f"p{c}") for c in "to"], differs.alias("differs")
    )
    single = single.withColumn("own", F.when(F.col("differs"), F.log(F.col("pt") / F.col("po")) - base).otherwise(0.0))

    follow = words.select(F.col("w").alias("v"), F.greatest("ft", F.lit(1)).alias("ft"), F.greatest("fo", F.lit(1)).alias("fo"))
    sure = (
        kept.filter(F.col("v").isNotNull() & (F.col("v") != OTHER))
        .join(follow, "v")
        .filter(_differ(F.col("t"), F.col("o"), F.col("ft"), F.col("fo")))
        .select("v", "w", *[(F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.col(f"f{c}")).alias(f"s{c}") for c in "to"])
    )
    sure = written(sure, "toxic-sure")
    weight = sure.groupBy("v").agg(*[F.greatest(1 - F.sum(f"s{c}"), F.lit(1e-6)).alias(f"w{c}") for c in "to"])
    context = weight.withColumn("context", F.log(F.col("wt") / F.col("wo")))
    joint = {c: F.col(f"s{c}") + F.col(f"w{c}") * F.col(f"p{c}") for c in "to"}
    extra = sure.join(context, "v").join(single, "w")
    extra = extra.select(
        _pair_key(F.col("v"), F.col("w")).alias("key"),
        (F.log(joint["t"] / joint["o"]) - F.col("context") - F.col("own") - base).alias("value"),
    )
    constant = F.lit(_CONTEXT).cast("bigint")
    parts = (
        single.filter("differs")
        .select(F.col("w").alias("key"), F.col("own").alias("value"))
        .unionByName(context.select(_pair_key(F.col("v"), constant).alias("key"), F.col("context").alias("value")))
        .unionByName(extra)
    )
    return written(parts.groupBy("key").agg(F.sum("value").alias("value")), "toxic-model"), base


def _keys(hashes: np.ndarray) -> np.ndarray:
    before = hashes[:-1]
    return np.concatenate([hashes, pair_keys(before, _CONTEXT), pair_keys(before, hashes[1:])]) if len(hashes) else hashes


def _differences(model, base: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = model.value
        hashes = _Hashes()
        for batch in batches:
            found = []
            for text in batch.column("text"):
                own = hashes.of(text.as_py())
                asked = _keys(own)
                at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
                hit = at[keys[at] == asked] if len(keys) else at[:0]
                found.append(base + values[hit].sum() / len(own) if len(own) else None)
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(found, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "d"])

    return score


def _text_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()
    for batch in batches:
        found, times, sizes = [], [], []
        for text in batch.column("text"):
            own = hashes.of(text.as_py())
            keys, counts = np.unique(_keys(own), return_counts=True)
            found.append(keys.view(np.int64))
            times.append(counts.astype(np.int64))
            sizes.append(len(own))
        offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
        lists = [
            pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int64), *x]))) for x in (found, times)
        ]
        columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(sizes, pa.int64()), *lists]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_words", "keys", "times"])


def differences(given: DataFrame, model: DataFrame, base: float, max_rows: int | None = None) -> DataFrame:
    """(doc_id, held_out, d) of rows (doc_id, held_out, text): d is toxic minus ordinary log-likelihood per word."""
    spark = given.sparkSession
    if model.count() <= (MODEL_ROWS if max_rows is None else max_rows):
        table = model.toArrow()
        keys = table["key"].to_numpy().view(np.uint64)
        order = np.argsort(keys)
        shared = spark.sparkContext.broadcast((keys[order], table["value"].to_numpy()[order]))
        return given.mapInArrow(_differences(shared, base), "doc_id bigint, held_out boolean, d double")
    shape = "doc_id bigint, held_out boolean, n_words bigint, keys array<bigint>, times array<bigint>"
    texts = written(given.mapInArrow(_text_keys, shape), "toxic-texts").withColumn("row", F.monotonically_increasing_id())
    asked = texts.select("row", F.explode(F.arrays_zip("keys", "times")).alias("x")).select("row", "x.*")
    asked = skewed_join(asked.withColumnRenamed("keys", "key"), model, ["key"], "inner")
    totals = asked.groupBy("row").agg(F.sum(F.col("times") * F.col("value")).alias("total"))
    d = F.when(F.col("n_words") > 0, base + F.coalesce("total", F.lit(0.0)) / F.col("n_words"))
    return texts.join(totals, "row", "left").select("doc_id", "held_out", d.alias("d"))


def _fit(rows: list) -> tuple[float, float]:
    """Slope and offset of the logistic, from rows (toxic, bin, n), by Newton steps."""
    place = np.array([(row["bin"] + 0.5) / BINS * 2 - 1 for row in rows])
    x = place / (1 - np.abs(place))
    y = np.array([float(row["toxic"]) for row in rows])
    n = np.array([float(row["n"]) for row in rows])
    mean = (n @ y) / n.sum() if len(n) else 0.0
    if mean in (0.0, 1.0):
        return 0.0, 0.0
    scale = max(np.sqrt(n @ (x - (n @ x) / n.sum()) ** 2 / n.sum()), 1e-9)
    design = np.stack([x / scale, np.ones_like(x)], axis=1)
    beta = np.array([0.0, np.log(mean / (1 - mean))])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (n * (y - p)) - 1e-3 * beta
        curve = (design * (n * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta = beta + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(True))


def _marks(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the labelled ids that may be learned from; broadcast while few."""
    marks = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).alias("toxic"))
    )
    return F.broadcast(marks) if marks.count() <= BROADCAST_ROWS else marks


def score_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of ``docs``.

    ``labels`` has doc_id and toxic (0 or 1); those of held-out ids are not read.
    """
    doc_id, text = F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`")
    given = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), text.alias("text"))
    marks = _marks(labels.select("doc_id", "toxic"))
    trained = train(given.join(marks, "doc_id").select("toxic", "text"))
    if trained is None:
        scored = given.select("doc_id", "held_out", F.lit(0.5).alias("score"))
        return scored.withColumn("predicted", F.lit(1))
    found = written(differences(given, *trained), "toxic-differences")
    place = F.col("d") / (1 + F.abs("d"))
    bins = (
        found.filter(F.col("d").isNotNull())
        .join(marks, "doc_id")
        .groupBy("toxic", F.least(F.floor((place + 1) / 2 * BINS), F.lit(BINS - 1)).alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    # At most 2 * BINS rows.
    slope, offset = _fit(bins.collect())
    score = 1 / (1 + F.exp(-(F.lit(offset) + F.lit(slope) * F.coalesce("d", F.lit(0.0)))))
    return found.select("doc_id", "held_out", score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
