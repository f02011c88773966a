"""Collocations of words, mined from a prefix-free parse of the corpus.

A text is a sequence of words and ends of pieces. Four neighbouring tokens whose hash
falls on a trigger end one chunk and start the next, so chunks overlap by four tokens
and the same passage gives the same chunks wherever it stands. The dictionary holds
each distinct chunk once, with how often the parse uses it. A phrase of at most five
words lies within a chunk; the chunk in which it starts before the overlap owns it, so
every occurrence is counted once, with the chunk's frequency as its weight.

Phrases are counted length by length, as tuples of their words' hashes. A phrase can only
reach the least count if both phrases inside it that are one word shorter do, so each
pass skips the others by a bit set of the last pass's frequent phrases. The bit set has a
fixed size: a corpus with very many frequent phrases fills it and prunes less, and counts
are exact either way, as occurrences of one phrase are kept or skipped together and the
least count is tested on the sum. After the pairs, chunks are cut to their runs of
frequent pairs, which the longer phrases are counted in. Any three words of a run are a
phrase to count, so built-in functions count these, a row for each place. Hashes tell words
apart: if two words of a language had the same one, another salt would be taken.

Defined results
- A null or empty text, or one of separators alone, has no words and adds nothing.
- A null language is ``und`` and shares the counts of rows marked so.
- Repeated rows count each; an empty table gives no rows.
- A text of any length is parsed whole by the task that reads it.
- Phrases with equal scores and counts come in byte order.
- Other columns of the input, whatever their names, take no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import written
from tidewire.operators.topn import top_n

UNKNOWN = "und"
MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
# A chunk ends after about this many tokens.
PERIOD = 64
# Bits of the set of frequent phrases: 2 MB.
BITS = 1 << 24
# Different words a task keeps numbers for before it starts anew.
KEEP_WORDS = 400_000
# Tokens that a task counts phrases in at once; Spark adds these counts up.
HELD = 1_500_000
# The seed of Spark's xxhash64.
SEED = 42

_OVERLAP = MAX_WORDS - 1
_END = b"."
# Fixed: A-Z are lowered; these ten characters end a piece, tabs are blanks.
_LETTERS = bytes(range(ord("A"), ord("Z") + 1))
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes.maketrans(_LETTERS + _ENDS + b"\t", _LETTERS.lower() + _END * len(_ENDS) + b" ")
_ODD = np.uint64(0x9E3779B97F4A7C15)

CHUNKS = "lang string, chunk string, owned int, n bigint"
RUNS = "run array<bigint>, owned int, n bigint"


class _Hashes(dict):
    """Hashes of words, each computed once."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found

    def of(self, parts: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, parts), np.uint64, len(parts))


class _Words(dict):
    """Numbers for the words of a language in order of appearance, and a hash for each number.

    Ends of pieces have number 0. Hashes are those of ``word_hash``.
    """

    def __init__(self, lang: str, salt: str):
        super().__init__({_END: 0})
        self.seed = xxhash.xxh64_intdigest((lang + salt).encode("utf-8", "surrogatepass"), SEED)
        self.names = [_END]
        self._hashes = np.empty(0, np.uint64)

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.names)
        self.names.append(word)
        return number

    def numbers(self, parts: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, parts), np.int64, len(parts))

    def hashes(self) -> np.ndarray:
        new = self.names[len(self._hashes) :]
        if new:
            more = np.array([xxhash.xxh64_intdigest(word, self.seed) for word in new], np.uint64)
            self._hashes = np.concatenate([self._hashes, more])
        return self._hashes


def word_hash(lang: Column, word: Column, salt: str) -> Column:
    return F.xxhash64(F.concat(lang, F.lit(salt)), word)


def tokens(text: str) -> list[bytes]:
    """Words of a text, lower-cased, and a ``.`` at every end of a piece."""
    plain = text.encode("utf-8", "surrogatepass").translate(_TABLE)
    # No other white space of bytes is left: its other characters end a piece.
    return plain.replace(_END, b" . ").split()


def _mixed(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for every ``size`` neighbours."""
    out = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for k in range(size):
        out = (out ^ (out >> np.uint64(29)) ^ hashes[k : k + len(out)]) * _ODD
    return out ^ (out >> np.uint64(32))


def chunks(parts: list[bytes], hashes: np.ndarray, period: int = PERIOD) -> Iterator[tuple[bytes, int]]:
    """(chunk, owned): chunks overlap by four tokens, the first ``owned`` ones of each are its own."""
    triggers = np.flatnonzero(_mixed(hashes, _OVERLAP) % np.uint64(period) == 0)
    bounds = [0, *triggers[triggers > 0].tolist(), len(parts)]
    for start, end in zip(bounds, bounds[1:]):
        yield b" ".join(parts[start : end + _OVERLAP]), end - start


def _parse(period: int):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            if len(hashes) > KEEP_WORDS:
                hashes.clear()
            found: Counter[tuple] = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                parts = tokens(text.as_py() or "")
                if parts:
                    found.update((lang, *chunk) for chunk in chunks(parts, hashes.of(parts), period))
            if found:
                lang, chunk, owned = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(lang, pa.string()),
                        pa.array(chunk, pa.binary()).cast(pa.string()),
                        pa.array(owned, pa.int32()),
                        pa.array(found.values(), pa.int64()),
                    ],
                    names=["lang", "chunk", "owned", "n"],
                )

    return parse


def dictionary(docs: DataFrame, text: Column, lang: Column, period: int = PERIOD) -> DataFrame:
    """Distinct chunks of each language with their own tokens and parse frequencies."""
    given = docs.select(F.coalesce(lang, F.lit(UNKNOWN)).alias("lang"), text.alias("text"))
    parsed = given.mapInArrow(_parse(period), CHUNKS)
    return parsed.groupBy("lang", "chunk", "owned").agg(F.sum("n").alias("n"))


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes * _ODD >> np.uint64(32)) % np.uint64(BITS)


def _in_set(bits, hashes: np.ndarray, size: int) -> np.ndarray:
    """Whether ``size`` neighbours may be a frequent phrase, for each place that they begin at."""
    bucket = _bucket(_mixed(hashes, size))
    return bits.value[bucket >> np.uint64(6)] >> (bucket & np.uint64(63)) & np.uint64(1) == 1


def _read(batches: Iterator[pa.RecordBatch], salt: str) -> Iterator[tuple[np.ndarray, ...]]:
    """Chunks of one language after another as arrays over their tokens.

    That is the words' hashes, 0 at ends of pieces; whether the place is owned; the chunk's frequency.
    """
    tables: dict[str, _Words] = {}
    for batch in batches:
        if sum(map(len, tables.values())) > KEEP_WORDS:
            tables.clear()
        langs = np.array(batch.column(0).to_pylist(), object)
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        owned, weight = (batch.column(k).to_numpy() for k in (2, 3))
        for lang in dict.fromkeys(langs):
            rows = np.flatnonzero(langs == lang)
            # An end of a piece between chunks, so that no phrase crosses from one to the next.
            parts = b" . ".join([texts[i] for i in rows]).split(b" ")
            lengths = np.array([texts[i].count(b" ") + 2 for i in rows])
            starts = np.cumsum(lengths) - lengths
            chunk = np.repeat(np.arange(len(rows)), lengths)[: len(parts)]
            words = tables.setdefault(lang, _Words(lang, salt))
            numbers = words.numbers(parts)
            hashes = np.where(numbers == 0, np.uint64(0), words.hashes()[numbers])
            yield hashes, np.arange(len(parts)) - starts[chunk] < owned[rows][chunk], weight[rows][chunk]


def _grams(hashes: np.ndarray, mine: np.ndarray, weight: np.ndarray, size: int) -> pa.RecordBatch | None:
    """Weighted counts of the phrases of ``size`` words that begin at the places in ``mine``."""
    at = np.flatnonzero(mine)
    if not len(at):
        return None
    rows = hashes[at[:, None] + np.arange(size)]
    code = np.zeros(len(at), np.int64)
    # Exact: a phrase is numbered by its words' numbers, one word at a time.
    for k in range(size):
        own = np.unique(rows[:, k], return_inverse=True)[1]
        code = np.unique(code * (int(own.max()) + 1) + own, return_inverse=True)[1]
    first = np.empty(int(code.max()) + 1, np.int64)
    first[code[::-1]] = np.arange(len(code))[::-1]
    total = np.zeros(len(first), np.int64)
    np.add.at(total, code, weight[at])
    columns = [pa.array(rows[first, k].view(np.int64)) for k in range(size)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(total)], names=[*_names(size), "n"])


def _names(size: int) -> list[str]:
    return [f"h{k}" for k in range(size)]


def _may_begin(hashes: np.ndarray, bits, size: int) -> np.ndarray:
    """Places where a frequent phrase of ``size`` words may begin, as both shorter ones in it may be."""
    n = max(0, len(hashes) - size + 1)
    shorter = _in_set(bits, hashes, size - 1)
    found = shorter[:n] & shorter[1 : n + 1]
    for k in range(size):
        found &= hashes[k : k + n] != 0
    return found


def _gathered(parts: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays over about ``HELD`` tokens, with an end of a piece behind each part."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for part in parts:
        held.append(tuple(np.append(x, np.zeros(1, x.dtype)) for x in part))
        size += len(part[0])
        if size >= HELD:
            yield tuple(map(np.concatenate, zip(*held)))
            held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _counted(parts: Iterator[tuple[np.ndarray, ...]], size: int, bits) -> Iterator[pa.RecordBatch]:
    for hashes, mine, weight in _gathered(parts):
        found = _may_begin(hashes, bits, size)
        batch = _grams(hashes, found & mine[: len(found)], weight, size)
        if batch is not None:
            yield batch


def _pairs(bits, salt: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _counted(_read(batches, salt), 2, bits)

    return count


def _runs(bits, salt: str):
    """Runs of frequent pairs, of three words or more."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, mine, weight in _read(batches, salt):
            n = max(0, len(hashes) - 1)
            pair = _in_set(bits, hashes, 2) & (hashes[:n] != 0) & (hashes[1 : n + 1] != 0)
            edges = np.flatnonzero(np.diff(np.r_[False, pair, False].astype(np.int8)))
            starts, ends = edges[::2], edges[1::2] + 1
            # A run lies within a chunk, of which the first places are owned.
            owned = np.add.reduceat(np.r_[mine, False].astype(np.int64), np.stack([starts, ends], 1).ravel())[::2] if len(starts) else starts
            kept = (ends - starts >= 3) & (owned > 0)
            starts, ends, owned = starts[kept], ends[kept], owned[kept]
            offsets = np.cumsum(np.r_[0, ends - starts])
            own = np.repeat(starts - offsets[:-1], ends - starts) + np.arange(offsets[-1])
            runs = pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(hashes[own].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [runs, pa.array(owned.astype(np.int32)), pa.array(weight[starts])], names=["run", "owned", "n"]
            )

    return cut


def _triples(runs: DataFrame) -> DataFrame:
    """The three words at every owned place of the runs, with the run's frequency."""
    at = F.sequence(F.lit(0), F.least("owned", F.size("run") - 2) - 1)
    places = runs.select("run", "n", F.explode(at).alias("at"))
    return places.select(*[F.get("run", F.col("at") + k).alias(name) for k, name in enumerate(_names(3))], "n")


def _in_runs(size: int, bits):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            if not batch.num_rows:
                continue
            offsets = batch.column(0).offsets.to_numpy()
            values = batch.column(0).values.to_numpy()[offsets[0] : offsets[-1]]
            # A 0 behind each run, as at ends of pieces.
            lengths = np.diff(offsets) + 1
            run = np.repeat(np.arange(len(lengths)), lengths)
            place = np.arange(len(run)) - (np.cumsum(lengths) - lengths)[run]
            hashes = np.zeros(len(run), np.uint64)
            hashes[place < lengths[run] - 1] = values.view(np.uint64)
            owned, weight = (batch.column(k).to_numpy()[run] for k in (1, 2))
            yield hashes, place < owned, weight

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _counted(read(batches), size, bits)

    return count


def _cells(size: int):
    """Places of phrases in the bit set."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.stack([column.to_numpy().view(np.uint64) for column in batch.columns], axis=1)
            # Each phrase by itself: one row after the other, every size-th hash of them.
            bucket = _bucket(_mixed(rows.ravel(), size)[::size])
            cells, at = np.unique(bucket >> np.uint64(6), return_inverse=True)
            bits = np.zeros(len(cells), np.uint64)
            np.bitwise_or.at(bits, at, np.uint64(1) << (bucket & np.uint64(63)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells.astype(np.int64)), pa.array(bits.view(np.int64))], names=["cell", "bits"]
            )

    return place


def _bit_set(frequent: DataFrame, size: int) -> np.ndarray:
    cells = frequent.select(*_names(size)).mapInArrow(_cells(size), "cell bigint, bits bigint")
    # At most BITS / 64 rows.
    found = cells.groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(BITS // 64, np.uint64)
    out[found["cell"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def _salt(words: DataFrame) -> str:
    """A salt by which no two words of the table have one hash, nor one the mark of an end."""
    for salt in map(str, range(100)):
        hashed = words.select(word_hash(F.col("lang"), F.col("phrase"), salt).alias("h"))
        if hashed.groupBy("h").count().filter("count > 1 OR h = 0").isEmpty():
            return salt
    raise ValueError("words without hashes of their own")


def phrase_counts(
    docs: DataFrame, text: Column, lang: Column, min_count: int = MIN_COUNT, period: int = PERIOD
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f) of every phrase with ``min_count`` occurrences, and (lang, n) words."""
    spark = docs.sparkSession
    parsed = written(dictionary(docs, text, lang, period), "chunks")
    own = F.slice(F.split("chunk", " "), F.lit(1), F.col("owned"))
    words = parsed.select("lang", F.explode(own).alias("phrase"), "n").filter(F.col("phrase") != ".")
    words = written(words.groupBy("lang", "phrase").agg(F.sum("n").alias("f")), "words")
    salt = _salt(words)
    names = words.filter(F.col("f") >= min_count).select(
        "lang", "phrase", "f", word_hash(F.col("lang"), F.col("phrase"), salt).alias("h0")
    )
    found, runs = written(names, "frequent-words"), None
    names, grams = found, []
    for size in range(2, MAX_WORDS + 1):
        cells = _bit_set(found, size - 1)
        if not cells.any():
            break
        bits = spark.sparkContext.broadcast(cells)
        if size == 3:
            cut = parsed.mapInArrow(_runs(bits, salt), RUNS).groupBy("run", "owned").agg(F.sum("n").alias("n"))
            runs = written(cut, "runs")
        shape = ", ".join(f"{name} bigint" for name in [*_names(size), "n"])
        if size == 2:
            held = parsed.mapInArrow(_pairs(bits, salt), shape)
        else:
            held = _triples(runs) if size == 3 else runs.mapInArrow(_in_runs(size, bits), shape)
        counted = held.groupBy(*_names(size)).agg(F.sum("n").alias("f"))
        found = written(counted.filter(F.col("f") >= min_count), f"phrases-{size}")
        grams.append(found.select(F.array(*_names(size)).alias("hashes"), F.lit(size).alias("k"), "f"))
    frequent = names.select("lang", "phrase", F.lit(1).alias("k"), "f")
    if grams:
        every = reduce(DataFrame.unionByName, grams)
        placed = every.select("*", F.posexplode("hashes").alias("at", "h0")).join(names.select("lang", "phrase", "h0"), "h0")
        ordered = F.sort_array(F.collect_list(F.struct("at", "phrase")))
        phrases = placed.groupBy("lang", "hashes", "k", "f").agg(
            F.array_join(F.transform(ordered, lambda x: x["phrase"]), " ").alias("phrase")
        )
        frequent = frequent.unionByName(phrases.select("lang", "phrase", "k", "f"))
    return written(frequent, "frequent"), words.groupBy("lang").agg(F.sum("f").alias("n"))


def scored(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, k, a, l, r, n, score) of phrases of two words or more, by their weakest cut."""
    parts = F.split("phrase", " ")
    cuts = frequent.filter("k >= 2").select(
        "lang", "phrase", "k", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    )
    cuts = cuts.withColumns(
        {
            "first": F.array_join(F.slice(parts, 1, F.col("cut")), " "),
            "rest": F.array_join(F.slice(parts, F.col("cut") + 1, F.col("k") - F.col("cut")), " "),
        }
    )
    left = frequent.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    # Decimals of 38 digits hold the products; the quotient is at most 10 n.
    score = F.expr("(1000 * cast(a as decimal(18, 0)) * n) div (cast(l as decimal(18, 0)) * r)")
    return (
        cuts.join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .join(totals, "lang")
        .withColumn("score", score)
        .groupBy("lang", "phrase", "k", "a", "n")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
        .select("lang", "phrase", "k", "a", "low.l", "low.r", "n", "low.score")
    )


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    top: int = TOP,
    inside: int = 100,
    period: int = PERIOD,
) -> DataFrame:
    """Each language's ``top`` phrases (lang, rank, phrase, a, l, r, n, score).

    A phrase within a longer one that has ``inside`` percent of its occurrences or more is left out.
    """
    text, lang = F.col(f"`{text_col}`"), F.col(f"`{lang_col}`")
    frequent, totals = phrase_counts(docs, text, lang, min_count, period)
    candidates = scored(frequent, totals)
    parts = F.split("phrase", " ")
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("k") - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("k") - size + 1),
                lambda at: F.array_join(F.slice(parts, at, size), " "),
            ),
        )
    )
    longer = (
        frequent.filter("k >= 3")
        .select("lang", F.explode(spans).alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longest"))
    )
    kept = candidates.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longest").isNull() | (100 * F.col("longest") < inside * F.col("a"))
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    best = top_n(kept, ["lang"], order, top, spread=64)
    return best.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
