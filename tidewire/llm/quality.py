"""Quality rules: base counts, and distribution divergence from language references.

A document's histograms of character classes and of common words are compared with
references of the languages in the table by Jensen-Shannon distance: with its own
language's, and with all if it is not near that or has none. References cover every
row: class counts are summed by language, and common words, those with at least
``COMMON_SHARE`` of a language's words, are found exactly in two passes. The first
counts words by hash bucket, so its state has a fixed size for each language; only
words from buckets that hold the share can have it themselves, and the second counts
those. A language has at most 1 / COMMON_SHARE common words.

References are tables. While at most ``LITERAL_LANGUAGES`` languages have one, they go
into the expressions and everything else is row-local: texts are not shuffled. Beyond
that, documents' words are joined to the common words, with the same result. Only
DataFrame functions are used.

Guards: a document below the base rules' length is judged by these alone; a shorter
one may lie farther from its reference, as its histogram is a smaller sample; a
language with less than ``REFERENCE_WORDS`` words in the table has no reference, however
many other languages have, and its documents are judged by the base rules alone.

Defined results
- A null text has no words; it fails the base rules like an empty one.
- A null language, or a wrong one, does not matter: then the best match over all
  references counts.
- Repeated rows each have their row, and count in the references each.
- An empty table has no rows and no references.
- A text of any length is counted whole. Other columns stay in ``row``.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import GAP, WORD, checkpointed, let, skewed_join, words_of, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"
COMMON_SHARE = 0.002
REFERENCE_WORDS = 2000
BUCKETS = 4096
# Languages whose references go into the expressions, and rows of one that are broadcast.
LITERAL_LANGUAGES = 32
BROADCAST_ROWS = 500_000
# Windows found again that are searched for one by one.
FEW = 64
# Limits of the Jensen-Shannon distances (0 to 1). That of words is wider for short
# texts by a share of 1 / sqrt(words), as sampling alone takes a histogram that far.
MAX_CLASS_DISTANCE = 0.26
MAX_WORD_DISTANCE = 0.25
WORD_DISTANCE_SLACK = 1.5

CLASSES = ("lower", "space", "upper", "digit", "letter", "stop", "other")


def window_hashes(words: Column) -> Column:
    """Hashes of the 3-word windows, in order."""
    hashes = F.transform(words, lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)))
    return F.slice(hashes, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))


def found_again(hashes: Column, in_order: Column) -> Column:
    """The hashes found twice or more; null if there are none."""
    again = F.array_distinct(F.filter(in_order, lambda x, i: F.coalesce(x == F.get(in_order, i + 1), F.lit(False))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), again)


def n_repeat_words(hashes: Column, again: Column) -> Column:
    """Words that lie in a window found twice or more."""

    def covered(starts: Column) -> Column:
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))

        def add(acc: Column, p: Column) -> Column:
            return F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"))

        return F.aggregate(starts, start, add, lambda acc: acc["n"])

    def sorted_starts(order: Column) -> Column:
        def same(x: Column, j: Column) -> Column:
            return F.coalesce(x["h"] == F.get(order, j)["h"], F.lit(False))

        twice = F.filter(order, lambda x, j: same(x, j - 1) | same(x, j + 1))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    # A search for each window serves while few are found again, a sort beyond.
    few = F.filter(
        F.sequence(F.lit(0), F.size(hashes) - 1), lambda i: F.array_contains(again, F.get(hashes, i))
    )
    order = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return (
        F.when(again.isNull(), F.lit(0).cast("bigint"))
        .when(F.size(again) <= FEW, covered(few))
        .otherwise(covered(let(order, sorted_starts)))
    )


def class_counts(text: Column) -> Column:
    """Array of the numbers of characters by ``CLASSES``."""
    text = F.coalesce(text, F.lit(""))
    no_lower = F.regexp_replace(text, r"\p{Ll}+", "")

    def of_rest(parts: Column) -> Column:
        upper, digit = F.regexp_count(parts["rest"], F.lit(r"\p{Lu}")), F.regexp_count(parts["rest"], F.lit(r"\p{N}"))
        letter = F.regexp_count(parts["rest"], F.lit(r"[\p{Lo}\p{Lt}\p{Lm}\p{M}]"))
        stop = F.regexp_count(parts["rest"], F.lit(r"[.,]"))
        rest = F.char_length(parts["rest"])
        counts = [
            parts["all"] - parts["no_lower"],
            parts["no_lower"] - rest,
            upper,
            digit,
            letter,
            stop,
            rest - upper - digit - letter - stop,
        ]
        return F.array(*[count.cast("double") for count in counts])

    parts = let(
        no_lower,
        lambda x: F.struct(
            F.char_length(text).alias("all"),
            F.char_length(x).alias("no_lower"),
            F.regexp_replace(x, GAP, "").alias("rest"),
        ),
    )
    return let(parts, of_rest)


def plain_words(text: Column) -> Column:
    """Words in lower case without full stops and commas."""
    return words_of(F.replace(F.replace(F.lower(text), F.lit("."), F.lit("")), F.lit(","), F.lit("")))


def _meet(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join with a table that is broadcast while it is small; beyond, hot keys are split."""
    if right.count() <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), keys, how)
    return skewed_join(left, right, keys, how)


def references(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Class shares (lang, shares) and common words (lang, word, q), over all of (text, lang)."""
    known = docs.filter(F.col("lang").isNotNull())
    tokens = known.select("lang", F.explode(plain_words(F.col("text"))).alias("word")).withColumn(
        "bucket", F.pmod(F.xxhash64("word"), F.lit(BUCKETS))
    )
    # Used three times; BUCKETS rows a language.
    by_bucket = checkpointed(tokens.groupBy("lang", "bucket").agg(F.count("*").alias("n")))
    totals = by_bucket.groupBy("lang").agg(F.sum("n").alias("words")).filter(F.col("words") >= REFERENCE_WORDS)
    heavy = (
        by_bucket.join(totals, "lang")
        .filter(F.col("n") >= COMMON_SHARE * F.col("words"))
        .select("lang", "bucket", "words")
    )
    common = (
        _meet(tokens, heavy, ["lang", "bucket"], "inner")
        .groupBy("lang", "word", "words")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= COMMON_SHARE * F.col("words"))
        .select("lang", "word", (F.col("n") / F.col("words")).alias("q"))
    )
    counts = class_counts(F.col("text"))
    sums = known.select("lang", counts.alias("c")).groupBy("lang").agg(
        F.array(*[F.sum(F.col("c")[i]) for i in range(len(CLASSES))]).alias("sums")
    )
    total = reduce(Column.__add__, [F.col("sums")[i] for i in range(len(CLASSES))])
    shares = sums.join(totals.select("lang"), "lang").select(
        "lang", F.transform("sums", lambda n: n / total).alias("shares")
    )
    return written(shares, "class-shares"), written(common, "common-words")


def _part(p: Column, q: Column) -> Column:
    return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))


def _distance(divergence: Column) -> Column:
    return F.sqrt(F.greatest(divergence, F.lit(0.0)))


def _least(values: list[Column]) -> Column:
    return F.least(*values) if len(values) > 1 else values[0]


def _class_distance(counts: Column, share) -> Column:
    kinds = range(len(CLASSES))
    total = F.greatest(reduce(Column.__add__, [counts[i] for i in kinds]), F.lit(1.0))
    pairs = [(counts[i] / total, share[i]) for i in kinds]
    return _distance(reduce(Column.__add__, [_part(p, q) + _part(q, p) for p, q in pairs]) / 2)


def class_distance(counts: Column, shares: list[list[float]]) -> Column:
    """Least Jensen-Shannon distance of class counts from the references' shares."""
    return _least([_class_distance(counts, [F.lit(float(x)) for x in share]) for share in shares])


def word_distance(words: Column, shares: list[dict[str, float]], own: Column, limit: Column) -> Column:
    """Jensen-Shannon distance of words from a reference's common words and the rest.

    That is the reference number ``own`` if the words are within ``limit`` of it, else
    the nearest one.
    """
    vocabulary = sorted(set().union(*shares))
    if not vocabulary:
        return F.lit(None).cast("double")
    rows = [F.array(*[F.lit(float(of.get(word, 0.0))) for of in shares]) for word in vocabulary]
    lookup = F.map_from_arrays(F.array(*[F.lit(w) for w in vocabulary]), F.array(*rows))
    totals = F.array(*[F.lit(float(sum(of.values()))) for of in shares])

    def of_words(all_words: Column) -> Column:
        size = F.greatest(F.size(all_words), F.lit(1))

        def of_common(common: Column) -> Column:
            seen = F.transform(
                F.array_distinct(common),
                lambda w: F.struct(
                    ((F.size(common) - F.size(F.array_remove(common, w))) / size).alias("p"),
                    F.try_element_at(lookup, w).alias("q"),
                ),
            )
            return let(seen, of_seen)

        return let(F.filter(all_words, lambda w: w.isin(*vocabulary)), of_common)

    def of_seen(seen: Column) -> Column:
        def to(total: Column, i: Column) -> Column:
            # A word that is not common in this language counts as one of the rest.
            start = F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q"))

            def add(acc: Column, x: Column) -> Column:
                p, q = x["p"], F.get(x["q"], i)
                more = F.struct(
                    (acc["d"] + _part(p, q) + _part(q, p)).alias("d"),
                    (acc["p"] + p).alias("p"),
                    (acc["q"] + q).alias("q"),
                )
                return F.when(q > 0, more).otherwise(acc)

            def end(acc: Column) -> Column:
                p, q = 1 - acc["p"], 1 - total
                missing = total - acc["q"]
                return _distance((acc["d"] + missing + _part(p, q) + _part(q, p)) / 2)

            return F.aggregate(seen, start, add, end)

        first = F.when(own.isNotNull(), to(F.get(totals, own), own))
        nearest = F.array_min(F.transform(totals, to))
        return let(first, lambda d: F.when(d <= limit, d).otherwise(nearest))

    return let(words, of_words)


def word_distances(rows: DataFrame, common: DataFrame) -> DataFrame:
    """(rid, word_distance) of rows (rid, text, lang, limit), as ``word_distance`` has it, by joins."""
    totals = common.groupBy("lang").agg(F.sum("q").alias("total"))
    words = plain_words(F.col("text"))
    sized = rows.select("rid", "lang", "limit", words.alias("words"))
    tokens = sized.select("rid", F.greatest(F.size("words"), F.lit(1)).alias("size"), F.explode("words").alias("word"))
    lookup = common.groupBy("word").agg(F.collect_list(F.struct(F.col("lang").alias("ref"), "q")).alias("refs"))
    seen = _meet(tokens, lookup.select("word"), ["word"], "left_semi").groupBy("rid", "size", "word")
    seen = _meet(seen.agg((F.count("*") / F.col("size")).alias("p")), lookup, ["word"], "inner")
    seen = seen.select("rid", "p", F.inline("refs"))
    p, q = F.col("p"), F.col("q")
    matched = seen.groupBy("rid", "ref").agg(
        F.sum(_part(p, q) + _part(q, p)).alias("d"), F.sum("p").alias("p"), F.sum("q").alias("q")
    )

    def whole(d: Column, p: Column, q: Column, total: Column) -> Column:
        return _distance((d + (total - q) + _part(1 - p, 1 - total) + _part(1 - total, 1 - p)) / 2)

    nothing = F.lit(0.0)
    matched = _meet(matched, totals.withColumnRenamed("lang", "ref"), ["ref"], "inner")
    matched = matched.withColumn("d", whole(F.col("d"), p, q, F.col("total")))
    by_row = matched.groupBy("rid").agg(F.collect_list(F.struct("d", "ref")).alias("matched"))
    # Distances from references of which a text has no word, the least first.
    apart = totals.select(F.struct(whole(nothing, nothing, nothing, F.col("total")).alias("d"), F.col("lang").alias("ref")).alias("x"))
    apart = apart.agg(F.sort_array(F.collect_list("x"))).scalar()
    refs = F.transform("matched", lambda x: x["ref"])
    others = F.filter(F.col("apart"), lambda x: ~F.array_contains(refs, x["ref"]))
    every = F.concat("matched", F.slice("others", 1, 1))
    own = F.filter(F.concat("matched", "others"), lambda x: x["ref"] == F.col("lang"))
    found = (
        sized.select("rid", "lang", "limit")
        .join(by_row, "rid", "left")
        .withColumn("matched", F.coalesce("matched", F.array().cast("array<struct<d:double,ref:string>>")))
        .withColumn("apart", apart)
        .withColumn("others", others)
        .withColumn("own", F.get(own, F.lit(0))["d"])
        .withColumn("nearest", F.array_min(F.transform(every, lambda x: x["d"])))
    )
    d = F.when(F.col("own") <= F.col("limit"), F.col("own")).otherwise(F.col("nearest"))
    return found.select("rid", d.alias("word_distance"))


def _word_limit(n_words: Column) -> Column:
    return MAX_WORD_DISTANCE + WORD_DISTANCE_SLACK / F.sqrt(F.greatest(n_words, F.lit(1)))


def _counted(given: DataFrame) -> DataFrame:
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    # Columns that are used several times are selected first, to be computed once.
    return (
        given.select(
            "*",
            words_of(F.col("text")).alias("words"),
            class_counts(F.col("text")).alias("classes"),
            F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        )
        .withColumn("n_words", F.size("words").cast("bigint"))
        .withColumn("word_chars", F.char_length(F.array_join("words", "")).cast("bigint"))
        .withColumn("hashes", window_hashes(F.col("words")))
        .withColumn("in_order", F.sort_array("hashes"))
        .withColumn("again", found_again(F.col("hashes"), F.col("in_order")))
        .withColumn("n_repeat_words", n_repeat_words(F.col("hashes"), F.col("again")))
    )


def _by_expressions(given: DataFrame, shares: DataFrame, common: DataFrame) -> DataFrame:
    """Counts, distances and no_reference, with the references as literals."""
    # At most LITERAL_LANGUAGES rows, and 1 / COMMON_SHARE words each.
    classes = {row["lang"]: row["shares"] for row in shares.collect()}
    words: dict[str, dict[str, float]] = defaultdict(dict)
    for row in common.collect():
        words[row["lang"]][row["word"]] = row["q"]
    names, lang, nothing = sorted(words), F.col("lang"), F.lit(None).cast("double")
    own = F.lit(None).cast("int")
    for i, name in enumerate(names):
        own = F.when(lang == name, i).otherwise(own)
    return (
        _counted(given)
        .withColumn("class_distance", class_distance(F.col("classes"), [classes[n] for n in sorted(classes)]) if classes else nothing)
        .withColumn("limit", _word_limit(F.col("n_words")))
        .withColumn(
            "word_distance",
            word_distance(plain_words(F.col("text")), [words[n] for n in names], own, F.col("limit")) if words else nothing,
        )
        .withColumn("no_reference", lang.isNotNull() & ~lang.isin(*classes) if classes else F.lit(True))
    )


def _by_joins(given: DataFrame, shares: DataFrame, common: DataFrame) -> DataFrame:
    """The same for any number of languages."""
    rows = written(given.withColumn("rid", F.monotonically_increasing_id()), "quality-rows")
    counted = _counted(rows).withColumn("limit", _word_limit(F.col("n_words")))
    near = word_distances(rows.withColumn("limit", _word_limit(F.size(words_of(F.col("text"))))), common)
    has = _meet(
        rows.select("rid", "lang"), shares.select("lang", F.lit(True).alias("has")), ["lang"], "left"
    ).select("rid", (F.col("lang").isNotNull() & F.col("has").isNull()).alias("no_reference"))
    every = shares.agg(F.collect_list("shares")).scalar()
    classes = F.array_min(F.transform(F.col("every"), lambda share: _class_distance(F.col("classes"), share)))
    return (
        counted.withColumn("every", every)
        .withColumn("class_distance", classes)
        .drop("every")
        .join(near, "rid")
        .join(has, "rid")
    )


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Every row as struct ``row``, with its counts, distances, base_failed and kept."""
    given = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.col(lang_col).alias("lang"),
    )
    shares, common = references(given.select("text", "lang"))
    few = shares.count() <= LITERAL_LANGUAGES
    counted = (_by_expressions if few else _by_joins)(given, shares, common)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    near = (F.coalesce("class_distance", F.lit(0.0)) <= MAX_CLASS_DISTANCE) & (
        F.coalesce("word_distance", F.lit(0.0)) <= F.col("limit")
    )
    verdict = F.struct(
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "class_distance",
        "word_distance",
        "base_failed",
        (~F.col("base_failed") & (F.col("no_reference") | near)).alias("kept"),
    )
    # A filter on the result must not reach below this selection: every step of the
    # counts would be written out again within the condition. An expression that Spark
    # does not take for deterministic keeps it above.
    always = F.monotonically_increasing_id() >= 0
    return (
        counted.withColumn("base_failed", failed)
        .select("row", F.when(always, verdict).alias("verdict"))
        .select("row", "verdict.*")
    )
