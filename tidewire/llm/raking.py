"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted into cells, one for each combination of the dimensions, with
their tokens. A cell's share of kept tokens is a product of one factor for each of
its values; each sweep goes through the dimensions and scales the factors of one, so
that its values meet their targets, until all margins do. Shares above 1 cannot be
sampled, so a cell counts with at most all its tokens, and what it cannot give goes to
the other cells of its margins. Documents are then sampled by
their cell's share, with a draw that depends on the id and the seed alone.

Sweeps go through cells, never documents. Up to ``ROW_CELLS`` cells are one row of
arrays, and all sweeps one expression over it; beyond that, cells and factors stay
tables, which are joined and summed, and each sweep's factors are checkpointed.
Documents are read twice, to count and to sample. Their cells' shares are sent to them
while these are few; beyond that the join on the cell is spread over ``SALTS`` parts, as one source may have a third of
all rows. Only DataFrame functions are used.

Defined results
- Null and empty values of a dimension are values like others (null is ``(none)``).
- Targets name shares by value. A value without a target, or with target 0, is not
  sampled; targets of values without tokens are left out. Shares are scaled to 1.
- Without targets a dimension's shares follow its tokens to the power ``flatness``.
- A value whose target is more than it has gives all it has; the others of its
  dimension share the rest. Sweeps go on until all margins are met or, where targets
  of several dimensions can't be met together, until the factors stand still.
- Documents without tokens weigh nothing; they have their cell's share like others.
- A null id is drawn as the text ``null``. Rows with one id are kept or left together.
- An empty table gives no rows. A text of any length is counted whole.
- Other columns, whatever their names, stay in ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import WORD, checkpointed, let

NONE = "(none)"
FLATNESS = 0.9
KEPT_SHARE = 0.6
MAX_SWEEPS = 1000
TOLERANCE = 1e-9
# A sweep that changes no factor by more than this part of it is the last; factors
# below NOTHING don't count.
STILL = 1e-12
NOTHING = 1e-15
SALTS = 16
# Up to this number, cells are swept in one row; beyond, as a table.
ROW_CELLS = 5_000
# Up to this number, cells go to the documents; beyond, documents are shuffled.
BROADCAST_CELLS = 100_000
# Factors stay within this range, where a target can't be met.
MOST = 1e6


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def form_topic(text: Column) -> Column:
    """A topic by the form of a text, where no other is known."""
    text = F.coalesce(text, F.lit(""))
    return (
        F.when(text.rlike(r"[Ll]icen[sc]ed under|[Rr]eleased under the"), "legal")
        .when(text.rlike(r"\|[\x20\x09-\x0D]+[^|]*\|"), "tabular")
        .when(text.rlike(r"[0-9]{3}"), "figures")
        .when(text.rlike(r"\n[^\n]*\n"), "prose")
        .otherwise("note")
    )


def draw(id_col: Column, seed: int) -> Column:
    """A number in [0, 1) from the id and the seed."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def _goals(
    cells: DataFrame, dim: str, budget: float, shares: dict[str, float] | None, flatness: float
) -> DataFrame:
    """(dim, goal): the tokens that each value shall give, ``budget`` in sum where there are as many.

    Goals follow the targets up to the tokens that a value has; what is asked beyond
    goes to the dimension's other values, in proportion to their targets.
    """
    values = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("there")).filter("there > 0")
    if shares is None:
        values = values.withColumn("w", F.pow("there", F.lit(flatness)))
    else:
        pairs = [(value, float(share)) for value, share in shares.items()]
        given = cells.sparkSession.createDataFrame(pairs, f"{dim} string, w double")
        values = values.join(given, dim).filter("w > 0")
    values = checkpointed(values)
    full = -1
    level = 0.0
    while True:
        # Each round fixes at least one more value at all it has, or is the last.
        over = F.col("there") <= level * F.col("w")
        now = values.agg(
            F.count(F.when(over, 1)).alias("n"),
            F.sum(F.when(over, F.col("there")).otherwise(0.0)).alias("there"),
            F.sum(F.when(over, 0.0).otherwise(F.col("w"))).alias("w"),
        ).first()
        if now["n"] == full or not now["w"]:
            return values.select(dim, F.least("there", level * F.col("w")).alias("goal"))
        full, level = now["n"], max(level, (budget - now["there"]) / now["w"])


def _swept_in_row(fitted: DataFrame, dims: list[str]) -> DataFrame:
    """``fitted`` (cells, factor and goals) after all sweeps, each over arrays in one row."""
    at = F.struct(*dims, *[name for name in fitted.columns if name not in dims])
    one = fitted.agg(F.sort_array(F.collect_list(at)).alias("cells"))
    for dim in dims:
        # The values of a dimension: each with its goal and the numbers of its cells.
        numbered = F.transform("cells", lambda c, i: F.struct(c[dim].alias("v"), i.alias("i"), c[f"{dim}_goal"].alias("goal")))
        one = one.withColumn("numbered", numbered).withColumn(
            f"{dim}_values",
            F.transform(
                F.array_distinct(F.transform("numbered", lambda c: F.struct(c["v"], c["goal"]))),
                lambda v: F.struct(
                    v["goal"].alias("goal"),
                    F.transform(F.filter("numbered", lambda c: c["v"] == v["v"]), lambda c: c["i"]).alias("at"),
                    v["v"].alias("v"),
                ),
            ),
        )
        names = F.transform(f"{dim}_values", lambda v: v["v"])
        place = F.transform("cells", lambda c: F.array_position(F.col("names"), c[dim]).cast("int") - 1)
        one = one.withColumn("names", names).withColumn(f"{dim}_place", place).drop("names", "numbered")
    one = one.withColumn("tokens", F.transform("cells", lambda c: c["tokens"].cast("double")))

    def scaled(state: Column, dim: str) -> Column:
        def scale(v: Column, masses: Column) -> Column:
            given = F.aggregate(v["at"], F.lit(0.0), lambda total, i: total + F.get(masses, i))
            return let(given, lambda g: F.when(g > 0, v["goal"] / g).otherwise(F.lit(1.0)))

        def by(scales: Column) -> Column:
            factors = F.transform(
                state["factors"],
                lambda x, i: F.least(x * F.get(scales, F.get(F.col(f"{dim}_place"), i)), F.lit(MOST)),
            )
            off = F.array_max(F.transform(scales, lambda x: F.abs(x - 1)))
            return F.struct(factors.alias("factors"), F.greatest(state["off"], off).alias("off"))

        masses = F.transform(
            state["factors"], lambda x, i: F.get(F.col("tokens"), i) * F.least(F.lit(1.0), x)
        )
        scales = let(masses, lambda m: F.transform(f"{dim}_values", lambda v: scale(v, m)))
        return let(scales, by)

    def sweep(acc: Column) -> Column:
        def end(state: Column) -> Column:
            moved = F.transform(
                state["factors"],
                lambda x, i: F.when(x < NOTHING, 0.0).otherwise(F.abs(x / F.get(acc["factors"], i) - 1)),
            )
            done = (state["off"] < TOLERANCE) | (F.array_max(moved) < STILL)
            return F.struct(state["factors"].alias("factors"), done.alias("done"))

        def from_dim(state: Column, left: list[str]) -> Column:
            return let(scaled(state, left[0]), lambda s: from_dim(s, left[1:])) if left else end(state)

        start = F.struct(acc["factors"].alias("factors"), F.lit(0.0).alias("off"))
        return let(start, lambda state: from_dim(state, dims))

    first = F.struct(F.transform("cells", lambda c: c["factor"]).alias("factors"), F.lit(False).alias("done"))
    factors = F.aggregate(
        F.sequence(F.lit(1), F.lit(MAX_SWEEPS)),
        first,
        lambda acc, _: F.when(acc["done"], acc).otherwise(sweep(acc)),
        lambda acc: acc["factors"],
    )
    # Checkpointed, so that the sweeps are not gone through again by every reader.
    done = checkpointed(one.select(F.explode(F.arrays_zip("cells", factors.alias("factor"))).alias("x")))
    return done.select("x.cells.*", F.col("x.factor").alias("new")).withColumn("factor", F.col("new")).drop("new")


def _swept_as_table(fitted: DataFrame, dims: list[str]) -> DataFrame:
    """``fitted`` (cells, factor and goals) after all sweeps, each by joins with the margins."""
    mass = F.col("tokens") * F.least(F.lit(1.0), F.col("factor"))
    for _ in range(MAX_SWEEPS):
        off = [f"{dim}_off" for dim in dims]
        fitted = fitted.withColumn("old", F.col("factor"))
        for dim in dims:
            scale = F.when(F.col("given") > 0, F.col(f"{dim}_goal") / F.col("given")).otherwise(F.lit(1.0))
            fitted = (
                fitted.join(fitted.groupBy(dim).agg(F.sum(mass).alias("given")), dim)
                .withColumn(f"{dim}_off", F.abs(scale - 1))
                .withColumn("factor", F.least(F.col("factor") * scale, F.lit(MOST)))
                .drop("given")
            )
        fitted = checkpointed(fitted)
        moved = F.when(F.col("factor") >= NOTHING, F.abs(F.col("factor") / F.col("old") - 1))
        last = fitted.filter("factor > 0").agg(
            F.max(F.greatest(*off, F.lit(0.0))).alias("off"), F.max(moved).alias("moved")
        ).first()
        fitted = fitted.drop(*off, "old")
        if (last["off"] or 0.0) < TOLERANCE or (last["moved"] or 0.0) < STILL:
            break
    return fitted


def rake(
    cells: DataFrame,
    dims: list[str],
    kept_share: float = KEPT_SHARE,
    targets: dict[str, dict[str, float]] | None = None,
    flatness: float = FLATNESS,
) -> DataFrame:
    """``cells`` (dims, docs, tokens) with ``share``, the part of each cell's tokens to keep."""
    cells = checkpointed(cells)
    total = cells.agg(F.sum("tokens").alias("t")).first()["t"] or 0
    if not total:
        return cells.withColumn("share", F.lit(float(kept_share)))
    fitted = cells.withColumn("factor", F.lit(float(kept_share)))
    for dim in dims:
        goals = _goals(cells, dim, kept_share * total, (targets or {}).get(dim), flatness)
        fitted = fitted.join(goals.withColumnRenamed("goal", f"{dim}_goal"), dim, "left")
    unwanted = F.greatest(*[F.col(f"{dim}_goal").isNull().cast("int") for dim in dims], F.lit(0)) == 1
    fitted = checkpointed(fitted.withColumn("factor", F.when(unwanted, 0.0).otherwise(F.col("factor"))))
    swept = _swept_in_row if fitted.count() <= ROW_CELLS else _swept_as_table
    return swept(fitted, dims).select(*cells.columns, F.least(F.lit(1.0), F.col("factor")).alias("share"))


def mix(
    docs: DataFrame,
    dims: dict[str, Column],
    kept_share: float = KEPT_SHARE,
    targets: dict[str, dict[str, float]] | None = None,
    flatness: float = FLATNESS,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every row as struct ``row``, with its dims, n_tokens, share and kept."""
    names = list(dims)
    values = [F.coalesce(value.cast("string"), F.lit(NONE)).alias(name) for name, value in dims.items()]
    given = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        *values,
        token_count(F.col(text_col)).alias("n_tokens"),
        draw(F.col(id_col), seed).alias("draw"),
    )
    cells = given.groupBy(*names).agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens"))
    shares = rake(cells, names, kept_share, targets, flatness).select(*names, "share")
    wanted = ["row", *names, "n_tokens", "share", (F.col("draw") < F.col("share")).alias("kept")]
    if shares.count() <= BROADCAST_CELLS:
        return given.join(F.broadcast(shares), names).select(*wanted)
    salted = given.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    spread = shares.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(spread, [*names, "salt"]).select(*wanted)
