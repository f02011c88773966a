"""URL filters: a temporal list join.

A list is a log of dated entries: at some time a rule is added to a category or
removed from it. Entries become validity intervals, from each addition to the next
entry of the same rule and category. Every capture is evaluated against the rules
active when it was fetched: its host, the domains above it and the leading parts of
its path, as many as the list's longest rule has, are looked up by equality, and the
interval must hold the fetch time. An allow rule outweighs block rules that are less
specific.

Captures with one URL and time are looked up once. A host, or a capture, with a large
part of all rows is split into parts, and its few list entries are repeated for each.

Defined results
- A null, empty or unreadable URL has no keys, and a null time meets no interval:
  nothing is active, the capture is not blocked.
- Intervals are closed at the start and open at the end. Of entries at one time for
  one rule and category the removal wins. A removal without an addition does nothing.
- Entries without rule, action or date are passed over; equal entries count once.
- Repeated captures have a row each; an empty table of captures gives no rows, and with an
  empty list nothing is active.
- A URL of any length has all its keys, up to the parts of the list's longest rule.
- Other columns of the captures, whatever their names, stay in ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import skewed_join

# Path parts of the keys of a URL where no other depth is asked for; look-ups take the
# depth from the list.
PATH_DEPTH = 3
ALLOW = "allow"


def host_of(url: Column) -> Column:
    """Host in lower case without user, port, www. and closing dot; empty if there is none."""
    host = F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.regexp_replace(F.lower(host), r"^www\.|\.+$", "")


def path_of(url: Column) -> Column:
    """Path parts, joined by single slashes, without query and fragment."""
    path = F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.array_join(F.array_remove(F.split(path, "/"), ""), "/")


def keys_of(url: Column, depth: int = PATH_DEPTH) -> Column:
    """Rules that may hold for a URL: domains as ``example.org``, prefixes as ``host/a/b``.

    Prefixes have up to ``depth`` path parts.
    """
    host, parts = host_of(url), F.split(path_of(url), "/")
    labels = F.split(host, r"\.")
    # From the whole host up to the domain of two labels.
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(depth, 1)))),
        lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")),
    )
    keys = F.when(path_of(url) == "", domains).otherwise(F.concat(domains, prefixes))
    return F.when(F.coalesce(host, F.lit("")) != "", F.array_distinct(keys)).otherwise(
        F.array().cast("array<string>")
    )


def intervals(entries: DataFrame) -> DataFrame:
    """(rule, category, valid_from, valid_to) from entries (rule, category, action, dated).

    Actions are ``add`` and ``remove``; ``valid_to`` is null while a rule stays active.
    """
    usable = entries.select("rule", "category", "action", "dated").filter(
        F.col("rule").isNotNull() & F.col("dated").isNotNull() & F.col("action").isin("add", "remove")
    )
    # One state for each moment; "remove" is the greater text.
    states = usable.groupBy("rule", "category", "dated").agg(F.max("action").alias("action"))
    log = Window.partitionBy("rule", "category").orderBy("dated")
    changes = states.withColumn("before", F.lag("action").over(log)).filter(
        ~F.col("action").eqNullSafe(F.col("before"))
    )
    return (
        changes.withColumn("valid_to", F.lead("dated").over(log))
        .filter(F.col("action") == "add")
        .select("rule", "category", F.col("dated").alias("valid_from"), "valid_to")
    )


def evaluate(captures: DataFrame, entries: DataFrame, url_col: str, time_col: str) -> DataFrame:
    """Every capture as struct ``row``, with n_active, categories and blocked."""
    given = captures.select(
        F.struct(*[F.col(f"`{name}`") for name in captures.columns]).alias("row"),
        F.col(url_col).alias("url"),
        F.col(time_col).alias("at"),
    )
    asked = given.select("url", "at").distinct()
    longest = entries.agg(F.max(F.size(F.split("rule", "/")) - 1).alias("n")).first()["n"] or 0
    looked_up = asked.select("url", "at", F.explode(keys_of(F.col("url"), longest)).alias("rule"))
    active = skewed_join(looked_up, intervals(entries), ["rule"], "inner").filter(
        (F.col("at") >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col("at") < F.col("valid_to")))
    )
    allows = F.col("category") == ALLOW
    depth = F.length("rule")
    verdicts = (
        active.groupBy("url", "at")
        .agg(
            F.count("*").alias("n_active"),
            F.array_join(F.sort_array(F.collect_set("category")), ",").alias("categories"),
            F.max(F.when(allows, depth)).alias("allow"),
            F.max(F.when(~allows, depth)).alias("block"),
        )
        .select(
            "url",
            "at",
            "n_active",
            "categories",
            (F.col("block").isNotNull() & (F.col("block") > F.coalesce("allow", F.lit(-1)))).alias("blocked"),
        )
    )
    return skewed_join(given, verdicts, ["url", "at"], "left").select(
        "row",
        F.coalesce("n_active", F.lit(0).cast("bigint")).alias("n_active"),
        F.coalesce("categories", F.lit("")).alias("categories"),
        F.coalesce("blocked", F.lit(False)).alias("blocked"),
    )
