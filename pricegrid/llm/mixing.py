"""Mixing sources to target weights: budgets down a tree, prefixes of seeded epochs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricegrid.llm.common import staged

#: Hash ranges of a leaf; only the range in which its budget ends is sorted.
RANGES = 4096
LEVELS = ("domain", "lang", "source")


def tokens_of(text: Column) -> Column:
    """Words of a text: runs without blanks, tabs and line ends."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _filled(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Share each parent's ``budget`` among its children, none beyond its ``room``.

    Children in order of room per weight: as long as a child's share of what is left
    exceeds its room, it gets its room and the rest goes to its siblings. The share is
    taken from whole numbers in one division, so every engine gets the same result.
    """
    w = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    ratio = (F.col("room") / F.col("weight")).alias("ratio")
    before = w.orderBy(ratio, "weight", "node").rowsBetween(Window.unboundedPreceding, -1)
    ranked = nodes.select(
        "*",
        F.struct(ratio, "weight", "node").alias("rank"),
        F.coalesce(F.sum("room").over(before), F.lit(0)).alias("room_before"),
        (F.sum("weight").over(w) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weight_left"),
    ).withColumn("left", F.greatest(F.col("budget") - F.col("room_before"), F.lit(0)))
    share = F.col("left").cast("double") * F.col("weight").cast("double") / F.col("weight_left").cast("double")
    # once one child is not full, none after it is: what is left then is shared by weight
    rest = F.min(F.when(share < F.col("room").cast("double"), F.struct("rank", "left", "weight_left"))).over(w)
    shared = ranked.withColumn("rest", rest)
    part = F.floor(
        F.col("rest.left").cast("double") * F.col("weight").cast("double") / F.col("rest.weight_left").cast("double")
    )
    after = F.col("rest").isNotNull() & (F.col("rank") >= F.col("rest.rank"))
    return shared.select(
        *nodes.columns, F.when(after, F.least(part.cast("long"), F.col("room"))).otherwise(F.col("room")).alias("given")
    )


def _weight(level: str, weights: Mapping[str, int], default: int) -> Column:
    value = F.coalesce(F.col(level), F.lit(""))
    out = F.lit(default)
    for name, weight in sorted(weights.items()):
        out = F.when(value == name, F.lit(int(weight))).otherwise(out)
    return out.cast("long")


def leaf_budgets(leaves: DataFrame, budget: int | Column, weights: Mapping[str, Mapping[str, int]],
                 levels=LEVELS, epochs: int = 2, default: int = 1) -> DataFrame:
    """Tokens for each leaf of the tree, from ``(levels..., tokens)`` rows.

    The root's budget goes down by the weights of the children (whole numbers; a name
    without one has ``default``, a weight of 0 takes a node out). No node gets more
    than its room, ``epochs`` times its tokens: what it can't take goes to its siblings
    first, and only what all of them together can't take goes to the ancestors'
    siblings, since an inner node's room is the sum of its leaves'. Rounding leaves at
    most one token per child unused.
    """
    levels = list(levels)
    now = leaves.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in levels],
                        F.col("tokens").cast("long").alias("tokens"))
    now = now.groupBy(*levels).agg(F.sum("tokens").alias("tokens"))
    for c in levels:
        now = now.withColumn(f"weight_{c}", _weight(c, weights.get(c, {}), default))
    usable = F.lit(True)
    for c in levels:
        usable = usable & (F.col(f"weight_{c}") > 0)
    now = now.withColumn("room", F.when(usable, F.col("tokens") * epochs).otherwise(F.lit(0)))
    total = F.lit(int(budget)) if isinstance(budget, int) else budget
    given = None
    for depth, level in enumerate(levels):
        above = levels[:depth]
        nodes = (
            now.where(F.col("room") > 0)
            .groupBy(*above, F.col(level).alias("node"))
            .agg(F.sum("room").alias("room"), F.first(f"weight_{level}").alias("weight"))
        )
        if given is None:
            nodes = nodes.withColumn("budget", total.cast("long"))
        else:
            nodes = nodes.join(given, above)
        given = _filled(nodes, above).select(
            *above, F.col("node").alias(level), F.col("given").alias("budget")
        )
    return now.join(given, levels, "left").select(
        *levels, "tokens", "room", F.coalesce("budget", F.lit(0).cast("long")).alias("budget")
    )


def epoch_order(seed: int, epoch: Column, doc_id: Column) -> Column:
    """Order of a document in an epoch: a hash that every engine has."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def mix(docs: DataFrame, budget: int | None, weights: Mapping[str, Mapping[str, int]], levels: Mapping[str, Column],
        epochs: int = 2, seed: int = 7, ranges: int = RANGES, default: int = 1, id_col: str = "doc_id") -> DataFrame:
    """Documents chosen for the mix: ``doc_id``, the levels, ``tokens`` and ``copies``.

    ``levels`` maps each level of the tree to the expression of its name, from the root
    down. ``budget`` None is the number of tokens there are. A leaf whose budget covers
    k whole epochs takes every document k times; of the next epoch it takes documents
    in the order of :func:`epoch_order` as long as the tokens up to and including the
    document stay within the budget (the first that goes beyond ends the epoch).

    A leaf may hold a third of all rows, so it is never sorted as a whole: its tokens are
    summed per range of the order's first digits, the running sum over the ranges finds
    the one in which the budget ends, and only that one is sorted. Documents are read
    without their texts after the tokens are counted.

    Null names are the empty name, null text has no tokens; documents without tokens
    cost nothing and go with the range they fall into. Rows that repeat a doc_id are
    documents of their own with the same place in the order (ties by tokens); they are
    taken or left together.
    """
    names = list(levels)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        *[F.coalesce(e.cast("string"), F.lit("")).alias(c) for c, e in levels.items()],
        tokens_of(F.col("text")).alias("tokens"),
    )
    rows = staged(rows, "mixing-tokens")  # texts are read once; what follows reads the numbers
    return mixed_rows(rows, names, budget, weights, epochs, seed, ranges, default)


def mixed_rows(rows: DataFrame, names: list[str], budget: int | None, weights, epochs: int, seed: int,
               ranges: int, default: int) -> DataFrame:
    """:func:`mix` on rows ``(doc_id, levels..., tokens)``; other columns are carried along."""
    leaves = rows.groupBy(*names).agg(F.sum("tokens").alias("tokens"))
    if budget is None:
        leaves = leaves.withColumn("all_tokens", F.sum("tokens").over(Window.partitionBy(F.lit(0))))
        total = leaves.agg(F.coalesce(F.max("all_tokens"), F.lit(0)).alias("t")).scalar()
        leaves = leaves.drop("all_tokens")
    else:
        total = budget
    plan = leaf_budgets(leaves, total, weights, names, epochs, default).select(
        *names,
        F.when(F.col("tokens") > 0, F.expr("budget div tokens"))
        .otherwise(F.lit(0)).cast("long").alias("whole"),
        F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(F.lit(0)).alias("rest"),
    )
    # Later steps are keyed by the leaf as one value: they deal the rows anew instead of
    # building on this join, so the adaptive plan may split it at a hot leaf.
    placed = rows.join(plan, names).withColumn("leaf", F.struct(*names)).withColumn(
        "place", epoch_order(seed, F.col("whole"), F.col("doc_id"))
    ).withColumn("range", (F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * ranges / F.lit(2**32)).cast("int"))
    sums = placed.where("rest > 0").groupBy("leaf", "range").agg(F.sum("tokens").alias("in_range"), F.max("rest").alias("rest"))
    running = Window.partitionBy("leaf").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        sums.withColumn("before", F.coalesce(F.sum("in_range").over(running), F.lit(0)))
        .where("before <= rest AND before + in_range > rest")
        .groupBy("leaf")
        .agg(F.min("range").alias("edge"), F.min_by("before", "range").alias("edge_before"))
    )
    cut = placed.join(edges, "leaf", "left")
    at_edge = cut.where("rest > 0 AND range = edge")
    up_to = Window.partitionBy(F.struct("leaf", "range")).orderBy("place").rangeBetween(Window.unboundedPreceding, 0)
    taken = at_edge.withColumn("upto", F.col("edge_before") + F.sum("tokens").over(up_to)).withColumn(
        "extra", (F.col("upto") <= F.col("rest")).cast("long")
    ).drop("upto")
    others = cut.where("NOT (rest > 0 AND edge IS NOT NULL AND range = edge)").withColumn(
        "extra", (F.col("rest") > 0).cast("long") * (F.col("edge").isNull() | (F.col("range") < F.col("edge"))).cast("long")
    )
    return (
        others.unionByName(taken)
        .withColumn("copies", F.col("whole") + F.col("extra"))
        .where("copies > 0")
        .drop("leaf", "whole", "rest", "place", "range", "edge", "edge_before", "extra")
    )
