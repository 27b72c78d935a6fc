"""Mixing sources to target weights through a tree of groups. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partylens.llm.numbering import running_before
from partylens.session import stable



def token_count(text: Column) -> Column:
    """Words between white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint")


def _name(levels: Sequence[Column]) -> Column:
    """One text for a path of the tree, as in ``node_name``."""
    parts = [F.coalesce(F.concat(F.lit("="), F.replace(F.replace(c.cast("string"), F.lit("%"), F.lit("%25")), F.lit("/"), F.lit("%2F"))), F.lit("-")) for c in levels]
    return F.concat_ws("/", *parts) if parts else F.lit("")


def node_name(*values: str | None) -> str:
    """Name of a node by its path from the top: ``=a/=b``; null is ``-``."""
    return "/".join("-" if v is None else "=" + v.replace("%", "%25").replace("/", "%2F") for v in values)


def filled(children: DataFrame) -> DataFrame:
    """Share each parent's budget among its children: columns parent, node, weight, capacity, budget (of the parent).

    Water filling: a child gets budget * weight / weights, but not more than its capacity; what it
    cannot use goes to its siblings by weight, and so on. With children sorted by capacity / weight the
    level of the water follows from running sums, so nothing is iterated. ``given`` is the child's budget;
    what no child can hold is left over. Children without weight get nothing.
    """
    order = Window.partitionBy("parent").orderBy(F.col("capacity") / F.col("weight"), "node")
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    tried = children.where(F.col("weight") > 0).withColumn("level", level)
    # the first child that the water does not cover sets the level; children before it are full
    open_level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("capacity"), F.struct(F.col("capacity") / F.col("weight"), "node", "level"))).over(Window.partitionBy("parent"))
    found = tried.withColumn("water", open_level["level"])
    given = F.when(F.col("water").isNull(), F.col("capacity")).otherwise(F.least("capacity", F.greatest(F.lit(0.0), F.col("water")) * F.col("weight")))
    return found.withColumn("given", given).drop("level", "water")


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], weights: DataFrame | None, budget: float, epochs: float) -> DataFrame:
    """Token budget of every leaf: ``leaf`` and ``given``.

    ``leaves`` has the level columns, ``leaf`` and ``tokens``. A leaf can give ``epochs`` times its tokens,
    an inner node what its leaves can. The root gets ``budget`` times all tokens (no more than its
    capacity); each level shares what its parent has, so a shortage is met by siblings first, and reaches
    the parent's siblings only where all of a parent's leaves together fall short. ``weights`` has
    (node, weight) for nodes named by ``_name``; nodes that it leaves out weigh 1.
    """
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("all"))
    parents = total.select(F.lit("").alias("parent"), (F.col("all") * F.lit(float(min(budget, epochs)))).alias("budget"))
    paths = [F.col(c) for c in levels]
    for depth in range(1, len(levels) + 1):
        nodes = leaves.groupBy(_name(paths[:depth - 1]).alias("parent"), _name(paths[:depth]).alias("node")).agg(
            (F.sum("tokens") * F.lit(float(epochs))).alias("capacity")
        )
        if weights is not None:
            nodes = nodes.join(weights, "node", "left")
        nodes = nodes.withColumn("weight", F.coalesce(F.col("weight") if weights is not None else F.lit(None), F.lit(1.0)).cast("double"))
        shared = filled(nodes.join(parents, "parent"))
        parents = stable(shared.select(F.col("node").alias("parent"), F.col("given").alias("budget")), "budgets")
    return parents.select(F.col("parent").alias("leaf"), F.col("budget").alias("given"))


def mixed(docs: DataFrame, levels: dict[str, Column], weights: DataFrame | None = None, budget: float = 1.0, epochs: int = 1, seed: str = "0", id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, tokens, copies, then the columns of ``carry`` with ``_carried_`` before their names.

    ``levels`` names the tree's levels from the top with their expressions (domain, language, source); null
    is a group like others. ``budget`` is the tokens wanted as a share of all tokens, ``epochs`` how often a
    row may be used. A leaf with budget g and t tokens uses all its rows g // t times, and once more the
    rows at the head of its seeded order, from a fresh hash of (seed, epoch, id, text), as long as the tokens
    before a row are below the rest: the row that crosses the line is taken, so the leaf misses its budget
    by less than one row. Rows without words are used in every whole epoch and at the head of the order; a leaf
    of such rows only is used in every epoch, unless it or a node above it has no weight.
    Every row goes by itself, with or without an id of its own; rows equal in id and text stand next to each other.
    The order is made from ids, token counts and hashes alone. With ``carry`` the rows are read again and held against the last row that
    each leaf takes, so texts do not move; only where some of several rows equal in id and text are taken, those are numbered.
    An empty table gives an empty result.
    """
    names = list(levels)
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"), *[e.alias(f"_level_{n}") for n, e in levels.items()], *[F.col(c).alias(f"_carried_{c}") for c in carry])
    carried = [f"_carried_{c}" for c in carry]
    counted = base.select(
        "doc_id", _name([F.col(f"_level_{n}") for n in names]).alias("leaf"), *[F.col(f"_level_{n}") for n in names],
        token_count(F.col("_text")).alias("tokens"), F.xxhash64("_text").alias("_sign"), *carried,
    )
    keys = stable(counted.drop(*carried), "tokens")  # small; the texts are read once for it, and once more to carry columns
    leaves = stable(keys.groupBy("leaf", *[f"_level_{n}" for n in names]).agg(F.sum("tokens").alias("tokens")), "leaves")
    given = leaf_budgets(leaves, [f"_level_{n}" for n in names], weights, budget, epochs)
    plan = leaves.join(given, "leaf", "left").select(
        F.col("leaf").alias("_leaf"),
        F.when(F.col("tokens") > 0, F.floor(F.coalesce("given", F.lit(0.0)) / F.col("tokens") + F.lit(1e-9))).when(F.col("given").isNotNull(), epochs).otherwise(0).cast("int").alias("whole"),
        F.coalesce("given", F.lit(0.0)).alias("given"), F.col("tokens").alias("_all"),
    ).withColumn("rest", F.greatest(F.lit(0.0), F.col("given") - F.col("whole") * F.col("_all")))
    plan = stable(plan, "plan")  # a row per leaf: known to be small before the rows are joined to it
    order = F.xxhash64(F.lit(seed), F.col("whole"), F.col("doc_id"), F.col("_sign")).alias("_order")
    joined = keys.join(plan, keys["leaf"].eqNullSafe(plan["_leaf"])).select("doc_id", "leaf", "tokens", "whole", "rest", order)
    placed = running_before(joined, "leaf", ["_order", "doc_id", "tokens"], "tokens", "_before")
    more = F.col("_before") + F.lit(1e-6) < F.col("rest")
    if not carry:
        return placed.select("doc_id", "leaf", "tokens", (F.col("whole") + more.cast("int")).alias("copies"))
    at = F.struct((F.col("_order") < 0).alias("_upper"), "_order", "doc_id", "tokens")  # slices go by the hash without sign
    equal = placed.groupBy("leaf", at.alias("_last")).agg(F.count(F.lit(1)).alias("_equal"), F.count_if(more).alias("_taken"))
    lasts = equal.where(F.col("_taken") > 0).groupBy("leaf").agg(F.max(F.struct("_last", "_equal", "_taken")).alias("_cut")).select(F.col("leaf").alias("_leaf"), "_cut.*")
    cuts = stable(plan.select("_leaf", "whole").join(lasts, "_leaf", "left"), "cuts")
    rows = counted.join(cuts, counted["leaf"].eqNullSafe(cuts["_leaf"])).select("doc_id", "leaf", "tokens", "whole", order, "_last", "_equal", "_taken", *carried)
    some = F.coalesce((at == F.col("_last")) & (F.col("_taken") < F.col("_equal")), F.lit(False))
    head = F.coalesce(at <= F.col("_last"), F.lit(False))
    out = rows.where(~some).select("doc_id", "leaf", "tokens", (F.col("whole") + head.cast("int")).alias("copies"), *carried)
    if cuts.where(F.col("_taken") < F.col("_equal")).isEmpty():
        return out
    nth = F.row_number().over(Window.partitionBy("leaf").orderBy("_order"))
    tied = rows.where(some).withColumn("_nth", nth).select("doc_id", "leaf", "tokens", (F.col("whole") + (F.col("_nth") <= F.col("_taken")).cast("int")).alias("copies"), *carried)
    return out.unionByName(tied)
