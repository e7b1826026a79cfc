"""Tiers kept up to date from changed edges alone.

A tier is the least number of steps from a root, plus one. A node with tier t is held by any edge to a
parent with tier t - 1 (a root by its row without a parent). When edges go, nodes lose their tiers only
where no such edge is left; this is decided tier by tier from the top, so parents are settled before their
children and nothing is taken back that another edge holds. When edges come, and for the nodes that lost
their tier, new tiers are derived from settled neighbours, least first. Each round joins the few nodes
that are in question with the edges and the tiers; all others are never touched. There is a round per
tier that changes, not one per level of the hierarchy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir, growing


def _edges(df: DataFrame, node: str, parent: str) -> DataFrame:
    return df.select(F.col(node).alias("child"), F.col(parent).alias("parent")).where(F.col("child").isNotNull()).distinct()


def _least(df: DataFrame) -> int | None:
    return df.agg(F.min("t")).first()[0]


def _lost(old: DataFrame, edges: DataFrame, removed: DataFrame) -> DataFrame:
    """(node, t) of the nodes whose tier no edge holds any more."""
    parent = old.select(F.col("node").alias("parent"), F.col("t").alias("pt"))
    asked = (removed.join(growing(parent), "parent", "left").join(growing(old.withColumnRenamed("node", "child")), "child")
             .where(F.when(F.col("parent").isNull(), F.col("t") == 1).otherwise(F.col("t") == F.col("pt") + 1))
             .select(F.col("child").alias("node"), "t").distinct().checkpoint(eager=True))
    lost = asked.limit(0)
    while (t := _least(asked)) is not None:
        now = asked.where(F.col("t") == t)
        over = now.join(growing(edges), F.col("node") == F.col("child"))
        if t == 1:
            held = over.where(F.col("parent").isNull())
        else:
            held = over.join(growing(parent.where(F.col("pt") == t - 1)), "parent").join(
                growing(lost.select(F.col("node").alias("parent"))), "parent", "left_anti")
        gone = now.join(growing(held.select("node").distinct()), "node", "left_anti").checkpoint(eager=True)
        lost = lost.unionByName(gone).checkpoint(eager=True)
        below = (gone.select(F.col("node").alias("parent")).join(growing(edges), "parent").select(F.col("child").alias("node")).distinct()
                 .join(growing(old.where(F.col("t") == t + 1)), "node"))
        asked = asked.where(F.col("t") > t).unionByName(below.select("node", "t")).distinct().checkpoint(eager=True)
    return lost


def _derived(base: DataFrame, edges: DataFrame, lost: DataFrame, added: DataFrame) -> DataFrame:
    """(node, t) of the nodes with a tier that ``base`` does not give them."""
    from_parent = base.select(F.col("node").alias("parent"), F.col("t").alias("pt"))
    own = base.select(F.col("node").alias("child"), F.col("t").alias("now"))

    def offers(part: DataFrame) -> DataFrame:
        """What the parents of these edges offer, where it is better than what the child has."""
        t = F.when(F.col("parent").isNull(), F.lit(1)).otherwise(F.col("pt") + 1)
        return (part.join(growing(from_parent), "parent", "left").select("child", t.alias("t")).where("t is not null")
                .join(growing(own), "child", "left").where("now is null or t < now").select(F.col("child").alias("node"), "t"))

    asked = offers(edges.join(growing(lost.select(F.col("node").alias("child"))), "child", "left_semi")).unionByName(offers(added))
    asked = asked.groupBy("node").agg(F.min("t").alias("t")).checkpoint(eager=True)
    done = asked.limit(0)
    while (t := _least(asked)) is not None:
        now = asked.where(F.col("t") == t)
        done = done.unionByName(now).checkpoint(eager=True)
        below = (now.select(F.col("node").alias("parent")).join(growing(edges), "parent").select("child").distinct()
                 .join(growing(own), "child", "left").where(f"now is null or now > {t + 1}").select(F.col("child").alias("node"), F.lit(t + 1).alias("t")))
        asked = (asked.where(F.col("t") > t).unionByName(below).join(growing(done.select("node")), "node", "left_anti")
                 .groupBy("node").agg(F.min("t").alias("t")).checkpoint(eager=True))
    return done


def hierarchy_delta(tiers: DataFrame, edges: DataFrame, added: DataFrame, removed: DataFrame, node: str, parent: str,
                    tier_alias: str = "tier") -> tuple[DataFrame, DataFrame]:
    """(tiers, touched) after ``added`` and ``removed`` edges.

    ``tiers`` is what ``hierarchy_tier`` gave for the edges before, ``edges`` are all edges now; a row without a
    parent makes its node a root. The new tiers equal ``hierarchy_tier(edges)``: nodes out of reach have no
    row. ``touched``: node, old tier, new tier of the nodes whose tier was in question and fell, rose, came
    or went. ``tiers`` and ``edges`` are read once per changed tier, so they should be stored tables.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    now, plus, minus = (_edges(df, node, parent) for df in (edges, added, removed))
    same = F.col("child").eqNullSafe(F.col("c")) & F.col("parent").eqNullSafe(F.col("p"))
    pairs = now.select(F.col("child").alias("c"), F.col("parent").alias("p"))
    minus = minus.join(growing(pairs), same, "left_anti")  # an edge that is there is not removed
    old = tiers.select(F.col(node).alias("node"), F.col(tier_alias).cast("int").alias("t"))
    lost = _lost(old, now, minus)
    base = old.join(growing(lost.select("node")), "node", "left_anti")
    new = _derived(base, now, lost, plus.join(growing(pairs), same, "left_semi"))
    kept = base.join(growing(new.select("node")), "node", "left_anti")
    names = F.col("node").alias(node), F.col("t").alias(tier_alias)
    changed = lost.select("node").union(new.select("node")).distinct()
    touched = (changed.join(growing(old.withColumnRenamed("t", "old_tier")), "node", "left")
               .join(growing(new.withColumnRenamed("t", "new_tier")), "node", "left")
               .where("not old_tier <=> new_tier").withColumnRenamed("node", node))
    return kept.unionByName(new).select(*names), touched
