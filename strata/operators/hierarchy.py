"""H1: hierarchy tier by breadth-first expansion over (node, parent) edges.

The source computes tiers with a recursive CTE (anchor = nodes without a parent, tier 1;
child tier = parent tier + 1, matched by name) and keeps the lowest tier per node. Here each
level is one join of the current frontier with the edge list, minus nodes already reached, so
the loop yields the lowest tier directly, ends on cycles, and runs as many jobs as the
hierarchy is deep. Nodes never reached (orphans, cycles without a root) get no row; a left
join from the caller gives them a NULL tier.

Scale: the edges are checkpointed once, and adaptive execution plans each level's join, so a parent
with very many children is split over tasks. Every level is checkpointed to the shared folder, which
cuts lineage and lets a lost executor recompute from the last level instead of from the source. The
nodes reached so far are kept in few checkpoints: every ``_COMPACT`` levels they are written as one.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir, growing

# Levels whose nodes are written together, so that plans stay small in deep hierarchies.
_COMPACT = 8


class HierarchyDepthError(RuntimeError):
    pass


def _check_depth(deeper: DataFrame, max_depth: int) -> None:
    if not deeper.isEmpty():
        raise HierarchyDepthError(f"hierarchy deeper than {max_depth} steps below a root")


def hierarchy_tier(df: DataFrame, node: str, parent: str, max_depth: int | None = None,
                   tier_alias: str = "tier") -> DataFrame:
    """Lowest tier per node: roots (NULL parent) are tier 1.

    The loop ends by itself, also on cycles. ``max_depth`` is the number of steps below a root that
    are allowed, as a recursion limit counts them: a node at tier ``max_depth + 2`` raises.
    """
    ensure_checkpoint_dir(df.sparkSession)
    edges = (df.select(F.col(node).alias("child"), F.col(parent).alias("parent"))
             .where(F.col("child").isNotNull()).distinct().checkpoint(eager=True))
    linked = edges.where(F.col("parent").isNotNull())
    frontier = (edges.where(F.col("parent").isNull())
                .select(F.col("child").alias("node"), F.lit(1).alias(tier_alias)).distinct()
                .checkpoint(eager=True))
    reached = [frontier]
    level = 1
    while not frontier.isEmpty():
        if max_depth is not None and level > max_depth + 1:
            _check_depth(frontier, max_depth)
        level += 1
        if len(reached) > _COMPACT:
            reached = [_union(reached).checkpoint(eager=True)]
        seen = _union(reached).select("node", F.lit(True).alias("__seen"))
        # The "not reached yet" test is a left join + IS NULL: written as a left-anti join, Catalyst
        # pushes it below the inner join onto the edge table, which would then be shuffled twice.
        found = (frontier.select(F.col("node").alias("parent")).join(growing(linked), "parent")
                 .select(F.col("child").alias("node")).distinct()
                 .join(growing(seen), "node", "left").where(F.col("__seen").isNull()))
        frontier = found.select("node", F.lit(level).alias(tier_alias)).checkpoint(eager=True)
        reached.append(frontier)
    return _union(reached).select(F.col("node").alias(node), F.col(tier_alias))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def hierarchy_tier_doubling(df: DataFrame, node: str, parent: str, max_depth: int | None = None,
                            tier_alias: str = "tier") -> DataFrame:
    """H1 for tree-shaped hierarchies (at most one parent row per node), in O(log depth) rounds.

    Pointer doubling: each node keeps (ancestor, distance); every round replaces the ancestor by
    the ancestor's ancestor and adds the distances, until it reaches a root (tier = distance + 1)
    or a missing parent (unreachable). ``max_depth`` is as in ``hierarchy_tier``. Deep chains take about log2(depth) rounds instead of
    one job per level. Cycles never reach a root and get no tier, as in breadth-first order.
    Raises ValueError when some node has several parent rows (use ``hierarchy_tier``).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    edges = (df.select(F.col(node).alias("node"), F.col(parent).alias("parent"))
             .where(F.col("node").isNotNull()).distinct())
    # A NULL-parent row makes a node a root whatever its other rows say.
    per_node = edges.groupBy("node").agg(
        F.max(F.col("parent").isNull().cast("int")).alias("is_root"),
        F.count_distinct("parent").alias("n_parents"),
        F.max("parent").alias("parent"))
    if per_node.where((F.col("is_root") == 0) & (F.col("n_parents") > 1)).limit(1).count() > 0:
        raise ValueError("a node has several parents; use hierarchy_tier")
    # state: ancestor still to resolve (NULL when done), distance so far, status.
    state = per_node.select(
        "node",
        F.when(F.col("is_root") == 1, F.lit(None).cast("string")).otherwise(F.col("parent")).alias("anc"),
        F.when(F.col("is_root") == 1, F.lit(0)).otherwise(F.lit(1)).alias("dist"),
        F.when(F.col("is_root") == 1, F.lit("done")).otherwise(F.lit("open")).alias("status"),
    ).checkpoint(eager=True)
    # After ceil(log2(n)) + 1 rounds every node that can reach a root has done so; what is still
    # open then sits on a cycle (or under one) and gets no tier.
    n_nodes = state.count()
    rounds = max(1, math.ceil(math.log2(max(n_nodes, 2)))) + 1
    for _ in range(rounds):
        if state.where(F.col("status") == "open").limit(1).count() == 0:
            break
        t = state.select(F.col("node").alias("t_node"), F.col("anc").alias("t_anc"),
                         F.col("dist").alias("t_dist"), F.col("status").alias("t_status"))
        j = state.join(growing(t), state["anc"] == t["t_node"], "left")
        is_open = F.col("status") == "open"
        state = j.select(
            "node",
            F.when(is_open & (F.col("t_status") == "open"), F.col("t_anc"))
             .when(is_open, F.lit(None).cast("string")).otherwise(F.col("anc")).alias("anc"),
            F.when(is_open & F.col("t_status").isNotNull(), F.col("dist") + F.col("t_dist"))
             .otherwise(F.col("dist")).alias("dist"),
            F.when(is_open & F.col("t_node").isNull(), F.lit("dead"))
             .when(is_open & (F.col("t_status") == "done"), F.lit("done"))
             .when(is_open & (F.col("t_status") == "dead"), F.lit("dead"))
             .otherwise(F.col("status")).alias("status"),
        ).checkpoint(eager=True)
    tiers = state.where(F.col("status") == "done").select("node", (F.col("dist") + 1).alias(tier_alias))
    if max_depth is not None:
        _check_depth(tiers.where(F.col(tier_alias) > max_depth + 1), max_depth)
    return tiers.select(F.col("node").alias(node), F.col(tier_alias))
