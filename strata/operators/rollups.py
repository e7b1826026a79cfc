"""Per-key lists and counts of child rows, attached to a base table.

``STRING_AGG(x, ', ') ... GROUP BY key`` has no defined order in the source; we fix it (given
order columns, then the value) so results are reproducible. Lists are built with
``collect_list`` (a partial aggregate: each task pre-collects its rows before the shuffle).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import growing

from strata.functions.scalars import DEFAULT_TEXT


def _ordered_join(elems: Column, sep: str) -> Column:
    # elems: array<struct<o..., v>>; sort by the struct (order columns first, then value).
    return F.array_join(F.transform(F.array_sort(elems), lambda x: x.getField("v")), sep)


def list_per_key(df: DataFrame, key: str | Sequence[str], value: str, alias: str,
                 order: Sequence[str] = (), sep: str = ", ") -> DataFrame:
    """A1/A2: one row per key with its values joined by ``sep`` (NULL values skipped)."""
    keys = [key] if isinstance(key, str) else list(key)
    elem = F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)],
                    F.col(value).cast("string").alias("v"))
    rows = df.where(F.col(value).isNotNull())
    return rows.groupBy(*keys).agg(_ordered_join(F.collect_list(elem), sep).alias(alias))


def _slots(specs: list[tuple[DataFrame, Column]], key: str) -> DataFrame:
    """One row per child row with its key and a slot ``__e<i>`` per spec (child, value).

    Specs that read the same child table share its rows, so each child is scanned once; a row
    leaves the slots of other children NULL.
    """
    types = [c.select(v.alias("v")).schema["v"].dataType for c, v in specs]
    parts, done = [], []
    for child, _ in specs:
        if any(child is d for d in done):
            continue
        done.append(child)
        parts.append(child.select(F.col(key).alias("__key"), *[
            (v if c is child else F.lit(None).cast(types[i])).alias(f"__e{i}") for i, (c, v) in enumerate(specs)]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def flat_lists(base: DataFrame, key: str, lists: Mapping[str, tuple], default: str = DEFAULT_TEXT,
               sep: str = ", ", distinct: bool = False) -> DataFrame:
    """Attach several per-key lists to ``base``; keys without children get ``default``.

    ``lists`` maps output column -> (child DataFrame, value column[, order columns]). Children are
    aggregated in **one** shuffle and joined to the base once, instead of one aggregation and one
    join per list; lists of the same child DataFrame read it once. ``distinct`` keeps each value
    (with its order columns) once per key, already before the shuffle.
    """
    specs = []
    for child, value, *order in lists.values():
        elem = F.struct(*[F.col(o).alias(f"o{j}") for j, o in enumerate(order[0] if order else [])],
                        F.col(value).cast("string").alias("v"))
        specs.append((child, F.when(F.col(value).isNotNull(), elem)))
    collect = F.collect_set if distinct else F.collect_list
    agg = _slots(specs, key).groupBy("__key").agg(*[collect(f"__e{i}").alias(f"__l{i}") for i in range(len(specs))])
    # A key with rows for some lists only has an empty array for the others: default too.
    joined = base.join(growing(agg), base[key] == agg["__key"], "left")
    out = [base[c] for c in base.columns]
    for i, alias in enumerate(lists):
        text = F.when(F.size(f"__l{i}") > 0, _ordered_join(F.col(f"__l{i}"), sep))
        out.append(F.coalesce(text, F.lit(default)).alias(alias))
    return joined.select(*out)


def child_counts(base: DataFrame, key: str, children: Mapping[str, tuple]) -> DataFrame:
    """A3: per-key child counts attached to ``base``, 0 when there are no children.

    ``children`` maps output column -> (child DataFrame, counted column or None for rows,
    distinct flag). All are counted in one aggregation; counts of the same child DataFrame read it once.
    """
    specs = [(child, F.col(counted).cast("string") if counted else F.lit("")) for child, counted, _ in children.values()]
    aggs = [(F.count_distinct(F.col(f"__e{i}")) if distinct else F.count(f"__e{i}")).alias(alias)
            for i, (alias, (_, _, distinct)) in enumerate(children.items())]
    agg = _slots(specs, key).groupBy("__key").agg(*aggs)
    joined = base.join(growing(agg), base[key] == agg["__key"], "left")
    return joined.select(*[base[c] for c in base.columns],
                         *[F.coalesce(F.col(a), F.lit(0)).cast("long").alias(a) for a in children])
