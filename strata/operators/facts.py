"""Idempotent incremental fact loads.

New fact rows = the batch minus the rows already stored at the grain (``NOT EXISTS`` ->
left-anti join). Re-running a batch adds nothing, so a retried micro-batch or a re-run day is
safe. Rows with a NULL grain part never match an anti-join and would be re-added every run;
they are split off as rejects first.

Scale: the stored history grows without bound while a batch touches few days. The history is
semi-joined to the batch's distinct days, so dynamic partition pruning reads only those partitions.
The days are broadcast: a table of days is bounded by the calendar (a century is 36,525 rows). They
can be given as a narrow table (``days``), so that the batch's joins do not run just to list them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import growing


def _any_null(cols: Sequence[str]) -> Column:
    cond = None
    for c in cols:
        e = F.col(c).isNull()
        cond = e if cond is None else cond | e
    return cond


def split_null_grain(batch: DataFrame, grain: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Q2 before D8: (rows with a complete grain, rows with a NULL grain part)."""
    bad = _any_null(grain)
    return batch.where(~bad), batch.where(bad)


def prune_history(history: DataFrame, days: DataFrame, prune_col: str) -> DataFrame:
    """The part of ``history`` whose ``prune_col`` occurs in ``days`` (any rows with that column)."""
    # Not null, said as a comparison: Catalyst plans dynamic pruning only by a filtered side.
    wanted = days.select(prune_col).where(F.col(prune_col).cast("string") > "").distinct()
    return history.join(F.broadcast(wanted), prune_col, "left_semi")


def new_facts(batch: DataFrame, history: DataFrame | None, grain: Sequence[str],
              prune_col: str | None = None, days: DataFrame | None = None) -> DataFrame:
    """Rows of ``batch`` whose grain is not yet in ``history`` (NULL-grain rows excluded).

    prune_col: the day (or month) by which the history is partitioned; ``days`` lists the batch's
    values of it, by default taken from the batch itself.
    """
    grain = list(grain)
    good, _ = split_null_grain(batch, grain)
    if history is None:
        return good
    if prune_col is not None:
        history = prune_history(history, good if days is None else days, prune_col)
    return good.join(growing(history.select(*grain)), grain, "left_anti")


def dedupe_grain(batch: DataFrame, grain: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per grain inside a batch (first by ``order``), as the primary key demands."""
    from strata.operators.windows import keep_one
    return keep_one(batch, list(grain), list(order), latest=False)
