"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed to cells (source, language, topic) with their tokens. The cells' weights are
raked: in turn for each dimension, they are scaled so that the weighted tokens of each value meet its
target share, until all margins hold. Documents are then sampled with probabilities proportional
to their cell's weight, scaled to a token budget; a probability stops at one, and what it cannot
take is spread over the other cells.

All steps are DataFrame operations. The cells are grouped sums (combined before the shuffle) and
never leave Spark; the driver sees single rows of totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import free_names, staged

DIMENSIONS = ("source", "lang", "topic")
#: Words are runs without ASCII white space.
WORD = "[^ \t-\r]+"
#: The topic of a text is the first rule that it meets.
TOPICS = (("legal", "(?i)licen[cs]e|copyright"), ("contact", "@"), ("web", "https?://"), ("table", r"\| .*\| "))
#: Rounds end when no margin is further from its target, as a share of all tokens; what is left when doubles bring
#: it no nearer is let pass if it is below the second.
TOLERANCE, NEAR = 1e-13, 1e-9
ROUNDS = 300


def topic_of(text: Column) -> Column:
    rule = F.lit(None).cast("string")
    for name, pattern in reversed(TOPICS):
        rule = F.when(text.rlike(pattern), F.lit(name)).otherwise(rule)
    return F.coalesce(rule, F.lit("prose"))


def measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, u), one row per row; u is uniform by a hash of the id."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    u = F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.col(lang_col).cast("string").alias("lang"), topic_of(text).alias("topic"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_tokens"), u.alias("u"))


def tempered_targets(cells: DataFrame, power: float) -> DataFrame:
    """(dimension, value, share): shares proportional to each value's tokens to a power; below 1 it
    lifts small sources, languages and topics."""
    out = None
    for d in DIMENSIONS:
        part = cells.groupBy(F.col(d).alias("value")).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("s"))
        total = part.agg(F.sum("s").alias("total")).first().total or 1.0
        part = part.select(F.lit(d).alias("dimension"), "value", (F.col("s") / F.lit(total)).alias("share"))
        out = part if out is None else out.union(part)
    return out


def rake(cells: DataFrame, targets: DataFrame, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` with ``weight``: weighted tokens meet the target shares of every dimension.

    A value without a target gets the weight zero. A target whose value has no tokens cannot be met and is
    passed over, and the others of its dimension share what is left in proportion. Rounds go on until no margin
    was further than ``tolerance`` (of all tokens) from its target when it was scaled. Targets that contradict each
    other raise ValueError with the error that is left: three rounds in a row did not bring it down, or there
    were ``rounds``.
    """
    total = float(cells.agg(F.sum("tokens").alias("t")).first().t or 0)
    given = targets.groupBy("dimension", "value").agg(F.sum("share").alias("share"))
    there = None
    for d in DIMENSIONS:
        part = cells.groupBy(F.col(d).alias("v")).agg(F.sum("tokens").alias("n")).where("n > 0").select(F.lit(d).alias("d"), "v")
        there = part if there is None else there.union(part)
    given = given.join(there, (F.col("dimension") == F.col("d")) & F.col("value").eqNullSafe(F.col("v"))).drop("d", "v")
    sums = given.groupBy("dimension").agg(F.sum("share").alias("all")).where("all > 0")
    shares = staged(given.join(sums, "dimension").select("dimension", "value", (F.col("share") / F.col("all")).alias("share")), "mixing-shares")
    now, before, stalled = cells.withColumn("weight", F.lit(1.0)), float("inf"), 0
    for _ in range(rounds):
        now = now.withColumn("off", F.lit(0.0))  # how far margins were from their targets before this round
        for d in DIMENSIONS:
            share = shares.where(F.col("dimension") == d).select("value", "share")
            margin = now.groupBy(F.col(d).alias("v")).agg(F.sum(F.col("weight") * F.col("tokens")).alias("m"))
            target = F.coalesce("share", F.lit(0.0)) * total
            factor = (margin.join(share, F.col("v").eqNullSafe(F.col("value")), "left")
                      .select("v", F.when(F.col("m") > 0, target / F.col("m")).otherwise(F.lit(1.0)).alias("factor"),
                              (F.abs(F.col("m") - target) / (total or 1.0)).alias("d_off")))
            now = staged(now.join(factor, F.col(d).eqNullSafe(F.col("v")))
                         .withColumns({"weight": F.col("weight") * F.col("factor"), "off": F.greatest("off", "d_off")})
                         .drop("v", "factor", "d_off"), "mixing-step")
        error = now.agg(F.max("off")).first()[0] or 0.0
        if error <= tolerance or (error <= NEAR and error > before / 2):  # doubles bring it no nearer
            return now.drop("off")
        stalled = stalled + 1 if error > before * (1 - 1e-4) else 0
        if stalled == 3:
            break
        before = error
    raise ValueError(f"the target shares cannot be met together: a margin is off by {error:.3g} of all tokens")


def inclusion(cells: DataFrame, budget: float) -> DataFrame:
    """``cells`` with ``probability`` = min(1, rate x weight), where the expected tokens are ``budget`` of
    all (or what the weights above zero allow). Each step caps the cells that pass one and raises
    the rate for the others, and the capped set only grows, so it ends."""
    weight, tokens = F.col("weight"), F.col("tokens")
    total = cells.agg(F.sum("tokens").alias("t")).first().t or 0
    rate = 0.0
    while True:
        full = weight * F.lit(rate) >= 1
        r = cells.agg(F.sum(F.when(full, tokens).otherwise(0)).alias("capped"),
                      F.sum(F.when(full, 0.0).otherwise(weight * tokens)).alias("open")).first()
        if not r.open:
            break
        new = (budget * total - r.capped) / r.open
        if new <= rate * (1 + 1e-12):
            break
        rate = new
    return cells.withColumn("probability", F.least(F.lit(1.0), weight * F.lit(rate)))


def weigh(docs: DataFrame, budget: float = 0.5, power: float = 0.7, targets: DataFrame | None = None,
          rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          lang_col: str = "lang") -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, weight, probability and sampled, one row per row of ``docs``.

    targets: (dimension, value, share); by default each value's tokens to ``power``. budget: the
    share of all tokens to expect in the sample. Null sources and languages are values of their own.
    A null or empty text has no tokens: it adds nothing to a margin and is sampled like the rest of its
    cell. Where a cell, or everything, has no tokens, weights stay as the other cells make them, or 1.
    Rows with one id are sampled alike; a null id is hashed as the empty string. Other columns are
    not read. No documents give no rows.
    """
    rows = staged(measured(docs, id_col, text_col, source_col, lang_col), "mixing-rows")
    cells = cell_probabilities(rows, budget, power, targets, rounds)
    return (_with_cells(rows, cells)
            .select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability",
                    (F.col("u") < F.col("probability")).alias("sampled")))


def cell_probabilities(rows: DataFrame, budget: float, power: float, targets: DataFrame | None, rounds: int) -> DataFrame:
    cells = staged(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "mixing-cells")
    shares = staged(tempered_targets(cells, power), "mixing-targets") if targets is None else targets
    return staged(inclusion(rake(cells, shares, rounds), budget), "mixing-probabilities")


def _with_cells(rows: DataFrame, cells: DataFrame) -> DataFrame:
    named = cells.select(*(F.col(d).alias(f"_{d}") for d in DIMENSIONS), "weight", "probability")
    same = [F.col(d).eqNullSafe(F.col(f"_{d}")) for d in DIMENSIONS]
    return rows.join(named, same[0] & same[1] & same[2]).drop(*(f"_{d}" for d in DIMENSIONS))


def sample_documents(docs: DataFrame, budget: float = 0.5, power: float = 0.7, targets: DataFrame | None = None,
                     rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                     lang_col: str = "lang") -> DataFrame:
    """The sampled rows of ``docs``, all columns, with _topic, _weight and _probability (with a further
    underscore where ``docs`` has such a column); see ``weigh``."""
    rows = staged(measured(docs, id_col, text_col, source_col, lang_col), "mixing-rows")
    cells = cell_probabilities(rows, budget, power, targets, rounds)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    u = F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    names = free_names(docs, "_topic", "_weight", "_probability", "_source", "_lang", "_cell")
    topic, weight, probability, source, lang, cell = names
    named = cells.select(F.col("source").alias(source), F.col("lang").alias(lang), F.col("topic").alias(cell),
                         F.col("weight").alias(weight), F.col("probability").alias(probability))
    return (docs.withColumn(topic, topic_of(text))
            .join(named, F.col(source_col).cast("string").eqNullSafe(F.col(source))
                  & F.col(lang_col).cast("string").eqNullSafe(F.col(lang)) & (F.col(topic) == F.col(cell)))
            .where(u < F.col(probability)).drop(source, lang, cell))
