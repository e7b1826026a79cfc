"""Silver by change feed: per-card tables follow the cards that changed instead of a full refresh.

Two versions of bronze are compared by a digest of each card (of the columns that the tables use): cards
that are new, changed or gone are the change feed. The tables here have rows that follow from one card
alone, and are kept in hash buckets of the card id. Only the buckets of cards in the feed are shredded
again, from the new bronze, and written; the others stay as they are. All tables change in one commit.

Not among them: prices (they also age), sets (numbered over all cards of a set) and the main table (its
tiers hang on other cards; see ``hierarchy_delta``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.plans import cards
from strata.sources.commits import BUCKET, LayerCommit
from strata.sources.tables import version_path, _names

_COLUMN, _COUNT = "__bucket", ".buckets"
#: What of a card the tables use; a change elsewhere (prices, the load's date) is none here.
USED = ("id", "subtypes", "types", "attacks", "weaknesses", "resistances", "retreat_cost", "abilities", "national_pokedex_numbers",
        "legalities", "images")


def change_feed(old: DataFrame | None, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, change): ``insert``, ``update`` or ``delete`` of each row whose ``columns`` are not the same in both.

    Keys are unique and not NULL in both versions; a NULL differs from every value. Only the key and a
    128-bit digest are shuffled.
    """
    def digests(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col(key).isNotNull()).select(key, F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})).alias(name))

    after = digests(new, "__new")
    if old is None:
        return after.select(key, F.lit("insert").alias("change"))
    both = digests(old, "__old").join(after, key, "full_outer").where(~F.col("__old").eqNullSafe(F.col("__new")))
    return both.select(key, F.when(F.col("__old").isNull(), "insert").when(F.col("__new").isNull(), "delete").otherwise("update").alias("change"))


def _extras(bronze: DataFrame) -> DataFrame:
    """D10 of these cards alone."""
    base = bronze.select(F.col("id").alias("card_id"))
    return cards.card_extras_flattened(base, cards.card_subtypes(bronze), cards.card_types(bronze), cards.card_weaknesses(bronze),
                                       cards.card_resistances(bronze), cards.card_national_pokedex_numbers(bronze))


#: Tables whose rows follow from one card: name -> builder(bronze).
PER_CARD = {
    "card_attacks": cards.card_attacks, "card_weaknesses": cards.card_weaknesses, "card_abilities": cards.card_abilities,
    "card_resistances": cards.card_resistances, "card_retreat_cost": cards.card_retreat_cost, "card_subtypes": cards.card_subtypes,
    "card_types": cards.card_types, "card_national_pokedex_numbers": cards.card_national_pokedex_numbers,
    "card_legalities": cards.card_legalities, "card_images": cards.card_images, "card_extras_flattened": _extras,
}


def _bucket(key: str, n: int):
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def refresh_changed(layer: LayerCommit, old: DataFrame | None, new: DataFrame, tables: dict = PER_CARD,
                    n_buckets: int = 256) -> list[int]:
    """Bring ``tables`` of ``layer`` from bronze ``old`` to ``new``; seen when the layer is committed. Returns the
    buckets that were written anew (at most ``n_buckets`` numbers, fixed by the first call).

    ``old`` is the bronze that the tables were made from; None for the first time.
    """
    known = layer.parts(_COUNT)
    n_buckets = known[_COUNT][-1] if known else n_buckets
    feed = change_feed(old, new, "id", USED)
    buckets = sorted(r[0] for r in feed.select(_bucket("id", n_buckets)).distinct().collect())
    if not buckets:
        return []
    rows = new.where(F.col("id").isNotNull() & _bucket("id", n_buckets).isin(buckets))
    for name, build in tables.items():
        out = build(rows).withColumn(_COLUMN, _bucket("card_id", n_buckets))
        version = layer.write(out.hint("rebalance", _COLUMN), name, partition_by=[_COLUMN])
        folder = version_path(layer.path(name), version)
        full = {n.removeprefix(f"{_COLUMN}=") for n in _names(layer.spark, folder)}
        for b in buckets:
            # 0: a bucket without rows has no folder.
            layer.point(f"{name}{BUCKET}{b:06d}", version if str(b) in full else 0)
    layer.point(_COUNT, n_buckets)
    return buckets


def read_changed(layer: LayerCommit, table: str) -> DataFrame | None:
    """All rows of a table kept by ``refresh_changed``; None if it has none."""
    prefix = table + BUCKET
    folders = [f"{version_path(layer.path(table), v[-1])}/{_COLUMN}={int(n[len(prefix):])}"
               for n, v in layer.parts(prefix).items() if v[-1]]
    if not folders:
        return None
    return layer.spark.read.option("basePath", layer.path(table)).parquet(*folders).drop("__version", _COLUMN)
