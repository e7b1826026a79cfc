"""Card documents derived from the star-schema tables, for running the real pipeline at scale.

Each ``part`` row becomes one card document with the source's field names: the part key names
the card and its parent (``k div 10``; a few parents are missing), brand is the set, name
words are types and attack costs, and two finishes of daily prices come from a per-part
aggregate of ``lineitem`` (partial aggregation, so a hot part is combined map-side). The
documents are written as JSON Lines (splittable), one file per task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import growing

# Fixed run day of the derived documents and the span of their price update days.
DOC_AS_OF = _dt.datetime(2026, 1, 20, 12, 0, 0)
UPDATE_SPREAD_DAYS = 30


def _maybe(cond: Column, value: Column) -> Column:
    return F.when(cond, value)


# The market prices that the documents carry, of the names that a card may have.
CARDMARKET_PRICES = ("averageSellPrice", "lowPrice")


def card_documents(part: DataFrame, lineitem: DataFrame, as_of: _dt.datetime = DOC_AS_OF,
                   updated: Column | None = None) -> DataFrame:
    """updated: the day from which the price update days count back (by default the run day)."""
    k = F.col("p_partkey")
    words = F.split(F.upper("p_name"), " ")
    brand_no = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    prices = lineitem.groupBy("l_partkey").agg(
        F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi"), F.count(F.lit(1)).alias("n"),
        F.max("l_discount").alias("md"), F.min("l_tax").alias("tlo"), F.max("l_tax").alias("thi"),
        F.min("l_quantity").alias("qmin"))
    p = part.join(growing(prices), part["p_partkey"] == prices["l_partkey"], "left")
    upd_day = F.date_sub(F.lit(as_of.date()) if updated is None else updated, (k % UPDATE_SPREAD_DAYS).cast("int"))
    upd_text = F.date_format(upd_day, "yyyy/MM/dd")
    set_ts = F.format_string("2001/02/03 04:%02d:00", (k % 60).cast("int"))
    tcg_prices = F.when(F.col("n").isNotNull(), F.create_map(
        F.lit("normal"), F.struct(F.col("lo").alias("low"), F.col("hi").alias("high"),
                                  _maybe(F.col("n") % 2 == 0, F.col("md") * F.lit(100.0)).alias("market")),
        F.lit("holofoil"), F.struct(F.col("tlo").alias("low"), F.col("thi").alias("high"),
                                    F.col("qmin").alias("market"))))
    return p.select(
        F.concat(F.lit("c"), k.cast("string")).alias("id"),
        F.concat(F.lit("n"), k.cast("string")).alias("name"),
        F.col("p_type").alias("supertype"),
        F.array("p_type").alias("subtypes"),
        (F.col("p_size") * 10).cast("string").alias("hp"),
        words.alias("types"),
        F.when(k == 0, F.lit(None).cast("string"))
         .when(F.col("p_size") == 50, F.concat(F.lit("x"), k.cast("string")))
         .otherwise(F.concat(F.lit("n"), F.floor(k / 10).cast("long").cast("string"))).alias("evolvesFrom"),
        F.array(F.struct(F.col("p_type").alias("name"), words.alias("cost"),
                         F.size(words).alias("convertedEnergyCost"),
                         F.when(F.col("p_size") % 5 == 0, F.lit(" ")).otherwise(F.col("p_size").cast("string"))
                         .alias("damage"),
                         F.col("p_brand").alias("text"))).alias("attacks"),
        F.array(F.struct(words.getItem(0).alias("type"), F.concat(F.lit("×"), F.col("p_size").cast("string")).alias("value"))).alias("weaknesses"),
        F.when(F.col("p_size") % 2 == 1, F.array(F.struct(F.col("p_brand").alias("type"),
                                                          F.col("p_size").cast("string").alias("value"))))
         .otherwise(F.array().cast("array<struct<type:string,value:string>>")).alias("resistances"),
        F.array_repeat(words.getItem(1), (F.col("p_size") % 4).cast("int")).alias("retreatCost"),
        (F.col("p_size") % 4).cast("int").alias("convertedRetreatCost"),
        F.struct(F.col("p_brand").alias("id"), F.concat("p_brand", F.lit(" Set")).alias("name"),
                 F.concat(F.lit("Series "), (brand_no % 3).cast("string")).alias("series"),
                 brand_no.alias("printedTotal"), (brand_no + 1).alias("total"), F.lit("ST").alias("ptcgoCode"),
                 F.format_string("20%02d/01/01", (brand_no % 25).cast("int")).alias("releaseDate"),
                 F.when(k % 7 == 0, F.substring(set_ts, 2, 100)).otherwise(set_ts).alias("updatedAt"),
                 F.struct(F.concat(F.lit("https://img.example/"), F.col("p_brand"), F.lit("/symbol.png")).alias("symbol"),
                          F.concat(F.lit("https://img.example/"), F.col("p_brand"), F.lit("/logo.png")).alias("logo"))
                 .alias("images")).alias("set"),
        F.when(k % 11 == 0, F.concat(F.lit("TG"), F.col("p_size").cast("string")))
         .otherwise(F.col("p_size").cast("string")).alias("number"),
        F.concat(F.lit("Artist "), (k % 5).cast("string")).alias("artist"),
        F.when(k % 9 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("rarity"),
        F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("flavorText"),
        F.array((k % 1000).cast("int")).alias("nationalPokedexNumbers"),
        F.struct(_maybe(F.col("p_size") > 40, F.lit("Legal")).alias("standard"),
                 _maybe(F.col("p_size") > 20, F.lit("Legal")).alias("expanded"),
                 F.lit("Legal").alias("unlimited")).alias("legalities"),
        F.struct(F.concat(F.lit("https://img.example/c"), k.cast("string"), F.lit(".png")).alias("small"),
                 F.concat(F.lit("https://img.example/c"), k.cast("string"), F.lit("_hires.png")).alias("large"))
        .alias("images"),
        F.when(F.col("p_size") % 3 == 0, F.array(F.struct(words.getItem(0).alias("name"),
                                                          F.col("p_type").alias("text")))).alias("abilities"),
        F.struct(F.concat(F.lit("https://prices.example/c"), k.cast("string")).alias("url"),
                 upd_text.alias("updatedAt"), tcg_prices.alias("prices")).alias("tcgplayer"),
        F.struct(F.concat(F.lit("https://market.example/c"), k.cast("string")).alias("url"),
                 upd_text.alias("updatedAt"),
                 F.struct(F.col("p_retailprice").alias("averageSellPrice"),
                          (F.col("p_retailprice") / F.lit(2.0)).alias("lowPrice")).alias("prices")).alias("cardmarket"),
    )


def write_card_documents(spark: SparkSession, part: DataFrame, lineitem: DataFrame, out_dir: str,
                         as_of: _dt.datetime = DOC_AS_OF) -> str:
    card_documents(part, lineitem, as_of).write.mode("overwrite").json(out_dir)
    return out_dir
