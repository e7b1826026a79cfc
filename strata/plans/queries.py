"""Operator checks on the supplied star-schema tables.

There is no card data in the test tables, so each operator runs on nested values that Spark
builds from the flat tables (``to_json``), while the matching DuckDB SQL in ``ORACLE_SQL``
computes the expected result straight from the flat tables. Every query reads whole tables;
NULLs and blanks are induced with CASE rules because the tables contain none.

Each query is ``fn(spark, sf_dir) -> DataFrame``; column names match the oracle's.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import functions as sf
from strata.operators import (assign_keys, cast_rejects, child_counts, length_violations, count_within, date_dimension_covering, dedupe_grain,
                              explode_entries, explode_objects, explode_scalars, flat_lists, flatten_struct,
                              fresh_since, having_value, hierarchy_tier, hierarchy_tier_doubling, keep_lowest, keep_one, key_violations,
                              list_per_key, merge_type1, new_facts, null_violations, number_within, profile)
from strata.session import scratch_path, spread
from strata.sources import land_pages, restore, snapshot

# Fixed run clock for the freshness queries (the source uses the server clock).
AS_OF = _dt.datetime(2024, 2, 5, 12, 0, 0)
FRESH_DAYS = 20
LOCAL_OFFSET_HOURS = -5
# Card-number strip set for "Brand#n" codes: the letters, '!', '?' and '#'.
BRAND_STRIP = sf.scalars.CODE_STRIP_CHARS + "#"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def wide_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """A table feeding row-wise JSON work: pruned to ``cols``, spread over all cores if the
    scan itself is not split."""
    df = table(spark, sf_dir, name)
    return spread(df.select(*cols) if cols else df)


# --------------------------------------------------------------------------- JSON shredding

def json_typed_fields(spark, sf_dir):
    """Typed field out of JSON text, read as text then cast, then aggregated."""
    ev = wide_table(spark, sf_dir, "events", "event_type", "value", "props")
    parsed = ev.select("event_type", "value",
                       F.from_json("props", "k string").getField("k").alias("k_text"))
    k = sf.safe_cast("k_text", "int")
    return (parsed.withColumn("k", k).groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("n_events"), F.count("k").alias("n_k"),
                 F.sum("k").cast("long").alias("sum_k"), F.max("k").alias("max_k"),
                 # Average from exact integer cents, so every engine divides the same integers.
                 F.round(F.sum(F.round(F.col("value") * 100).cast("long")) / F.count(F.lit(1)) / F.lit(100.0), 6)
                 .alias("avg_value")))


def _facets_json(li: DataFrame) -> DataFrame:
    facets = F.array(F.struct(F.lit("QUANTITY").alias("type"), F.col("l_quantity").alias("value")),
                     F.struct(F.lit("DISCOUNT").alias("type"), F.col("l_discount").alias("value")),
                     F.struct(F.lit("TAX").alias("type"), F.col("l_tax").alias("value")))
    kept = F.filter(facets, lambda x: x.getField("value") > 0)
    return li.select("l_orderkey", "l_linenumber", F.to_json(kept).alias("facets"))


def q_explode_objects(spark, sf_dir):
    """Array-of-objects JSON (variable length, some empty) -> one row per object."""
    docs = _facets_json(wide_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity",
                                   "l_discount", "l_tax"))
    out = explode_objects(docs, "facets", "type string, value double", keep=["l_orderkey", "l_linenumber"],
                          rename={"type": "facet_type", "value": "facet_value"})
    return out.withColumn("facet_type", F.lower("facet_type"))


def q_explode_scalars(spark, sf_dir):
    """K5-K7/F1: JSON array of scalars -> one row per element, position kept, lower-cased."""
    part = table(spark, sf_dir, "part")
    docs = part.select("p_partkey", F.to_json(F.split(F.upper("p_name"), " ")).alias("words"))
    return explode_scalars(docs, "words", "string", keep=["p_partkey"], alias="word", lower=True,
                           pos_alias="word_pos")


def value_lookup(spark, sf_dir):
    """Parents that have a given value in their child table."""
    words = q_explode_scalars(spark, sf_dir)
    return having_value(words, "p_partkey", "word", "widget")


def q_explode_entries(spark, sf_dir):
    """Open-key object {finish: {low, high, market}} -> rows, market fallback."""
    li = wide_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice",
                    "l_discount", "l_tax")
    net = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    prices = F.create_map(
        F.lit("gross"), F.struct(net.alias("low"), F.col("l_extendedprice").alias("high"),
                                 F.when(F.col("l_tax") > 0, F.col("l_extendedprice") * (F.lit(1.0) + F.col("l_tax")))
                                 .alias("market")),
        F.lit("net"), F.struct((net * (F.lit(1.0) - F.col("l_tax"))).alias("low"), net.alias("high"),
                               F.when(F.col("l_discount") > 0, net).alias("market")))
    docs = li.select("l_orderkey", "l_linenumber", "l_shipdate", F.to_json(prices).alias("prices"))
    rows = explode_entries(docs, "prices", "low double, high double, market double",
                           keep=["l_orderkey", "l_linenumber", "l_shipdate"], key_alias="price_kind")
    return rows.select("l_orderkey", "l_linenumber", "price_kind",
                       sf.date_key("l_shipdate").alias("date_id"),
                       sf.price_fallback("market", "high", "low").alias("market_price"),
                       F.col("high").alias("highest_price"),
                       F.col("low").alias("lowest_price"))


ATTACK_SCHEMA = ("name string, cost array<string>, convertedEnergyCost int, damage string, text string")


def _attack_docs(part: DataFrame) -> DataFrame:
    words = F.split(F.upper("p_name"), " ")
    first = F.struct(F.col("p_type").alias("name"),
                     F.concat(words, F.slice(words, 1, 1)).alias("cost"),
                     F.col("p_size").alias("convertedEnergyCost"),
                     F.when(F.col("p_size") % 5 == 0, F.lit("  ")).otherwise(F.col("p_size").cast("string"))
                     .alias("damage"),
                     F.col("p_brand").alias("text"))
    second = F.struct(F.col("p_brand").alias("name"),
                      F.slice(words, 1, (F.col("p_size") % 3).cast("int")).alias("cost"),
                      (F.col("p_size") * 2).alias("convertedEnergyCost"),
                      F.lit(None).cast("string").alias("damage"),
                      F.lit(None).cast("string").alias("text"))
    return part.select(F.col("p_partkey").alias("card_id"), F.to_json(F.array(first, second)).alias("attacks"))


def nested_two_level(spark, sf_dir):
    """Attacks x cost -> one row per energy symbol, with the per-(card, attack,
    symbol) count repeated on each row; attacks with an empty cost vanish."""
    docs = _attack_docs(wide_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_brand", "p_size"))
    attacks = explode_objects(docs, "attacks", ATTACK_SCHEMA, keep=["card_id"])
    symbols = explode_scalars(attacks, "cost", "string",
                              keep=["card_id", "name", "convertedEnergyCost", "damage", "text"], alias="energy")
    counted = count_within(symbols, ["card_id", "name", "energy"], "energy", "energy_amount_needed")
    return counted.select("card_id",
                          F.lower("name").alias("attack_name"),
                          F.lower("energy").alias("energy_needed"),
                          "energy_amount_needed",
                          F.col("convertedEnergyCost").alias("total_energy_cost"),
                          sf.blank_to_default("damage").alias("damage"),
                          sf.blank_to_default("text").alias("description"))


WIDE_SCHEMA = ("quantityTotal double, extendedPrice double, discountRate double, taxRate double, "
               "netPrice double, grossPrice double")


def flatten_wide(spark, sf_dir):
    """One JSON object of camelCase doubles -> snake_case columns."""
    li = wide_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                    "l_discount", "l_tax")
    net = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    obj = F.struct(F.col("l_quantity").alias("quantityTotal"), F.col("l_extendedprice").alias("extendedPrice"),
                   F.col("l_discount").alias("discountRate"), F.col("l_tax").alias("taxRate"),
                   net.alias("netPrice"), (net * (F.lit(1.0) + F.col("l_tax"))).alias("grossPrice"))
    docs = li.select("l_orderkey", "l_linenumber", F.to_json(obj).alias("prices"))
    return flatten_struct(docs, "prices", {
        "quantityTotal": "quantity_total", "extendedPrice": "extended_price", "discountRate": "discount_rate",
        "taxRate": "tax_rate", "netPrice": "net_price", "grossPrice": "gross_price"},
        keep=["l_orderkey", "l_linenumber"], schema=WIDE_SCHEMA)


# --------------------------------------------------------------------------- scalar rules

def _induced_segment() -> F.Column:
    return (F.when(F.col("c_custkey") % 7 == 0, F.lit("   "))
            .when(F.col("c_custkey") % 11 == 0, F.lit(None).cast("string"))
            .when(F.col("c_custkey") % 13 == 0, F.concat(F.lit(" "), F.col("c_mktsegment")))
            .otherwise(F.col("c_mktsegment")))


def q_blank_to_default(spark, sf_dir):
    """trimmed blank or NULL -> 'n/a'."""
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", sf.blank_to_default(_induced_segment()).alias("segment"))


def q_null_default(spark, sf_dir):
    """NULL -> default, then lower-case."""
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", F.lower(sf.null_default(_induced_segment(), "special")).alias("segment"))


def q_digits_from_code(spark, sf_dir):
    """number out of an alphanumeric code; letters only -> 0; '1a2' -> NULL (reject)."""
    p = table(spark, sf_dir, "part")
    code = (F.when(F.col("p_partkey") % 13 == 0, F.col("p_type"))
            .when(F.col("p_partkey") % 17 == 0, F.concat(F.lit("1"), F.lower(F.substring("p_type", 1, 1)), F.lit("2")))
            .when(F.col("p_partkey") % 19 == 0, F.concat(F.col("p_brand"), F.lit("!")))
            .when(F.col("p_partkey") % 23 == 0, F.lit(None).cast("string"))
            .otherwise(F.col("p_brand")))
    return p.select("p_partkey", code.alias("code")).select(
        "p_partkey", "code", sf.digits_from_code("code", BRAND_STRIP).alias("set_card_number"))


def q_repair_timestamp(spark, sf_dir):
    """timestamp text that lost its first character is repaired; slash dates parsed."""
    o = table(spark, sf_dir, "orders")
    ts = F.timestamp_add("SECOND", (F.col("o_orderkey") % 86400), F.col("o_orderdate"))
    # Text from the wall-clock fields: date_format would pass a TIMESTAMP_NTZ through the session
    # time zone and move times that fall in a daylight-saving gap.
    text = F.format_string("%04d/%02d/%02d %02d:%02d:%02d", F.year(ts), F.month(ts), F.dayofmonth(ts),
                           F.hour(ts), F.minute(ts), F.second(ts))
    broken = F.when(F.col("o_orderkey") % 3 == 0, F.substring(text, 2, 100)).otherwise(text)
    rel = F.date_format("o_orderdate", "yyyy/MM/dd")
    return o.select("o_orderkey", broken.alias("update_text"), rel.alias("release_text")).select(
        "o_orderkey", "update_text",
        sf.repair_timestamp("update_text").alias("set_update_date"),
        sf.parse_date("release_text").alias("set_release_date"))


def presence_label(spark, sf_dir):
    """Precedence label from which fields are present (not their values)."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    lab = table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id", "left")
    standard = F.when(F.col("quality") == 1, F.lit("Legal"))
    expanded = F.when(F.col("toxic") == 0, F.lit("Legal"))
    unlimited = F.when(F.col("quality").isNotNull(), F.lit("Banned"))
    return j.select("doc_id", sf.first_present_label(
        [(standard, "Standard+"), (expanded, "Expanded+"), (unlimited, "Unlimited Only")]).alias("legality"))


def fresh_rows(spark, sf_dir):
    """Rows whose DATE is newer than as_of - 20 days (DATE compared at midnight)."""
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", F.to_date("ts").alias("event_day"))
    return fresh_since(ev, "event_day", AS_OF, FRESH_DAYS)


def local_day(spark, sf_dir):
    """Fixed -5 h clock shift, its calendar day and day key."""
    ev = table(spark, sf_dir, "events")
    day = sf.local_day("ts", LOCAL_OFFSET_HOURS)
    return ev.select("event_id", day.alias("local_day"), sf.date_key(day).alias("local_date_id"))


def case_insensitive_match(spark, sf_dir):
    """lower-case values matched to upper-case ones without regard to case."""
    c = table(spark, sf_dir, "customer")
    left = c.select("c_custkey", F.lower("c_mktsegment").alias("seg"))
    right = c.select(F.upper("c_mktsegment").alias("segment")).distinct()
    j = left.join(right, sf.ci_key(left["seg"]) == sf.ci_key(right["segment"]), "inner")
    return j.groupBy("segment").agg(F.count(F.lit(1)).alias("n_customers"))


# --------------------------------------------------------------------------- calendar / hierarchy

def q_date_dimension(spark, sf_dir):
    """Date dimension over the span of the ship dates."""
    return date_dimension_covering(table(spark, sf_dir, "lineitem"), "l_shipdate")


def _part_tree(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    parent = (F.when(key == 0, F.lit(None).cast("string"))
              .when(F.col("p_size") == 50, F.concat(F.lit("x"), key.cast("string")))
              .otherwise(F.floor(key / 10).cast("long").cast("string")))
    return part.select("p_partkey", key.cast("string").alias("card_name"), parent.alias("evolves_from"))


def q_hierarchy_tier(spark, sf_dir):
    """Lowest tier per node by name; orphans and their descendants get NULL."""
    tree = _part_tree(table(spark, sf_dir, "part"))
    tiers = hierarchy_tier(tree, "card_name", "evolves_from", tier_alias="evolution_tier")
    return tree.join(tiers, "card_name", "left").select("p_partkey", "card_name", "evolution_tier")


def q_hierarchy_delta(spark, sf_dir):
    """H1/J6 kept up to date: tiers of the tree of parts, then some parts move, get a second parent, become
    roots or are cut off, and only what hangs on these edges is worked out anew."""
    from strata.operators.hierarchy_delta import hierarchy_delta
    part = table(spark, sf_dir, "part")
    before = _written(spark, _part_tree(part).select("card_name", "evolves_from"), "tree-before")
    tiers = _written(spark, hierarchy_tier(before, "card_name", "evolves_from", tier_alias="evolution_tier"), "tree-tiers")
    k = F.col("p_partkey")
    moved = _part_tree(part).select("p_partkey", "card_name", F.when(k % 13 == 5, F.lit(None).cast("string"))
                                    .when(k % 17 == 4, F.concat(F.lit("x"), "card_name"))
                                    .when(k % 11 == 3, F.floor(k / 100).cast("string")).otherwise(F.col("evolves_from")).alias("evolves_from"))
    second = part.where(k % 19 == 6).select("p_partkey", k.cast("string").alias("card_name"), F.floor(k / 3).cast("string").alias("evolves_from"))
    after = _written(spark, moved.unionByName(second).select("card_name", "evolves_from"), "tree-after")
    same = ["card_name", "evolves_from"]
    new, _ = hierarchy_delta(tiers, after, after.select(*same).exceptAll(before.select(*same)),
                             before.select(*same).exceptAll(after.select(*same)), "card_name", "evolves_from", "evolution_tier")
    return new


# --------------------------------------------------------------------------- windows / rollups

def lowest_rank(spark, sf_dir):
    """Lowest price per brand, ties kept."""
    p = table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_retailprice")
    return keep_lowest(p, "p_brand", "p_retailprice")


def row_number_latest(spark, sf_dir):
    """Order sequence per customer (by date, tiebreak order key), hot-key safe."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return number_within(o, "o_custkey", ["o_orderdate", "o_orderkey"], alias="order_seq")


def keep_latest(spark, sf_dir):
    """One row per key, the latest by (date, order key)."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return keep_one(o, "o_custkey", ["o_orderdate", "o_orderkey"], latest=True)


def q_list_per_key(spark, sf_dir):
    """A1: ordered ', '-joined list of a text child per key (an order has few lines, however many
    orders there are)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return list_per_key(li, "l_orderkey", "l_returnflag", "flag_list", order=["l_linenumber"])


def q_flat_lists(spark, sf_dir):
    """Five per-supplier lists (one an INT list) from one scan, 'n/a' when empty
    (a supplier in three has no status list by rule)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    rows = (li.join(part, li["l_partkey"] == part["p_partkey"], "left").join(orders, li["l_orderkey"] == orders["o_orderkey"], "left")
            .select(F.col("l_suppkey").alias("s_suppkey"), "l_returnflag", "l_linestatus", "p_type",
                    F.year("l_shipdate").alias("ship_year"),
                    F.when(F.col("l_suppkey") % 3 != 0, F.col("o_orderstatus")).alias("order_status")))
    return flat_lists(s, "s_suppkey", {
        "returnflag_list": (rows, "l_returnflag"),
        "status_list": (rows, "l_linestatus"),
        "type_list": (rows, "p_type"),
        "year_list": (rows, "ship_year", ["ship_year"]),
        "order_status_list": (rows, "order_status"),
    }, distinct=True)


def q_child_counts(spark, sf_dir):
    """A3: distinct children and child rows per parent, 0 when none."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    return child_counts(o, "o_orderkey", {"number_of_parts": (li, "l_partkey", True),
                                          "number_of_lines": (li, None, False)})


# --------------------------------------------------------------------------- dimensions / facts

def _existing_customer_keys(c: DataFrame) -> DataFrame:
    return c.where(F.col("c_custkey") % 2 == 0).select(
        "c_custkey", (F.expr("c_custkey div 2") + F.lit(1)).cast("long").alias("cust_key"))


def surrogate_keys(spark, sf_dir):
    """Existing keys kept, new natural keys numbered after the current maximum."""
    c = table(spark, sf_dir, "customer")
    return assign_keys(c, "c_custkey", "cust_key", existing=_existing_customer_keys(c))


def scd1_merge(spark, sf_dir):
    """Type-1 merge; source NULLs overwrite, target-only rows are kept."""
    c = table(spark, sf_dir, "customer")
    target = (_existing_customer_keys(c).join(c, "c_custkey")
              .select("cust_key", "c_custkey", "c_name", (F.col("c_acctbal") - F.lit(100.0)).alias("c_acctbal"),
                      "c_mktsegment"))
    source = c.where(F.col("c_nationkey") != 0).select(
        "c_custkey", "c_name", "c_acctbal",
        F.when(F.col("c_custkey") % 10 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment"))
        .alias("c_mktsegment"))
    return merge_type1(target, source, "c_custkey", "cust_key")


def scd1_bucketed(spark, sf_dir):
    """D2/D3 in hash buckets: a first load, a merge, and the same merge again, each one commit."""
    from strata.operators.bucketed import merge_bucketed, read_bucketed
    from strata.sources import LayerCommit
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    nation = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    first = c.where(F.col("c_custkey") % 2 == 0).withColumn(
        "c_acctbal", F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal") - 100.0).otherwise(F.col("c_acctbal")))
    later = c.join(nation.where(F.col("c_nationkey") != 0), "c_custkey").select(
        "c_custkey", "c_name", "c_acctbal",
        F.when(F.col("c_custkey") % 10 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    layer_dir = scratch_path(spark, "bucketed")
    for day, source in enumerate((first, later, later)):
        layer = LayerCommit(spark, layer_dir)
        merge_bucketed(layer, "dim_customer", source, "c_custkey", "cust_key", "load_time_stamp",
                       AS_OF + _dt.timedelta(days=day), n_buckets=16)
        layer.commit()
    return read_bucketed(LayerCommit(spark, layer_dir), "dim_customer")


FACT_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
FACT_GRAIN = ["date_id", "order_key", "line_number"]


def _written(spark, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written to the shared scratch folder and read again, so that it is computed once."""
    path = scratch_path(spark, name)
    out = df.hint("rebalance", partition_by) if partition_by else df
    w = out.write.partitionBy(partition_by) if partition_by else out.write
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _fact_source(spark, sf_dir) -> DataFrame:
    # The grain dedupe is a sort-based aggregate (min_by over a struct): spread an unsplit scan
    # so its map side runs on every core.
    li = wide_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate", *FACT_ORDER)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey")
    batch = dedupe_grain(li.select("l_orderkey", "l_linenumber", sf.date_key("l_shipdate").alias("l_date_id"), *FACT_ORDER),
                         ["l_orderkey", "l_linenumber", "l_date_id"], FACT_ORDER)
    order_keys = assign_keys(orders, "o_orderkey", "order_key")
    cust_keys = assign_keys(cust, "c_custkey", "cust_key")
    dates = date_dimension_covering(table(spark, sf_dir, "lineitem"), "l_shipdate").select("date_id", "full_date")
    dim = orders.join(order_keys, "o_orderkey")
    src = (batch.join(dim, batch["l_orderkey"] == dim["o_orderkey"], "inner")
           .join(dates, F.col("l_date_id") == dates["date_id"], "left")
           .join(cust_keys, F.col("o_custkey") == cust_keys["c_custkey"], "left"))
    return src.select("order_key", "cust_key", "date_id", "full_date",
                      F.col("l_linenumber").alias("line_number"), "l_orderkey",
                      F.col("l_extendedprice").alias("market_price"),
                      (F.col("l_extendedprice") * (F.lit(1.0) + F.col("l_tax"))).alias("highest_price"),
                      (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("lowest_price"))


def incremental_fact(spark, sf_dir):
    """New fact rows = batch minus the stored history at the grain. The history (even
    orders) is a table partitioned by month, of which only the batch's months are read."""
    month = F.floor(F.col("date_id") / 100).cast("int").alias("month_id")
    src = _written(spark, _fact_source(spark, sf_dir).select("*", month), "fact-source")  # the only scan of the prices
    history = _written(spark, src.where(F.col("l_orderkey") % 2 == 0).select(*FACT_GRAIN, "month_id"), "fact-history", "month_id")
    new = new_facts(src, history, FACT_GRAIN, prune_col="month_id")
    return new.select("order_key", "cust_key", "date_id", "full_date", "line_number",
                      "market_price", "highest_price", "lowest_price")


def fact_point_lookup(spark, sf_dir):
    """Some cards' history out of a fact laid out along a curve over (day, card), with Bloom filters."""
    from strata.sources import read_clustered, write_clustered
    fact = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("card_key"), sf.date_key("l_shipdate").alias("date_id"), F.col("l_orderkey").alias("offer"),
        F.col("l_linenumber").alias("line"), F.col("l_extendedprice").alias("market_price"))
    path = scratch_path(spark, "clustered-fact")
    write_clustered(fact, path, ["date_id", "card_key"], files=64, bloom=["card_key"], bits=6)
    one = read_clustered(spark, path, card_key=7)
    days = read_clustered(spark, path, card_key=(11, 12), date_id=(None, 20231231))
    return one.unionByName(days)


# --------------------------------------------------------------------------- quality

def unique_violations(spark, sf_dir):
    """Q1: keys that occur more than once."""
    li = table(spark, sf_dir, "lineitem")
    return key_violations(li, ["l_orderkey", "l_linenumber"])


def q_null_violations(spark, sf_dir):
    """Q2: rows with NULLs in required columns, with the offending column names."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 97 == 0, F.lit(None).cast("string")).otherwise(F.col("l_returnflag"))
        .alias("l_returnflag"),
        F.when(F.col("l_partkey") % 89 == 0, F.lit(None).cast("double")).otherwise(F.col("l_quantity"))
        .alias("l_quantity"))
    bad = null_violations(li, ["l_returnflag", "l_quantity"])
    return bad.select("l_orderkey", "l_linenumber", F.array_join("null_columns", ",").alias("null_columns"))


def q_length_violations(spark, sf_dir):
    """Q3: values longer than a declared width (gold narrows text columns)."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    bad = length_violations(p, {"p_name": 10, "p_type": 6})
    return bad.select("p_partkey", "p_name", "p_type", F.array_join("too_long", ",").alias("too_long"))


def q_cast_rejects(spark, sf_dir):
    """Q4: non-NULL codes whose card number does not convert (reported, not loaded)."""
    codes = q_digits_from_code(spark, sf_dir)
    return cast_rejects(codes, "code", "int", converted=F.col("set_card_number")).select("p_partkey", "code")


def q_profile(spark, sf_dir):
    """Q6: null / untrimmed / blank profile of text columns in one pass."""
    c = table(spark, sf_dir, "customer").select("c_name", _induced_segment().alias("c_mktsegment"))
    return profile(c, ["c_name", "c_mktsegment"])


def profile_sketch(spark, sf_dir):
    """Q6/Q1 from run days: each day's profile is appended, and the days are merged without their data."""
    from strata.operators import merge_profiles, profile_day
    from strata.sources import LayerCommit
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", _induced_segment().alias("c_mktsegment"), "c_acctbal")
    layer_dir = scratch_path(spark, "profiles")
    for day in range(PROFILE_DAYS):
        layer = LayerCommit(spark, layer_dir)
        part = c.where(F.pmod("c_custkey", F.lit(PROFILE_DAYS)) == day).drop("c_custkey")
        layer.append(profile_day(part, part.columns, AS_OF.date() + _dt.timedelta(days=day)), "column_profiles")
        layer.commit()
    profiles = LayerCommit(spark, layer_dir).read("column_profiles")
    return merge_profiles(profiles, last_day=AS_OF.date() + _dt.timedelta(days=PROFILE_DAYS - 2)).select(
        "column_name", "n_rows", "n_null", "n_untrimmed", "n_blank", "longest")


PROFILE_DAYS = 3


# --------------------------------------------------------------------------- storage round trips

def snapshot_restore(spark, sf_dir):
    """Snapshot orders enriched with customer columns, restore with keys kept."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    base = scratch_path(spark, "snapshots")
    snapshot(o, base, "v1", enrich=c, on="o_custkey")
    return restore(spark, base, "v1").select("o_orderkey", "o_custkey", "o_totalprice", "c_name", "c_mktsegment")


def ordered_listing(spark, sf_dir):
    """O2: a result ordered by two keys."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return (s.join(n, s["s_nationkey"] == n["n_nationkey"])
            .select("n_name", "s_suppkey", "s_name").orderBy("n_name", "s_suppkey"))


def distinct_pairs(spark, sf_dir):
    """Distinct projection."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return s.join(n, s["s_nationkey"] == n["n_nationkey"]).select("n_name", "n_regionkey").distinct()


EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])
# JSON timestamp layout with microseconds (Spark's JSON default keeps milliseconds only).
TS_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# Page size of the paged extractor.
PAGE_SIZE = 250


def landing_dedupe(spark, sf_dir):
    """Page files with overlapping pages (a resumed extract re-reads the last page)
    -> one row per item."""
    ev = table(spark, sf_dir, "events")
    page = F.floor(F.col("event_id") / PAGE_SIZE).cast("long")
    item = F.struct(*[F.col(f.name) for f in EVENT_SCHEMA.fields])
    # The last 10 items of each page are fetched again at the start of the next page.
    again = ev.where(F.col("event_id") % PAGE_SIZE >= PAGE_SIZE - 10).select((page + 1).alias("page"), item.alias("it"))
    first = ev.select(page.alias("page"), item.alias("it"))
    pages = (first.unionByName(again).groupBy("page")
             .agg(F.sort_array(F.collect_list("it")).alias("data")))
    page_dir = scratch_path(spark, "pages")
    pages.write.option("timestampNTZFormat", TS_MICROS).json(page_dir)
    return land_pages(spark, page_dir, EVENT_SCHEMA, "event_id")


def stream_daily(spark, sf_dir):
    """Daily files processed as an available-now stream into an append-only fact;
    a second full re-run over the same files adds nothing."""
    from strata.sources import append_table, read_table
    from strata.streaming import run_stream

    ev = table(spark, sf_dir, "events")
    in_dir = scratch_path(spark, "daily-in")
    (ev.withColumn("day", F.date_format("ts", "yyyyMMdd")).write.partitionBy("day")
     .option("timestampNTZFormat", TS_MICROS).json(in_dir))
    sink = scratch_path(spark, "daily-fact")
    grain = ["date_id", "event_id"]

    def load(batch: DataFrame, _epoch: int) -> None:
        rows = batch.select("event_id", sf.date_key("ts").alias("date_id"), "event_type", "value")
        hist = read_table(spark, sink)  # None before the first batch
        append_table(new_facts(rows, hist, grain, prune_col="date_id"), sink, partition_by=["date_id"])

    for attempt in range(2):
        run_stream(spark, in_dir, EVENT_SCHEMA, scratch_path(spark, f"daily-ckpt-{attempt}"), load,
                   multi_line=False, max_files_per_trigger=16)
    return spark.read.parquet(sink).select("event_id", "date_id", "event_type", "value")


# ----------------------------------------------------------------------------- the card pipeline

def _card_lake(spark, sf_dir) -> str:
    """Bronze -> silver -> gold over card documents derived from ``part``/``lineitem``."""
    from strata.plans import loads
    from strata.plans.card_docs import DOC_AS_OF, write_card_documents
    landing = write_card_documents(spark, table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem"),
                                   scratch_path(spark, "card-landing"))
    root = scratch_path(spark, "card-lake")
    loads.run(spark, root, DOC_AS_OF, source=landing, multi_line=False)
    return root


def _two_day_lake(spark, sf_dir) -> str:
    """The lake after a second day, on which some cards are gone, some are new, and the prices of
    most have moved on a day."""
    from strata.plans import loads
    from strata.plans.card_docs import DOC_AS_OF, card_documents
    part, lineitem = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    root, day2 = _card_lake(spark, sf_dir), DOC_AS_OF + _dt.timedelta(days=1)
    k = F.col("p_partkey")
    new = part.where(k % 19 == 5).withColumn("p_partkey", k + NEW_CARD_OFFSET)
    later = card_documents(part.where(k % 17 != 3).unionByName(new), lineitem, day2,
                           updated=F.when(k % 4 == 0, F.lit(DOC_AS_OF.date())).otherwise(F.lit(day2.date())))
    landing = scratch_path(spark, "card-landing")
    later.write.json(landing)
    loads.run(spark, root, day2, source=landing, multi_line=False)
    return root


# Part keys of the cards that are new on the second day.
NEW_CARD_OFFSET = 1_000_000_000


def silver_delta(spark, sf_dir):
    """A1-A3/W1/J4/S6 by change feed: the flattened lists after a second day on which cards have come and gone."""
    from strata.plans import cards
    from strata.plans.card_docs import DOC_AS_OF, card_documents
    from strata.plans.silver_delta import PER_CARD, read_changed, refresh_changed
    from strata.sources import LayerCommit
    part, lineitem, k = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem"), F.col("p_partkey")
    new = part.where(k % 19 == 5).withColumn("p_partkey", k + NEW_CARD_OFFSET)
    bronze = [_written(spark, cards.bronze_from_documents(card_documents(p, lineitem), DOC_AS_OF), f"bronze-{i}")
              for i, p in enumerate((part, part.where(k % 17 != 3).unionByName(new)))]
    layer_dir = scratch_path(spark, "silver-delta")
    tables = {n: PER_CARD[n] for n in ("card_attacks", "card_extras_flattened")}
    for old, now in ((None, bronze[0]), bronze):
        layer = LayerCommit(spark, layer_dir)
        refresh_changed(layer, old, now, tables, n_buckets=64)
        layer.commit()
    return read_changed(LayerCommit(spark, layer_dir), "card_extras_flattened")


def card_day2_dims(spark, sf_dir):
    """D2/D3/D4 over two days: keys stay, discontinued cards stay, new ones get the next keys."""
    from strata.sources import layer_path, read_table
    dim = read_table(spark, layer_path(_two_day_lake(spark, sf_dir), "gold", "dim_cards"))
    return dim.select("card_key", "set_key", "card_id", "set_card_number", "number_of_abilities", "load_time_stamp")


def card_day2_sets(spark, sf_dir):
    """D5 over two days."""
    from strata.sources import layer_path, read_table
    return read_table(spark, layer_path(_two_day_lake(spark, sf_dir), "gold", "dim_card_sets"))


def card_day2_fact(spark, sf_dir):
    """D8 over two days: unchanged prices are not added again, moved ones are."""
    from strata.sources import layer_path, read_table
    fact = read_table(spark, layer_path(_two_day_lake(spark, sf_dir), "gold", "fact_hst_tcg_data"))
    return fact.select("card_key", "date_id", "printing_finish_rarity", "market_price", "log_created")


def rerun_idempotent(spark, sf_dir):
    """The same day loaded twice gives each fact and each reported value once."""
    from strata.plans import loads
    from strata.plans.card_docs import DOC_AS_OF, card_documents
    from strata.sources import layer_path, read_table
    docs = card_documents(table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem"))
    docs = docs.withColumn("hp", F.when(F.col("hp") == "70", F.lit("seventy")).otherwise(F.col("hp")))
    landing, root = scratch_path(spark, "card-landing"), scratch_path(spark, "card-lake")
    docs.write.json(landing)
    for _ in range(2):
        loads.run(spark, root, DOC_AS_OF, source=landing, multi_line=False)
    facts = read_table(spark, layer_path(root, "gold", "fact_hst_tcg_data")).groupBy("printing_finish_rarity")
    rejects = read_table(spark, layer_path(root, "audit", "cast_rejects")).groupBy("value")
    return (facts.agg(F.count("*").alias("n")).select(F.lit("fact").alias("what"), F.col("printing_finish_rarity").alias("value"), "n")
            .union(rejects.agg(F.count("*").alias("n")).select(F.lit("cast_rejects"), "value", "n")))


def card_retreat_cost(spark, sf_dir):
    """K5 on card documents: one row per retreat symbol, repeats kept."""
    from strata.plans import cards
    from strata.plans.card_docs import DOC_AS_OF, card_documents
    docs = card_documents(table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem"))
    return cards.card_retreat_cost(cards.bronze_from_documents(docs, DOC_AS_OF))


def mkt_cardmarket(spark, sf_dir):
    """K13 on card documents: the wide price object, absent prices NULL."""
    from strata.plans import cards
    from strata.plans.card_docs import DOC_AS_OF, CARDMARKET_PRICES, card_documents
    docs = card_documents(table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem"))
    known = [f.name for f in cards.CARDMARKET["prices"].dataType.fields if f.name not in CARDMARKET_PRICES]
    prices = F.struct("cardmarket.prices.*", *[F.lit(None).cast("double").alias(n) for n in known])
    docs = docs.withColumn("cardmarket", F.struct("cardmarket.url", "cardmarket.updatedAt", prices.alias("prices")))
    return cards.mkt_cardmarket(cards.bronze_from_documents(docs, DOC_AS_OF)).select(
        "card_id", "cardmarket_updated_at", "average_sell_price", "low_price", "trend_price", "avg_30", "card_url")


def variant_prices(spark, sf_dir):
    """Card prices kept as VARIANT in bronze, a row per finish by a lateral explode."""
    from strata.operators.variants import as_variant, variant_entries, variant_field
    from strata.plans.card_docs import card_documents
    docs = card_documents(table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem"))
    text = docs.select(F.col("id").alias("card_id"), F.to_json("tcgplayer").alias("tcgplayer"))
    bronze = _written(spark, as_variant(text, "tcgplayer"), "variant-bronze").withColumn(
        "tcg_updated_at", sf.parse_date(variant_field("tcgplayer", "$.updatedAt")))
    prices = variant_entries(bronze, "tcgplayer", ["card_id", "tcg_updated_at"], {n: (f"$.{n}", "double") for n in ("low", "high", "market")},
                             path="$.prices", key_alias="printing_finish_rarity")
    return prices.select("card_id", "printing_finish_rarity", sf.date_key("tcg_updated_at").alias("date_id"),
                         sf.price_fallback("market", "high", "low").alias("market_price"), F.col("high").alias("highest_price"),
                         F.col("low").alias("lowest_price"))


def json_malformed(spark, sf_dir):
    """JSON text of which some lines are cut off: whole records kept, damaged ones told apart."""
    from strata.sources import CORRUPT_COLUMN, read_json_documents
    ev = table(spark, sf_dir, "events").select("event_id", "event_type")
    text = F.to_json(F.struct("event_id", "event_type"))
    cut = F.when(F.col("event_id") % 50 == 7, F.expr("substring(text, 1, length(text) - 3)")).otherwise(F.col("text"))
    path = scratch_path(spark, "malformed")
    ev.withColumn("text", text).select(cut.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())])
    read = read_json_documents(spark, path, schema, multi_line=False, keep_corrupt=True)
    whole = F.col(CORRUPT_COLUMN).isNull()
    return read.select(F.when(whole, F.col("event_id")).alias("event_id"), F.when(whole, F.col("event_type")).alias("event_type"),
                       F.col(CORRUPT_COLUMN).alias("damaged"))


def json_split_array(spark, sf_dir):
    """All documents as one JSON array in one file, read by many tasks."""
    from strata.sources import read_json_array
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "one-document")
    first = docs.agg(F.min("doc_id").alias("d")).first()["d"]
    # The text begins every record but the first with a comma; the array ends after the last.
    head = F.when(F.col("doc_id") == first, F.lit("[")).otherwise(F.lit(","))
    record = F.to_json(F.struct(*docs.columns), {"pretty": "true"})
    lines = docs.select("doc_id", F.concat(head, record).alias("value")).unionByName(
        spark.range(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit("]" if first is not None else "[]").alias("value")))
    lines.coalesce(1).sortWithinPartitions(F.col("doc_id").asc_nulls_last()).select("value").write.text(path)
    return read_json_array(spark, path, docs.schema, split_bytes=SPLIT_BYTES)


#: Small ranges, so that also the small tables give a file to many tasks.
SPLIT_BYTES = 1 << 18


def paged_source(spark, sf_dir):
    """An extract of pages that breaks off in a page, is resumed, and is then fetched once more:
    each item lands once, where pages overlap from the later one."""
    from strata.sources import land_paged
    ev = table(spark, sf_dir, "events")
    pages = _event_pages(ev)
    page_dir, out, checkpoint = (scratch_path(spark, n) for n in ("paged-in", "paged-out", "paged-checkpoint"))
    middle = pages.agg(F.floor(F.max("page") / 2).cast("long").alias("m")).first()["m"] or 0
    item = F.to_json(F.struct("data"), {"timestampNTZFormat": TS_MICROS}).alias("value")

    def fetch(part: DataFrame) -> DataFrame:
        (part.select("page", item).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("page").text(page_dir))
        return land_paged(spark, page_dir, EVENT_SCHEMA, "event_id", out, checkpoint, page_size=PAGE_SIZE + OVERLAP)

    cut = F.when(F.col("page") < middle, F.col("data")).otherwise(F.slice("data", 1, 100))
    fetch(pages.where(F.col("page") <= middle).withColumn("data", cut))
    fetch(pages.where(F.col("page") >= middle))
    return fetch(pages)


#: Days for which a price holds in the price stream (the events span a month).
PRICE_DAYS = 5


def stream_latest_price(spark, sf_dir):
    """The latest price of every key held as state of a stream over shuffled day files."""
    from strata.streaming import file_stream, held_prices, run_latest_prices
    ev = table(spark, sf_dir, "events").select("user_id", "event_type", F.to_date("ts").alias("day"), "value")
    in_dir, out = scratch_path(spark, "prices-in"), scratch_path(spark, "prices-out")
    part = F.pmod(F.datediff("day", F.lit("2024-01-01").cast("date")) * 7, F.lit(5)).alias("part")
    ev.select("*", part).repartition("part").write.partitionBy("part").json(in_dir)
    schema = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                           T.StructField("day", T.DateType()), T.StructField("value", T.DoubleType())])
    stream = file_stream(spark, in_dir, schema, multi_line=False, max_files_per_trigger=1)
    run_latest_prices(stream, ["user_id", "event_type"], "day", "value", PRICE_DAYS, out, scratch_path(spark, "prices-checkpoint"))
    return held_prices(spark, out, ["user_id", "event_type"]).select(
        "user_id", "event_type", F.to_date(F.timestamp_millis("time_ms")).alias("day"), F.col("price").alias("value"))


def _event_pages(ev: DataFrame) -> DataFrame:
    """Pages of events in their order; the last items of each page come again on the next."""
    page = F.floor(F.col("event_id") / PAGE_SIZE).cast("long")
    item = F.struct(*[F.col(f.name) for f in EVENT_SCHEMA.fields])
    again = ev.where(F.col("event_id") % PAGE_SIZE >= PAGE_SIZE - OVERLAP).select((page + 1).alias("page"), item.alias("it"))
    return (ev.select(page.alias("page"), item.alias("it")).unionByName(again).groupBy("page")
            .agg(F.sort_array(F.collect_list("it")).alias("data")))


#: Items at the end of a page that the next page repeats.
OVERLAP = 10


def dated_documents(spark, sf_dir):
    """Whole-file multi-line documents, one per region, named by a day and found by that name, with
    text beyond ASCII; the row's day is taken from the file's name."""
    from strata.sources import dated_name, dated_path, read_json_documents
    r = table(spark, sf_dir, "region")
    doc = F.to_json(F.struct("r_regionkey", F.concat("r_name", F.lit(" × é ✓")).alias("r_name")), {"pretty": "true"})
    base, first = scratch_path(spark, "dated"), _dt.date(2026, 1, 20)
    r.select(doc.alias("value"), F.col("r_regionkey").alias("k")).write.partitionBy("k").text(base)
    keys = [x["r_regionkey"] for x in r.select("r_regionkey").collect()]  # the regions of the world: a handful
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    for k in keys:
        # The writer names its files itself; the extractor's rule gives them their day.
        written = fs.Path(f"{base}/k={k}/part-*").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        part = written.globStatus(fs.Path(f"{base}/k={k}/part-*"))[0].getPath()
        written.rename(part, fs.Path(f"{base}/{dated_name(first + _dt.timedelta(days=int(k)))}"))
    schema = T.StructType([T.StructField("r_regionkey", T.LongType()), T.StructField("r_name", T.StringType())])
    paths = [dated_path(base, first + _dt.timedelta(days=int(k))) for k in keys]
    return read_json_documents(spark, paths, schema, multi_line=True, day_col="day")


def run_audit(spark, sf_dir):
    """One audit row per step of a load, with its status and times."""
    from strata.sources import layer_path
    runs = spark.read.parquet(layer_path(_card_lake(spark, sf_dir), "audit", "runs"))
    return runs.select("step", "status", (F.col("seconds") >= 0).alias("timed"),
                       (sf.elapsed_seconds("started_at", "ended_at") >= 0).alias("in_order"))


def elapsed_seconds(spark, sf_dir):
    """F16: whole seconds between two times."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", sf.elapsed_seconds(F.date_trunc("DAY", "ts").cast("timestamp_ntz"), "ts").alias("seconds"))


def hierarchy_deep(spark, sf_dir):
    """H1 on one chain through all parts, by pointer doubling."""
    p = table(spark, sf_dir, "part").select("p_partkey")
    before = F.when(F.col("p_partkey") > 0, F.concat(F.lit("n"), (F.col("p_partkey") - 1).cast("string")))
    names = p.select(F.concat(F.lit("n"), F.col("p_partkey").cast("string")).alias("name"), before.alias("parent"))
    return hierarchy_tier_doubling(names, "name", "parent")


def card_load_fact(spark, sf_dir):
    """X2/D8 end to end: the daily price fact after the full bronze/silver/gold load."""
    from strata.sources import layer_path, read_table
    root = _card_lake(spark, sf_dir)
    fact = read_table(spark, layer_path(root, "gold", "fact_hst_tcg_data"))
    return fact.select("card_key", "set_key", "date_id", "full_date", "printing_finish_rarity", "market_price",
                       "highest_price", "lowest_price", "log_created")


def card_load_dims(spark, sf_dir):
    """D4/D9/A3/F5/F9 end to end: the card dimension after the full load."""
    from strata.sources import layer_path, read_table
    root = _card_lake(spark, sf_dir)
    dim = read_table(spark, layer_path(root, "gold", "dim_cards"))
    return dim.select("card_key", "set_key", "card_id", "card_name", "supertype", "evolution_tier", "artist",
                      "set_card_rarity", "set_card_number", "legality", "number_of_attacks", "number_of_abilities",
                      "hp")


def card_load_extras(spark, sf_dir):
    """D6/D10 end to end: flattened lists and images per card key."""
    from strata.sources import layer_path, read_table
    root = _card_lake(spark, sf_dir)
    return read_table(spark, layer_path(root, "gold", "dim_cards_extra_info"))


QUERIES = {
    "json_typed_fields": json_typed_fields,
    "explode_objects": q_explode_objects,
    "explode_scalars": q_explode_scalars,
    "value_lookup": value_lookup,
    "explode_entries": q_explode_entries,
    "nested_two_level": nested_two_level,
    "flatten_wide": flatten_wide,
    "blank_to_default": q_blank_to_default,
    "null_default": q_null_default,
    "digits_from_code": q_digits_from_code,
    "repair_timestamp": q_repair_timestamp,
    "presence_label": presence_label,
    "fresh_rows": fresh_rows,
    "local_day": local_day,
    "case_insensitive_match": case_insensitive_match,
    "date_dimension": q_date_dimension,
    "hierarchy_tier": q_hierarchy_tier,
    "hierarchy_delta": q_hierarchy_delta,
    "lowest_rank": lowest_rank,
    "row_number_latest": row_number_latest,
    "keep_latest": keep_latest,
    "list_per_key": q_list_per_key,
    "flat_lists": q_flat_lists,
    "child_counts": q_child_counts,
    "surrogate_keys": surrogate_keys,
    "scd1_merge": scd1_merge,
    "scd1_bucketed": scd1_bucketed,
    "incremental_fact": incremental_fact,
    "fact_point_lookup": fact_point_lookup,
    "unique_violations": unique_violations,
    "null_violations": q_null_violations,
    "profile": q_profile,
    "length_violations": q_length_violations,
    "cast_rejects": q_cast_rejects,
    "snapshot_restore": snapshot_restore,
    "ordered_listing": ordered_listing,
    "distinct_pairs": distinct_pairs,
    "landing_dedupe": landing_dedupe,
    "stream_daily": stream_daily,
    "card_load_fact": card_load_fact,
    "card_load_dims": card_load_dims,
    "card_load_extras": card_load_extras,
    "silver_delta": silver_delta,
    "card_day2_dims": card_day2_dims,
    "card_day2_sets": card_day2_sets,
    "card_day2_fact": card_day2_fact,
    "rerun_idempotent": rerun_idempotent,
    "card_retreat_cost": card_retreat_cost,
    "mkt_cardmarket": mkt_cardmarket,
    "json_malformed": json_malformed,
    "variant_prices": variant_prices,
    "profile_sketch": profile_sketch,
    "dated_documents": dated_documents,
    "hierarchy_deep": hierarchy_deep,
    "run_audit": run_audit,
    "elapsed_seconds": elapsed_seconds,
    "json_split_array": json_split_array,
    "paged_source": paged_source,
    "stream_latest_price": stream_latest_price,
}
