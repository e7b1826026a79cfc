"""The trading-card catalogue pipeline as configuration of the generic operators.

bronze  : one typed row per card from the dated JSON document (nested values stay nested)
silver  : 15 relational tables shredded from bronze (full refresh)
gold    : dim_dates, dim_card_sets, dim_cards, dim_cards_extra_info (type-1 merges with
          surrogate keys) and fact_hst_tcg_data (append-only daily prices, idempotent)

Every builder is ``DataFrame -> DataFrame`` and lazy; ``strata.plans.loads`` writes them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import functions as sf
from strata.operators import (cast_rejects, child_counts, count_within, length_violations, date_dimension, explode_entries, explode_objects,
                              explode_scalars, flat_lists, flatten_struct, fresh_since, hierarchy_tier,
                              keep_one, merge_type1, new_facts, number_within, split_null_grain)
from strata.plans.fixed_values import (BRONZE_RENAMES, CARDMARKET_PRICE_NAMES, CASE_INSENSITIVE,  # noqa: F401
                                       CLOCK_OFFSET_HOURS, DATE_DIM_END, DATE_DIM_START, DEFAULT_RARITY, ENERGY_COUNT_COLUMN, GOLD_WIDTHS,
                                       LEGALITY_LABELS, PRICE_FRESH_DAYS)
from strata.session import growing
from strata.sources import CORRUPT_COLUMN, raw_json_columns, read_json_array, read_json_documents

S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Source field names of the card documents, in the order the source declares them.
ATTACK = _struct(("name", S), ("cost", T.ArrayType(S)), ("convertedEnergyCost", I), ("damage", S), ("text", S))
TYPE_VALUE = _struct(("type", S), ("value", S))
ABILITY = _struct(("name", S), ("text", S))
SET_IMAGES = _struct(("symbol", S), ("logo", S))
CARD_SET = _struct(("id", S), ("name", S), ("series", S), ("printedTotal", I), ("total", I),
                   ("ptcgoCode", S), ("releaseDate", S), ("updatedAt", S), ("images", SET_IMAGES))
LEGALITIES = _struct(("standard", S), ("expanded", S), ("unlimited", S))
IMAGES = _struct(("small", S), ("large", S))
TCG_PRICE = _struct(("low", D), ("mid", D), ("high", D), ("market", D), ("directLow", D))
TCGPLAYER = _struct(("url", S), ("updatedAt", S), ("prices", T.MapType(S, TCG_PRICE)))
CARDMARKET = _struct(("url", S), ("updatedAt", S),
                     ("prices", _struct(*[(k, D) for k in CARDMARKET_PRICE_NAMES])))

# The source document: hp arrives as text ("140") and is cast in silver.
CARD_SCHEMA = _struct(
    ("id", S), ("name", S), ("supertype", S), ("subtypes", T.ArrayType(S)), ("hp", S), ("types", T.ArrayType(S)),
    ("evolvesFrom", S), ("attacks", T.ArrayType(ATTACK)), ("weaknesses", T.ArrayType(TYPE_VALUE)),
    ("resistances", T.ArrayType(TYPE_VALUE)), ("retreatCost", T.ArrayType(S)), ("convertedRetreatCost", I),
    ("set", CARD_SET), ("number", S), ("artist", S), ("rarity", S), ("flavorText", S),
    ("nationalPokedexNumbers", T.ArrayType(S)), ("legalities", LEGALITIES), ("images", IMAGES),
    ("abilities", T.ArrayType(ABILITY)), ("tcgplayer", TCGPLAYER), ("cardmarket", CARDMARKET),
)



# ----------------------------------------------------------------------------- bronze

def bronze_from_documents(docs: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """Typed bronze: renamed columns plus the run's load date (clock shifted -5 h)."""
    cols = [F.col(f"`{c}`").alias(BRONZE_RENAMES.get(c, c)) for c in docs.columns]
    load_date = sf.shift_hours(sf.ts_literal(as_of), CLOCK_OFFSET_HOURS)
    return docs.select(*cols, load_date.alias("load_date"))


def accepted(bronze: DataFrame) -> Column:
    """Whether a bronze row is a card: a document that could be parsed, with an id."""
    whole = F.col(CORRUPT_COLUMN).isNull() if CORRUPT_COLUMN in bronze.columns else F.lit(True)
    return whole & F.col("id").isNotNull()


def read_bronze(spark: SparkSession, path: str | list[str], as_of: _dt.datetime, multi_line: bool = True,
                raw: bool = False, keep_corrupt: bool = False, split: bool = False) -> DataFrame:
    """Bronze from the day's document. ``raw=True`` keeps the 13 nested fields as JSON text, as
    the source's bronze table does; silver accepts either layout (see ``as_typed``). ``split=True`` reads
    one large document by many tasks (``read_json_array``)."""
    schema = raw_json_columns(CARD_SCHEMA, RAW_JSON_FIELDS) if raw else CARD_SCHEMA
    if split:
        return bronze_from_documents(read_json_array(spark, path, schema, keep_corrupt), as_of)
    return bronze_from_documents(read_json_documents(spark, path, schema, multi_line=multi_line, keep_corrupt=keep_corrupt),
                                 as_of)


# The nested fields the source keeps as JSON text in bronze (arrays and objects).
RAW_JSON_FIELDS = {"subtypes", "types", "attacks", "weaknesses", "resistances", "retreatCost",
                   "nationalPokedexNumbers", "set", "abilities", "legalities", "images", "tcgplayer", "cardmarket"}


def as_typed(bronze: DataFrame) -> DataFrame:
    """Parse raw JSON text columns with their declared types (a no-op on typed bronze).

    On raw bronze each silver query parses only the columns it reads; persisting typed bronze
    (what ``loads.load_bronze`` writes) parses each document once.
    """
    declared = {BRONZE_RENAMES.get(f.name, f.name): f.dataType for f in CARD_SCHEMA.fields}
    cols = []
    for f in bronze.schema.fields:
        target = declared.get(f.name)
        if target is not None and isinstance(f.dataType, T.StringType) and not isinstance(target, T.StringType):
            cols.append(F.from_json(F.col(f.name), target).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return bronze.select(*cols)


# ----------------------------------------------------------------------------- silver

def card_attacks(bronze: DataFrame, case_insensitive: bool = CASE_INSENSITIVE) -> DataFrame:
    """K1 + W1 + F2: a row per energy symbol of each attack; the per-(card, attack, symbol)
    count compares names and symbols without case by default (F21)."""
    attacks = explode_objects(bronze.select(F.col("id").alias("card_id"), "attacks"), "attacks", keep=["card_id"])
    symbols = explode_scalars(attacks, "cost", keep=["card_id", "name", "convertedEnergyCost", "damage", "text"],
                              alias="energy")
    key = sf.ci_key if case_insensitive else (lambda c: F.col(c))
    symbols = symbols.withColumn("__name_k", key("name")).withColumn("__energy_k", key("energy"))
    counted = count_within(symbols, ["card_id", "__name_k", "__energy_k"], "energy", ENERGY_COUNT_COLUMN)
    return counted.select("card_id", F.lower("name").alias("attack_name"),
                          F.lower("energy").alias("energy_needed"), ENERGY_COUNT_COLUMN,
                          F.col("convertedEnergyCost").alias("total_energy_cost"),
                          sf.blank_to_default("damage").alias("damage"),
                          sf.blank_to_default("text").alias("description"))


def _type_value(bronze: DataFrame, col: str, prefix: str) -> DataFrame:
    rows = explode_objects(bronze.select(F.col("id").alias("card_id"), col), col, keep=["card_id"],
                           pos_alias="position")
    return rows.select("card_id", F.lower("type").alias(f"{prefix}_type"), F.col("value").alias(f"{prefix}_value"),
                       "position")


def card_weaknesses(bronze: DataFrame) -> DataFrame:
    """K2."""
    return _type_value(bronze, "weaknesses", "weakness")


def card_resistances(bronze: DataFrame) -> DataFrame:
    """K4."""
    return _type_value(bronze, "resistances", "resistance")


def card_abilities(bronze: DataFrame) -> DataFrame:
    """K3."""
    rows = explode_objects(bronze.select(F.col("id").alias("card_id"), "abilities"), "abilities", keep=["card_id"])
    return rows.select("card_id", F.lower("name").alias("ability_name"), F.col("text").alias("ability_description"))


def _scalars(bronze: DataFrame, col: str, alias: str, elem: str = "string", lower: bool = True) -> DataFrame:
    return explode_scalars(bronze.select(F.col("id").alias("card_id"), col), col, elem, keep=["card_id"],
                           alias=alias, lower=lower, pos_alias="position")


def card_retreat_cost(bronze: DataFrame) -> DataFrame:
    """K5 (duplicates kept)."""
    return _scalars(bronze, "retreat_cost", "energy_type_to_retreat")


def card_subtypes(bronze: DataFrame) -> DataFrame:
    """K6."""
    return _scalars(bronze, "subtypes", "subtype")


def card_types(bronze: DataFrame) -> DataFrame:
    """K7."""
    return _scalars(bronze, "types", "type")


def card_national_pokedex_numbers(bronze: DataFrame) -> DataFrame:
    """K9: numbers cast to INT (non-numbers become NULL; see quality.cast_rejects)."""
    rows = _scalars(bronze, "national_pokedex_numbers", "value_text", lower=False)
    return rows.select("card_id", sf.safe_cast("value_text", "int").alias("national_pokedex_number"), "position")


def card_set(bronze: DataFrame, numbering: str = "range") -> DataFrame:
    """K8 + F5 + F6 + F7 + W2: the card's set, its number in the set and the per-set row number
    ordered by the repaired update time (tiebreak card id). A set without images gives no row,
    as the chained apply drops it."""
    s = flatten_struct(bronze.select(F.col("id").alias("card_id"), "number", "set"), "set", {
        "id": "set_id", "name": "name", "series": "series", "printedTotal": "set_total_printed",
        "total": "set_total_cards", "ptcgoCode": "set_ptcgo_code", "releaseDate": "release_text",
        "updatedAt": "update_text", "images.symbol": "set_symbol_image", "images.logo": "set_logo_image",
        "images": "__images"}, keep=["card_id", "number"])
    s = s.where(F.col("__images").isNotNull())
    s = s.select("card_id", "set_id", sf.digits_from_code("number").alias("set_card_number"),
                 F.lower("name").alias("set_name"), F.lower("series").alias("set_series"), "set_total_printed",
                 "set_total_cards", "set_ptcgo_code", sf.parse_date("release_text").alias("set_release_date"),
                 sf.repair_timestamp("update_text").alias("set_update_date"), "set_symbol_image", "set_logo_image")
    return number_within(s, "set_id", ["set_update_date", "card_id"], alias="row_number", method=numbering)


def card_legalities(bronze: DataFrame) -> DataFrame:
    """K10 + F9: a label from which formats are present (a missing object gives no row)."""
    base = bronze.select(F.col("id").alias("card_id"), "legalities").where(F.col("legalities").isNotNull())
    label = sf.first_present_label([(f"legalities.{field}", text) for field, text in LEGALITY_LABELS])
    return base.select("card_id", label.alias("legality"))


def card_images(bronze: DataFrame) -> DataFrame:
    """K11."""
    return flatten_struct(bronze.select(F.col("id").alias("card_id"), "images"), "images",
                          {"small": "small_image_url", "large": "large_image_url"}, keep=["card_id"])


def mkt_tcgplayer(bronze: DataFrame, as_of: _dt.datetime, fresh_days: int = PRICE_FRESH_DAYS) -> DataFrame:
    """K12 + F4 + F8 + P3: a row per finish of the open-key price object, kept when the
    update date is within ``fresh_days`` of ``as_of``."""
    tcg = bronze.select(F.col("id").alias("card_id"), F.col("tcgplayer.url").alias("tcg_url"),
                        sf.parse_date("tcgplayer.updatedAt").alias("tcg_updated_at"),
                        F.col("tcgplayer.prices").alias("prices")).where(F.col("prices").isNotNull())
    tcg = fresh_since(tcg, "tcg_updated_at", as_of, fresh_days)
    rows = explode_entries(tcg, "prices", TCG_PRICE, keep=["card_id", "tcg_url", "tcg_updated_at"],
                           key_alias="printing_finish_rarity")
    return rows.select("card_id", "printing_finish_rarity", "tcg_updated_at",
                       sf.date_key("tcg_updated_at").alias("date_id"),
                       sf.price_fallback("market", "high", "low").alias("market_price"),
                       F.col("high").alias("highest_price"), F.col("low").alias("lowest_price"),
                       F.col("directLow").alias("direct_buy_price"), "tcg_url")


def mkt_cardmarket(bronze: DataFrame) -> DataFrame:
    """Fifteen price fields flattened wide, camelCase to snake_case."""
    mapping = {"updatedAt": "update_text", "url": "card_url"}
    mapping.update({f"prices.{k}": v for k, v in CARDMARKET_PRICE_NAMES.items()})
    mapping["prices"] = "__prices"
    rows = flatten_struct(bronze.select(F.col("id").alias("card_id"), "cardmarket"), "cardmarket", mapping,
                          keep=["card_id"]).where(F.col("__prices").isNotNull())
    return rows.select("card_id", sf.parse_date("update_text").alias("cardmarket_updated_at"),
                       *CARDMARKET_PRICE_NAMES.values(), "card_url")


def _name_key(case_insensitive: bool):
    return sf.ci_key if case_insensitive else (lambda c: F.col(c))


def evolution_tiers(bronze: DataFrame, case_insensitive: bool = CASE_INSENSITIVE) -> DataFrame:
    """H1 over the distinct (name, evolves_from) pairs: lowest tier per name key (names match
    parents without case by default, F21)."""
    key = _name_key(case_insensitive)
    names = bronze.select(key("name").alias("name_key"), key("evolves_from").alias("parent_key")).distinct()
    return hierarchy_tier(names, "name_key", "parent_key", tier_alias="evolution_tier")


def card_main_info(bronze: DataFrame, card_set_df: DataFrame, tiers: DataFrame | None = None,
                   case_insensitive: bool = CASE_INSENSITIVE) -> DataFrame:
    """D9 = H1 + J3 + W3: main attributes with the lowest evolution tier of the card's name
    and the set card number."""
    tiers = evolution_tiers(bronze, case_insensitive) if tiers is None else tiers
    base = bronze.select(F.col("id").alias("card_id"), "name", "supertype", "hp", "artist", "rarity", "flavor_text",
                         _name_key(case_insensitive)("name").alias("name_key"))
    numbers = card_set_df.select("card_id", "set_card_number")
    j = base.join(growing(tiers), "name_key", "left").join(growing(numbers), "card_id", "left")
    return j.select("card_id", F.lower("name").alias("card_name"), F.lower("supertype").alias("supertype"),
                    sf.safe_cast("hp", "int").alias("hp"), "evolution_tier", F.lower("artist").alias("artist"),
                    F.lower(sf.null_default("rarity", DEFAULT_RARITY)).alias("set_card_rarity"), "set_card_number",
                    F.lower(sf.null_default("flavor_text", "n/a")).alias("description")).distinct()


def card_extras_flattened(main: DataFrame, subtypes: DataFrame, types: DataFrame, weaknesses: DataFrame,
                          resistances: DataFrame, pokedex: DataFrame) -> DataFrame:
    """D10 = J4 + A1/A2 + F3: five ', '-joined lists per card in array order, 'n/a' if none."""
    base = main.select("card_id").distinct()
    return flat_lists(base, "card_id", {
        "subtype_list": (subtypes, "subtype", ["position"]),
        "type_list": (types, "type", ["position"]),
        "weaknesses_list": (weaknesses, "weakness_type", ["position"]),
        "resistances_list": (resistances, "resistance_type", ["position"]),
        "pokedex_list": (pokedex, "national_pokedex_number", ["position"]),
    })


def silver_builders(as_of: _dt.datetime, numbering: str = "range") -> dict:
    """The 13 silver tables that read only bronze: name -> builder(typed bronze)."""
    return {
        "card_attacks": card_attacks,
        "card_weaknesses": card_weaknesses,
        "card_abilities": card_abilities,
        "card_resistances": card_resistances,
        "card_retreat_cost": card_retreat_cost,
        "card_subtypes": card_subtypes,
        "card_types": card_types,
        "card_set": lambda b: card_set(b, numbering),
        "card_national_pokedex_numbers": card_national_pokedex_numbers,
        "card_legalities": card_legalities,
        "card_images": card_images,
        "mkt_tcgplayer": lambda b: mkt_tcgplayer(b, as_of),
        "mkt_cardmarket": mkt_cardmarket,
    }


def build_silver(bronze: DataFrame, as_of: _dt.datetime, numbering: str = "range") -> dict[str, DataFrame]:
    """The 13 silver tables that read only bronze (lazy, except the checkpointed numbering)."""
    typed_bronze = as_typed(bronze)
    return {name: build(typed_bronze) for name, build in silver_builders(as_of, numbering).items()}


def build_silver_dependent(bronze: DataFrame, silver: dict[str, DataFrame],
                           tiers: DataFrame | None = None) -> dict[str, DataFrame]:
    """The two silver tables that read other silver tables (written after them)."""
    bronze = as_typed(bronze)
    main = card_main_info(bronze, silver["card_set"], tiers)
    extras = card_extras_flattened(main, silver["card_subtypes"], silver["card_types"], silver["card_weaknesses"],
                                   silver["card_resistances"], silver["card_national_pokedex_numbers"])
    return {"card_main_info": main, "card_extras_flattened": extras}


# ----------------------------------------------------------------------------- quality



def cast_reject_report(bronze: DataFrame) -> DataFrame:
    """Q4: source values that do not convert (the source database would abort the load).

    One row per rejected value: card id, column and the text that failed.
    """
    bronze = as_typed(bronze)
    hp = cast_rejects(bronze.select(F.col("id").alias("card_id"), F.col("hp").alias("value")), "value", "int")
    number = bronze.select(F.col("id").alias("card_id"), F.col("number").alias("value"))
    number = cast_rejects(number, "value", "int", converted=sf.digits_from_code("value"))
    dex = _scalars(bronze, "national_pokedex_numbers", "value", lower=False)
    dex = cast_rejects(dex, "value", "int")
    parts = [hp.select("card_id", F.lit("hp").alias("column_name"), "value"),
             number.select("card_id", F.lit("number").alias("column_name"), "value"),
             dex.select("card_id", F.lit("national_pokedex_numbers").alias("column_name"), "value")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def length_report(table: str, df: DataFrame, key: str) -> DataFrame:
    """Q3: values longer than the gold width (the source database would raise)."""
    limits = {c: n for c, n in GOLD_WIDTHS[table].items() if c in df.columns}
    bad = length_violations(df, limits)
    return bad.select(F.lit(table).alias("table_name"), F.col(key).cast("string").alias("row_key"),
                      F.array_join("too_long", ",").alias("columns"))


# ----------------------------------------------------------------------------- gold

def dim_dates(spark: SparkSession) -> DataFrame:
    """The calendar over the source's fixed span."""
    return date_dimension(spark, DATE_DIM_START, DATE_DIM_END)


def dim_card_sets(card_set_df: DataFrame, target: DataFrame | None, load_ts: _dt.datetime) -> DataFrame:
    """One row per set (row number 1), merged type 1 with surrogate ``set_key``."""
    src = card_set_df.where(F.col("row_number") == 1).select(
        "set_id", "set_name", "set_series", "set_total_printed", "set_total_cards", "set_release_date",
        "set_update_date")
    src = keep_one(src, "set_id", ["set_update_date", "set_name"], latest=False)
    return merge_type1(target, src, "set_id", "set_key", "load_time_stamp", load_ts)


def dim_cards(main: DataFrame, legalities: DataFrame, attacks: DataFrame, abilities: DataFrame,
              card_set_df: DataFrame, sets_dim: DataFrame, target: DataFrame | None,
              load_ts: _dt.datetime) -> DataFrame:
    """Main info + legality + attack/ability counts + set key, merged type 1 (``card_key``)."""
    set_keys = card_set_df.select("card_id", "set_id").join(sets_dim.select("set_id", "set_key"), "set_id", "left")
    # One legality and one set per card, chosen deterministically if a card arrived twice.
    legal = keep_one(legalities.select("card_id", "legality"), "card_id", ["legality"], latest=False)
    one_set = keep_one(set_keys.select("card_id", "set_key"), "card_id", ["set_key"], latest=False)
    base = main.join(growing(legal), "card_id", "left").join(growing(one_set), "card_id", "left")
    counted = child_counts(base, "card_id", {
        "number_of_attacks": (attacks, "attack_name", True),
        "number_of_abilities": (abilities, None, False),
    })
    src = counted.select("set_key", "card_id", "card_name", "supertype", "evolution_tier", "artist",
                         "set_card_rarity", "set_card_number", "legality",
                         F.col("number_of_attacks").cast("int").alias("number_of_attacks"),
                         F.col("number_of_abilities").cast("int").alias("number_of_abilities"), "hp")
    src = keep_one(src, "card_id", ["card_name", "set_card_number"], latest=False)
    return merge_type1(target, src, "card_id", "card_key", "load_time_stamp", load_ts)


def dim_cards_extra_info(extras: DataFrame, images: DataFrame, cards_dim: DataFrame,
                         target: DataFrame | None) -> DataFrame:
    """The flattened lists and image URLs, keyed by ``card_key``."""
    one_image = keep_one(images, "card_id", ["small_image_url", "large_image_url"], latest=False)
    src = (extras.join(growing(one_image), "card_id", "left")
           .join(growing(cards_dim.select("card_id", "card_key")), "card_id", "inner")
           .select("card_key", "subtype_list", "type_list", "resistances_list", "weaknesses_list", "pokedex_list",
                   "small_image_url", "large_image_url"))
    return merge_type1(target, src, "card_key", None)


FACT_GRAIN = ["date_id", "card_key", "printing_finish_rarity"]


def fact_candidates(tcg: DataFrame, cards_dim: DataFrame, dates_dim: DataFrame, sets_dim: DataFrame) -> DataFrame:
    """J1 + J2: today's prices with card, set and date keys (before the history check)."""
    dates = dates_dim.select(F.col("date_id").alias("d_date_id"), "full_date")
    j = (cards_dim.select("card_key", "card_id", "set_key")
         .join(growing(tcg), "card_id", "inner")
         # dim_dates holds one row per day of a fixed span: a bounded broadcast.
         .join(F.broadcast(dates), F.col("date_id") == F.col("d_date_id"), "left")
         .join(sets_dim.select(F.col("set_key").alias("s_set_key")), F.col("set_key") == F.col("s_set_key"), "left"))
    return j.select("card_key", F.col("s_set_key").alias("set_key"), F.col("d_date_id").alias("date_id"),
                    "full_date", "printing_finish_rarity", "market_price", "highest_price", "lowest_price")


def fact_rows(candidates: DataFrame, days: DataFrame, history: DataFrame | None, log_ts: _dt.datetime) -> DataFrame:
    """D8 = J1 + J2 + J5: the candidates not yet stored at (date_id, card_key, finish).

    days: the price table, whose ``date_id`` values bound the part of the history that is read.
    """
    # One row per grain inside the batch (a card listed twice in the day's documents), as the
    # primary key demands; a partial aggregate, so a repeated card is combined map-side.
    rows = keep_one(candidates.where(F.col("date_id").isNotNull()), FACT_GRAIN,
                    ["market_price", "highest_price", "lowest_price", "set_key", "full_date"], latest=False)
    new = new_facts(rows, history, FACT_GRAIN, prune_col="date_id", days=days)
    return new.withColumn("log_created", sf.ts_literal(log_ts))


def fact_rejects(candidates: DataFrame, log_ts: _dt.datetime) -> DataFrame:
    """Q2 before D8: price rows whose grain has a NULL part (e.g. a day outside dim_dates);
    the source's primary key would reject the whole load, here they are kept aside."""
    _, bad = split_null_grain(candidates, FACT_GRAIN)
    return bad.withColumn("log_created", sf.ts_literal(log_ts))
