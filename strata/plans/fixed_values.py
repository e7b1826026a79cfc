"""Fixed values of the source system that results depend on.

These are values, not logic: names, labels, widths and clock settings that must equal the
source's for the tables to come out the same. They are stated here together, in the order the
source uses them, and imported by ``strata.plans.cards`` and ``strata.plans.loads``.
"""

import datetime as _dt

# --- fixed values (must equal the source's) ---------------------------------------------------

# Bronze column names (source path -> column).
BRONZE_RENAMES = {"evolvesFrom": "evolves_from", "convertedRetreatCost": "converted_retreat_cost",
                  "flavorText": "flavor_text", "retreatCost": "retreat_cost",
                  "nationalPokedexNumbers": "national_pokedex_numbers"}

# cardmarket.prices: source name -> silver column name.
CARDMARKET_PRICE_NAMES = {
    "averageSellPrice": "average_sell_price", "lowPrice": "low_price", "trendPrice": "trend_price",
    "germanProLow": "german_pro_low", "suggestedPrice": "suggested_price", "reverseHoloSell": "reverse_holo_sell",
    "reverseHoloLow": "reverse_holo_low", "reverseHoloTrend": "reverse_holo_trend",
    "lowPriceExPlus": "low_price_ex_plus", "avg1": "avg_1", "avg7": "avg_7", "avg30": "avg_30",
    "reverseHoloAvg1": "reverse_holo_avg_1", "reverseHoloAvg7": "reverse_holo_avg_7",
    "reverseHoloAvg30": "reverse_holo_avg_30",
}

# Hour offset of the source's run clock.
CLOCK_OFFSET_HOURS = -5
# Freshness window of the daily prices, in days.
PRICE_FRESH_DAYS = 20
# String matches in the source run under a case-insensitive collation (names, energy symbols).
CASE_INSENSITIVE = True
# Legality labels, in precedence order (the first present format wins), and the fallback.
LEGALITY_LABELS = [("standard", "Standard+"), ("expanded", "Expanded+"), ("unlimited", "Unlimited Only")]
# Rarity when the card has none.
DEFAULT_RARITY = "special"
# Silver column name of the per-symbol energy count, spelled as in the source table.
ENERGY_COUNT_COLUMN = "energy_amount_neeed"

# Declared widths of gold text columns (the gold DDL narrows several silver columns).
GOLD_WIDTHS = {
    "dim_cards": {"card_id": 50, "card_name": 200, "supertype": 50, "artist": 255, "set_card_rarity": 50,
                  "legality": 150},
    "dim_cards_extra_info": {"subtype_list": 50, "type_list": 50, "resistances_list": 50, "weaknesses_list": 50,
                             "pokedex_list": 50, "small_image_url": 200, "large_image_url": 200},
    "dim_card_sets": {"set_id": 50, "set_name": 255, "set_series": 255},
    "fact_hst_tcg_data": {"printing_finish_rarity": 50},
}
# Span of the date dimension.
DATE_DIM_START = _dt.date(2000, 1, 1)
DATE_DIM_END = _dt.date(2050, 12, 31)
# Run clock of a streamed day: the source runs at 02:00 in a zone 5 hours behind UTC.
STREAM_RUN_HOUR_UTC = 7
