"""End-to-end bronze -> silver -> gold on an invented card document."""

import os

from pyspark.sql import functions as F

from conftest import AS_OF
from strata.plans import cards, loads
from strata.sources import layer_path, read_table


def _rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_bronze_silver_gold(spark, cards_file, tmp_root):
    root = os.path.join(tmp_root, "lake")
    audit = loads.run(spark, root, AS_OF, source=cards_file)
    assert {r["status"] for r in audit.frame().collect()} == {"succeeded"}
    s = lambda n: read_table(spark, layer_path(root, "silver", n))

    # Symbols that differ by case only count as one.
    att = s("card_attacks").where(F.col("card_id") == "k-1")
    assert _rows(att, "attack_name", "energy_needed", "energy_amount_neeed") == sorted(
        [("peck", "sky", 2)] * 2 + [("peck", "stone", 1), ("dive", "stone", 1)])
    # an attack with an empty cost vanishes
    assert s("card_attacks").where(F.col("card_id") == "k-2").count() == 0

    assert _rows(s("card_weaknesses"), "card_id", "weakness_type", "weakness_value") == [("k-1", "frost", "×9")]
    assert _rows(s("card_retreat_cost"), "card_id", "energy_type_to_retreat") == [("k-1", "sky"), ("k-1", "stone")]
    assert _rows(s("card_types"), "card_id", "type") == [("k-1", "sky")]
    assert _rows(s("card_national_pokedex_numbers"), "national_pokedex_number") == [(7,)]

    legal = dict(_rows(s("card_legalities"), "card_id", "legality"))
    assert legal == {"k-1": "Unlimited Only", "k-2": "Standard+", "k-3": "n/a"}

    cs = {r["card_id"]: r for r in s("card_set").collect()}
    assert set(cs) == {"k-1", "k-2", "k-3"}  # the other set has no images -> no row
    assert {c: r["set_card_number"] for c, r in cs.items()} == {"k-1": 1, "k-2": 12, "k-3": 0}
    assert str(cs["k-2"]["set_update_date"]) == "2016-08-10 09:00:00"
    assert str(cs["k-1"]["set_release_date"]) == "2015-06-07"
    assert {c: r["row_number"] for c, r in cs.items()} == {"k-1": 1, "k-3": 2, "k-2": 3}

    tcg = s("mkt_tcgplayer")
    rows = {(r["card_id"], r["printing_finish_rarity"]): r for r in tcg.collect()}
    assert ("k-3", "plain") not in rows  # 2025-12-01 is older than 20 days
    assert rows[("k-1", "foil")]["market_price"] == 7.25
    assert rows[("k-1", "foil")]["date_id"] == 20260115
    assert rows[("k-2", "plain")]["market_price"] == 2.0  # midpoint fallback
    assert rows[("k-2", "unheard")]["market_price"] is None

    main = {r["card_id"]: r for r in s("card_main_info").collect()}
    assert {c: r["evolution_tier"] for c, r in main.items()} == {"k-3": 1, "k-2": 2, "k-1": 3, "m-1": None}
    assert main["m-1"]["set_card_rarity"] == "special"
    assert main["m-1"]["description"] == "n/a"
    assert main["k-1"]["hp"] == 75

    ex = {r["card_id"]: r for r in s("card_extras_flattened").collect()}
    assert (ex["k-1"]["subtype_list"], ex["k-1"]["pokedex_list"], ex["m-1"]["type_list"]) == ("third", "7", "n/a")

    g = lambda n: read_table(spark, layer_path(root, "gold", n))
    assert g("dim_dates").count() == 18628
    dc = {r["card_id"]: r for r in g("dim_cards").collect()}
    assert sorted(r["card_key"] for r in dc.values()) == [1, 2, 3, 4]
    assert dc["k-1"]["number_of_attacks"] == 2
    assert dc["k-2"]["number_of_abilities"] == 1
    fact = g("fact_hst_tcg_data")
    n1 = fact.count()
    assert n1 == 6  # two finishes of each card but the one with an old price

    # Re-running the same day adds no fact rows; keys stay stable.
    loads.run(spark, root, AS_OF, source=cards_file)
    assert g("fact_hst_tcg_data").count() == n1
    dc2 = {r["card_id"]: r["card_key"] for r in g("dim_cards").collect()}
    assert dc2 == {k: v["card_key"] for k, v in dc.items()}
    audit_rows = read_table(spark, layer_path(root, "audit", "runs")).collect()
    assert {r["status"] for r in audit_rows} == {"succeeded"}


def test_bronze_schema_keeps_text_fields(spark, cards_file):
    b = cards.read_bronze(spark, cards_file, AS_OF)
    assert "evolves_from" in b.columns and "load_date" in b.columns
    assert b.where("id = 'k-1'").select("hp").first()[0] == "75"


def test_raw_text_bronze_gives_same_silver(spark, cards_file):
    typed = cards.read_bronze(spark, cards_file, AS_OF)
    raw = cards.read_bronze(spark, cards_file, AS_OF, raw=True)
    assert dict(raw.dtypes)["attacks"] == "string" and dict(typed.dtypes)["attacks"] != "string"
    a = cards.build_silver(typed, AS_OF, numbering="window")
    b = cards.build_silver(raw, AS_OF, numbering="window")
    for name in a:
        assert sorted(map(tuple, a[name].collect())) == sorted(map(tuple, b[name].collect())), name


def test_two_days_type1_and_history(spark, tmp_root):
    import datetime as dt
    import json

    from conftest import card, make_cards, price
    landing = os.path.join(tmp_root, "landing2")
    os.makedirs(landing)
    day1 = make_cards()
    with open(os.path.join(landing, "card_data_20260120.json"), "w") as fh:
        json.dump(day1, fh)
    root = os.path.join(tmp_root, "lake2")
    as_of1 = dt.datetime(2026, 1, 20, 12, 0)
    loads.run(spark, root, as_of1, landing_dir=landing)
    g = lambda n: read_table(spark, layer_path(root, "gold", n))
    keys1 = {r["card_id"]: r["card_key"] for r in g("dim_cards").collect()}
    facts1 = g("fact_hst_tcg_data").count()

    # Day 2: one card changes rarity, one disappears, one is new; prices move a day on.
    day2 = [c for c in make_cards() if c["id"] != "m-1"]
    day2[0]["rarity"] = "Secret"
    day2[0]["tcgplayer"]["updatedAt"] = "2026/01/16"
    day2.append(card("k-9", "Newcomer", tcgplayer=price("2026/01/15", plain={"market": 1.0}, foil={"market": 2.0})))
    with open(os.path.join(landing, "card_data_20260121.json"), "w") as fh:
        json.dump(day2, fh)
    as_of2 = dt.datetime(2026, 1, 21, 12, 0)
    loads.run(spark, root, as_of2, landing_dir=landing)
    dim = {r["card_id"]: r for r in g("dim_cards").collect()}
    assert {k: dim[k]["card_key"] for k in keys1} == keys1          # keys never change
    assert dim["k-9"]["card_key"] == max(keys1.values()) + 1      # new card: next key
    assert "m-1" in dim                                          # discontinued card kept
    assert dim["k-1"]["set_card_rarity"] == "secret"             # type-1 overwrite
    assert dim["k-1"]["load_time_stamp"] == as_of2
    assert dim["m-1"]["load_time_stamp"] == as_of1
    fact = g("fact_hst_tcg_data")
    # New: the changed card's next day and the new card's, two finishes each; unchanged days are
    # already stored and are not added again.
    assert fact.count() == facts1 + 4
    assert fact.groupBy("date_id", "card_key", "printing_finish_rarity").count().where("count > 1").count() == 0


def test_quality_reports(spark, tmp_root):
    import json

    from conftest import card, kite_set, price
    landing = os.path.join(tmp_root, "landing3")
    os.makedirs(landing)
    bad = card("q-1", "Oddity", hp="abc", number="1a2", nationalPokedexNumbers=["x1", 7], artist="a" * 300, set=kite_set(),
               tcgplayer=price("2026/01/15", plain={"market": 1.0}))
    with open(os.path.join(landing, "card_data_20260120.json"), "w") as fh:
        json.dump([bad, card("q-2", "Fine", hp="75")], fh)
    root = os.path.join(tmp_root, "lake3")
    loads.run(spark, root, AS_OF, landing_dir=landing)
    rejects = sorted((r["card_id"], r["column_name"], r["value"])
                     for r in read_table(spark, layer_path(root, "audit", "cast_rejects")).collect())
    assert rejects == [("q-1", "hp", "abc"), ("q-1", "national_pokedex_numbers", "x1"),
                       ("q-1", "number", "1a2")]
    too_long = [(r["table_name"], r["row_key"], r["columns"])
                for r in read_table(spark, layer_path(root, "audit", "length_violations")).collect()]
    assert ("dim_cards", "q-1", "artist") in too_long
    main = {r["card_id"]: r for r in read_table(spark, layer_path(root, "silver", "card_main_info")).collect()}
    assert main["q-1"]["hp"] is None and main["q-2"]["hp"] == 75


def test_load_from_overlapping_pages(spark, tmp_root):
    import json

    from conftest import make_cards
    pages = os.path.join(tmp_root, "pages")
    os.makedirs(pages)
    cs = make_cards()
    stale = json.loads(json.dumps(cs[1]))
    stale["rarity"] = "Old Value"
    # Page 2 repeats the last card of page 1 (a resumed extract); the later page wins.
    with open(os.path.join(pages, "page_0001.json"), "w") as fh:
        fh.write(json.dumps({"page": 1, "data": [cs[0], stale]}) + "\n")
    with open(os.path.join(pages, "page_0002.json"), "w") as fh:
        fh.write(json.dumps({"page": 2, "data": [cs[1], cs[2], cs[3]]}) + "\n")
    root = os.path.join(tmp_root, "lake4")
    loads.run(spark, root, AS_OF, pages_dir=pages)
    bronze = read_table(spark, layer_path(root, "bronze", "cards_json_raw"))
    assert bronze.count() == 4 and bronze.select("id").distinct().count() == 4
    main = {r["card_id"]: r for r in read_table(spark, layer_path(root, "silver", "card_main_info")).collect()}
    assert main["k-2"]["set_card_rarity"] == "plain"
    assert read_table(spark, layer_path(root, "gold", "fact_hst_tcg_data")).count() == 6


def test_stream_days_exactly_once(spark, tmp_root):
    import json

    from conftest import make_cards
    landing = os.path.join(tmp_root, "stream_in")
    os.makedirs(landing)
    cs = make_cards()
    with open(os.path.join(landing, "card_data_20260120.json"), "w") as fh:
        json.dump(cs, fh)
    root = os.path.join(tmp_root, "lake5")
    ck = os.path.join(tmp_root, "stream_ck")
    loads.stream_days(spark, root, landing, ck)
    fact = lambda: read_table(spark, layer_path(root, "gold", "fact_hst_tcg_data"))
    n1 = fact().count()
    assert n1 == 6
    loads.stream_days(spark, root, landing, ck)       # nothing new: the checkpoint remembers the file
    assert fact().count() == n1
    cs[0]["tcgplayer"] = dict(cs[0]["tcgplayer"], updatedAt="2026/01/20")
    with open(os.path.join(landing, "card_data_20260121.json"), "w") as fh:
        json.dump(cs, fh)
    loads.stream_days(spark, root, landing, ck)       # only the new day is loaded
    assert fact().count() == n1 + 2
    runs = read_table(spark, layer_path(root, "audit", "runs"))
    assert runs.select("run_id").distinct().count() == 2


def test_case_insensitive_matches(spark, tmp_root):
    import json

    from conftest import card
    landing = os.path.join(tmp_root, "ci")
    os.makedirs(landing)
    root_card = card("s-1", "Acorn")
    child = card("s-2", "Oak", evolvesFrom="ACORN", attacks=[{"name": "Fall", "cost": ["Leaf", "leaf", "Bark"],
                                                              "convertedEnergyCost": 3}])
    f = os.path.join(landing, "card_data_20260120.json")
    with open(f, "w") as fh:
        json.dump([root_card, child], fh)
    bronze = cards.read_bronze(spark, f, AS_OF)
    tiers = dict(cards.evolution_tiers(bronze).collect())
    assert tiers == {"acorn": 1, "oak": 2}
    att = cards.card_attacks(bronze).where("card_id = 's-2'")
    assert sorted((r["energy_needed"], r["energy_amount_neeed"]) for r in att.collect()) == [
        ("bark", 1), ("leaf", 2), ("leaf", 2)]
    exact = cards.card_attacks(bronze, case_insensitive=False).where("card_id = 's-2'")
    assert sorted(r["energy_amount_neeed"] for r in exact.collect()) == [1, 1, 1]


def test_card_listed_twice_gives_one_fact_row(spark, tmp_root):
    import json

    from conftest import make_cards
    landing = os.path.join(tmp_root, "dup")
    os.makedirs(landing)
    cs = make_cards()
    with open(os.path.join(landing, "card_data_20260120.json"), "w") as fh:
        json.dump(cs + [cs[0]], fh)  # the first card appears twice in the day's document
    root = os.path.join(tmp_root, "lake6")
    loads.run(spark, root, AS_OF, landing_dir=landing)
    fact = read_table(spark, layer_path(root, "gold", "fact_hst_tcg_data"))
    assert fact.count() == 6
    dims = read_table(spark, layer_path(root, "gold", "dim_cards"))
    assert dims.count() == 4 and dims.select("card_id").distinct().count() == 4
