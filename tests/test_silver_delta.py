"""Silver by change feed equals a full refresh, and leaves unchanged cards alone."""

from strata.plans import cards
from strata.plans.silver_delta import PER_CARD, change_feed, read_changed, refresh_changed
from strata.sources import LayerCommit, tables
from tests.conftest import AS_OF, card, make_cards


def _bronze(spark, docs):
    return cards.bronze_from_documents(spark.createDataFrame(docs, cards.CARD_SCHEMA), AS_OF)


def _rows(df):
    return sorted(str(r.asDict(True)) for r in df.collect()) if df is not None else []


def test_second_day_equals_a_full_refresh(spark, tmp_root):
    many = [card(f"x-{i}", f"X{i}", types=["Sky"], subtypes=["Old"], hp="1") for i in range(40)]
    day1 = make_cards() + many
    day2 = [dict(d) for d in day1 if d["id"] != "k-2"] + [card("new", "New", types=["Stone", "Sky"])]
    next(d for d in day2 if d["id"] == "x-7")["types"] = ["Stone"]
    next(d for d in day2 if d["id"] == "x-8")["hp"] = "2"  # no table here uses it
    before, after = _bronze(spark, day1), _bronze(spark, day2)
    feed = {r.id: r.change for r in change_feed(before, after, "id", ("id", "types", "subtypes")).collect()}
    assert feed == {"k-2": "delete", "new": "insert", "x-7": "update"}
    some = {n: PER_CARD[n] for n in ("card_types", "card_attacks", "card_extras_flattened")}
    layer = LayerCommit(spark, tmp_root)
    refresh_changed(layer, None, before, some, n_buckets=64)
    layer.commit()
    entries = tables._whole_manifest(spark, tmp_root)[1]
    layer = LayerCommit(spark, tmp_root)
    buckets = refresh_changed(layer, before, after, some, n_buckets=5)
    layer.commit()
    assert len(buckets) <= 3
    now = tables._whole_manifest(spark, tmp_root)[1]
    assert {n.rpartition("-")[2] for n in now if now[n] != entries.get(n)} == {f"{b:06d}" for b in buckets}
    for name, build in some.items():
        assert _rows(read_changed(LayerCommit(spark, tmp_root), name)) == _rows(build(after)), name
    layer = LayerCommit(spark, tmp_root)
    assert refresh_changed(layer, after, after, some) == [] and layer.commit() == 0
