"""One commit for a whole layer: torn loads are never seen, and two writers never both win."""

import os

import pytest
from pyspark.sql import functions as F

from strata.plans import loads
from strata.sources import CommitConflictError, LayerCommit, clean_layer, layer_path, read_table
from strata.sources import commits, tables
from tests.conftest import AS_OF

GOLD = ("dim_card_sets", "dim_cards", "dim_cards_extra_info", "dim_dates", "fact_hst_tcg_data")


def _state(spark, root):
    return {t: sorted(map(str, df.collect())) if (df := read_table(spark, layer_path(root, "gold", t))) is not None else None
            for t in GOLD}


def test_reads_see_a_commit_whole(spark, tmp_root):
    rows = lambda n: spark.range(n).withColumn("day", F.col("id") % 2)
    first = LayerCommit(spark, tmp_root)
    assert first.read("dim") is None and first.read("fact", rows(0).schema).count() == 0
    first.replace(rows(3), "dim")
    first.append(rows(4), "fact", partition_by=["day"])
    assert first.read("dim").count() == 3 and read_table(spark, f"{tmp_root}/dim") is None
    assert first.commit() == 1
    second = LayerCommit(spark, tmp_root)
    second.append(rows(6), "fact", partition_by=["day"])
    second.append(rows(0), "fact", partition_by=["day"])
    assert second.read("fact").count() == 10 and read_table(spark, f"{tmp_root}/fact").count() == 4
    second.commit()
    fact = read_table(spark, f"{tmp_root}/fact")
    assert fact.columns == ["id", "day"] and fact.where("day = 1").count() == 5
    # A table of many appends becomes one version again.
    third = LayerCommit(spark, tmp_root)
    third.replace(third.read("fact"), "fact", partition_by=["day"])
    third.commit()
    assert read_table(spark, f"{tmp_root}/fact").count() == 10 and len(tables.published_paths(spark, f"{tmp_root}/fact")) == 1
    assert LayerCommit(spark, tmp_root).commit() == 0


def test_two_writers(spark, tmp_root):
    a, b, c = (LayerCommit(spark, tmp_root) for _ in range(3))
    for w in (a, b):
        w.append(spark.range(2), "fact")
    c.replace(spark.range(5), "other")
    assert len(os.listdir(f"{tmp_root}/fact/_claims")) >= 2  # each has a folder of its own
    a.commit()
    with pytest.raises(CommitConflictError, match="fact"):
        b.commit()
    c.commit()  # touched nothing that a changed
    assert read_table(spark, f"{tmp_root}/fact").count() == 2 and read_table(spark, f"{tmp_root}/other").count() == 5
    # A reader's basis may not move either: what it made of it would be stale.
    reader, writer = LayerCommit(spark, tmp_root), LayerCommit(spark, tmp_root)
    reader.append(reader.read("other"), "fact")
    writer.replace(spark.range(1), "other")
    writer.commit()
    with pytest.raises(CommitConflictError, match="other"):
        reader.commit()


def test_a_number_is_taken_once(spark, tmp_root, monkeypatch):
    """Another writer commits between this one's look at the log and its claim."""
    a = LayerCommit(spark, tmp_root)
    a.replace(spark.range(1), "x")
    claim, others = tables._claim_manifest, []

    def late(spark, layer_dir, number, entries):
        if not others:
            others.append(number)
            assert claim(spark, layer_dir, number, {"y": [7]})
        return claim(spark, layer_dir, number, entries)

    monkeypatch.setattr(tables, "_claim_manifest", late)
    assert a.commit() == others[0] + 1
    assert tables._whole_manifest(spark, tmp_root)[1] == {"x": [1], "y": [7]}


def test_clean_layer(spark, tmp_root):
    for n in (1, 2, 3):
        w = LayerCommit(spark, tmp_root)
        w.replace(spark.range(n), "t")
        w.commit()
    lost = LayerCommit(spark, tmp_root)
    lost.replace(spark.range(9), "t")
    assert clean_layer(spark, tmp_root) == []  # may still be written to
    assert sorted(clean_layer(spark, tmp_root, older_than_s=0)) == ["t/1", "t/4"]
    assert read_table(spark, f"{tmp_root}/t").count() == 3


def test_a_load_killed_between_any_two_writes(spark, tmp_root, cards_file, monkeypatch):
    day2 = AS_OF.replace(day=21)
    loads.run(spark, tmp_root, AS_OF, source=cards_file)
    before = _state(spark, tmp_root)
    assert all(before.values())
    silver = read_table(spark, layer_path(tmp_root, "silver", "mkt_tcgplayer")).withColumn("date_id", F.col("date_id") + 1)
    tables.replace_table(silver, layer_path(tmp_root, "silver", "mkt_tcgplayer"))  # prices of another day
    write, commit = LayerCommit._write, LayerCommit.commit

    def killed_at(step):
        made = []

        def maybe(fn):
            def run(self, *args, **kw):
                out = fn(self, *args, **kw) if step > 0 or fn is write else None
                made.append(fn)
                if len(made) == abs(step) or (step == 0 and fn is commit):
                    raise KeyboardInterrupt("killed")
                return out
            return run
        monkeypatch.setattr(LayerCommit, "_write", maybe(write))
        monkeypatch.setattr(LayerCommit, "commit", maybe(commit))

    for step in (1, 2, 3, 4, 0):  # after each write; 0: before the commit
        killed_at(step)
        with pytest.raises(KeyboardInterrupt):
            loads.load_gold(spark, tmp_root, day2)
        assert _state(spark, tmp_root) == before
    monkeypatch.setattr(LayerCommit, "_write", write)
    monkeypatch.setattr(LayerCommit, "commit", commit)
    loads.load_gold(spark, tmp_root, day2)
    after = _state(spark, tmp_root)
    assert len(after["fact_hst_tcg_data"]) == 2 * len(before["fact_hst_tcg_data"])
    loads.load_gold(spark, tmp_root, day2)
    assert _state(spark, tmp_root)["fact_hst_tcg_data"] == after["fact_hst_tcg_data"]
    assert commits.BUCKET not in "".join(GOLD)


def _dim(spark, rows):
    return spark.createDataFrame(rows, "id string, v string, w double")


def test_a_merge_rewrites_only_buckets_that_change(spark, tmp_root):
    from strata.operators.bucketed import merge_bucketed, read_bucketed

    def merge(rows, day, n=8):
        layer = LayerCommit(spark, tmp_root)
        buckets = merge_bucketed(layer, "dim", _dim(spark, rows), "id", "key", "at", AS_OF.replace(day=day), n_buckets=n)
        layer.commit()
        return buckets

    def rows():
        return {r.id: (r.key, r.v, r.w, r["at"].day) for r in read_bucketed(LayerCommit(spark, tmp_root), "dim").collect()}

    ids = [f"c{i:02d}" for i in range(40)]
    assert read_bucketed(LayerCommit(spark, tmp_root), "dim") is None
    assert len(merge([(i, "a", 1.0) for i in ids] + [(None, "x", 0.0)], 1)) > 4
    assert rows() == {x: (k + 1, "a", 1.0, 1) for k, x in enumerate(ids)}
    before = tables._whole_manifest(spark, tmp_root)[1]
    assert merge([("c07", "b", None), ("c08", "a", 1.0)], 2, n=3) != []  # the first number of buckets stays
    after = tables._whole_manifest(spark, tmp_root)[1]
    assert len({n for n in after if after[n] != before.get(n)}) == 1
    written = [f for f in os.listdir(tables.version_path(f"{tmp_root}/dim", 2)) if f.startswith("__bucket=")]
    assert len(written) == 1
    assert rows() == {x: (k + 1, "a", 1.0, 1) for k, x in enumerate(ids)} | {"c07": (8, "b", None, 2)}
    # The same again changes nothing; then a NULL is overwritten, and two cards are new.
    assert merge([("c07", "b", None)], 3) == []
    merge([("c07", "b", 2.0), ("b99", None, None), ("z", "new", 3.0)], 4)
    want = {x: (k + 1, "a", 1.0, 1) for k, x in enumerate(ids)}
    assert rows() == want | {"c07": (8, "b", 2.0, 4), "b99": (41, None, None, 4), "z": (42, "new", 3.0, 4)}
    # Two merges at once: the second sees that its basis has moved.
    one, two = LayerCommit(spark, tmp_root), LayerCommit(spark, tmp_root)
    for layer in (one, two):
        merge_bucketed(layer, "dim", _dim(spark, [("c01", "c", 1.0)]), "id", "key", "at", AS_OF)
    one.commit()
    with pytest.raises(CommitConflictError):
        two.commit()
