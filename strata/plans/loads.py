"""The daily load procedures: ``load_bronze``, ``load_silver``, ``load_gold`` and ``run``.

Tables live under ``root/<layer>/<table>``. Bronze and silver are full refreshes written as
new versions and published after the whole layer is written; gold dimensions are merged and new facts
appended, partitioned by ``date_id``, in one commit. Each step is audited; errors are recorded and
re-raised (a failed layer is never published).

Input that cannot be loaded never gets that far. Documents are written once to an unpublished bronze
version, split by whether they are cards; the others (text that is no JSON document, cards without an
id) go to ``audit/bronze_rejects``, and if a document was damaged the load raises before anything is
published. Report tables hold one folder per run day, which a repeated run of that day replaces.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import functions as sf
from strata.operators import RunAudit
from strata.plans import cards
from strata.plans.fixed_values import STREAM_RUN_HOUR_UTC
from strata.session import ensure_checkpoint_dir, scratch_path
from strata.sources import (CORRUPT_COLUMN, LayerCommit, clean_layer, dated_path, land_pages, layer_path,
                            publish_versions, read_table, replace_table, with_corrupt_column, write_day)
from strata.sources.tables import version_path
from strata.streaming import run_stream


class MalformedInputError(RuntimeError):
    """A source document could not be parsed; nothing was published."""


def _bronze_path(root: str) -> str:
    return layer_path(root, "bronze", "cards_json_raw")


def read_bronze_table(spark: SparkSession, root: str) -> DataFrame:
    """The current bronze cards (rejected rows are in another partition, which is not read)."""
    # A partition value comes back as text where the schema is read from the files.
    return read_table(spark, _bronze_path(root)).where("cast(accepted AS boolean)").drop("accepted", CORRUPT_COLUMN)


def _store_bronze(spark: SparkSession, root: str, bronze: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """Write bronze, put rows that are no cards aside, and publish unless a document was damaged."""
    path = _bronze_path(root)
    if CORRUPT_COLUMN not in bronze.columns:
        bronze = bronze.withColumn(CORRUPT_COLUMN, F.lit(None).cast("string"))
    # A multi-line document is read by one task per file: REBALANCE makes bronze many even files.
    rows = bronze.withColumn("accepted", cards.accepted(bronze)).hint("rebalance")
    version = replace_table(rows, path, partition_by=["accepted"], publish=False)
    written = spark.read.schema(rows.schema).parquet(version_path(path, version))
    write_day(written.where("not accepted").select("id", "name", CORRUPT_COLUMN), layer_path(root, "audit", "bronze_rejects"), as_of)
    damaged = written.where(F.col(CORRUPT_COLUMN).isNotNull()).count()
    if damaged:
        raise MalformedInputError(f"{damaged} damaged source document(s), kept in audit/bronze_rejects; nothing was published")
    publish_versions(spark, {path: version})
    return read_bronze_table(spark, root)


def load_bronze(spark: SparkSession, root: str, source: str | list[str], as_of: _dt.datetime,
                multi_line: bool = True, audit: RunAudit | None = None, split: bool = False) -> DataFrame:
    """Parse the day's document once into typed Parquet (splittable, nested-column pruned).

    ``split``: a document of any size is read by many tasks, whether it spans lines or not.
    """
    return _store_bronze(spark, root, cards.read_bronze(spark, source, as_of, multi_line, keep_corrupt=True, split=split), as_of)


def load_bronze_frame(spark: SparkSession, root: str, docs: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """Typed bronze from documents already read (a stream micro-batch, for instance)."""
    return _store_bronze(spark, root, cards.bronze_from_documents(docs, as_of), as_of)


def load_bronze_from_pages(spark: SparkSession, root: str, pages_dir: str, as_of: _dt.datetime,
                           multi_line: bool = False) -> DataFrame:
    """S12 + D1: bronze from the extractor's page files (``{"data": [card, ...]}``).

    A resumed extract fetches its last page again, so a card can sit on two pages; one row per
    card id is kept (the latest page wins), then typed bronze is written as usual.
    """
    cards_df = land_pages(spark, pages_dir, cards.CARD_SCHEMA, "id", multi_line=multi_line, keep_corrupt=True)
    return _store_bronze(spark, root, cards.bronze_from_documents(cards_df, as_of), as_of)


def load_silver(spark: SparkSession, root: str, as_of: _dt.datetime, audit: RunAudit | None = None,
                numbering: str = "range", parallel: int = 4) -> dict[str, DataFrame]:
    """Write the 15 silver tables as new versions, then publish them together.

    The 13 tables that read only bronze are independent jobs: they are submitted from a small
    thread pool so their scheduling overlaps (Spark runs concurrent jobs of one session), and
    the hierarchy tiers for ``card_main_info`` are computed alongside them.
    """
    bronze = read_bronze_table(spark, root)
    typed_bronze = cards.as_typed(bronze)
    first = cards.silver_builders(as_of, numbering)
    paths = {name: layer_path(root, "silver", name) for name in [*first, "card_main_info", "card_extras_flattened"]}

    def write_one(name: str, df: DataFrame) -> int:
        sort = ["set_id"] if name == "card_set" else []
        return _write(audit, f"silver.{name}", df,
                      lambda d: replace_table(d, paths[name], sort_within=sort, publish=False))

    written: dict[str, int] = {}
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        tiers_job = pool.submit(cards.evolution_tiers, bronze)
        # Each task builds its table too, so eager steps (card_set's numbering) overlap the rest.
        jobs = {name: pool.submit(lambda n=name, b=build: write_one(n, b(typed_bronze)))
                for name, build in first.items()}
        for name, job in jobs.items():
            written[name] = job.result()
        tiers = tiers_job.result()
    # Dependent tables read the freshly written (not yet published) versions.
    fresh = {name: spark.read.parquet(version_path(paths[name], written[name])) for name in first}
    for name, df in cards.build_silver_dependent(bronze, fresh, tiers).items():
        written[name] = write_one(name, df)
    publish_versions(spark, {paths[n]: v for n, v in written.items()})
    return {name: read_table(spark, path) for name, path in paths.items()}


def load_gold(spark: SparkSession, root: str, as_of: _dt.datetime, audit: RunAudit | None = None) -> None:
    """Merge the dimensions and append the new facts, as one commit of the gold layer.

    A load that fails leaves gold as it was. If another load commits meanwhile this one raises
    ``CommitConflictError``; run again, it starts from what the other made.
    """
    silver = {n: read_table(spark, layer_path(root, "silver", n)) for n in
              ["card_set", "card_main_info", "card_legalities", "card_attacks", "card_abilities",
               "card_extras_flattened", "card_images", "mkt_tcgplayer"]}
    gold = LayerCommit(spark, layer_path(root, "gold", "").rstrip("/"))
    sets = cards.dim_card_sets(silver["card_set"], gold.read("dim_card_sets"), as_of)
    with ThreadPoolExecutor(max_workers=3) as pool:
        # Independent steps run as concurrent jobs: dim_dates with dim_card_sets, then the
        # extra-info dimension, the reject table and the fact append.
        first = [pool.submit(_write, audit, "gold.dim_card_sets", sets, lambda d: gold.replace(d, "dim_card_sets"))]
        if gold.read("dim_dates") is None:
            first.append(pool.submit(_write, audit, "gold.dim_dates", cards.dim_dates(spark),
                                     lambda d: gold.replace(d, "dim_dates")))
        for job in first:
            job.result()
        sets_dim = gold.read("dim_card_sets")
        cards_df = cards.dim_cards(silver["card_main_info"], silver["card_legalities"], silver["card_attacks"],
                                   silver["card_abilities"], silver["card_set"], sets_dim, gold.read("dim_cards"), as_of)
        _write(audit, "gold.dim_cards", cards_df, lambda d: gold.replace(d, "dim_cards"))
        cards_dim = gold.read("dim_cards")
        extra = cards.dim_cards_extra_info(silver["card_extras_flattened"], silver["card_images"], cards_dim,
                                           gold.read("dim_cards_extra_info"))
        # The candidates (three joins) are written once; rejects and new facts both read them.
        path = scratch_path(spark, "fact-candidates")
        cards.fact_candidates(silver["mkt_tcgplayer"], cards_dim, gold.read("dim_dates"), sets_dim).write.parquet(path)
        candidates = spark.read.parquet(path)
        rejects = cards.fact_rejects(candidates, as_of)
        new = cards.fact_rows(candidates, silver["mkt_tcgplayer"].select("date_id"), gold.read("fact_hst_tcg_data"), as_of)
        last = [
            pool.submit(_write, audit, "gold.dim_cards_extra_info", extra, lambda d: gold.replace(d, "dim_cards_extra_info")),
            pool.submit(_write, audit, "gold.fact_rejects", rejects,
                        lambda d: write_day(d, layer_path(root, "audit", "fact_rejects"), as_of)),
            pool.submit(_write, audit, "gold.fact_hst_tcg_data", new,
                        lambda d: gold.append(d, "fact_hst_tcg_data", partition_by=["date_id"], sort_within=["card_key"])),
        ]
        for job in last:
            job.result()
    # Dimensions and facts become visible together, or not at all.
    gold.commit()
    clean_layer(spark, gold.layer_dir)


def load_cast_rejects(spark: SparkSession, root: str, as_of: _dt.datetime, audit: RunAudit | None = None) -> None:
    """Q4 report of the run (reads bronze only), the run day's part of ``audit/cast_rejects``."""
    stamp = sf.ts_literal(as_of).alias("run_as_of")
    bronze = read_bronze_table(spark, root)
    casts = cards.cast_reject_report(bronze).select("*", stamp)
    _write(audit, "quality.cast_rejects", casts,
           lambda d: write_day(d, layer_path(root, "audit", "cast_rejects"), as_of))


def load_quality(spark: SparkSession, root: str, as_of: _dt.datetime, audit: RunAudit | None = None) -> None:
    """Q3 report of the run (reads gold), the run day's part of ``audit/length_violations``
    (reported, never silently dropped). A table without data files has nothing to report."""
    stamp = sf.ts_literal(as_of).alias("run_as_of")
    keys = {"dim_cards": "card_id", "dim_cards_extra_info": "card_key", "dim_card_sets": "set_id",
            "fact_hst_tcg_data": "card_key"}
    tables = {t: read_table(spark, layer_path(root, "gold", t)) for t in keys}
    reports = [cards.length_report(t, df, keys[t]) for t, df in tables.items() if df is not None]
    lengths = reports[0]
    for r in reports[1:]:
        lengths = lengths.unionByName(r)
    _write(audit, "quality.length_violations", lengths.select("*", stamp),
           lambda d: write_day(d, layer_path(root, "audit", "length_violations"), as_of))


def _write(audit: RunAudit | None, name: str, df: DataFrame, writer):
    return audit.write(name, df, writer) if audit is not None else writer(df)


def run(spark: SparkSession, root: str, as_of: _dt.datetime, source: str | list[str] | None = None,
        landing_dir: str | None = None, multi_line: bool = True, numbering: str = "range",
        pages_dir: str | None = None, docs: DataFrame | None = None, split: bool = False) -> RunAudit:
    """The whole daily load: bronze, silver, gold, quality, with one audit row per step.

    The input is, in order of precedence: ``docs`` (documents already read), ``pages_dir`` (the
    extractor's page files, deduped), ``source`` (document paths), or the run day's dated
    document under ``landing_dir``. ``split`` reads these documents by many tasks.
    """
    ensure_checkpoint_dir(spark)
    audit = RunAudit(spark, uuid.uuid4().hex, layer_path(root, "audit", "runs"))
    if docs is not None:
        audit.step("bronze", load_bronze_frame, spark, root, docs, as_of)
    elif pages_dir is not None:
        audit.step("bronze", load_bronze_from_pages, spark, root, pages_dir, as_of)
    else:
        if source is None:
            run_day = as_of + _dt.timedelta(hours=cards.CLOCK_OFFSET_HOURS)
            source = dated_path(landing_dir, run_day)
        audit.step("bronze", load_bronze, spark, root, source, as_of, multi_line, split=split)
    audit.step("silver", load_silver, spark, root, as_of, audit, numbering)
    with ThreadPoolExecutor(max_workers=1) as pool:
        # The cast report reads bronze only, so it runs while gold is loaded.
        casts = pool.submit(audit.step, "quality.casts", load_cast_rejects, spark, root, as_of, audit)
        audit.step("gold", load_gold, spark, root, as_of, audit)
        casts.result()
    audit.step("quality", load_quality, spark, root, as_of, audit)
    audit.flush()
    return audit


def stream_days(spark: SparkSession, root: str, landing_dir: str, checkpoint: str, multi_line: bool = True,
                max_files_per_trigger: int | None = 64, run_hour_utc: int = STREAM_RUN_HOUR_UTC) -> None:
    """Load every dated document not processed yet, as an available-now stream.

    The file source's checkpoint makes each file count once. A micro-batch may hold several
    days; they are loaded in day order, each with its own run clock, through the same ``run``
    as the batch load. A replayed micro-batch adds no fact rows (the fact load is an anti-join).
    The day list per batch is bounded by the files in the trigger (``max_files_per_trigger``).

    A file whose name has no day cannot be loaded: its cards go to ``audit/undated_rejects`` (one
    folder per micro-batch), and the dated files beside it load. A damaged document raises and
    leaves its micro-batch unprocessed.
    """
    def transform(stream: DataFrame) -> DataFrame:
        name = F.col("_metadata.file_name")
        return (stream.withColumn("__file", name)
                .withColumn("__day", F.try_to_date(F.regexp_extract(name, r"(\d{8})", 1), "yyyyMMdd")))

    def load(batch: DataFrame, epoch: int) -> None:
        # The batch is read once per day below; keep it for the length of the micro-batch.
        batch = batch.persist()
        try:
            undated = batch.where(F.col("__day").isNull()).select("__file", "id", "name", CORRUPT_COLUMN)
            undated.write.mode("overwrite").parquet(f"{layer_path(root, 'audit', 'undated_rejects')}/epoch={epoch}")
            days = sorted(r["__day"] for r in batch.select("__day").distinct().collect() if r["__day"] is not None)
            for day in days:
                as_of = _dt.datetime(day.year, day.month, day.day, run_hour_utc)
                run(spark, root, as_of, docs=batch.where(F.col("__day") == F.lit(day)).drop("__day", "__file"))
        finally:
            batch.unpersist()

    run_stream(spark, landing_dir, with_corrupt_column(cards.CARD_SCHEMA), checkpoint, load, multi_line=multi_line,
               max_files_per_trigger=max_files_per_trigger, transform=transform)
