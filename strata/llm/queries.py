"""The registered queries of this subpackage, each an operator over its whole intended table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    audit,
    decontaminate,
    embeddings,
    mixing,
    oracle,
    quality,
    repeats,
    sharding,
    simhash,
    substring,
    token_counts,
    toxicity,
    urls,
    warc,
)
from strata.llm.common import table
from strata.session import scratch_path, spread


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.weigh(table(spark, sf_dir, "documents"))
    return out.withColumns({c: F.round(c, 6) for c in ("weight", "probability")})


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("mark")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches: every document under two tokenizers; then toxic documents are withdrawn, and bad
    ones are counted anew without signs; the last batch comes twice."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    totals = token_counts.TokenTotals(spark, scratch_path(spark, "token-totals"))
    for version in token_counts.PATTERNS:
        totals.apply(f"insert-{version}", token_counts.pattern_counts(docs, [version]))
    toxic = labels.where("toxic = 1").select("doc_id")
    bad = labels.where("quality = 0").select("doc_id").join(toxic, "doc_id", "left_anti").distinct()
    keys = F.explode(F.array(*map(F.lit, token_counts.PATTERNS))).alias("tokenizer")
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("source", "string"), ("lang", "string"), ("n_tokens", "long"))]
    totals.apply("withdraw", toxic.select("doc_id", keys, *nothing, F.lit("delete").alias("op")))
    clean = F.regexp_replace("text", r"[!-/:-@\[-`{-~]+", "")
    # Counted before the join, and with an inner join: a semi-join would go below the counting,
    # and whole texts would be shuffled.
    revised = token_counts.pattern_counts(docs, op="revise", text=clean).join(bad, "doc_id")
    for _ in range(2):
        totals.apply("revise", revised)
    return totals.totals()


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("mark")


def _list_entries(pages: DataFrame) -> DataFrame:
    """Two dated lists from the captures themselves: a path's first segment is blocked by "tracking"
    on days with a tracking parameter and allowed on days without; "farms" blocks a domain from the
    day of its first capture of a host named so, and allows a path on it from its tenth day."""
    day = F.col("fetched").cast("date").alias("day")
    parts = pages.select(urls.host_of(F.col("url")).alias("host"), F.regexp_extract("url", r"://[^/?#]*/([^/?#]+)", 1).alias("top"),
                         F.col("url").contains("utm_").alias("utm"), day).where("host <> ''")
    tracking = parts.where("top <> ''").groupBy("host", "top", "day").agg(F.max("utm").alias("utm")).select(
        F.lit("tracking").alias("list"), F.concat("host", F.lit("/"), "top").alias("pattern"),
        F.when(F.col("utm"), "block").otherwise("allow").alias("action"), "day")
    farms = parts.where(F.col("host").contains("farm") | F.col("host").startswith("blog.")).groupBy("host").agg(F.min("day").alias("day"))
    blocked = farms.select(F.lit("farms").alias("list"), F.concat(F.lit("."), "host").alias("pattern"),
                           F.lit("block").alias("action"), "day")
    allowed = farms.select(F.lit("farms").alias("list"), F.concat("host", F.lit("/en")).alias("pattern"),
                           F.lit("allow").alias("action"), F.date_add("day", 10).alias("day"))
    return tracking.union(blocked).union(allowed)


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The pages carry no fetch time: one capture an hour, in the order of their ids.
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.timestamp_seconds(F.col("page_id") * 3600).alias("fetched"))
    return urls.evaluate(pages, _list_entries(pages))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The pages carry no fetch time: one capture a minute, in the order of their ids.
    pages = table(spark, sf_dir, "pages").withColumn("fetched", F.timestamp_seconds(F.col("page_id") * 60))
    index = warc.archive_and_index(pages, time_col="fetched")
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(repeats.periodic_runs(repeats.planted(spread(table(spark, sf_dir, "documents")))))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shards(table(spark, sf_dir, "documents"))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_mixing, op3_substring_dedup, op4_quality_classifier, op5_token_counts,
    op6_simhash_near_dedup, op7_url_filters, op8_embedding_near_dedup, op9_warc, op10_toxicity,
    op11_periodic_runs, op12_sharding, op13_filter_audit)}
ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": oracle.DECONTAMINATION, "op2_mixing": oracle.MIXING, "op5_token_counts": oracle.TOKEN_COUNTS,
    "op7_url_filters": oracle.URL_FILTERS, "op8_embedding_near_dedup": oracle.EMBEDDINGS, "op9_warc": oracle.WARC,
    "op11_periodic_runs": oracle.PERIODIC_RUNS, "op12_sharding": oracle.SHARDING, "op13_filter_audit": oracle.FILTER_AUDIT}
