"""URL lists with dates, joined to captures as of their fetch time.

A list is a log of dated entries: from its day on, a pattern is blocked or allowed, until the next entry
of the same list and pattern. Entries become validity intervals. A capture is looked up under every
pattern that could match its url: its host, the domains above it, and the beginnings of its path.
The as-of join is an equi-join on the pattern and a month, with a range condition on the day: an
interval is dealt to the months it covers within the captures' time, so a host that holds a third of
all captures is spread over months, and a capture meets only the few intervals of its month.

All steps are DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import staged

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _HOST, 1))


def _segments(url: Column) -> Column:
    return F.filter(F.split(F.regexp_extract(url, _PATH, 1), "/"), lambda s: s != "")


def patterns_of(url: Column) -> Column:
    """Array of (pattern, rank): the domains above and at the host (".example.org", rank 0), the host
    (rank 1), and host/segment, host/segment/segment, ... (rank 2). None for a url without a host."""
    host, parts = host_of(url), F.split(host_of(url), r"\.")
    segments = _segments(url)

    def of(pattern: Column, rank: int) -> Column:
        return F.struct(pattern.alias("pattern"), F.lit(rank).alias("rank"))

    def numbers(n: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), n), lambda i: i > 0)

    domains = F.transform(numbers(F.size(parts) - 1), lambda i: of(
        F.concat(F.lit("."), F.array_join(F.slice(parts, i, F.size(parts)), ".")), 0))
    prefixes = F.transform(numbers(F.size(segments)), lambda i: of(
        F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/")), 2))
    return F.when(F.length(host) > 0, F.concat(domains, F.array(of(host, 1)), prefixes))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, action, since, until) of a log (list, pattern, action, day); until is open (null)
    for the latest. Of entries on one day a block wins, so a pattern has one row a day at most."""
    daily = (entries.where("list is not null and pattern is not null and day is not null and action in ('block', 'allow')")
             .groupBy("list", "pattern", "day").agg(F.max("action").alias("action")))
    following = F.lead("day").over(Window.partitionBy("list", "pattern").orderBy("day"))
    return daily.select("list", "pattern", "action", F.col("day").alias("since"), following.alias("until"))


def evaluate(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
             time_col: str = "fetched") -> DataFrame:
    """page_id, n_active, blocked_by and decision, one row per row of ``captures``.

    n_active counts the entries that match and are active on the day of the fetch (UTC date of the
    timestamp in the session's zone). In each list the most specific decides: a path before a host
    before a domain, and the longer one. blocked_by has the lists that decide to block, sorted and
    comma-joined; decision is block if there is one, else allow if a list allows, else none.
    A null url or one without a host, and a null time, match nothing. Entries with nulls or another
    action are left out; repeated entries count once. Repeated captures stay repeated, null ids
    are kept. Other columns are not read. No captures give no rows, an empty list decides nothing.
    """
    rows = staged(captures.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.col(time_col).cast("date").alias("day")).withColumn("row", F.monotonically_increasing_id()), "urls-rows")
    span = rows.agg(F.min("day").alias("low"), F.max("day").alias("high")).first()
    low, high = F.lit(span.low).cast("date"), F.lit(span.high).cast("date")
    start, end = F.greatest("since", low), F.least(F.coalesce(F.date_sub("until", 1), high), high)
    months = F.sequence(F.trunc("start", "month"), F.trunc("end", "month"), F.expr("interval 1 month"))
    active = (intervals(entries).withColumn("start", start).withColumn("end", end)
              .where("start <= end").select("list", "pattern", "action", "start", "end", F.explode(months).alias("month")))
    looked = (rows.where("day is not null").select("row", "day", F.trunc("day", "month").alias("month"),
                                                   F.explode(patterns_of(F.col("url"))).alias("p"))
              .select("row", "day", "month", "p.pattern", "p.rank"))
    matches = looked.join(active, ["pattern", "month"]).where("day between start and end")
    decided = matches.groupBy("row", "list").agg(
        F.max_by("action", F.struct("rank", F.length("pattern").alias("size"), "pattern")).alias("action"), F.count("*").alias("n"))
    verdict = decided.groupBy("row").agg(
        F.sum("n").alias("n_active"), F.max("action").alias("decision"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("action") == "block", F.col("list")))), ",").alias("blocked_by"))
    return rows.join(verdict, "row", "left").select(
        "page_id", F.coalesce("n_active", F.lit(0).cast("long")).alias("n_active"),
        F.coalesce("blocked_by", F.lit("")).alias("blocked_by"), F.coalesce("decision", F.lit("none")).alias("decision"))
