"""URL filter lists that change over time.

A list is dated entries: from ``at`` on, ``host`` and all hosts below it are blocked or allowed, or the entry is
removed. Successive entries of a host become validity intervals [from, to). A capture is judged by the
intervals that hold at its fetch time, of its host and the domains above it; the most specific host decides.

Captures are reduced to distinct (host, fetch time), and of the domains above these only those stay that a list small enough
to broadcast holds. The as-of join sorts them together with the intervals' starts, within a domain, a span of time and a salt, and
carries the latest start forward: a busy host, a long history or a domain above everything is many keys, and none is
compared pair by pair.

Of entries of one host and time the last action in the order remove, allow, block counts; repeated entries count once. Captures
with a null URL, no host, or a null time are kept, unjudged; entries with nulls are left out. Every capture gives one row:
repeated captures are judged alike. Without captures the result is empty, and without entries all are unjudged. Columns of captures
named like those that are added are replaced; others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridweave.llm.spark_util import BROADCAST_ROWS, cut, partitions, spread_join

SPAN_DAYS = 30
_MADE = ("url_host", "listed_host", "list_action", "listed_from")
_RANK = {"remove": 0, "allow": 1, "block": 2}


def url_host(url: Column) -> Column:
    """The lower-case host of a URL, without user, port and final dot; null if there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.nullif(F.regexp_replace(F.lower(host), r"\.$", ""), F.lit(""))


def _micros(at: Column) -> Column:
    return F.unix_micros(at.cast("timestamp"))


def _span(at: Column) -> Column:
    return F.floor(_micros(at) / (SPAN_DAYS * 86_400_000_000)).cast("bigint")


def validity_intervals(entries: DataFrame) -> DataFrame:
    """entry_host, action, valid_from, valid_to (null: for good). A host's entries are ordered span by span; the
    last of a span ends with the first of the host's next span, so no host is sorted in one task."""
    rank = F.create_map(*(F.lit(x) for kv in _RANK.items() for x in kv))
    named = entries.select(F.lower("host").alias("entry_host"), F.col("at").alias("valid_from"), F.col("action").alias("action")).where("entry_host IS NOT NULL AND valid_from IS NOT NULL AND action IS NOT NULL")
    single = named.groupBy("entry_host", "valid_from").agg(F.max_by("action", rank[F.col("action")]).alias("action")).withColumn("span", _span(F.col("valid_from")))
    in_span = F.lead("valid_from").over(W.partitionBy("entry_host", "span").orderBy("valid_from"))
    firsts = single.groupBy("entry_host", "span").agg(F.min("valid_from").alias("first"))
    later = firsts.select("entry_host", "span", F.lead("first").over(W.partitionBy("entry_host").orderBy("span")).alias("later"))
    ended = single.withColumn("until", in_span).join(later, ["entry_host", "span"])
    return ended.select("entry_host", "action", "valid_from", F.coalesce("until", "later").alias("valid_to")).where("action <> 'remove'")


def filter_urls(captures: DataFrame, entries: DataFrame, url: str = "url", fetched_at: str = "fetched_at") -> DataFrame:
    """``captures`` with url_host, listed_host, list_action, listed_from; the last three are null if nothing applies."""
    spark, kept = captures.sparkSession, [c for c in captures.columns if c not in _MADE]
    plain = [f"doc.`{c}`" for c, kind in captures.dtypes if c in kept and "map<" not in kind]  # what a row can be hashed by
    keyed = captures.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("doc"), url_host(F.col(url)).alias("url_host"), F.col(fetched_at).alias("at"))
    named = F.col("url_host").isNotNull() & F.col("at").isNotNull()
    labels = F.split("url_host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    wanted = keyed.where(named).select("url_host", "at").distinct().select("url_host", "at", F.explode(above).alias("entry_host"))
    intervals = cut(validity_intervals(entries))
    hosts = intervals.select("entry_host").distinct()
    if hosts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        wanted = wanted.join(F.broadcast(hosts), "entry_host", "left_semi")
    salt = F.pmod(F.xxhash64("url_host", "at"), F.lit(partitions(spark))).cast("int")
    wanted = cut(wanted.select("entry_host", _span(F.col("at")).alias("span"), salt.alias("salt"), "url_host", "at"))
    low, high = wanted.agg(F.coalesce(F.min("span"), F.lit(0)), F.coalesce(F.max("span"), F.lit(-1))).first()
    first, last = F.greatest(_span(F.col("valid_from")), F.lit(low)), F.least(_span(F.col("valid_to")), F.lit(high))
    spread = intervals.where(first <= last).select("entry_host", F.struct("action", "valid_from", _micros(F.col("valid_to")).alias("until")).alias("interval"), F.explode(F.sequence(first, last)).alias("span"))
    asked = wanted.select("entry_host", "span", "salt").distinct()
    starts = asked.join(spread, ["entry_host", "span"]).withColumn("t", _micros(F.col("interval.valid_from")))
    both = wanted.withColumn("t", _micros(F.col("at"))).unionByName(starts, allowMissingColumns=True)
    # at one time an interval comes before the captures that it holds for
    order = W.partitionBy("entry_host", "span", "salt").orderBy("t", F.col("url_host").isNotNull()).rowsBetween(W.unboundedPreceding, W.currentRow)
    latest = both.withColumn("interval", F.last("interval", ignorenulls=True).over(order)).where("url_host IS NOT NULL AND interval IS NOT NULL AND (interval.until IS NULL OR t < interval.until)")
    verdicts = latest.groupBy("url_host", "at").agg(F.max(F.struct(F.length("entry_host").alias("depth"), "entry_host", "interval.action", "interval.valid_from")).alias("verdict"))
    judged = spread_join(keyed.where(named), ["url_host", "at"], plain, verdicts, "left")
    joined = judged.unionByName(keyed.where(~named), allowMissingColumns=True)
    return joined.select("doc.*", "url_host", F.col("verdict.entry_host").alias("listed_host"), F.col("verdict.action").alias("list_action"), F.col("verdict.valid_from").alias("listed_from"))
