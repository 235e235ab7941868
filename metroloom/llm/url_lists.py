"""Temporal list join of urls (operator 3, DataFrame functions only).

List entries are dated: (pattern, date, action), a pattern being a host or a domain and the action what
the list says from that date on until the pattern's next entry. Entries become validity intervals
[valid_from, valid_to). A capture asks with its host and all parent domains, and its verdict is that of
the longest pattern with an interval that holds its fetch time: an as-of join.

The join is on (pattern, period): intervals are laid out over the periods of fixed length they touch
within the time the captures span, so a capture meets only the intervals of its own period, never a
pattern's whole history. Captures of each (pattern, period) are counted first: intervals that none asks for
are left out, and one that more than PART_ROWS ask for is salted: captures deal over as many parts of it as
that takes, its intervals stand in each. Hosts are reduced to distinct (host, fetch time) pairs before they
fan out to their domains.

Edge cases: a null or hostless url matches nothing and is allowed; of entries of one pattern and date the
one whose action sorts last counts; a null fetch time matches nothing; repeated captures each get
their verdict; an empty list allows all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Distinct (host, fetch time) pairs that one part of a pattern and period answers.
PART_ROWS = 100_000


def host_of(url: Column) -> Column:
    """Lower-case host without user and port; null where there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.nullif(host, F.lit(""))


def intervals(entries: DataFrame) -> DataFrame:
    """pattern, action, valid_from, valid_to (null: open) of dated entries."""
    one = entries.filter("pattern IS NOT NULL AND date IS NOT NULL").groupBy("pattern", "date").agg(F.max("action").alias("action"))
    return one.select("pattern", "action", F.col("date").alias("valid_from"), F.lead("date").over(Window.partitionBy("pattern").orderBy("date")).alias("valid_to"))


def evaluate(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url", fetched: str = "fetched", period_days: int = 30, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per capture: key, host, fetched, pattern, listed_since, verdict (``allow`` where nothing matches)."""
    asked = captures.select(F.col(key), host_of(F.col(url)).alias("host"), F.to_date(F.col(fetched)).alias("fetched"))
    period = lambda d: F.floor(F.datediff(d, F.lit("1970-01-01")) / period_days)
    span = asked.agg(F.min("fetched").alias("lo"), F.max("fetched").alias("hi"))
    held = intervals(entries).crossJoin(F.broadcast(span)).filter("valid_from <= hi AND (valid_to IS NULL OR valid_to > lo)")  # span: one row
    first, last = period(F.greatest("valid_from", "lo")), period(F.least(F.coalesce(F.date_sub("valid_to", 1), F.col("hi")), F.col("hi")))
    laid = held.filter(first <= last).select("pattern", "action", "valid_from", "valid_to", F.explode(F.sequence(first, last)).alias("period"))
    labels = F.split("host", r"\.")
    hosts = asked.filter("host IS NOT NULL AND fetched IS NOT NULL").select("host", "fetched").distinct()
    domains = hosts.select("host", "fetched", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("pattern"))
    probes = domains.select("*", period(F.col("fetched")).alias("period"))
    asked_for = probes.groupBy("pattern", "period").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts"))
    laid = laid.join(asked_for, ["pattern", "period"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    hot = asked_for.filter("parts > 1")
    salt = F.pmod(F.xxhash64("host", "fetched"), F.coalesce("parts", F.lit(1))).cast("int")
    probes = probes.join(hot, ["pattern", "period"], "left").withColumn("salt", salt).drop("parts")
    met = probes.join(laid, ["pattern", "period", "salt"]).filter("valid_from <= fetched AND (valid_to IS NULL OR fetched < valid_to)")
    best = met.groupBy("host", "fetched").agg(F.max_by(F.struct("pattern", "valid_from", "action"), F.length("pattern")).alias("hit"))
    joined = asked.join(best, ["host", "fetched"], "left")
    return joined.select(key, "host", "fetched", F.col("hit.pattern").alias("pattern"), F.col("hit.valid_from").alias("listed_since"), F.coalesce("hit.action", F.lit("allow")).alias("verdict"))
