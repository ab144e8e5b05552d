"""URL filters over time: dated list entries become validity intervals, captures meet them as of their fetch.

An entry names a pattern, a time and an action. A pattern is ``host=`` and a host,
``domain=`` and a domain with all hosts below it, or ``prefix=`` and a host with the
first segments of a path. ``add`` opens an interval for its pattern, which lasts up to
the pattern's next entry; of entries dated alike a removal counts last.

A capture looks up the patterns its URL falls under. The as-of join goes by pattern and
day: an interval stands once on the day it begins, and a window over the days on which a
pattern was captured carries the latest interval to those it is still open on. However
long an interval is, it costs one row and one for each such day. Pattern and day are
then joined by equality and exact times compared, so that a host with a third of all
captures is spread over days, and adaptive joins split what is still large. Equal
captures are looked up once.

Nulls and edges: entries with a null in any column, or an unknown action, say nothing.
A capture with a null URL or time, or a URL without a host, matches nothing and is
allowed. Dots at the end of a host don't count. Every capture row gives one row; all its
columns are kept, whatever their names, in front of ``n_active``, ``patterns`` and
``blocked``, which replace columns of these names.

Only DataFrame functions run, no Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import written

DAY = 86_400_000_000


def host_of(url: Column) -> Column:
    return F.rtrim(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1), F.lit("."))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def patterns_of(url: Column) -> Column:
    """All patterns that a URL falls under; none without a host."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    steps = F.filter(F.split(path_of(url), "/"), lambda x: x != "")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda k: F.concat(F.lit("domain="), F.array_join(F.slice(labels, k, F.size(labels)), ".")))
    prefixes = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda k: F.concat(F.lit("prefix="), host, F.lit("/"), F.array_join(F.slice(steps, F.lit(1), k), "/")))
    none = F.array().cast("array<string>")
    found = F.concat(
        F.array(F.concat(F.lit("host="), host)),
        F.when(F.size(labels) > 1, domains).otherwise(none),
        F.when(F.size(steps) > 0, prefixes).otherwise(none),
    )
    return F.when(host == "", none).otherwise(found)


def intervals(entries: DataFrame) -> DataFrame:
    """``pattern, valid_from, valid_to`` of entries (pattern, at, action), times in microseconds; an open end is null."""
    known = entries.select("pattern", "at", "action").filter("pattern is not null and at is not null and action in ('add', 'remove')").distinct()
    by_time = Window.partitionBy("pattern").orderBy("at", "action")
    return known.withColumn("valid_to", F.lead("at").over(by_time)).filter("action = 'add' and (valid_to is null or valid_to > at)").select("pattern", F.col("at").alias("valid_from"), "valid_to")


def _by_day(opened: DataFrame, wanted: DataFrame) -> DataFrame:
    """``pattern, day, valid_from, valid_to``: what may be active on the days wanted (pattern, day).

    Of a pattern's intervals, which don't overlap, only the latest of earlier days can
    still be open when a day begins.
    """
    begun = opened.withColumn("day", F.floor(F.col("valid_from") / DAY))
    latest = begun.groupBy("pattern", "day").agg(F.max(F.struct("valid_from", "valid_to")).alias("latest"), F.lit(False).alias("asked"))
    asked = wanted.distinct().select("pattern", "day", F.lit(None).cast(latest.schema["latest"].dataType).alias("latest"), F.lit(True).alias("asked"))
    days = latest.union(asked).groupBy("pattern", "day").agg(F.max("latest").alias("latest"), F.max("asked").alias("asked"))
    before = Window.partitionBy("pattern").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.withColumn("open", F.last("latest", ignorenulls=True).over(before)).filter("asked and open is not null")
    still = carried.select("pattern", "day", "open.*").filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("day") * DAY))
    return begun.select("pattern", "day", "valid_from", "valid_to").union(still)


def temporal_list_join(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "at") -> DataFrame:
    """The captures with the list patterns active when each was fetched."""
    rows = captures.select(F.struct(*captures.drop("n_active", "patterns", "blocked").columns).alias("capture"), F.col(url).alias("url"), F.col(at).alias("at"))
    wanted = rows.select("url", "at").filter("url is not null and at is not null").distinct()
    opened = written(intervals(entries))
    day = F.floor(F.col("at") / DAY)
    looked = wanted.select("url", "at", day.alias("day"), F.explode(patterns_of(F.col("url"))).alias("pattern"))
    listed = written(looked.join(opened.select("pattern").distinct(), "pattern", "left_semi"))
    active = listed.join(_by_day(opened, listed.select("pattern", "day")), ["pattern", "day"]).filter("valid_from <= at and (valid_to is null or at < valid_to)")
    found = active.groupBy("url", "at").agg(F.array_sort(F.collect_set("pattern")).alias("found"))
    both = rows.join(found, ["url", "at"], "left")
    number = F.when(F.col("found").isNull(), 0).otherwise(F.size("found")).cast("long")
    return both.select("capture.*", number.alias("n_active"), F.coalesce(F.array_join("found", ","), F.lit("")).alias("patterns"), (number > 0).alias("blocked"))
