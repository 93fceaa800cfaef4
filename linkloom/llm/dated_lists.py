"""Captures judged by the list entries that were active when they were fetched.

A list changes over time: dated changes add or remove an entry, a domain
(``example.org``, with its subdomains) or a host with the start of a path
(``example.org/a/``, up to a slash).  Changes become validity intervals, from a change up
to the next one of the same entry.  A capture looks up its host, every parent domain and
every start of its path; the join is by entry and by the month of the fetch, then by the
interval itself, so neither an often-changed entry nor a host with a third of all captures
is ever one task's work: intervals are cut at months, and Spark splits captures of a hot
key, whose other side is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.scratch import written


def _month(date: Column) -> Column:
    return (F.year(date) * 12 + F.month(date) - 1).cast("int")


def intervals(changes: DataFrame) -> DataFrame:
    """``list, entry, valid_from, valid_until`` (exclusive; NULL: open) of active entries.

    ``changes`` has ``list, entry, action, at`` with an action ``add`` or ``remove``.  Of
    several changes of an entry on one date a removal wins.  Rows with a NULL in these
    columns, or another action, are not changes.  An entry that is added again while it is
    active stays active.
    """
    good = F.col("list").isNotNull() & F.col("entry").isNotNull() & F.col("at").isNotNull()
    good &= F.col("action").isin("add", "remove")
    days = changes.where(good).groupBy("list", "entry", F.col("at").cast("date").alias("at")).agg(
        F.min(F.col("action") == "add").alias("active")
    )
    days = days.withColumn("month", _month(F.col("at")))
    # The next change, within the month or at the start of a later one.
    within = Window.partitionBy("list", "entry", "month").orderBy("at")
    days = days.withColumn("next", F.lead("at").over(within))
    months = days.groupBy("list", "entry", "month").agg(F.min("at").alias("starts"))
    later = Window.partitionBy("list", "entry").orderBy("month")
    months = months.select("list", "entry", "month", F.lead("starts").over(later).alias("later"))
    return (
        days.join(months, ["list", "entry", "month"])
        .where("active")
        .select("list", "entry", F.col("at").alias("valid_from"), F.coalesce("next", "later").alias("valid_until"))
    )


def url_entries(url: Column) -> Column:
    """All entries that would match a URL: its host, parent domains, and starts of its path."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    parts = F.split(path, "/")
    folders = F.when(
        F.size(parts) > 1,
        F.transform(
            F.sequence(F.lit(1), F.size(parts) - 1),
            lambda i: F.concat(host, F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/")),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.when(host != "", F.array_distinct(F.concat(domains, folders)))


def judged(captures: DataFrame, changes: DataFrame, url: str = "url", fetched: str = "fetched_at") -> DataFrame:
    """Adds ``lists``, those with an active entry for the capture, ascending; else empty.

    A column ``lists`` that the captures have already is replaced, and comes last.
    Every capture gives one row, repeated rows too.  A capture without a URL or a date, or
    whose URL has no host, is on no list.
    """
    at = F.col(f"`{fetched}`").cast("date")
    asked = captures.select(F.col(f"`{url}`").alias("_url_"), at.alias("_at_")).where("_url_ IS NOT NULL AND _at_ IS NOT NULL")
    asked = written(asked.distinct(), "captures")
    last = F.lit(asked.agg(F.max("_at_")).first()[0]).cast("date")
    active = intervals(changes).where(F.col("valid_from") <= last)
    until = F.date_sub(F.coalesce("valid_until", F.date_add(last, 1)), 1)
    months = F.sequence(_month(F.col("valid_from")), _month(F.greatest(F.least(until, last), "valid_from")))
    active = active.withColumn("month", F.explode(months))
    keys = asked.select("_url_", "_at_", _month(F.col("_at_")).alias("month"), F.explode(url_entries(F.col("_url_"))).alias("entry"))
    met = keys.join(active, ["entry", "month"]).where("valid_from <= _at_ AND (valid_until IS NULL OR _at_ < valid_until)")
    found = met.groupBy("_url_", "_at_").agg(F.sort_array(F.collect_set("list")).alias("lists"))
    packed = captures.select(F.struct("*").alias("row"), F.col(f"`{url}`").alias("u"), at.alias("d"))
    rows = packed.join(found, (F.col("u") == F.col("_url_")) & (F.col("d") == F.col("_at_")), "left")
    lists = F.coalesce("lists", F.array().cast("array<string>"))
    return rows.select(*(F.col("row")[c].alias(c) for c in captures.columns if c != "lists"), lists.alias("lists"))
