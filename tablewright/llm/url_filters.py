"""URL filters: every capture is judged by the list entries that were in force when it was fetched.

Dated entries of a domain become validity intervals, each until the domain's next entry; a capture's host is looked up
with all its parent domains, and the entry of the longest one that was in force decides.

Captures are first reduced to distinct pairs of host and day, so that a host with a third of all captures meets the list
as a few hundred rows; the verdicts go back to the captures by a join that Spark can split where a host is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let

HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#@]+)"


def host_of(url: Column) -> Column:
    """Lower-case host without a final dot; null if the URL has none."""
    host = F.regexp_replace(F.regexp_extract(F.lower(url), HOST, 1), r"\.$", "")
    return F.when(host != "", host)


def intervals(entries: DataFrame) -> DataFrame:
    """(domain, action, since, until) from dated entries (domain, action, since); until is exclusive, null for the last.

    Of entries of the same domain and day the strictest holds (block before allow). Entries with a null are no entries.
    """
    days = entries.select(F.lower("domain").alias("domain"), "action", "since").dropna().groupBy("domain", "since").agg(F.max("action").alias("action"))
    return days.withColumn("until", F.lead("since").over(Window.partitionBy("domain").orderBy("since")))


def url_filters(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """For each row of captures (page_id, url, fetched: date): host, matched_domain, action and blocked.

    A capture without a host or a date, or for which no entry was in force, has null matched_domain and action and isn't
    blocked. Repeated rows give repeated results; other columns are ignored.
    """
    pages = captures.select("page_id", host_of(F.col("url")).alias("host"), F.col("fetched").cast("date").alias("fetched"))
    pairs = pages.select(F.col("host").alias("__host"), F.col("fetched").alias("__day")).dropna().distinct()
    parents = let(F.split("__host", r"\."), lambda p: F.transform(F.sequence(F.lit(1), F.size(p)), lambda k: F.struct(k.alias("k"), F.array_join(F.slice(p, k, F.size(p)), ".").alias("domain"))))
    looked = pairs.select("__host", "__day", F.explode(parents).alias("p")).select("__host", "__day", F.col("p.k").alias("k"), F.col("p.domain").alias("domain"))
    active = (F.col("__day") >= F.col("since")) & (F.col("until").isNull() | (F.col("__day") < F.col("until")))
    verdicts = (
        looked.join(intervals(entries), "domain")
        .where(active)
        .groupBy("__host", "__day")
        .agg(F.min(F.struct("k", "domain", "action")).alias("v"))
        .select("__host", "__day", F.col("v.domain").alias("matched_domain"), F.col("v.action").alias("action"))
    )
    joined = pages.join(verdicts, (F.col("host") == F.col("__host")) & (F.col("fetched") == F.col("__day")), "left")
    return joined.select("page_id", "host", "fetched", "matched_domain", "action", F.coalesce(F.col("action") == "block", F.lit(False)).alias("blocked"))
