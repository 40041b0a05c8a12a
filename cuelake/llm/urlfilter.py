"""URL filters with dated lists: every capture is judged by the entries active when it was fetched.

List entries are dated: (domain, listed_at, action), where action 'block' puts the
domain and all below it on the list and 'allow' takes it off. They become validity
intervals: an entry holds from its date until the next one of the same domain. A
capture looks up its host and every parent domain; of the intervals that hold at its
fetch time the one of the longest domain decides. Without any, it is allowed.

The as-of join is an equi-join on the domain with the interval as a condition: the
intervals of a domain don't overlap, so each lookup finds one row at most, and a host
with a third of all captures can be split by the engine like any skewed join key.

Of entries of one domain at one time 'block' wins. Entries with a null domain or time,
or another action, are ignored; so is case. A capture whose URL has no host, or without
a fetch time, is allowed, with null in matched_domain. Repeated rows are judged one by
one. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOST = r"(?i)^[a-z][a-z0-9+.-]*://([^/?#@]*@)?([^/?#:]+)"


def host(url: Column) -> Column:
    """Lower-case host of an absolute URL, without a final dot; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 2)), r"\.+$", "")


def domains(name: Column) -> Column:
    """The host and its parents, down to the last label."""
    parts = F.split(name, r"\.")
    return F.when(F.length(name) > 0, F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts) - k + 1), "."))).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """(domain, blocked, valid_from, valid_to): valid_to is excluded, null for the last."""
    own = entries.select(F.lower("domain").alias("domain"), F.col("listed_at").alias("valid_from"), F.lower("action").alias("_a")).where("domain is not null and valid_from is not null and _a in ('block', 'allow')")
    own = own.groupBy("domain", "valid_from").agg(F.max(F.col("_a") == "block").alias("blocked"))
    return own.withColumn("valid_to", F.lead("valid_from").over(Window.partitionBy("domain").orderBy("valid_from")))


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(page_id, host, fetched_at, allowed, matched_domain, since) for each row of captures (page_id, url, fetched_at)."""
    own = captures.select("page_id", "fetched_at", host(F.col("url")).alias("host"))
    asked = own.select("host", "fetched_at").distinct().withColumn("domain", F.explode(domains(F.col("host"))))
    held = intervals(entries)
    at = F.col("fetched_at")
    met = asked.join(held, "domain").where((at >= F.col("valid_from")) & (F.col("valid_to").isNull() | (at < F.col("valid_to"))))
    best = met.groupBy("host", "fetched_at").agg(F.max(F.struct(F.length("domain").alias("n"), "domain", "blocked", "valid_from")).alias("_b"))
    judged = own.join(best, ["host", "fetched_at"], "left")
    return judged.select("page_id", "host", "fetched_at", F.coalesce(~F.col("_b.blocked"), F.lit(True)).alias("allowed"), F.col("_b.domain").alias("matched_domain"), F.col("_b.valid_from").alias("since"))
