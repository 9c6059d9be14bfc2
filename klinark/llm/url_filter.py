"""URL filters whose list entries have dates: validity intervals and an as-of join, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without user, port and last dot; null where there is none."""
    host = F.rtrim(F.regexp_extract(F.lower(url), HOST, 1), F.lit("."))
    return F.when(host != "", host)


def domains_of(host: Column) -> Column:
    """The host and its parent domains of at least two labels; a host of one label is itself."""
    labels = F.split(host, r"\.")
    count = F.greatest(F.size(labels) - 1, F.lit(1))
    return F.transform(F.sequence(F.lit(1), count), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))


def validity(entries: DataFrame) -> DataFrame:
    """Intervals (list, domain, since, until) in which a domain is on a list.

    `entries` has list, domain, day and action (`add` or `remove`). An entry holds until the day
    of the next one of the same list and domain; until is null while nothing follows. On one
    day a removal wins. Entries with a null are left out.
    """
    daily = (entries.dropna(subset=["list", "domain", "day", "action"])
             .groupBy("list", F.lower("domain").alias("domain"), "day").agg(F.max("action").alias("action")))
    following = F.lead("day").over(Window.partitionBy("list", "domain").orderBy("day"))
    return (daily.withColumn("until", following).filter("action = 'add'")
            .select("list", "domain", F.col("day").alias("since"), "until"))


def judge_captures(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """Captures with `lists` (sorted names of the lists that held them when fetched) and `blocked`.

    A domain on a list covers its subdomains. Captures first shrink to one row per host and
    day, combined before the shuffle, and those meet the intervals of their domains; the
    verdicts then go back to the captures, where adaptive execution splits a host with very
    many captures. Neither join builds pairs of captures.

    A null or malformed URL, or a null day, is on no list; repeated captures each keep their row;
    an empty list of entries blocks nothing. Columns named `lists` or `blocked` are replaced.
    """
    seen = captures.drop("lists", "blocked").withColumn("_host", host_of(F.col(url))).withColumn("_day", F.col(fetched).cast("date"))
    days = seen.select("_host", "_day").filter("_host is not null and _day is not null").distinct()
    asked = days.select("_host", "_day", F.explode(domains_of(F.col("_host"))).alias("domain"))
    active = (F.col("since") <= F.col("_day")) & (F.col("until").isNull() | (F.col("_day") < F.col("until")))
    verdicts = (asked.join(validity(entries), "domain").filter(active)
                .groupBy("_host", "_day").agg(F.array_sort(F.collect_set("list")).alias("lists")))
    judged = seen.join(verdicts, ["_host", "_day"], "left")
    lists = F.coalesce("lists", F.array().cast("array<string>"))
    return (judged.withColumn("lists", lists).withColumn("blocked", F.size("lists") > 0)
            .select(*[c for c in captures.columns if c not in ("lists", "blocked")], "lists", "blocked"))


def _draw(value: Column, start: int) -> Column:
    """A number 0..65535 from the digest of a text."""
    return F.conv(F.substring(F.md5(value.cast("binary")), start, 4), 16, 10).cast("int")


def derived_entries(pages: DataFrame) -> DataFrame:
    """Dated entries of three lists, derived from the hosts of the pages by their digests.

    A host is on a list if its digest says so: added on one day of the year, for most removed up
    to 90 days later, for some added again; every host's last two labels may be listed as well.
    """
    hosts = pages.select(host_of(F.col("url")).alias("host")).filter("host is not null").distinct()
    domains = hosts.select(F.explode(F.array("host", F.substring_index("host", ".", -3))).alias("domain")).distinct()
    lists = F.explode(F.array(*[F.lit(n) for n in ("adult", "malware", "spam")]))
    keyed = domains.withColumn("list", lists).withColumn("k", F.concat_ws("/", "list", "domain"))
    keyed = keyed.filter(_draw(F.col("k"), 1) % 3 == 0)
    start = F.date_add(F.lit("2024-01-01").cast("date"), _draw(F.col("k"), 5) % 300)
    stop = F.date_add(start, 1 + _draw(F.col("k"), 9) % 90)
    again = F.date_add(stop, 1 + _draw(F.col("k"), 13) % 60)
    events = F.array(F.struct(start.alias("day"), F.lit("add").alias("action"), F.lit(0).alias("least")),
                     F.struct(stop.alias("day"), F.lit("remove").alias("action"), F.lit(1).alias("least")),
                     F.struct(again.alias("day"), F.lit("add").alias("action"), F.lit(2).alias("least")))
    return (keyed.select("list", "domain", (_draw(F.col("k"), 17) % 4).alias("steps"), F.explode(events).alias("e"))
            .filter("e.least <= steps").select("list", "domain", "e.day", "e.action"))


def page_captures(pages: DataFrame) -> DataFrame:
    """(page_id, url, fetched): the day of the capture follows from the page number."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(366)).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched"))
