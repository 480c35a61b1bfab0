"""URL filter lists as they stood when a page was fetched.

Dated list entries become intervals in which a pattern was on a list; an as-of join then finds, for every capture, the
entries in force at its time. A capture is looked up by its host, all parent domains and all path prefixes, so
the join is on equal keys. Keys with many captures are salted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts into which the captures of one key are dealt; list entries are repeated as often.
SALTS = 16
HOST, DOMAIN, PREFIX = "host", "domain", "prefix"


def host_of(url: Column) -> Column:
    """Lower-case host without user and port; empty if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)", 1))
    return F.rtrim(host, F.lit("."))


def segments_of(url: Column) -> Column:
    """Path segments that are not empty."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda s: s != "")


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, value, start, end): when each pattern was listed; end is null while it still is.

    ``entries`` has list, kind ('host', 'domain' or 'prefix'), value, listed (boolean) and at. An entry holds until the
    next one of its pattern on its list. Of entries at one time, one that lists wins. Entries with a null in any column
    say nothing and are left out; repeated ones count once.
    """
    columns = ["list", "kind", "value", "at"]
    complete = entries.select(*columns, "listed").dropna()
    settled = complete.groupBy(*columns).agg(F.bool_or("listed").alias("listed"))
    of_pattern = Window.partitionBy("list", "kind", "value").orderBy("at")
    return (
        settled.withColumn("end", F.lead("at").over(of_pattern))
        .filter("listed")
        .select("list", "kind", F.lower("value").alias("value"), F.col("at").alias("start"), "end")
    )


def _keys(host: Column, segments: Column, depth: int) -> Column:
    """All patterns that a URL can match; none without a host."""
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(
            F.lit(DOMAIN).alias("kind"),
            F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("value"),
        ),
    )
    used = F.slice(segments, 1, depth) if depth else F.array().cast("array<string>")
    prefixes = F.transform(
        F.sequence(F.lit(0), F.size(used)),
        lambda i: F.struct(
            F.lit(PREFIX).alias("kind"),
            F.lower(F.concat_ws("/", host, F.slice(used, F.lit(1), i))).alias("value"),
        ),
    )
    exact = F.array(F.struct(F.lit(HOST).alias("kind"), host.alias("value")))
    return F.when(host != "", F.concat(exact, domains, prefixes))


def filter_captures(
    captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched"
) -> DataFrame:
    """(id, url, fetched, blocked, matches, lists): one row per row of ``captures``.

    ``matches`` counts the list entries in force at the time of the fetch that the URL falls under, ``lists`` names
    their lists in order. Hosts match 'host' entries as a whole, 'domain' entries also from below, 'prefix' entries are
    a host and leading path segments, ignoring case. A null or unreadable URL or a null time matches nothing. Repeated
    captures stay. Empty tables give an empty result, or captures that nothing matches. Other columns are ignored.
    """
    listed = intervals(entries)
    deepest = listed.filter(F.col("kind") == PREFIX).agg(F.max(F.size(F.split("value", "/")))).first()[0] or 0
    seen = captures.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(time_col).alias("fetched")
    )
    url = F.coalesce("url", F.lit(""))
    parsed = seen.withColumns({"host": host_of(url), "segments": segments_of(url)})
    salt = F.pmod(F.xxhash64("id", "url", "fetched"), F.lit(SALTS)).cast("int")
    looked_up = (
        parsed.withColumn("salt", salt)
        .withColumn("key", F.explode(_keys(F.col("host"), F.col("segments"), max(0, deepest - 1))))
        .select("id", "url", "fetched", "salt", "key.kind", "key.value")
    )
    salted = listed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    in_force = (
        (looked_up["kind"] == salted["kind"])
        & (looked_up["value"] == salted["value"])
        & (looked_up["salt"] == salted["salt"])
        & (looked_up["fetched"] >= salted["start"])
        & (salted["end"].isNull() | (looked_up["fetched"] < salted["end"]))
    )
    matched = looked_up.join(salted, in_force).select("id", "url", "fetched", "list", F.lit(False).alias("itself"))
    # The captures themselves stay out of the join and meet their matches here. Equal captures have equal keys: what they
    # match counts once for each.
    unmatched = seen.select("*", F.lit(None).cast("string").alias("list"), F.lit(True).alias("itself"))
    return (
        unmatched.unionByName(matched)
        .groupBy("id", "url", "fetched")
        .agg(
            F.count_if("itself").alias("rows"),
            F.count("list").alias("hits"),
            F.array_sort(F.collect_set("list")).alias("lists"),
        )
        .select(
            "id",
            "url",
            "fetched",
            (F.col("hits") > 0).alias("blocked"),
            F.expr("hits div rows").alias("matches"),
            "lists",
            F.explode(F.expr("array_repeat(0, cast(rows as int))")).alias("_row"),
        )
        .drop("_row")
    )
