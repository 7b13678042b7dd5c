"""URL filters by lists that change over time, in DataFrame operations only.

A list change says that from a time on a key is, or is no longer, in a list. Changes of a key
become validity intervals, each up to the next change. A key is a domain (``d:example.com``,
which also covers its subdomains) or the start of a URL up to a path segment (``u:host/a/b``).
A capture is held against the entries that were active when it was fetched, by an as-of join: its keys
and the intervals are sorted together by list, key and time, and the last interval that begins before
a capture, or with it, is the only one of its list and key that can be active. So a capture meets one
interval of a list and key, however many these have had.

Captures are reduced to distinct (url, time) first, and to keys that some list has; a key of many captures is
cut into slices for that lookup, and the keys are broadcast only if they are counted to be few. The sorted
rows are dealt by ranges of their whole order, so neither a key with many changes nor one that
covers a third of the captures is one task; a range begins with the last interval of those before it. The
next change of a key is found in the same way.

Defined results: a null or malformed url, or a null time, matches nothing and is kept; changes
with a null list, key or time are ignored; of changes of one key at one time a removal wins;
a fetch at the very time of a change sees the change; repeated captures each keep their row;
times may be any longs; empty tables give no rows, or no matches; the captures' columns are carried
along, but for those named like a column of the result, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinia.llm.common import Scratch, shuffle_partitions, unused, with_next
from opinia.operators.joins import lookup_join

#: The authority of a URL without user and port, and its path.
HOST = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)"
PATH = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """The host in lower case, without a final dot; null where there is none."""
    found = F.lower(F.regexp_extract(url, HOST, 1))
    return F.nullif(F.regexp_replace(found, r"\.$", ""), F.lit(""))


def segments_of(url: Column) -> Column:
    """The path's segments that are not empty."""
    return F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda x: x != "")


def keys_of(url: Column, depth: int) -> Column:
    """The keys that cover a URL: its host's suffixes, and its starts of 1 to ``depth`` segments."""
    host = host_of(url)
    labels, segments = F.split(host, r"\."), segments_of(url)
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat(F.lit("d:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")),
    )
    deep = F.least(F.size(segments), F.lit(depth))
    starts = F.when(
        deep > 0,
        F.transform(
            F.sequence(F.lit(1), F.greatest(deep, F.lit(1))),
            lambda i: F.concat(F.lit("u:"), host, F.lit("/"), F.array_join(F.slice(segments, 1, i), "/")),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.when(host.isNotNull(), F.concat(domains, starts)).otherwise(F.array().cast("array<string>"))


def intervals(changes: DataFrame, scratch: Scratch) -> DataFrame:
    """``(list, key, changed_at, listed)`` to ``(list, key, since, until)`` of what is listed;
    ``until`` is null for the last."""
    known = changes.where("list IS NOT NULL AND key IS NOT NULL AND changed_at IS NOT NULL")
    once = known.groupBy("list", "key", "changed_at").agg(F.min(F.coalesce("listed", F.lit(False))).alias("listed"))
    followed = with_next(once, ["list", "key", "changed_at"], scratch, "changes")
    same = (F.col("next.list") == F.col("list")) & (F.col("next.key") == F.col("key"))
    return followed.where("listed").select(
        "list", "key", F.col("changed_at").alias("since"), F.when(same, F.col("next.changed_at")).alias("until")
    )


def active_entries(asked: DataFrame, valid: DataFrame, scratch: Scratch) -> DataFrame:
    """``asked (list, key, _time, _url)``, without nulls, where an interval of that list and key has
    begun and not ended at that time. ``valid`` comes from :func:`intervals`."""
    order = ["list", "key", "_time", "_url"]
    interval = F.struct("list", "key", "since", "until")
    # Nulls sort first, so an interval stands before the captures of the second it begins in.
    begins = valid.select("list", "key", F.col("since").alias("_time"), interval.alias("_begun"))
    both = asked.select(*order).unionByName(begins, allowMissingColumns=True)
    parts = shuffle_partitions(asked.sparkSession)
    ranged = scratch.store(both.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), "sorted")
    # One row a range: the last interval of all ranges before it.
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranged.groupBy("_range").agg(F.max("_begun").alias("_last"))
    carried = carried.select("_range", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = ranged.withColumn("_begun", F.last("_begun", ignorenulls=True).over(inside)).join(F.broadcast(carried), "_range")
    last = F.coalesce("_begun", "_carried")
    own = (last["list"] == F.col("list")) & (last["key"] == F.col("key"))
    return found.where(
        F.col("_url").isNotNull() & own & (last["until"].isNull() | (F.col("_time") < last["until"]))
    ).select(*order)


def filter_urls(
    captures: DataFrame, changes: DataFrame, url_col: str = "url", time_col: str = "fetched_at"
) -> DataFrame:
    """``captures`` with ``host``, ``blocked``, ``n_active`` (entries active at the fetch), ``entry``
    (the longest of their keys, of equal length the least) and ``lists`` (sorted, by comma).

    Times are seconds as longs. ``changes`` has list, key, changed_at and listed.
    """
    scratch = Scratch(captures.sparkSession, "url-filter")
    marked = captures.drop(*[c for c in ("host", "blocked", "n_active", "entry", "lists") if c not in (url_col, time_col)])
    u, t = unused(marked, "_u", "_t")
    valid = scratch.store(intervals(changes, scratch), "intervals")
    seen = captures.select(F.col(url_col).alias("_url"), F.col(time_col).cast("long").alias("_time")).where(
        "_url IS NOT NULL AND _time IS NOT NULL"
    )
    # Only starts as deep as any of the list are looked up, and only keys that are listed.
    bounds = valid.agg(
        F.max(F.when(F.col("key").startswith("u:"), F.size(F.split("key", "/")) - 1)).alias("depth")
    ).first()
    listed = scratch.store(valid.select("list", "key").distinct(), "listed")
    looked = seen.distinct().select("_url", "_time", F.explode(keys_of(F.col("_url"), bounds["depth"] or 0)).alias("key"))
    asked = scratch.store(lookup_join(looked, listed, ["key"], "inner", ["_url", "_time"]), "asked")
    active = active_entries(asked, valid, scratch)
    verdicts = active.groupBy(F.col("_url").alias("_u"), F.col("_time").alias("_t")).agg(
        F.count("*").alias("n_active"),
        F.min(F.struct((-F.length("key")).alias("n"), F.col("key").alias("key")))["key"].alias("entry"),
        F.array_join(F.sort_array(F.collect_set("list")), ",").alias("lists"),
    )
    verdicts = verdicts.withColumnsRenamed({"_u": u, "_t": t})
    same = (marked[url_col] == verdicts[u]) & (marked[time_col].cast("long") == verdicts[t])
    return marked.join(verdicts, same, "left").select(
        *[marked[c] for c in marked.columns],
        host_of(marked[url_col]).alias("host"),
        F.col("n_active").isNotNull().alias("blocked"),
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        "entry",
        "lists",
    )


def kept(captures: DataFrame, changes: DataFrame, **settings) -> DataFrame:
    """The captures that no entry blocked when they were fetched."""
    return filter_urls(captures, changes, **settings).where(~F.col("blocked"))
