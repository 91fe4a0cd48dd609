"""URL lists over time: which entries were active when a page was fetched.

A list is a history: entries are added and removed at dates. Each entry's history becomes
validity intervals, and a capture is joined, as of its own time, with the intervals of the keys of its
URL: its host, every domain above it, and the URL itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwelltide.session import shared_folder

#: Intervals are filed by periods of so many seconds, so that a capture meets only its own.
PERIOD = 90 * 86_400
#: Captures of a key and period that one task of the join may take.
KEY_ROWS = 100_000


def url_host(url: Column) -> Column:
    """The host in lower case, without user, port and final dot; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))
    host = F.regexp_replace(host, r"\.$", "")
    return F.when(host != "", host)


def exact_url(url: Column) -> Column:
    """The URL without its fragment."""
    return F.regexp_replace(url, r"#.*$", "")


def host_suffixes(host: Column, labels: list[int]) -> Column:
    """The host or the domain above it of each number of labels, as far as it has so many."""
    has = F.length(host) - F.length(F.replace(host, F.lit("."))) + 1
    found = [F.when(has >= n, F.substring_index(host, ".", -n)) for n in labels]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def _period(at: str | Column) -> Column:
    """The period that holds a time, also before 1970 and at the ends of a long."""
    at = F.col(at) if isinstance(at, str) else at
    return F.call_function("div", at.cast("long"), F.lit(PERIOD)) - F.when(
        (at < 0) & (at % PERIOD != 0), 1
    ).otherwise(0)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``(list, kind, value, valid_from, valid_to)`` of a history
    ``(list, kind, value, action, at)``; ``valid_to`` is open, null if still valid.

    Actions are ``add`` and ``remove``, ``at`` whole seconds. Of several at the same time a
    ``remove`` counts. Rows of another action, or with a null, are left out; repeated rows
    count once. First the changes of an entry at a time become one row, so only as many meet as its
    history has times.
    """
    known = entries.filter(
        F.col("action").isin("add", "remove")
        & F.col("list").isNotNull() & F.col("kind").isNotNull()
        & F.col("value").isNotNull() & F.col("at").isNotNull()
    )
    changes = known.groupBy("list", "kind", "value", "at").agg(F.max("action").alias("action"))
    history = Window.partitionBy("list", "kind", "value").orderBy("at")
    states = changes.withColumn("before", F.lag("action").over(history)).filter(
        F.coalesce("before", F.lit("remove")) != F.col("action")
    )
    return (
        states.withColumn("valid_to", F.lead("at").over(history))
        .filter(F.col("action") == "add")
        .select("list", "kind", "value", F.col("at").alias("valid_from"), "valid_to")
    )


def listed_captures(
    captures: DataFrame,
    entries: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    time_col: str = "fetched_at",
    allow_lists: tuple[str, ...] = (),
) -> DataFrame:
    """``(id, url, fetched_at, matches, blocked)``: every capture with the entries
    ``list:kind:value`` active when it was fetched, in order, and whether it is blocked.

    Entries of kind ``domain`` match a host and all below it, of kind ``url`` the URL without
    its fragment; host names compare in lower case. An entry is active from the time it is added
    to just before the time it is removed. A capture is blocked if an entry of a list is active and none of
    ``allow_lists``. Null ids are kept. A capture of null URL or time, or without a host, matches
    no such entry and is not blocked. Repeated captures
    keep a row each; without entries none is blocked. No captures give an empty table. Other
    columns are not read. Times may be any long, hosts of any length.

    Equal (URL, time) pairs are joined once. A host has keys for those numbers of labels only that
    entries have, and an interval is filed in those periods only in which its key was fetched.
    The join is on (key, period); a key and period of very many captures is dealt out by a hash of them, and
    only its entries are copied. Those are sent to all executors as one row each: by their count
    no more than ``KEY_ROWS`` can be.
    """
    shared_folder(captures.sparkSession)
    rows = captures.select(
        F.col(id_col).alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(time_col).cast("long").alias("fetched_at"),
    )
    value = F.when(F.col("kind") == "domain", F.lower("value")).otherwise(F.col("value"))
    active = validity_intervals(entries).withColumn("value", value)
    # A few small numbers, whatever the lists hold.
    sizes = active.filter("kind = 'domain'").select(F.size(F.split("value", r"\.")).alias("n")).distinct()
    labels = sorted(r["n"] for r in sizes.collect())
    asked = rows.filter(F.col("url").isNotNull() & F.col("fetched_at").isNotNull())
    asked = asked.select("url", "fetched_at").distinct()
    domains = F.transform(
        F.coalesce(host_suffixes(url_host(F.col("url")), labels), F.array().cast("array<string>")),
        lambda v: F.struct(F.lit("domain").alias("kind"), v.alias("value")),
    )
    whole = F.array(
        F.struct(F.lit("url").alias("kind"), exact_url(F.col("url")).alias("value"))
    )
    keys = asked.withColumn("period", _period("fetched_at")).select(
        "url", "fetched_at", "period", F.explode(F.concat(domains, whole)).alias("key")
    ).select("url", "fetched_at", "period", "key.kind", "key.value")
    periods = keys.groupBy("kind", "value", "period").agg(F.count(F.lit(1)).alias("n"))
    met_in = F.col("period").between(
        _period("valid_from"), F.coalesce(_period(F.col("valid_to") - 1), F.col("period"))
    )
    filed = active.join(periods, ["kind", "value"]).filter(met_in).checkpoint()
    total = filed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    limit = max(KEY_ROWS, -(-total // KEY_ROWS))
    filed = filed.withColumn("lanes", F.expr(f"1 + (n - 1) div {limit}"))
    hot = filed.filter("lanes > 1").select(
        F.col("kind").alias("h_kind"), F.col("value").alias("h_value"), F.col("period").alias("h_period"), F.col("lanes").alias("h_lanes")
    ).distinct()
    is_hot = (F.col("kind") == F.col("h_kind")) & (F.col("value") == F.col("h_value")) & (F.col("period") == F.col("h_period"))
    lane = F.pmod(F.xxhash64("url", "fetched_at"), F.coalesce("h_lanes", F.lit(1).cast("long")))
    keys = keys.join(F.broadcast(hot), is_hot, "left").withColumn("lane", lane).drop(*hot.columns)
    copies = filed.withColumn("lane", F.explode(F.expr("sequence(0L, lanes - 1)"))).drop("n", "lanes")
    met = keys.join(copies, ["kind", "value", "period", "lane"]).filter(
        (F.col("fetched_at") >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))
    )
    allowed = F.col("list").isin(*allow_lists) if allow_lists else F.lit(False)
    found = met.groupBy("url", "fetched_at").agg(
        F.array_sort(F.collect_set(F.concat_ws(":", "list", "kind", "value"))).alias("matches"),
        (F.bool_or(~allowed) & ~F.bool_or(allowed)).alias("blocked"),
    )
    return rows.join(found, ["url", "fetched_at"], "left").select(
        F.col("id").alias(id_col),
        F.col("url").alias(url_col),
        F.col("fetched_at").alias(time_col),
        F.coalesce("matches", F.array().cast("array<string>")).alias("matches"),
        F.coalesce("blocked", F.lit(False)).alias("blocked"),
    )
