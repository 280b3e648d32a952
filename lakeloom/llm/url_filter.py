"""URL filters by dated lists: a temporal join of captures with the entries active when they were fetched.

A list says from when a pattern is blocked, allowed or no longer listed. Its dated entries become intervals
of validity, and each capture is matched by the keys its URL gives (domains above its host, folders above
its page) with the intervals that hold its fetch time. Intervals are cut at the borders of periods, so
the join is an equality of key and period with a check of the times, however long a pattern's history is.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import materialize

PERIOD = 30 * 24 * 3600
#: The order of actions that hold for one pattern at one time: the first wins.
ACTIONS = ("block", "allow", "remove")
HOST = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dots; empty where the URL has none."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1)), r"\.+$", "")


def folders_of(url: Column) -> Column:
    """Non-empty parts of the path."""
    parts = F.split(F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1), "/")
    return F.filter(parts, lambda part: part != "")


def validity_intervals(entries: DataFrame, period: int = PERIOD) -> DataFrame:
    """(list_name, pattern, action, valid_from, valid_to) of dated entries (list_name, pattern, action, effective_at).

    An entry holds until the next one of its list and pattern; ``valid_to`` is null for the last, and is not part
    of the interval. Of entries at one time the first of :data:`ACTIONS` counts. Removals end an interval
    and begin none. Entries with a null or an unknown action are left out. The next entry is looked up within
    the period and then in the next period that has any, so a long history is not one task.
    """
    rank = F.array_position(F.array(*map(F.lit, ACTIONS)), F.col("action"))
    at = Window.partitionBy("list_name", "pattern", "slice").orderBy("valid_from")
    slices = Window.partitionBy("list_name", "pattern").orderBy("slice")
    single = (
        entries.dropna(subset=["list_name", "pattern", "action", "effective_at"])
        .where(F.col("action").isin(*ACTIONS))
        .groupBy("list_name", "pattern", F.col("effective_at").cast("long").alias("valid_from"))
        .agg(F.min_by("action", rank).alias("action"))
        .withColumn("slice", F.floor(F.col("valid_from") / period))
    )
    later = (
        single.groupBy("list_name", "pattern", "slice")
        .agg(F.min("valid_from").alias("opens"))
        .select("list_name", "pattern", "slice", F.lead("opens").over(slices).alias("after"))
    )
    return (
        single.withColumn("next", F.lead("valid_from").over(at))
        .join(later, ["list_name", "pattern", "slice"])
        .select("list_name", "pattern", "action", "valid_from", F.coalesce("next", "after").alias("valid_to"))
        .where(F.col("action") != "remove")
    )


def capture_keys(url: Column, depth: int) -> Column:
    """Patterns that match a URL, as (key, labels, folders).

    ``example.com/`` matches a host and all below it, ``host/a/b/`` all pages of that host below those folders, up to
    ``depth`` folders.
    """
    host, folders = host_of(url), folders_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(
            F.concat(F.array_join(F.slice(labels, i, F.size(labels)), "."), F.lit("/")).alias("key"),
            (F.size(labels) - i + 1).alias("labels"),
            F.lit(0).alias("folders"),
        ),
    )
    deepest = F.least(F.size(folders), F.lit(depth))
    paths = F.when(
        deepest > 0,
        F.transform(
            F.sequence(F.lit(1), F.greatest(deepest, F.lit(1))),
            lambda i: F.struct(
                F.concat(host, F.lit("/"), F.array_join(F.slice(folders, 1, i), "/"), F.lit("/")).alias("key"),
                F.size(labels).alias("labels"),
                i.alias("folders"),
            ),
        ),
    ).otherwise(F.array().cast("array<struct<key:string,labels:int,folders:int>>"))
    return F.when(host != "", F.concat(domains, paths))


def filter_captures(
    captures: DataFrame,
    entries: DataFrame,
    period: int = PERIOD,
    id_column: str = "page_id",
    url_column: str = "url",
    time_column: str = "fetched_at",
) -> DataFrame:
    """(page_id, fetched_at, host, verdict, pattern, list_name, valid_from), one row per row of ``captures``.

    Times are whole seconds. The verdict is that of the most specific entry active at the fetch: most folders, then
    most labels; of equal ones a block, then the first list by name. It is ``unlisted`` where none is active, which
    holds for null URLs, URLs without a host and null times. Patterns are ``domain/`` or ``host/folders/``, hosts in
    lower case. Other columns are not read.
    """
    intervals = materialize(validity_intervals(entries, period), "list-intervals")
    thin = captures.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).alias("url"),
        F.col(time_column).cast("long").alias("fetched_at"),
    )
    # Equal captures get one verdict, so each is judged once and comes back as often as it was there.
    thin = thin.groupBy("page_id", "url", "fetched_at").agg(F.count("*").alias("times"))
    thin = materialize(thin.withColumn("host", host_of(F.col("url"))), "captures")
    span = thin.agg(F.min("fetched_at"), F.max("fetched_at")).first()
    depth = intervals.agg(F.max(F.size(F.split("pattern", "/")) - 2)).first()[0]
    first, last = (0, -1) if span[0] is None else (span[0] // period, span[1] // period)
    begins = F.greatest(F.floor(F.col("valid_from") / period), F.lit(first))
    ends = F.least(F.coalesce(F.floor((F.col("valid_to") - 1) / period), F.lit(last)), F.lit(last))
    pieces = intervals.where(begins <= ends).withColumn("slice", F.explode(F.sequence(begins, ends)))
    keys = thin.select(
        "*",
        F.floor(F.col("fetched_at") / period).alias("slice"),
        F.explode_outer(capture_keys(F.col("url"), depth or 0)).alias("match"),
    )
    active = (
        (keys["match"]["key"] == pieces["pattern"])
        & (keys["slice"] == pieces["slice"])
        & (keys["fetched_at"] >= pieces["valid_from"])
        & (pieces["valid_to"].isNull() | (keys["fetched_at"] < pieces["valid_to"]))
    )
    order = F.struct(
        (-F.col("match.folders")).alias("folders"),
        (-F.col("match.labels")).alias("labels"),
        (F.col("action") != "block").alias("allowed"),
        "list_name",
        "pattern",
        "valid_from",
        "action",
    )
    best = (
        keys.join(pieces, active, "left")
        .groupBy("page_id", "url", "fetched_at", "host", "times")
        .agg(F.min(F.when(F.col("action").isNotNull(), order)).alias("best"))
    )
    return best.select(
        "page_id",
        "fetched_at",
        "host",
        F.coalesce("best.action", F.lit("unlisted")).alias("verdict"),
        "best.pattern",
        "best.list_name",
        "best.valid_from",
        F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"),
    ).drop("copy")
