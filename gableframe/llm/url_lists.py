"""Dated URL lists joined to captures as of their fetch time.

List entries are changes: from a moment on, a pattern blocks, allows, or is off the
list. Each pattern's changes become validity intervals, from one change to the
next. A capture has a key for its URL, for every leading part of its path and for
every domain it lies in. The as-of join puts interval starts and the moments asked
for in one order per key and block of time: the last start at or before a moment is
its interval, or the one carried in from earlier blocks. The most specific pattern on
the list decides.

All of it is DataFrame operations. Captures are reduced to different pairs of URL
and time before keys are made, and only those narrow rows are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Kinds of pattern, from wide to narrow.
KINDS = ("domain", "prefix", "url")
#: What a change does; where changes of one pattern fall on one moment, the last of
#: this list that occurs holds.
ACTIONS = ("remove", "allow", "block")
UNLISTED = "unlisted"
#: Seconds of a block of time within which one task orders a pattern's moments.
BLOCK = 3600
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host(url: Column) -> Column:
    """Lower-case host; empty without one, null for null."""
    return F.lower(F.regexp_extract(url, _HOST, 1))


def path(url: Column) -> Column:
    """Path without query and fragment, at least '/'."""
    found = F.regexp_extract(url, _PATH, 1)
    return F.when(found == "", "/").otherwise(found)


def domains(name: Column) -> Column:
    """The host and the domains above it, down to two labels."""
    parts = F.split(name, r"\.")
    n = F.size(parts)
    up = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, i, n), "."))
    return F.when(name != "", up).otherwise(F.array().cast("array<string>"))


def prefixes(name: Column, way: Column) -> Column:
    """Host and path up to each slash."""
    parts = F.split(way, "/")
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))),
        lambda i: F.concat(name, F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")),
    )


def keys(url: Column) -> Column:
    """Array of (kind, pattern) a capture can be listed under."""
    name, way = host(url), path(url)

    def of(kind: str, patterns: Column) -> Column:
        return F.transform(patterns, lambda p: F.struct(F.lit(kind).alias("kind"), p.alias("pattern")))

    return F.concat(of("domain", domains(name)), of("prefix", prefixes(name, way)), of("url", F.array(F.concat(name, way))))


def intervals(changes: DataFrame) -> DataFrame:
    """``(kind, pattern, action, since, until)`` from ``changes(kind, pattern, action,
    at)``: the times a pattern is on the list; ``until`` is null for the last change.
    Changes with a null in any of the four, or of another kind or action, are void.

    A change is followed by the next of its day, and the last of a day by the first of
    the next day that has any, so no task orders all changes of a pattern: it orders
    those of a day, or one row per day.
    """
    known = changes.where(F.col("kind").isin(*KINDS) & F.col("action").isin(*ACTIONS) & F.col("pattern").isNotNull() & F.col("at").isNotNull())
    strength = F.array_position(F.array(*map(F.lit, ACTIONS)), F.col("action"))
    single = known.groupBy("kind", "pattern", "at").agg(F.max_by("action", strength).alias("action"))
    single = materialize(single.withColumn("on", F.to_date("at")), "url-changes")
    within = F.lead("at").over(Window.partitionBy("kind", "pattern", "on").orderBy("at"))
    after = F.lead("first").over(Window.partitionBy("kind", "pattern").orderBy("on"))
    days = single.groupBy("kind", "pattern", "on").agg(F.min("at").alias("first")).withColumn("after", after).drop("first")
    until = F.coalesce("within", "after")
    both = single.withColumn("within", within).join(days, ["kind", "pattern", "on"])
    return both.select("kind", "pattern", "action", F.col("at").alias("since"), until.alias("until")).where("action <> 'remove'")


def as_of(moments: DataFrame, held: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(kind, pattern, t, action, since)`` for each different ``moments(kind, pattern,
    t)`` that lies in one of the intervals ``held``.

    Both sides are put in one order per pattern and block of ``block`` seconds, where
    each moment takes the last start at or before it. What a block ends with is carried
    to the later ones over one row per pattern and block, so no task orders all moments
    or changes of a pattern, and an interval is one row however long it lasts. Equal
    moments of a hot pattern are one row.
    """
    entry = F.struct("since", "until", "action")
    number = F.floor(F.unix_seconds(F.col("t").cast("timestamp")) / block)
    starts = held.select("kind", "pattern", F.col("since").alias("t"), entry.alias("entry"))
    both = starts.unionByName(moments.select("kind", "pattern", "t").distinct(), allowMissingColumns=True)
    both = materialize(both.withColumn("block", number), "url-moments")
    ends = both.groupBy("kind", "pattern", "block").agg(F.max("entry").alias("last"))
    earlier = Window.partitionBy("kind", "pattern").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("carried", F.last("last", ignorenulls=True).over(earlier)).drop("last")
    # a start and a moment at one time are peers, so the start counts
    inside = Window.partitionBy("kind", "pattern", "block").orderBy("t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    own = both.withColumn("own", F.last("entry", ignorenulls=True).over(inside)).where("entry IS NULL")
    found = own.join(carried, ["kind", "pattern", "block"]).withColumn("entry", F.coalesce("own", "carried"))
    return found.where("entry IS NOT NULL AND (entry.until IS NULL OR t < entry.until)").select("kind", "pattern", "t", "entry.action", "entry.since")


def verdicts(captures: DataFrame, changes: DataFrame, url: str = "url", at: str = "fetched_at") -> DataFrame:
    """All columns of the captures and ``verdict`` (block, allow or unlisted), ``kind``,
    ``pattern`` and ``since`` of the deciding entry (null if unlisted).

    Narrower kinds win over wider ones, longer patterns over shorter ones. An
    interval holds from its change on, up to but not at the next. Captures with a
    null URL or time, or without a host, are unlisted; repeated captures stay
    repeated; an empty list leaves all unlisted. Columns with the four names are
    refused, all others kept, whatever their names. Times may be timestamps with or without a zone, in both tables alike.
    """
    made = {"verdict", "kind", "pattern", "since"}
    if made & set(captures.columns):
        raise ValueError(f"These columns are made here: {sorted(made & set(captures.columns))}")
    pairs = captures.select(F.col(url).alias("u"), F.col(at).alias("t")).where("u IS NOT NULL AND t IS NOT NULL").distinct()
    asked = pairs.where(host(F.col("u")) != "").select("u", "t", F.inline(keys(F.col("u"))))
    asked = materialize(asked, "url-asked")
    met = asked.join(as_of(asked.select("kind", "pattern", "t"), intervals(changes)), ["kind", "pattern", "t"])
    rank = F.struct(F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("r"), F.length("pattern").alias("n"), "pattern")
    best = met.groupBy("u", "t").agg(F.max_by(F.struct("action", "kind", "pattern", "since"), rank).alias("__entry"))
    best = materialize(best.select(F.col("u").alias("__u"), F.col("t").alias("__t"), "__entry"), "url-verdicts")
    joined = captures.join(best, (captures[url] == best["__u"]) & (captures[at] == best["__t"]), "left")
    entry = best["__entry"]
    return joined.select(
        *[captures[c] for c in captures.columns],
        F.coalesce(entry["action"], F.lit(UNLISTED)).alias("verdict"),
        *(entry[c].alias(c) for c in ("kind", "pattern", "since")),
    )
