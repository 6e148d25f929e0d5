"""URL filters whose lists change: every capture against the entries active when it was fetched.

A list is a feed of dated entries: from a moment on a domain is listed, or no longer. Entries of a domain
follow one another, so each is valid until the next one, and an as-of join gives every capture the listed
intervals of its host and of the domains above it that contain its fetch time. The days of an interval are cut into
stretches whose lengths are powers of two and which begin at multiples of their length, at most two of a length, so that ten
years take some twenty rows and not thousands. A capture looks for the one stretch of each length in use that holds its
day: a domain with a third of all captures is spread over its stretches, and what is left of such a group
is an ordinary skewed join, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellrecon.session import written

DAY = 86_400
#: Lengths of stretches, up to more days than a time in seconds can have.
_LEVELS = 48


def host(url: Column) -> Column:
    """The lower-case host of an absolute url, null where there is none."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", F.rtrim(found, F.lit(".")))


def domains(name: Column) -> Column:
    """The host and every domain above it with at least two labels; a host of one label alone."""
    labels = F.split(name, r"\.")
    starts = F.sequence(F.lit(0), F.greatest(F.size(labels) - 2, F.lit(0)))
    return F.transform(starts, lambda i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """``domain, since, until`` of the times a domain is listed, from ``domain, at, listed``; an open end is null.

    Of several entries for the same moment one that lists is the one that counts. Entries without a domain
    or a time are ignored, a null ``listed`` is false. Entries that change nothing are left out, so that a
    domain has no more rows than changes.
    """
    states = (
        entries.filter("domain is not null and at is not null")
        .groupBy("domain", "at")
        .agg(F.max(F.coalesce("listed", F.lit(False))).alias("listed"))
    )
    order = Window.partitionBy("domain").orderBy("at")
    changes = states.withColumn("before", F.lag("listed").over(order)).filter("before is null or before <> listed")
    return (
        changes.withColumn("until", F.lead("at").over(order))
        .filter("listed")
        .select("domain", F.col("at").alias("since"), "until")
    )


def stretches(first: Column, last: Column) -> Column:
    """The days from ``first`` to ``last`` as ``level, bucket``: ``2 ** level`` days from ``bucket * 2 ** level`` on, each day once.

    Of a length the first stretch inside is taken if it is no first half of a longer one inside, the last if it is
    no second half.
    """

    def of(level: Column) -> Column:
        begin = F.call_function("shiftright", first + F.call_function("shiftleft", F.lit(1).cast("bigint"), level) - 1, level)
        end = F.call_function("shiftright", last + 1, level)
        some = begin < end
        piece = lambda b: F.struct(level.alias("level"), b.alias("bucket"))
        return F.array(
            F.when(some & (begin.bitwiseAND(F.lit(1)) == 1), piece(begin)),
            F.when(some & (end.bitwiseAND(F.lit(1)) == 1), piece(end - 1)),
        )

    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(_LEVELS - 1)), of)))


def evaluate(captures: DataFrame, entries: DataFrame, id_col: str = "page_id") -> DataFrame:
    """A row for each capture: its id, ``host``, ``blocked``, and the most specific listed ``domain`` with ``since``.

    ``captures`` has the id, ``url`` and ``fetched_at``, ``entries`` ``domain``, ``at`` and ``listed``, times in epoch seconds. An entry
    holds from its very moment until just before the next. A capture without a host or a time is not blocked.
    Null and repeated ids are kept, a row for each. No captures give no rows, no entries block nothing. Other columns are ignored.
    """
    rows = captures.select(
        F.monotonically_increasing_id().alias("row"),
        captures[id_col].alias("id"),
        host(captures["url"]).alias("host"),
        captures["fetched_at"].cast("bigint").alias("at"),
    )
    # Stored, so that a row keeps its number when a lost task is run again.
    rows = written(rows, "captures")
    ends = captures.agg(F.max(F.col("fetched_at").cast("bigint")).alias("last"))
    day = lambda c: F.floor(c / DAY)
    # One row, so this is no product of tables: an open interval is filed up to the last capture.
    listed = intervals(entries).join(F.broadcast(ends), F.lit(True))
    end = day(F.least(F.coalesce(F.col("until") - 1, "last"), "last"))
    filed = written(
        listed.filter("since <= last")
        .select("domain", "since", "until", F.explode(stretches(day(F.col("since")), end)).alias("stretch"))
        .select("domain", "since", "until", "stretch.*"),
        "intervals",
    )
    levels = [r["level"] for r in filed.select("level").distinct().collect()]  # at most `_LEVELS`
    asked = rows.select("row", "id", "host", "at", F.explode_outer(domains(F.col("host"))).alias("domain"))
    # One without a length to look for still has a row.
    asked = asked.withColumn("level", F.explode(F.array(*map(F.lit, levels or [0])))).withColumn(
        "bucket", F.call_function("shiftright", day(F.col("at")), F.col("level"))
    )
    c, f = asked.alias("c"), filed.alias("f")
    active = (F.col("c.at") >= F.col("f.since")) & (F.col("f.until").isNull() | (F.col("c.at") < F.col("f.until")))
    joined = c.join(f, (F.col("c.domain") == F.col("f.domain")) & (F.col("c.level") == F.col("f.level")) & (F.col("c.bucket") == F.col("f.bucket")) & active, "left")
    found = F.max(F.when(F.col("f.since").isNotNull(), F.struct(
        F.length("c.domain").alias("n"), F.col("c.domain").alias("domain"), F.col("f.since").alias("since")))).alias("m")
    return joined.groupBy("c.row", "c.id", "c.host").agg(found).select(
        F.col("id").alias(id_col), "host", F.col("m").isNotNull().alias("blocked"), F.col("m.domain").alias("domain"), F.col("m.since").alias("since")
    )
