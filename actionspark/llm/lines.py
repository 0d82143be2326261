"""Frequency of lines across the pages of a host: what operators 2 and 8 share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actionspark.llm.common import SPACE_CHARS, ascii_lower, stored

BROADCAST_LINES = 1_000_000
SALTS = 64
# White space that is not one space: what collapsing changes.
UNEVEN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(line: Column) -> Column:
    """ASCII letters in lower case, white space collapsed and trimmed. ``line`` is a name, not an expression: it is read
    several times."""
    ascii_only = F.octet_length(line) == F.char_length(line)  # most lines; there the quick function does the same
    lower = F.when(ascii_only, F.lower(line)).otherwise(ascii_lower(line))
    return F.trim(F.regexp_replace(lower, UNEVEN, " "))


def worded(text: Column) -> Column:
    """The lines of a text that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, SPACE_CHARS, "")) > 0)


def line_key(line: Column) -> Column:
    return F.xxhash64(normalised(line))


def frequent_lines(pages: DataFrame, share: float, least: int, distinct: bool) -> DataFrame:
    """One row per host: ``n_pages`` and ``frequent``, the keys of lines on more than ``least`` pages and more than
    ``share`` of the host's pages.

    ``pages`` holds host, page (a key, used if ``distinct``: pages with equal keys count once) and keys (an array of
    line keys). A NULL key stands for the page itself, so the same aggregate counts pages and lines; it sums up
    before it shuffles, and a line or host on a third of all pages arrives as one row per task. A line
    in ``frequent`` is on more than ``share`` of the pages, so there are at most (mean lines per page / share) of them.
    """
    keys = F.explode(F.concat(F.array_distinct("keys"), F.array(F.lit(None).cast("long"))))
    found = pages.select("host", "page", keys.alias("key"))
    many = F.count_distinct("page") if distinct else F.count(F.lit(1))
    counts = found.groupBy("host", "key").agg(many.alias("n"))
    counts = stored(counts.filter(F.col("key").isNull() | (F.col("n") > least)), "line_counts")
    totals = counts.filter("key IS NULL").select(F.col("host").alias("_host"), F.col("n").alias("n_pages"))
    over = (F.col("n") > F.col("n_pages") * share) & F.col("key").isNotNull()
    joined = totals.join(counts, F.col("_host").eqNullSafe(F.col("host")))
    frequent = F.collect_list(F.when(over, F.col("key")))
    out = joined.groupBy("_host").agg(F.max("n_pages").alias("n_pages"), frequent.alias("frequent"))
    return stored(out, "frequent_lines")


def with_frequent(rows: DataFrame, host: str, lines: DataFrame) -> DataFrame:
    """``rows`` with n_pages and frequent of their host.

    The table of hosts is broadcast if it and its lists are small. Else it is joined on (host, salt), each host
    repeated for every salt, so that the rows of a hot host are spread over many tasks.
    """
    size = lines.agg(F.coalesce(F.sum(F.size("frequent") + 1), F.lit(0))).first()[0]
    if size <= BROADCAST_LINES:
        return rows.join(F.broadcast(lines), F.col(host).eqNullSafe(F.col("_host"))).drop("_host")
    salted = lines.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("_salt", F.floor(F.rand(7) * SALTS).cast("int"))
    same = F.col(host).eqNullSafe(F.col("_host")) & (F.col("_salt") == F.col("_s"))
    return rows.join(salted, same).drop("_host", "_s", "_salt")
