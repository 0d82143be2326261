"""Removal of boilerplate lines of a site by their share of its pages (operator 8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actionspark.llm.common import SPACE, ascii_lower, own_names, stored, table
from actionspark.llm.lines import frequent_lines, with_frequent

RATIO = 0.3
MIN_PAGES = 2
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
BREAKS = r"(?i)</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|footer|h[1-6]|head|header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>"
TAGS = r"<[^>]*>"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)"
# The entities that mark-up itself needs, the ampersand last.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
# White space within a line that is not one space: what collapsing changes.
UNEVEN = r"[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*|\x20[\x20\x09\x0B-\x0D]+"
OUTPUTS = ("host", "host_pages", "n_lines", "n_dropped", "clean_text")


def visible_lines(html: Column) -> Column:
    """The lines a reader sees: block tags break lines, other mark-up goes, white space is collapsed."""
    text = F.regexp_replace(F.regexp_replace(html, HIDDEN, ""), BREAKS, "\n")
    plain = F.array(F.regexp_replace(text, TAGS, ""))  # so that the next step names it and does not compute it again

    def read(text: Column) -> Column:
        out = text
        for entity, character in ENTITIES:
            out = F.replace(out, F.lit(entity), F.lit(character))
        return F.when(F.contains(text, F.lit("&")), out).otherwise(text)

    text = F.get(F.transform(plain, read), F.lit(0))
    lines = F.transform(F.split(F.regexp_replace(text, UNEVEN, " "), "\n", -1), lambda x: F.trim(x))
    return F.coalesce(F.filter(lines, lambda x: x != ""), F.array().cast("array<string>"))


@own_names(OUTPUTS, "url", "html")
def drop_boilerplate(
    pages: DataFrame,
    url: str = "url",
    html: str = "html",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``pages`` with host, host_pages, n_lines, n_dropped and clean_text (the lines that stay).

    The pages of a host that hold a line, divided by the host's pages, is the line's ratio; lines over ``ratio``
    and on more than ``min_pages`` pages are dropped wherever they stand. Lines are compared with ASCII letters in
    lower case. Mark-up is taken apart once: the rows with their lines are stored, and counted and cleaned from there.

    Edge cases: a NULL or empty html has no lines and an empty clean_text, but is a page of its host; a url that is NULL
    or has no host belongs to the host ''; repeated rows are pages of their own; an empty table gives an
    empty one. Input columns named like an output are replaced.
    """
    rows = pages.withColumn("host", ascii_host(F.col(url))).withColumn("lines", visible_lines(F.col(html)))
    rows = stored(rows, "lines").withColumn("keys", F.transform("lines", lambda x: F.xxhash64(ascii_lower(x))))
    seen = rows.select("host", F.lit(None).cast("long").alias("page"), "keys")
    rows = with_frequent(rows, "host", frequent_lines(seen, ratio, min_pages, distinct=False))
    kept = F.filter("lines", lambda x, i: ~F.array_contains("frequent", F.get("keys", i)))
    rows = rows.withColumn("stay", F.when(F.size("frequent") > 0, kept).otherwise(F.col("lines")))
    return (
        rows.withColumnRenamed("n_pages", "host_pages")
        .withColumn("n_lines", F.size("lines").cast("long"))
        .withColumn("n_dropped", F.col("n_lines") - F.size("stay"))
        .withColumn("clean_text", F.array_join("stay", "\n"))
    )


def ascii_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return drop_boilerplate(pages).select("page_id", *OUTPUTS)


QUERIES = {"op8_line_dedup": op8_line_dedup}


def _visible_sql() -> str:
    text = f"regexp_replace(regexp_replace(regexp_replace(html, '{HIDDEN}', '', 'g'), '{BREAKS}', chr(10), 'g'), '{TAGS}', '', 'g')"
    for entity, character in ENTITIES:
        text = f"replace({text}, '{entity}', '{character.replace(chr(39), chr(39) * 2)}')"
    return text


SQL = {
    "op8_line_dedup": rf"""
WITH p AS (
  SELECT row_number() OVER () AS r, page_id,
    coalesce(translate(regexp_extract(url, '{HOST}', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    list_filter(list_transform(string_split({_visible_sql()}, chr(10)),
      lambda x: trim(regexp_replace(x, '{SPACE}', ' ', 'g'))), lambda x: x <> '') AS lines
  FROM pages),
l AS (
  SELECT r, host, i, line, translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT r, host, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM p)),
t AS (SELECT host, count(*) AS host_pages FROM p GROUP BY host),
f AS (
  SELECT host, k, 1 AS hit FROM (SELECT host, k, count(DISTINCT r) AS n FROM l GROUP BY host, k) JOIN t USING (host)
  WHERE n > {MIN_PAGES} AND n > host_pages * {RATIO}::DOUBLE),
s AS (
  SELECT r, count(*) AS n_lines, count(hit) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (hit IS NULL), '') AS clean_text
  FROM l LEFT JOIN f USING (host, k) GROUP BY r)
SELECT page_id, host, host_pages, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
  CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped, coalesce(clean_text, '') AS clean_text
FROM p JOIN t USING (host) LEFT JOIN s USING (r)"""
}
