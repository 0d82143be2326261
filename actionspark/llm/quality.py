"""Quality rules by the frequency of lines across documents (operator 2), in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actionspark.llm.common import SPACE_CHARS, WORD, own_names, stored, table, without, word_count
from actionspark.llm.lines import line_key, worded

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
GRAM = 5
LINE_DOCS = 10
LINE_SHARE = 0.1
SHARE_DOCS = 5
LISTED = 100_000  # frequent lines that are looked up in every task's memory; more are joined
MIN_LEFT_PERCENT = 30
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
VERDICT = ("n_frequent_lines", "n_words_left", "kept", "clean_text")


def base_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns of BASE, all within the row.

    Words in repeated windows: each window of five words is hashed, equal hashes are found by sorting (hash,
    position) where there are any, and the covered words follow from the gaps of the sorted positions.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = without(docs, *(c for c in BASE if c != text)).withColumn("_words", F.regexp_extract_all(body, F.lit(WORD), F.lit(0)))
    rows = rows.withColumn("n_words", F.size("_words").cast("long"))
    rows = rows.withColumn("word_chars", F.length(F.translate(body, SPACE_CHARS, "")).cast("long"))
    rows = rows.withColumn("n_symbols", (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"))
    rows = rows.withColumn("_lines", worded(body))
    rows = rows.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    rows = rows.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w))).drop("_words", "_lines")
    windows = F.transform(
        F.sequence(F.lit(0), (F.col("n_words") - GRAM).cast("int")),
        lambda i: F.xxhash64(*(F.get("_hashes", i + j) for j in range(GRAM))),
    )
    rows = rows.withColumn("_grams", F.when(F.col("n_words") >= GRAM, windows))
    repeats = F.size(F.array_distinct("_grams")) < F.size("_grams")
    pairs = F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))
    rows = rows.withColumn("_sorted", F.when(repeats, F.array_sort(pairs))).drop("_grams", "_hashes")

    def gram(at):
        return F.get("_sorted", at).getField("g")

    equal = F.filter(
        "_sorted",
        lambda x, j: F.coalesce(gram(j - 1) == x.getField("g"), F.lit(False))
        | F.coalesce(gram(j + 1) == x.getField("g"), F.lit(False)),
    )
    rows = rows.withColumn("_starts", F.array_sort(F.transform(equal, lambda x: x.getField("i")))).drop("_sorted")
    gaps = F.transform(
        "_starts", lambda p, j: F.least(F.lit(GRAM), F.coalesce(F.get("_starts", j + 1) - p, F.lit(GRAM)))
    )
    covered = F.aggregate(gaps, F.lit(0), lambda a, g: a + g)
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_starts")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return rows.withColumn("base_failed", failed)


def _site_key(host: Column, line: Column) -> Column:
    """Host and line as one number; a NULL host is told from all others."""
    return F.xxhash64(host.isNull(), host, line)


def _frequent(rows: DataFrame, host: str, text: str, most: int, share: float, least: int) -> DataFrame:
    """(site_key) of the lines that more than ``most`` different texts of their host hold, or more than ``least`` of them
    and more than ``share`` of all.

    What is shuffled is (host, host and line, text) as numbers, once per text and line, copies of a text being one; a
    NULL line stands for the text itself, so the same aggregate counts lines and the host's texts. Counts are
    summed up before they meet, so a line or host on a third of all texts is a row per task. Only lines on ``most`` texts
    or fewer have to pass the share, and only hosts small enough for one to pass it are joined with them.
    """
    keys = F.transform(worded(F.coalesce(F.col(text), F.lit(""))), lambda x: _site_key(F.col(host), line_key(x)))
    found = rows.select(
        F.xxhash64(F.col(text)).alias("page"),
        F.xxhash64(F.col(host).isNull(), F.col(host)).alias("site"),
        F.explode(F.concat(F.array_distinct(keys), F.array(F.lit(None).cast("long")))).alias("site_key"),
    )
    counts = found.groupBy("site", "site_key").agg(F.count_distinct("page").alias("n"))
    counts = stored(counts.filter(F.col("site_key").isNull() | (F.col("n") > min(most, least))), "line_counts")
    found = counts.filter(F.col("site_key").isNotNull())
    texts = counts.filter(F.col("site_key").isNull()).select("site", F.col("n").alias("n_texts"))
    small = texts.filter(F.col("n_texts") * share < most)
    rest = found.filter((F.col("n") > least) & (F.col("n") <= most)).join(small, "site")
    shared = rest.filter(F.col("n") > F.col("n_texts") * share)
    frequent = found.filter(F.col("n") > most).select("site_key").unionAll(shared.select("site_key"))
    return stored(frequent, "frequent_lines")


def _lines_out(rows: DataFrame, host: str, text: str, frequent: DataFrame) -> DataFrame:
    """``rows`` with ``out``: for each line of the text whether it is a frequent one; NULL where none is.

    Up to LISTED frequent lines are a hashed set in the plan. If there are more, the texts' lines are joined with them on
    the key, which the planner splits where a line is hot, and what they hold comes back by host and text.
    """
    listed = frequent.limit(LISTED + 1).count()
    parts = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    worded_line = lambda x: F.length(F.translate(x, SPACE_CHARS, "")) > 0
    if listed <= LISTED:
        known = [r[0] for r in frequent.collect()]
        out = F.transform(parts, lambda x: worded_line(x) & _site_key(F.col(host), line_key(x)).isin(known))
        rows = rows.withColumn("out", out if known else F.lit(None).cast("array<boolean>"))
    else:
        rows = rows.withColumn("page", F.xxhash64(F.col(host).isNull(), F.col(host), F.col(text)))
        keys = F.transform(worded(F.coalesce(F.col(text), F.lit(""))), lambda x: _site_key(F.col(host), line_key(x)))
        each = rows.select("page", F.explode(F.array_distinct(keys)).alias("site_key")).distinct()
        held = each.join(frequent, "site_key").groupBy("page").agg(F.collect_list("site_key").alias("held"))
        rows = rows.join(stored(held, "held_lines"), "page", "left")
        out = F.transform(
            parts, lambda x: worded_line(x) & F.array_contains("held", _site_key(F.col(host), line_key(x)))
        )
        rows = rows.withColumn("out", F.when(F.col("held").isNotNull(), out))
    return rows.withColumn("out", F.when(F.array_contains("out", True), F.col("out")))


@own_names((*BASE, *VERDICT), "host", "text")
def quality(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    line_docs: int = LINE_DOCS,
    line_share: float = LINE_SHARE,
    share_docs: int = SHARE_DOCS,
) -> DataFrame:
    """``docs`` with BASE and n_frequent_lines, n_words_left, kept and clean_text.

    A line, with ASCII letters in lower case and white space collapsed, is frequent if more than ``line_docs``
    documents of its host hold it, however large the host is; on a small host it also is if more than ``share_docs``
    documents and more than ``line_share`` of all documents of the host hold it. Documents of a host with equal texts
    count once, so a document is not lost for having exact copies. Frequent lines are taken out of ``clean_text``. A
    document is depleted, and not kept, if fewer than ten words or less than three tenths of its words are left; nor is
    one kept that fails the base rules.

    Edge cases: a NULL or empty text has no words and fails; a NULL host is a host of its own; repeated rows get equal
    verdicts; an empty table gives an empty one. Input columns named like an output are replaced.
    """
    rows = base_features(docs, text)
    rows = _lines_out(rows, host, text, _frequent(docs, host, text, line_docs, line_share, share_docs))
    lines = F.split(F.col(text), "\n", -1)
    gone = F.filter(lines, lambda x, i: F.get("out", i))
    stay = F.filter(lines, lambda x, i: ~F.get("out", i))
    lost = F.aggregate(gone, F.lit(0).cast("long"), lambda a, x: a + word_count(x))
    some = F.col("out").isNotNull()
    rows = rows.withColumn("n_frequent_lines", F.when(some, F.size(gone)).otherwise(F.lit(0)).cast("long"))
    rows = rows.withColumn("n_words_left", F.col("n_words") - F.when(some, lost).otherwise(F.lit(0)))
    depleted = (F.col("n_words_left") < MIN_WORDS) | (
        100 * F.col("n_words_left") < MIN_LEFT_PERCENT * F.col("n_words")
    )
    # Always true, but not known before it runs: a filter on the verdict stays above it, where it reads a column, and is
    # not pushed down to the scan, where it would hold every expression above many times over.
    there = F.monotonically_increasing_id() >= 0
    return rows.withColumn("clean_text", F.when(some, F.array_join(stay, "\n")).otherwise(F.col(text))).withColumn(
        "kept", ~F.col("base_failed") & ~depleted & there
    )


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return quality(docs).select("doc_id", *BASE, "n_frequent_lines", "n_words_left", "kept")


QUERIES = {"op2_quality_rules": op2_quality}

_W = WORD
SQL = {
    "op2_quality_rules": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, text, coalesce(text, '') AS b,
         regexp_extract_all(coalesce(text, ''), '{_W}') AS ws FROM documents),
g AS (
  SELECT r, i, ws[i:i+4] AS gram FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)),
rep AS (SELECT r, gram FROM g GROUP BY r, gram HAVING count(*) > 1),
cov AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM g JOIN rep USING (r, gram)) GROUP BY r),
l AS (
  SELECT r, source, text, line, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM (SELECT r, source, text, unnest(string_split(b, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_W}')),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM l GROUP BY r),
tot AS (SELECT source, count(DISTINCT text) + CAST(bool_or(text IS NULL) AS INT) AS n FROM d GROUP BY source),
cnt AS (SELECT source, norm, count(DISTINCT text) AS n FROM l GROUP BY source, norm),
freq AS (
  SELECT cnt.source, norm FROM cnt JOIN tot ON cnt.source IS NOT DISTINCT FROM tot.source
  WHERE cnt.n > {LINE_DOCS} OR (cnt.n > {SHARE_DOCS} AND cnt.n > tot.n * {LINE_SHARE}::DOUBLE)),
lost AS (
  SELECT r, count(*) AS nl, sum(len(regexp_extract_all(line, '{_W}'))) AS n
  FROM l JOIN freq ON l.source IS NOT DISTINCT FROM freq.source AND l.norm = freq.norm GROUP BY r),
f AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(translate(b, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS BIGINT) AS word_chars,
    CAST(length(b) - length(translate(b, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(lost.nl, 0) AS BIGINT) AS n_frequent_lines, CAST(len(ws) - coalesce(lost.n, 0) AS BIGINT) AS n_words_left
  FROM d LEFT JOIN dup USING (r) LEFT JOIN cov USING (r) LEFT JOIN lost USING (r))
SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_words_left >= {MIN_WORDS}
    AND 100 * n_words_left >= {MIN_LEFT_PERCENT} * n_words AS kept
FROM f"""
}
