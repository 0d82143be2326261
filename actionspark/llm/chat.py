r"""Chat formatting in budgeted windows (operator 4).

A turn is written ``### role: text </turn>`` and a line feed. In roles and texts a backslash goes before each of
``\ < #``, in roles also before ``:``, so no mark can occur inside them and taking the backslashes out gives the
text back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actionspark.llm.common import on_workers, stored, table
from actionspark.llm.tokens import VOCABULARY, token_counter

BUDGET = 512
HISTORY = 128
RANGE_CHARS = 64
SYSTEM = "system"
TARGET = "assistant"
OPEN, MIDDLE, CLOSE = "### ", ": ", " </turn>\n"
_TURN = re.compile(r"### ([^\\:]*(?:\\.[^\\:]*)*): ([^\\<]*(?:\\.[^\\<]*)*) </turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escaped(text: Column, marks: str) -> Column:
    return F.regexp_replace(text, f"([{marks}])", r"\\$1")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def windows(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
    path: str | None = None,
) -> DataFrame:
    """One row per window: conv, window, text, n_turns, n_repeated, n_tokens and loss (spans of code points).

    A turn counts the tokens of its formatted form by the vocabulary at ``path`` (byte_bpe_50k.json unless given). Turns
    end with a line feed and begin with a mark, and the vocabulary's pattern cannot match across, so ``n_tokens`` is
    what the library counts for the whole window. A system turn at the head of a conversation opens each of its windows.
    The other turns' running sum, ``before``, is cut into blocks of what the budget leaves beside system turn and
    history (a quarter of it at least): turns that end in the block they begin in make one window, a turn
    that crosses a block's end makes its own. So a window exceeds the budget only by a turn or system turn that
    is itself too long; no turn is cut. Before its own turns a window repeats those that begin in the
    ``history`` tokens before it. ``n_repeated`` is how many of the window's turns an earlier window had. ``loss`` covers
    the texts of its own assistant turns, so each assistant turn is a target exactly once.

    Running sums are taken in two levels, over ranges of the turns in order and within a range, so a conversation of
    any length is many tasks. A turn is sent to its window and to the next windows that may repeat it, and a window,
    which the budget bounds, is put together from those.

    Edge cases: NULL text or role is empty; a NULL conversation is one of its own; turns come in the order of turn (NULL
    first), role, text, so ties and repeated rows are turns in a defined order; an empty table gives no window;
    further columns are not carried along.
    """
    rows, heads = _placed(turns, conv, turn, role, text, path or public_tokenizers.path(VOCABULARY))
    room = F.greatest(F.lit(max(1, budget // 4)), F.lit(budget - history) - F.col("_head_tokens"))
    block = F.floor(F.col("_before") / room)
    crosses = (F.col("_before") > 0) & (F.floor((F.col("_before") + F.col("_tokens") - 1) / room) > block)
    rows = rows.withColumn("_window", F.when(F.col("_rank") == 1, 0).otherwise(2 * block + crosses.cast("int")).cast("long"))
    last = (2 * F.floor((F.col("_before") + history) / room) + 1).cast("long")
    again = (F.col("_before") >= 0) & (F.col("_tokens") <= history) & (last > F.col("_window"))  # a longer turn ends too late
    following = F.when(again, F.sequence(F.col("_window") + 1, last))
    at = F.concat(F.array("_window"), F.coalesce(following, F.array().cast("array<bigint>")))
    sent = rows.withColumn("_at", F.explode(at))

    piece = F.struct("_rank", "_before", "_open", "_body", "_target", "_tokens")
    own = F.col("_at") == F.col("_window")
    made = sent.groupBy("_conv", "_at").agg(
        F.array_sort(F.collect_list(F.when(own, piece))).alias("_own"),
        F.array_sort(F.collect_list(F.when(~own, piece))).alias("_earlier"),
    )
    made = made.filter(F.size("_own") > 0).join(heads, F.col("_conv").eqNullSafe(F.col("_head_conv")), "left")
    first = F.col("_own")[0]
    earlier = F.filter("_earlier", lambda t: t["_before"] >= first["_before"] - history)
    system = F.when(F.col("_head").isNotNull() & (first["_rank"] > 1), F.array("_head"))
    again = F.concat(F.coalesce(system, F.slice("_own", 1, 0)), earlier)
    made = made.withColumn("_again", again).withColumn("n_repeated", F.size("_again").cast("long"))
    made = made.withColumn("_all", F.concat("_again", "_own"))
    nothing = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("n"), nothing.alias("spans"))

    def step(a, t):
        begin = a["at"] + F.length(t["_open"])
        end = begin + F.length(t["_body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("stop")))
        target = t["_target"] & (a["n"] >= F.col("n_repeated"))
        spans = F.when(target, F.concat(a["spans"], span)).otherwise(a["spans"])
        return F.struct((end + len(CLOSE)).alias("at"), (a["n"] + 1).alias("n"), spans.alias("spans"))

    return made.select(
        F.col("_conv").alias(conv),
        F.col("_at").alias("window"),
        F.array_join(F.transform("_all", lambda t: F.concat(t["_open"], t["_body"], F.lit(CLOSE))), "").alias("text"),
        F.size("_all").cast("long").alias("n_turns"),
        "n_repeated",
        F.aggregate("_all", F.lit(0).cast("long"), lambda a, t: a + t["_tokens"]).alias("n_tokens"),
        F.aggregate("_all", start, step, lambda a: a["spans"]).alias("loss"),
    )


def _placed(turns: DataFrame, conv: str, turn: str, role: str, text: str, path: str) -> tuple[DataFrame, DataFrame]:
    """The formatted turns with their place in the conversation, and the conversations' system turns.

    Turns have _rank (from 1), _before (tokens of the turns before, but for a system turn at the head, which has -1) and
    _head_tokens (those of the system turn). Turns are dealt to ranges in their order, and what the ranges before hold of the
    same conversation is added. Only a conversation that goes on from one range into the next has such a sum: there are
    fewer of them than ranges, so they are broadcast.
    """
    rows = turns.select(
        F.col(conv).alias("_conv"),
        F.col(turn).alias("_turn"),
        F.coalesce(F.col(role), F.lit("")).alias("_role"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    rows = rows.repartitionByRange("_conv", "_turn", "_role", F.substring("_text", 1, RANGE_CHARS))
    rows = rows.withColumn("_range", F.spark_partition_id())
    opened, body = _formatted(F.col("_role"), F.col("_text"))
    tokens = token_counter(turns.sparkSession, path)
    rows = stored(rows.withColumn("_tokens", tokens(F.concat(opened, body, F.lit(CLOSE)))), "turns")

    heads = rows.groupBy("_conv").agg(F.min(F.struct("_turn", "_role", "_text", "_tokens")).alias("_first"))
    first = F.col("_first")
    head_opened, head_body = _formatted(first["_role"], first["_text"])
    whole = F.struct(
        F.lit(1).alias("_rank"),
        F.lit(-1).cast("long").alias("_before"),
        head_opened.alias("_open"),
        head_body.alias("_body"),
        F.lit(False).alias("_target"),
        first["_tokens"].alias("_tokens"),
    )
    heads = heads.filter(first["_role"] == SYSTEM).select(F.col("_conv").alias("_head_conv"), whole.alias("_head"))
    heads = stored(heads, "heads")

    ranges = rows.groupBy("_conv", "_range").agg(F.sum("_tokens").alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    ahead = Window.partitionBy("_conv").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        F.col("_conv").alias("_c"), F.col("_range").alias("_r"), F.sum("_sum").over(ahead).alias("_ahead"), F.sum("_rows").over(ahead).alias("_ranks")
    ).filter("_ranks IS NOT NULL")
    lengths = heads.select("_head_conv", F.col("_head._tokens").alias("_known"))
    ranges = stored(ranges.join(lengths, F.col("_c").eqNullSafe(F.col("_head_conv")), "left").drop("_head_conv"), "ranges")

    same = F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_range") == F.col("_r"))
    rows = rows.join(F.broadcast(ranges), same, "left")
    zero = F.lit(0).cast("long")
    order = Window.partitionBy("_conv", "_range").orderBy(F.col("_turn").asc_nulls_first(), "_role", "_text")
    sofar = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_rank", F.row_number().over(order) + F.coalesce("_ranks", zero))
    rows = rows.withColumn("_sum", F.coalesce(F.sum("_tokens").over(sofar), zero) + F.coalesce("_ahead", zero))
    is_head = (F.col("_rank") == 1) & (F.col("_role") == SYSTEM)
    here = F.max(F.when(is_head, F.col("_tokens"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("_head_tokens", F.coalesce("_known", here, zero))
    rows = rows.withColumn("_before", F.when(is_head, F.lit(-1).cast("long")).otherwise(F.col("_sum") - F.col("_head_tokens")))
    rows = rows.withColumn("_open", opened).withColumn("_body", body).withColumn("_target", F.col("_role") == TARGET)
    return rows, heads


def _formatted(role: Column, text: Column) -> tuple[Column, Column]:
    """What stands before a turn's text, and the text as it is written."""
    return F.concat(F.lit(OPEN), escaped(role, r"\\<#:"), F.lit(MIDDLE)), escaped(text, r"\\<#")


def read_window(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted window, as (role, text)."""
    turns, at = [], 0
    while at < len(text):
        found = _TURN.match(text, at)
        if not found:
            raise ValueError(f"no turn at {at}: {text[at : at + 40]!r}")
        turns.append((unescaped(found[1]), unescaped(found[2])))
        at = found.end()
    return turns


DIGEST = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Per conversation, from its windows alone: digests of its turns and of what the loss covers.

    Windows are sorted by conversation and read as a stream; a task holds one window and two running digests. A digest
    covers a whole conversation in order, so this, unlike the formatting, reads a conversation in one task.
    """
    on_workers(formatted.sparkSession)
    kind = formatted.schema[conv].dataType.simpleString()
    narrow = formatted.select(conv, "window", "text", "n_repeated", "loss")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if state is None or state["conv"] != row[conv]:
                    if state:
                        done.append(closed(state))
                    state = {"conv": row[conv], "turns": 0, "loss": 0, "chars": 0, "a": hashlib.sha256(), "b": hashlib.sha256()}
                text = row["text"]
                for role, said in read_window(text)[row["n_repeated"] :]:
                    state["turns"] += 1
                    state["a"].update(f"{role}\n{said}\n".encode())
                for span in row["loss"]:
                    said = unescaped(text[span["start"] : span["stop"]])
                    state["loss"] += len(said)
                    state["b"].update(said.encode())
                state["chars"] += len(text)
            if done:
                yield to_batch(done)
        if state:
            yield to_batch([closed(state)])

    def closed(s):
        return (s["conv"], s["turns"], s["a"].hexdigest(), s["loss"], s["b"].hexdigest(), s["chars"])

    arrow = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    names = [conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [arrow, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def to_batch(rows):
        columns = [pa.array(list(c), type=k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    ordered = narrow.repartition(conv).sortWithinPartitions(F.col(conv).asc_nulls_first(), "window")
    return ordered.mapInArrow(digest, f"{conv} {kind}, {DIGEST}")


def op4_chat_format(spark, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, TARGET, said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(windows(turns.unionByName(own)))


QUERIES = {"op4_chat_format": op4_chat_format}

DIGEST_SQL = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256
FROM c GROUP BY conv_id"""
# The windows are not stated in SQL, so formatted_chars has no twin; the tests compare the rest with DIGEST_SQL.
SQL: dict[str, str] = {}
