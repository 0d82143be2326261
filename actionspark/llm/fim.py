"""Fill-in-the-middle texts whose cuts are found through content-defined chunks (operator 13)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actionspark.llm.common import free, on_workers, table, without

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
SEED = "1:"
PLAIN_PERCENT, SPM_PERCENT = 10, 20
OUTPUTS = ("n", "form", "prefix_chars", "middle_chars", "fim_text")

WINDOW = 32  # bytes the rolling hash looks back
LEAST, MOST, ONE_IN_BITS = 256, 8192, 10  # bytes of a chunk; a place in 2^10 is a boundary
SLICE = 1 << 20
CACHED_BYTES = 32 << 20
_GEAR = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes that end at each byte (of fewer, at the start), doubled up from hashes of one byte."""
    h = _GEAR[data]
    for s in (1, 2, 4, 8, 16):
        h[s:] = h[s:] + (h[:-s] << np.uint32(s))
    return h


def chunk_ends(text: bytes) -> list[int]:
    """Where the chunks of a text end. A boundary depends on the bytes just before it and on the boundary before, so equal
    passages are cut alike soon after they begin, wherever they stand. A slice of a long text is hashed at a time."""
    size, last, ends = len(text), 0, []
    if size > LEAST:
        data = np.frombuffer(text, np.uint8)
        for start in range(0, size, SLICE):
            left = max(0, start - WINDOW + 1)
            marked = rolling(data[left : start + SLICE])[start - left :] >> np.uint32(32 - ONE_IN_BITS) == 0
            for end in (np.flatnonzero(marked) + (start + 1)).tolist():
                while end - last > MOST:
                    last += MOST
                    ends.append(last)
                if end - last >= LEAST:
                    last = end
                    ends.append(last)
    while size - last > MOST:
        last += MOST
        ends.append(last)
    if size > last:
        ends.append(size)
    return ends


def starts(chunk: bytes) -> np.ndarray:
    """Whether a code point starts at each byte."""
    return (np.frombuffer(chunk, np.uint8) & 0xC0) != 0x80


class Summaries(dict):
    """What is known of each chunk met: how many code points start in it, and whether it holds a mark.

    The key is the chunk itself, so a summary is used only after all bytes were compared. Kept up to a fixed number of
    bytes.
    """

    def __init__(self):
        super().__init__()
        self.bytes = 0

    def __missing__(self, chunk: bytes) -> tuple[int, bool]:
        if self.bytes + len(chunk) > CACHED_BYTES:
            self.clear()
            self.bytes = 0
        value = int(np.count_nonzero(starts(chunk))), any(m in chunk for m in MARKS)
        self[chunk] = value
        self.bytes += len(chunk)
        return value


class Chunked:
    """A text as chunks with their summaries combined."""

    def __init__(self, text: bytes, known: Summaries):
        ends = chunk_ends(text)
        self.text, self.begins = text, [0, *ends][: len(ends)]
        self.chunks = [text[a:b] for a, b in zip(self.begins, ends, strict=True)]
        summaries = [known[c] for c in self.chunks]
        self.upto = np.cumsum([0, *(n for n, _ in summaries)])
        self.n = int(self.upto[-1])
        across = (text[max(0, b - 2) : b + 2] for b in self.begins[1:])  # a mark has three bytes
        self.marked = any(m for _, m in summaries) or any(m in x for x in across for m in MARKS)

    def place(self, at: int) -> int:
        """The byte at which code point ``at`` starts; the end of the text for one past the last."""
        if at >= self.n:
            return len(self.text)
        k = int(np.searchsorted(self.upto, at, side="right")) - 1
        within = np.flatnonzero(starts(self.chunks[k]))[at - self.upto[k]]
        return self.begins[k] + int(within)


def transformed(text: bytes, h: tuple[int, int, int, int], known: Summaries) -> tuple:
    """n, form, prefix_chars, middle_chars and output of one text."""
    cut = Chunked(text, known)
    n = cut.n
    if not text or cut.marked or h[2] % 100 >= 100 - PLAIN_PERCENT:
        return n, "plain", None, None, text
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = cut.place(first), cut.place(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = MARKS
    if h[3] % 100 < SPM_PERCENT:
        return n, "spm", first, second - first, b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", first, second - first, b"".join((p, prefix, s, suffix, m, middle))


_KNOWN = Summaries()  # of a worker, kept from task to task


MADE = T.StructType([T.StructField(c, T.StringType() if c in ("form", "fim_text") else T.LongType()) for c in OUTPUTS])


@F.arrow_udf(MADE)
def _transform(text: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
    seeds = zip(*(h.to_pylist() for h in (h1, h2, h3, h4)), strict=True)
    bodies = text.cast(pa.binary())
    out = [transformed(t.as_py(), h, _KNOWN) for t, h in zip(bodies, seeds, strict=True)]
    columns = list(zip(*out, strict=True)) or [()] * 5
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    arrays[4] = arrays[4].cast(pa.string())
    return pa.StructArray.from_arrays(arrays, names=list(OUTPUTS))


def seeds(key: Column) -> list[Column]:
    """The first four groups of eight hexadecimal digits of sha256 of ``1:`` and the key, as integers."""
    digest = F.sha2(F.concat(F.lit(SEED), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with OUTPUTS: the text cut into prefix, middle and suffix at two places that the key's hash gives, and put
    together again with the middle last, row by row: no shuffle.

    ``n`` is the number of code points and the cuts fall between code points. A text is cut into chunks by a rolling
    hash; the number of code points of a chunk and whether it holds a mark are looked up by its content, since passages
    recur; sums over the chunks before give the chunk a cut falls into, and only that one is looked through. Marks
    across two chunks are found from the bytes around the boundary. ``form`` is plain (the text as it is), psm (prefix,
    suffix, middle) or spm (suffix, prefix, middle).

    Edge cases: a NULL text is an empty one, and an empty one is plain; so is a text with one of the marks; a NULL
    key is hashed as an empty one; very long texts are hashed a slice at a time; repeated rows are transformed alike;
    an empty table gives an empty one. Input columns named like an output are replaced, others kept.
    """
    on_workers(docs.sparkSession)
    keep = without(docs, *OUTPUTS).columns
    (made,) = free(docs, "made")
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*keep, _transform(body, *seeds(F.col(key))).alias(made))
    return rows.select(*keep, f"{made}.*")


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of. No mark stands in a text that was cut, nor can one arise where a piece of it
    meets a mark, so the three marks are the only ones."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    one, two, three = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return F.when(form == "plain", output).when(form == "spm", F.concat(two, three, one)).otherwise(F.concat(one, three, two))


def op13_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = fill_in_middle(docs)
    back = F.sha2(restored(F.col("fim_text"), F.col("form")), 256)
    output = F.sha2("fim_text", 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", output.alias("output_sha256"), back.alias("restored_sha256")
    )


QUERIES = {"op13_fill_in_middle": op13_fill_in_middle}


def _seed_sql(i: int) -> str:
    return f"('0x' || substr(sha256('{SEED}' || coalesce(doc_id::VARCHAR, '')), {8 * i + 1}, 8))::BIGINT"


SQL = {
    "op13_fill_in_middle": f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
    {_seed_sql(0)} AS h1, {_seed_sql(1)} AS h2, {_seed_sql(2)} AS h3, {_seed_sql(3)} AS h4
  FROM documents),
f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}')
           OR h3 % 100 >= {100 - PLAIN_PERCENT} THEN 'plain'
         WHEN h4 % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM f)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || pre || '{SUFFIX}' || suf || '{MIDDLE}' || mid
         ELSE '{SUFFIX}' || suf || '{PREFIX}' || pre || '{MIDDLE}' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p"""
}
