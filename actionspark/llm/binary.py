"""Token ids of all documents as flat binary files with 64-bit offsets (operator 11)."""

from __future__ import annotations

import json
import math
import os
import posixpath
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actionspark.llm.common import free, on_workers, stored, table
from actionspark.sources.tables import scratch_path

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
PART_BYTES = 64 << 20  # of text in a file
CACHED = 900_000  # units a worker keeps
TOGETHER = 4_000  # units encoded as one text
BATCH_CHARS = 1 << 20
OUTPUTS = ("start", "n_tokens", "ids")

# A place where a text may be cut for the byte-level pattern: before a space or line end that follows anything but white space.
_SPACES = frozenset(c for c in map(chr, range(0x10000)) if c.isspace() or c in "\u180e\u200b\ufeff")
_CUT = re.compile(f"(?<=[^{''.join(sorted(_SPACES))}])(?=[ \\n])")


def id_type(vocabulary: int) -> str:
    """The narrowest unsigned type, little-endian, that holds all ids."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


class Encoder:
    """Ids of whole texts by the tokenizers library, as the bytes of a file.

    The pattern of a byte-level vocabulary never matches across a place where white space begins with a space or a line
    end, so a text is the sequence of its units from one such place to the next, and each unit is encoded by the library
    once and then remembered (a fixed number of them and a batch's). A vocabulary with any other normaliser, pattern or special string
    with spaces has whole texts encoded at once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.type = id_type(self.library.get_vocab_size())
        with open(path, encoding="utf-8") as f:
            self.by_units = self.separable(json.load(f))
        self.lengths = np.zeros(self.library.get_vocab_size(), dtype=np.int64)
        for token, i in self.library.get_vocab(with_added_tokens=False).items():
            self.lengths[i] = len(token)  # a letter stands for a byte
        for i, token in self.library.get_added_tokens_decoder().items():
            self.lengths[i] = len(token.content.encode())
        self.spaced: dict[str, bytes] = {}  # plain ones, whose keys a set is compared with without walking through them
        self.whole: dict[str, bytes] = {}
        self.chars = 0

    @staticmethod
    def separable(described: dict) -> bool:
        cut = described.get("pre_tokenizer") or {}
        plain = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
        special = described.get("added_tokens") or []
        tight = not any(
            t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"]) for t in special
        )
        return bool(plain and tight and not described.get("normalizer") and not described["model"].get("dropout"))

    def encoded(self, texts: list[str]) -> list[bytes]:
        made = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.type).tobytes() for e in made]

    def encoded_units(self, units: list[str]) -> list[bytes]:
        """The ids of units that begin with a space or line end: one after another they are a text whose units they are, so
        many are encoded at once, and the bytes that each id stands for show where one ends."""
        text = "".join(units)
        ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.type)
        upto = np.cumsum(self.lengths[ids])
        ends = np.cumsum(np.fromiter((len(u.encode()) for u in units), dtype=np.int64, count=len(units)))
        last = np.searchsorted(upto, ends)
        if not len(upto) or upto[last[-1]] != ends[-1] or (upto[last] != ends).any():
            return self.encoded(units)
        data, width = ids.tobytes(), ids.itemsize
        places = [0, *((last + 1) * width).tolist()]
        return [data[i:j] for i, j in zip(places, places[1:], strict=False)]

    def learn(self, known: dict[str, bytes], units: dict[str, str], together: bool) -> None:
        """Remember the ids of ``units`` under their keys."""
        keys = list(units)
        encode = self.encoded_units if together else self.encoded
        for i in range(0, len(keys), TOGETHER):
            some = keys[i : i + TOGETHER]
            known.update(zip(some, encode([units[k] for k in some]), strict=True))
        self.chars += sum(map(len, keys))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes of ``type``.

        Most texts are cut at single spaces and line ends where no other white space stands, which is quickest: a piece is
        looked up by what follows its space; a line end, which stays in front, is preceded by no space. Where two kinds
        of white space meet, the text is cut by the general rule.
        """
        if not self.by_units:
            return self.encoded(texts)
        spaced, whole = self.spaced, self.whole
        if len(spaced) + len(whole) > CACHED or self.chars > 16 * CACHED:
            spaced.clear()
            whole.clear()
            self.chars = 0
        cut, missing, heads = [], set(), set()
        for text in texts:
            parts = text.replace("\n", " \n").split(" ")
            first = parts[0]
            del parts[0]
            new = set(parts).difference(spaced)
            if any(not p or p[-1] in _SPACES for p in new) or first and first[-1] in _SPACES:
                units, parts = _CUT.split(text), ()
            else:
                units = (first,) if first else ()
                missing |= new
            heads.update(units)
            cut.append((units, parts))
        self.learn(spaced, {p: p if p[0] == "\n" else f" {p}" for p in missing}, True)
        self.learn(whole, {u: u for u in heads.difference(whole)}, False)
        return [
            b"".join((*map(whole.__getitem__, units), *map(spaced.__getitem__, parts))) for units, parts in cut
        ]


_ENCODERS: dict[str, Encoder] = {}  # of a worker, kept from task to task


def encoder(path: str) -> Encoder:
    return _ENCODERS.get(path) or _ENCODERS.setdefault(path, Encoder(path))


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def mapped(path: str, kind: str) -> np.ndarray:
    """A file as an array: mapped into memory where it is a local or mounted one, else read from its store."""
    files, place = _file_system(path)
    if files.get_file_info(place).size == 0:
        return np.empty(0, dtype=kind)
    source = pa.memory_map(place) if isinstance(files, pafs.LocalFileSystem) else files.open_input_file(place)
    return np.frombuffer(source.read_buffer(), dtype=kind)


class PartWriter:
    """The two files of one part: ids, and the offset at which each document starts in them, the end last."""

    def __init__(self, folder: str, name: str):
        files, root = _file_system(folder)
        files.create_dir(root, recursive=True)
        self.ids = files.open_output_stream(posixpath.join(root, f"{name}.ids"))
        self.offsets = files.open_output_stream(posixpath.join(root, f"{name}.offsets"))
        self.n = 0

    def append(self, documents: list[bytes], end: bytes) -> np.ndarray:
        """Write documents, each closed by ``end``; their numbers of ids."""
        sizes = np.fromiter(map(len, documents), dtype="<i8", count=len(documents)) // len(end) + 1
        self.ids.write(end.join([*documents, b""]))
        self.offsets.write((self.n + np.cumsum(sizes) - sizes).astype("<u8").tobytes())
        self.n += int(sizes.sum())
        return sizes

    def close(self) -> None:
        self.offsets.write(np.array([self.n], dtype="<u8").tobytes())
        self.ids.close()
        self.offsets.close()


def _writer(folder: str, vocabulary: str) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer, place = TaskContext.get().partitionId(), None, 0
        encode = encoder(vocabulary)
        end = np.array([END_ID], dtype=encode.type).tobytes()
        for batch in batches:
            if writer is None:
                name = f"{part:06d}-{uuid.uuid4().hex}"  # of this attempt: a task that runs again writes files of its own
                writer = PartWriter(folder, name)
            sizes, held, chars = [], [], 0
            for text in batch.column("text"):
                held.append(text.as_py())
                chars += len(held[-1])
                if chars >= BATCH_CHARS:
                    sizes.append(writer.append(encode(held), end))
                    held, chars = [], 0
            if held:
                sizes.append(writer.append(encode(held), end))
            n = batch.num_rows
            columns = [
                batch.column("key"),
                pa.array(np.full(n, part, dtype="int32")),
                pa.array([name] * n, pa.string()),
                pa.array(np.arange(place, place + n)),
                pa.array(np.concatenate(sizes) if sizes else np.empty(0, dtype="int64")),
            ]
            place += n
            yield pa.RecordBatch.from_arrays(columns, names=["key", "part", "file", "place", "n_tokens"])
        if writer is not None:
            writer.close()

    return write


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, key: str = "doc_id", text: str = "text", part_bytes: int = PART_BYTES
) -> DataFrame:
    """Write the ids of all texts in ascending order of ``key`` below ``path``; returns the index of the documents.

    ``path``/ids holds two files a part: the ids one after another, as unsigned integers of the narrowest width, each
    document closed by id 0, and the 64-bit offsets at which documents start in the part. ``path``/index (Parquet) has a
    row a document (key, part, file, place in the file, n_tokens), ``path``/bases a row a part: its file and ``base``,
    the number of ids in all parts before it, from prefix sums of the parts' totals. So the files one after another are
    one array, and base + offset is a document's start in it.

    Rows are dealt to parts by ranges of the key, within a key by a hash of the text, within equal rows by where they
    were read, so no key and no group of copies makes one part large. A part is encoded and written batch by batch. An
    attempt writes to files of its own name, and the index, which Spark commits, names those that count: files
    of an attempt that was lost are never read.

    Edge cases: NULL keys come first; a NULL text is an empty one, whose only id is 0; special strings in texts are
    handled as the library does by default; repeated rows are written each, rows of equal keys in the order of their
    hash; an empty table gives an empty index. Other columns are not stored, whatever they are called.
    """
    spark = docs.sparkSession
    on_workers(spark)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), body.alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long") + 8), F.lit(0))).first()[0]
    parts = max(math.ceil(total / part_bytes), min(int(spark.conf.get("spark.sql.shuffle.partitions")), total >> 20), 1)
    order = [F.col("key").asc_nulls_first(), F.col("hash")]
    dealt = (
        rows.withColumn("hash", F.xxhash64("text"))
        .withColumn("origin", F.spark_partition_id())
        .repartitionByRange(parts, *order, "origin")
        .sortWithinPartitions(*order)
        .select("key", "text")
    )
    fields = [("part", T.IntegerType()), ("file", T.StringType()), ("place", T.LongType()), ("n_tokens", T.LongType())]
    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType), *(T.StructField(n, t) for n, t in fields)])
    dealt.mapInArrow(_writer(f"{path}/ids", vocabulary), schema).write.parquet(f"{path}/index")
    index = spark.read.schema(schema).parquet(f"{path}/index")
    totals = index.groupBy("part", "file").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a part
    bases = totals.select("part", "file", "n_docs", "n_tokens", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).alias("base"))
    bases.write.parquet(f"{path}/bases")
    return index


def _reader(folder: str, kind: str, digest: bool) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, ids, offsets = None, None, None
        for batch in batches:
            starts, counts, values = [], [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("file", "place", "base")), strict=True)
            for file, place, base in rows:
                if file != name:
                    name = file
                    ids, offsets = mapped(f"{folder}/{name}.ids", kind), mapped(f"{folder}/{name}.offsets", "<u8")
                a, b = int(offsets[place]), int(offsets[place + 1])
                wide = ids[a:b].astype("<u4")
                starts.append(base + a)
                counts.append(b - a)
                values.append(zlib.crc32(wide.tobytes()) if digest else wide.astype("<i8"))
            last = pa.array(values, pa.int64() if digest else pa.list_(pa.int64()))
            columns = [batch.column("key"), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), last]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "start", "n_tokens", "value"])

    return read


def read_tokens(spark, path: str, vocabulary: str, key: str = "doc_id", digest: bool = False) -> DataFrame:
    """Every document as the files below ``path`` have it: key, start (ids of all documents before it), n_tokens and ids,
    or with ``digest`` ids_crc32, the unsigned crc32 of the ids as little-endian unsigned 32-bit integers.

    Documents are found by base, offset and the offset after; a part's files are mapped, so a document costs the pages it
    lies on.
    """
    on_workers(spark)
    index, bases = spark.read.parquet(f"{path}/index"), spark.read.parquet(f"{path}/bases")
    placed = index.drop("n_tokens").join(F.broadcast(bases.select("file", "base")), "file")  # a row a part
    schema = T.StructType(
        [
            T.StructField("key", index.schema["key"].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("value", T.LongType() if digest else T.ArrayType(T.LongType())),
        ]
    )
    read = placed.mapInArrow(_reader(f"{path}/ids", Encoder(vocabulary).type, digest), schema)
    return read.toDF(key, "start", "n_tokens", "ids_crc32" if digest else "ids")


def op11_token_files(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary, path = public_tokenizers.path(VOCABULARY), scratch_path(spark, "tokens")
    write_tokens(docs, path, vocabulary)
    return read_tokens(spark, path, vocabulary, digest=True)


QUERIES = {"op11_token_files": op11_token_files}
SQL: dict[str, str] = {}
