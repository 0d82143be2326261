"""Token files, the filter audit and fill-in-middle texts against brute force and exact round trips."""

import hashlib
import random
import zlib
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
from brute import words
from fixtures import DOCS, documents, edge_documents, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from actionspark.llm import audit, binary, fim

BPE = public_tokenizers.path("byte_bpe_50k.json")
CLASHING = "key part file place n_tokens base hash origin text_ rows block made _made n a b c d e digest first sums good toxic".split()


def clashing(spark, rows):
    """Documents with a column for every name that the operators use themselves, and a map."""
    df = documents(spark, rows)
    extra = [F.lit(i).alias(c) for i, c in enumerate(CLASHING)]
    return df.select("*", *extra, F.create_map(F.lit("k"), F.lit(1)).alias("m"))


def folder(spark, tmp_path_factory):
    return str(tmp_path_factory.mktemp("tokens") / "t")


# --- operator 11 -----------------------------------------------------------------------------------------------------


def library_ids(texts):
    made = Tokenizer.from_file(BPE).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [[*e.ids, 0] for e in made]


def test_units_give_the_ids_of_whole_texts():
    rnd = random.Random(1)
    parts = ["a", "b", "'s", "1", "!", " ", " ", " ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", "　", "​", "᠎"]
    parts += ["﻿", "\xa0", "é", "中", "\U0001f600", "<|endoftext|>", "<|endof", "text|>", "'", "x\r\n", ".", "\x00", "\x0b"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(20000)]
    texts += ["", " ", "\n", " a", "\na", "a ", "x" * 5000, " " * 3000, ("ab " * 2000) + "\n"]
    encode = binary.Encoder(BPE)
    assert encode.by_units and encode.type == "<u2"
    made = [b for i in range(0, len(texts), 700) for b in encode(texts[i : i + 700])]
    assert [[*np.frombuffer(b, "<u2").tolist(), 0] for b in made] == library_ids(texts)


def test_units_are_forgotten_and_learnt_again(monkeypatch):
    monkeypatch.setattr(binary, "CACHED", 20)
    texts = [prose(random.Random(i), 30) for i in range(30)]
    encode = binary.Encoder(BPE)
    made = [b for t in texts for b in encode([t])]
    assert [[*np.frombuffer(b, "<u2").tolist(), 0] for b in made] == library_ids(texts)
    assert len(encode.spaced) < 60


def test_vocabulary_that_cannot_be_cut_is_used_on_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    encode = binary.Encoder(path)
    texts = ["Some  words here", "", "a\nb c"]
    want = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert not encode.by_units
    assert [np.frombuffer(b, encode.type).tolist() for b in encode(texts)] == [e.ids for e in want]


@pytest.mark.parametrize("part_bytes", [1 << 26, 2000])
def test_files_hold_all_ids_in_key_order(spark, tmp_path_factory, part_bytes):
    rows = edge_documents() + [(60, "twice <|endoftext|> the same", "en", "a", 1)] * 40
    docs = clashing(spark, rows).repartition(3)
    path = folder(spark, tmp_path_factory)
    binary.write_tokens(docs, path, BPE, part_bytes=part_bytes)
    got = sorted(binary.read_tokens(spark, path, BPE).collect(), key=lambda r: r.start)
    assert sorted(repr(r.doc_id) for r in got) == sorted(repr(r[0]) for r in rows)
    keys = [r.doc_id for r in got]
    assert keys == [None] * sum(r[0] is None for r in rows) + sorted(r[0] for r in rows if r[0] is not None)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]
    want = sorted(zip((repr(r[0]) for r in rows), library_ids([r[1] for r in rows]), strict=True))
    assert sorted((repr(r.doc_id), r.ids) for r in got) == want
    digests = {(r.doc_id, r.start): r.ids_crc32 for r in binary.read_tokens(spark, path, BPE, digest=True).collect()}
    assert digests == {(r.doc_id, r.start): zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got}


def test_files_one_after_another_are_one_array(spark, tmp_path_factory):
    docs = documents(spark)
    path = folder(spark, tmp_path_factory)
    binary.write_tokens(docs, path, BPE, part_bytes=4000)
    bases = sorted(spark.read.parquet(f"{path}/bases").collect(), key=lambda r: r.part)
    assert len(bases) > 1 and [r.base for r in bases] == [0, *np.cumsum([r.n_tokens for r in bases])[:-1]]
    flat = np.concatenate([binary.mapped(f"{path}/ids/{r.file}.ids", "<u2") for r in bases])
    starts = np.concatenate([binary.mapped(f"{path}/ids/{r.file}.offsets", "<u8")[:-1] + np.uint64(r.base) for r in bases])
    got = sorted(binary.read_tokens(spark, path, BPE).collect(), key=lambda r: r.start)
    assert starts.tolist() == [r.start for r in got]
    assert flat.tolist() == [i for r in got for i in r.ids]


def test_equal_rows_are_dealt_to_many_parts(spark, tmp_path_factory):
    docs = documents(spark, [(1, "the same text " * 20, "en", "a", 1)] * 400).repartition(8)
    path = folder(spark, tmp_path_factory)
    binary.write_tokens(docs, path, BPE, part_bytes=20000)
    sizes = [r.n_docs for r in spark.read.parquet(f"{path}/bases").collect()]
    assert sum(sizes) == 400 and max(sizes) < 200


def test_files_of_a_lost_attempt_are_not_read(spark, tmp_path_factory):
    docs = documents(spark)
    path = folder(spark, tmp_path_factory)
    binary.write_tokens(docs, path, BPE)
    lost = binary.PartWriter(f"{path}/ids", "000000-lost")
    lost.append([b"\1\0\2\0"], b"\0\0")
    before = binary.read_tokens(spark, path, BPE, digest=True).count()
    assert before == docs.count()


def test_no_documents_no_files(spark, tmp_path_factory):
    path = folder(spark, tmp_path_factory)
    binary.write_tokens(documents(spark, []), path, BPE)
    assert binary.read_tokens(spark, path, BPE).collect() == []


# --- operator 12 -----------------------------------------------------------------------------------------------------


def brute_flags(rows):
    texts = [r[1] or "" for r in rows]
    first = {}
    for r, t in zip(rows, texts, strict=True):
        if r[0] is not None:
            first[t] = min(first.get(t, r[0]), r[0])
    out = []
    for r, t in zip(rows, texts, strict=True):
        w = words(t)
        upper = sum("A" <= c <= "Z" for c in t)
        flags = (
            len(w) < 200,
            100 * len(set(w)) < 50 * len(w),
            100 * upper > 2 * len(t),
            any(c in "#$%&*|" for c in t),
            r[0] is not None and first[t] < r[0],
        )
        out.append((r[0], r[3] or "", *flags))
    return out


def audit_rows():
    rnd = random.Random(3)
    rows = edge_documents()
    shared = prose(rnd, 260)
    for i in range(100, 160):
        body = shared if i % 7 == 0 else prose(rnd, rnd.choice([50, 250, 400]), rnd.choice([3, 400]))
        body = body.upper() if i % 5 == 0 else body
        rows.append((i, body + (" # $" if i % 4 == 0 else ""), "en", rnd.choice(["a", "b", "", None]), 1))
    return rows


@pytest.mark.parametrize("nonzeros", [2_000_000, 300])
def test_flags(spark, monkeypatch, nonzeros):
    monkeypatch.setattr(audit, "BLOCK_NONZEROS", nonzeros)
    rows = audit_rows()
    got = [tuple(r) for r in audit.filter_flags(clashing(spark, rows).repartition(3)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute_flags(rows)))


def test_matrix_holds_every_word(spark, monkeypatch):
    monkeypatch.setattr(audit, "PART_WORDS", 100)
    monkeypatch.setattr(audit, "BLOCK_NONZEROS", 900)
    rows = audit_rows()
    matrix, dictionary = audit.term_matrix(documents(spark, rows).select("doc_id", "text").repartition(4))
    spelt = {r.id: r.word for r in dictionary.collect()}
    want = {w for r in rows for w in words(r[1])}
    assert sorted(spelt) == list(range(len(want))) and set(spelt.values()) == want
    got = []
    for shard in matrix.collect():
        indptr = np.frombuffer(shard.indptr, "<i8")
        indices, counts = np.frombuffer(shard.indices, "<u8"), np.frombuffer(shard.counts, "<u4")
        for i, row in enumerate(shard.rows):
            part = slice(indptr[i], indptr[i + 1])
            bag = {spelt[int(w)]: int(n) for w, n in zip(indices[part], counts[part], strict=True)}
            assert shard.sums[i] == sum(bag.values()) and shard.nonzeros[i] == len(bag)
            got.append(repr((row.doc_id, sorted(bag.items()))))
    bags = []
    for r in rows:
        bag = {}
        for w in words(r[1]):
            bag[w] = bag.get(w, 0) + 1
        bags.append(repr((r[0], sorted(bag.items()))))
    assert sorted(got) == sorted(bags)


def brute_audit(rows, labels):
    flags = brute_flags(rows)
    good, toxic = {k for k, q, _ in labels if q == 1}, {k for k, _, t in labels if t == 1}
    out = []
    for part in {f[1] for f in flags}:
        mine = [f for f in flags if f[1] == part]
        table = []
        for order in permutations("ABCDE"):
            left = list(mine)
            for i, letter in enumerate(order):
                at = 2 + "ABCDE".index(letter)
                gone = [f for f in left if f[at]]
                before = [f for f in mine if f[at] and f not in gone and any(f[2 + "ABCDE".index(x)] for x in order[:i])]
                left = [f for f in left if not f[at]]
                only = sum(f[at] and sum(f[2:]) == 1 for f in mine)
                lost = [sum(f[0] is not None and f[0] in s for f in gone) for s in (good, toxic)]
                table.append([part, "".join(order), i + 1, len(left), len(gone), len(before), only, *lost])
        total = {x: sum(r[4] for r in table if r[1][r[2] - 1] == x) for x in "ABCDE"}
        out += [tuple([*r, total[r[1][r[2] - 1]]]) for r in table]
    return out


def test_audit_equals_brute_force(spark):
    rows = audit_rows()
    labels = [(i, i % 3 and 1, int(i % 4 == 0)) for i in range(0, 160, 2) if i != 20]
    labels += [(5, 0, 1), (5, 1, 0), (None, 1, 1), (104, None, None)]
    frame = spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT")
    got = [tuple(r) for r in audit.audit(clashing(spark, rows), frame).collect()]
    assert sorted(got) == sorted(brute_audit(rows, labels))


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    assert audit.audit(documents(spark, []), labels).collect() == []
    matrix, dictionary = audit.term_matrix(documents(spark, [(1, None, "en", "a", 0), (2, " \n", "en", "a", 0)]))
    assert [len(r.rows) for r in matrix.collect()] and dictionary.collect() == []


# --- operator 13 -----------------------------------------------------------------------------------------------------


def brute_fim(key, text):
    text, n = text or "", len(text or "")
    digest = hashlib.sha256(("1:" + ("" if key is None else str(key))).encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return key, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return key, n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return key, n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


def fim_rows():
    rnd = random.Random(9)
    shared = "".join(rnd.choice("ab cdé中\U0001f600\n") for _ in range(9000))
    rows = edge_documents()
    for i in range(100, 150):
        at = rnd.randrange(4000)
        rows.append((i, prose(rnd, 5) + shared[at : at + rnd.randrange(5000)], "en", "a", 1))
    for i in range(150, 170):  # marks at any place, half ones and ones that a chunk boundary may cut
        at = rnd.randrange(9000)
        rows.append((i, shared[:at] + rnd.choice(["<P>", "<S>", "<M>", "<P", "S>", "<", "<<"]) + shared[at:], "en", "a", 1))
    rows += [(170 + i, "<M>"[:i] + "x" + "<S>"[i:], "en", "a", 1) for i in range(4)]
    return rows


def test_fill_in_middle_equals_brute_force(spark):
    rows = fim_rows()
    df = clashing(spark, rows)
    made = fim.fill_in_middle(df)
    assert [c for c in made.columns if c not in fim.OUTPUTS] == [c for c in df.columns if c not in fim.OUTPUTS]
    got = made.withColumn("back", fim.restored(F.col("fim_text"), F.col("form"))).collect()
    want = [brute_fim(r[0], r[1]) for r in rows]
    assert sorted(repr((r.doc_id, *(r[c] for c in fim.OUTPUTS))) for r in got) == sorted(map(repr, want))
    assert all(r.back == (r.text or "") and r._made == CLASHING.index("_made") for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("size", [0, 1, 255, 256, 257, 8192, 8193, 70000])
def test_chunks_cover_a_text(monkeypatch, size):
    monkeypatch.setattr(fim, "SLICE", 3000)
    for data in (b"x" * size, random.Random(size).randbytes(size)):
        ends = fim.chunk_ends(data)
        assert ends == sorted(set(ends)) and (ends[-1] if ends else 0) == size
        sizes = np.diff([0, *ends])
        assert all(s <= fim.MOST for s in sizes) and all(s >= fim.LEAST for s in sizes[:-1])


def test_shared_passages_share_chunks_and_slices_do_not_matter(monkeypatch):
    rnd = random.Random(4)
    shared = rnd.randbytes(200_000)
    cut = [fim.chunk_ends(x) for x in (shared, rnd.randbytes(777) + shared)]
    chunks = [{x[a:b] for a, b in zip([0, *e], e, strict=False)} for x, e in zip((shared, b"\0" * 777 + shared), cut, strict=True)]
    assert len(chunks[0] & chunks[1]) > 0.9 * len(chunks[0])
    monkeypatch.setattr(fim, "SLICE", 5000)
    assert fim.chunk_ends(shared) == cut[0]


def test_marks_across_chunks_are_seen(monkeypatch):
    known = fim.Summaries()
    for at in range(1, 6):
        monkeypatch.setattr(fim, "chunk_ends", lambda text, at=at: sorted({min(at, len(text)), len(text)}))
        for text, marked in ((b"ab<P>cd", True), (b"ab<Pxcd", False), (b"a<<M>bc", True), ("é<S>é".encode(), True)):
            assert fim.Chunked(text, known).marked == marked


def test_summaries_are_bounded(monkeypatch):
    monkeypatch.setattr(fim, "CACHED_BYTES", 5000)
    known = fim.Summaries()
    for i in range(100):
        assert known[b"%d" % i * 300] == (len(b"%d" % i) * 300, False)
        assert known.bytes <= 5000


def test_no_texts(spark):
    assert fim.fill_in_middle(spark.createDataFrame([], DOCS)).collect() == []
