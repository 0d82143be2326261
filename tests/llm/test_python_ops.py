"""Repeated passages, near duplicates, contamination, token counts, language model, chat windows."""

import functools
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from brute import FOLD, contamination, near_groups, repeats, sha, words
from fixtures import documents, edge_documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from actionspark.llm import chat, decontaminate, lm, near, substring, tokens

# ---- repeated passages ----------------------------------------------------------------------------


@pytest.mark.parametrize("hot", [2000, 3])
def test_repeats_equal_brute_force(spark, hot):
    rows = edge_documents()
    periodic = " ".join(["p", "q", "r"] * 40)
    rows.append((900, periodic, "en", "a", 1))
    docs = documents(spark, rows).withColumn("spans", F.lit("clash"))
    got = substring.drop_repeats(docs, hot=hot).select("text", "n_words", "n_removed", "clean_text").collect()
    want = [(r[1], *w) for r, w in zip(rows, repeats([r[1] for r in rows]), strict=True)]
    mine = [(r.text, r.n_words, r.n_removed, " ".join(words(r.clean_text))) for r in got]
    assert sorted(map(repr, mine)) == sorted(map(repr, want))
    assert sum(w[2] for w in want) > 300
    assert all(r.clean_text == r.text for r in got if not r.n_removed)


def test_repeats_of_no_rows(spark):
    assert substring.drop_repeats(documents(spark, [])).collect() == []


def test_equal_windows_have_equal_anchors():
    rnd = np.random.default_rng(1)
    x = rnd.integers(0, 50, 400).astype(np.uint64)
    x[200:260] = x[100:160]
    anchor, first, count = substring.anchor_runs(x, 35, 8)
    assert count.sum() == 366 and count.max() <= 28
    of = np.repeat(anchor, count)
    assert (of[100:126] == of[200:226]).all()


# ---- near duplicates --------------------------------------------------------------------------------


def near_rows():
    rnd = random.Random(11)
    rows = edge_documents()
    base = [f"t{rnd.randrange(10_000)}" for _ in range(200)]
    for i in range(60):  # copies of one text, each edited in other places
        body = base[:]
        for _ in range(rnd.randint(0, 5)):
            body[rnd.randrange(200)] = f"e{i}"
        rows.append((1000 + i, " ".join(body), "en", "a", 1))
    chain = [f"c{j}" for j in range(400)]
    for i in range(8):  # neighbours are linked, ends are not
        rows.append((2000 + i, " ".join(chain[i * 20 : i * 20 + 200]), "en", "a", 1))
    footer = " ".join(f"f{j}" for j in range(30))
    for i in range(40):  # a shared passage makes no near duplicate
        rows.append((3000 + i, footer + " " + " ".join(f"o{i}x{j}" for j in range(rnd.randint(3, 40))), "en", "a", 1))
    return rows


@pytest.mark.parametrize("block", [near.BLOCK, 3])
def test_near_groups_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near._across, "__defaults__", (block,))
    rows = near_rows()
    docs = documents(spark, rows).withColumn("component", F.lit("clash")).withColumn("node", F.lit(0))
    found = near.near_duplicates(docs)
    got = sorted(repr((r.doc_id, r.text, r.n_shingles, r.component_id)) for r in found.collect())
    want = []
    groups = near_groups([(r[0], r[1]) for r in rows])
    for i, r in enumerate(rows):
        n, members = groups[i]
        least = min((rows[j][0] for j in members if rows[j][0] is not None), default=None)
        want.append(repr((r[0], r[1], n, least if n else r[0])))
    assert got == sorted(want)
    stay = [(r.doc_id, r.text) for r in near.one_of_each(found).collect()]
    sizes = {i: n for i, (n, _) in groups.items()}
    assert len(stay) == len({tuple(m) for i, (n, m) in groups.items() if n}) + sum(n == 0 for n in sizes.values())


def test_near_of_no_rows(spark):
    assert near.near_duplicates(documents(spark, [])).collect() == []


def test_prefixes_of_similar_sets_share_what_they_ask_for():
    rnd = np.random.default_rng(3)
    counts = rnd.integers(0, 50, (2, 1 << 10)).astype(np.int64)
    sketch = near.Sketch(counts)
    for _ in range(300):
        n = int(rnd.integers(1, 60))
        a = np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64))
        b = a[rnd.random(len(a)) > 0.12]
        b = np.unique(np.concatenate((b, rnd.integers(0, 1 << 63, int(rnd.integers(0, 6))).astype(np.uint64))))
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < 75 * (len(a) + len(b) - both):
            continue
        (p, m), (q, k) = sketch.prefix(a), sketch.prefix(b)
        assert len(np.intersect1d(p, q)) >= min(m, k)


@pytest.mark.parametrize("block", [1000, 4])
def test_pairs_across_equal_all_pairs_of_a_token(spark, block):
    rnd = random.Random(9)
    size = [rnd.choice([*range(1, 40), 300, 400, 401, 533, 10**6, 1333333, 1333334]) for _ in range(150)]
    post = [(t, n, (size[n] << 32) + (rnd.randrange(4) << 3) + 1, n % 7) for t in (1, 2) for n in range(150) if t == 1 or n % 3]
    placed = spark.createDataFrame(post, "token long, node long, size long, label long")
    placed = placed.join(placed.groupBy("token").agg(F.count(F.lit(1)).alias("times")), "token")
    got = [tuple(sorted(p)) for p in near._across(placed, 75, block).collect()]

    def place_allows(n, i, t):
        return i < n - t + 1

    want = set()
    for t, a, p, x in post:
        for u, b, q, y in post:
            n, m = p >> 32, q >> 32
            if t == u and a < b and x != y and 100 * min(n, m) >= 75 * max(n, m):
                least = -(-75 * (n + m) // 175)
                if place_allows(n, p % (1 << 32) >> 3, least) and place_allows(m, q % (1 << 32) >> 3, least):
                    want.add((a, b))
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100


def test_a_large_component_meets_the_others_not_itself(spark):
    """One token held by 600 nodes of one component and 3 others: the nodes are met by component, so the join holds rows
    for pairs of parts of different components, not the 180,000 pairs within the large one; no pair across is lost."""
    size = (50 << 32) + 1
    post = [(1, n, size, 0) for n in range(600)] + [(1, 1000 + n, size, 1000 + n) for n in range(3)]
    placed = spark.createDataFrame(post, "token long, node long, size long, label long")
    placed = placed.join(placed.groupBy("token").agg(F.count(F.lit(1)).alias("times")), "token")
    assert near._meetings(placed, 75).count() < 100
    got = {tuple(sorted(p)) for p in near._across(placed, 75).collect()}
    assert got == {(min(a, b), max(a, b)) for _, a, _, x in post for _, b, _, y in post if a < b and x != y}


def test_many_small_components_meet_in_few_rows(spark):
    """One token held by 600 nodes: 300 components of one or two nodes and one of 200: the small ones are mixed in rows,
    so the join holds rows for a few pairs of parts, not the ~45,000 pairs of components; no pair across is lost."""
    size = (50 << 32) + 1
    post = [(1, n, size, n // 2 if n < 200 else n) for n in range(400)] + [(1, 1000 + n, size, 1000) for n in range(200)]
    placed = spark.createDataFrame(post, "token long, node long, size long, label long")
    placed = placed.join(placed.groupBy("token").agg(F.count(F.lit(1)).alias("times")), "token")
    assert near._meetings(placed, 75).count() < 100
    got = [tuple(sorted(p)) for p in near._across(placed, 75).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for _, a, _, x in post for _, b, _, y in post if a < b and x != y}


def test_components_of_long_chains_and_stars(spark):
    rnd = random.Random(2)
    ids = rnd.sample(range(1, 10**9), 60)
    edges = [(min(a, b), max(a, b)) for a, b in zip(ids[:40], ids[1:40], strict=False)] + [(min(ids[40], x), max(ids[40], x)) for x in ids[41:]]
    got = {r.node: r.label for r in near.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: min(ids[:40]) for x in ids[:40]} | {x: min(ids[40:]) for x in ids[40:]}


# ---- contamination -----------------------------------------------------------------------------------

ITEMS = "item_id BIGINT, text STRING"


def items_of(rows):
    long = [r[1] for r in rows if r[1] and len(words(r[1])) > 60]
    cut = lambda t, a, n: " ".join(words(t)[a : a + n])
    out = [(1, cut(long[0], 3, 30).upper() + "!"), (2, cut(long[0], 10, 13)), (2, cut(long[2], 0, 14)), (30, "four words are here"), (31, "One")]
    return out + [(None, cut(long[3], 5, 20)), (5, None), (6, " .,; "), (7, cut(long[0], 3, 30)), (8, "never there at all")]


@pytest.mark.parametrize("shard_words,block_windows", [(400_000, 200_000), (50, 5)])
def test_contamination_equals_brute_force(spark, shard_words, block_windows):
    rows = edge_documents()
    items = items_of(rows)
    docs = documents(spark, rows).withColumn("items", F.lit("clash"))
    out = decontaminate.decontaminate(
        docs, spark.createDataFrame(items, ITEMS), shard_words=shard_words, block_windows=block_windows
    ).select("text", "n_words", "n_hit", "spans", "items", "contaminated")
    named = [("null" if i is None else i, t) for i, t in items]
    want = contamination([r[1] for r in rows], named)
    for_sort = sorted(repr((r[1], n, len(hit), ids, bad)) for r, (n, hit, ids, bad) in zip(rows, want, strict=True))
    got = out.collect()
    assert sorted(repr((r.text, r.n_words, r.n_hit, list(r["items"]), r.contaminated)) for r in got) == for_sort
    covered = [sorted(j for a, b in zip(r.spans[::2], r.spans[1::2], strict=True) for j in range(a, b)) for r in got]
    assert sorted(map(repr, covered)) == sorted(repr(sorted(hit)) for _, hit, _, _ in want)


def test_contamination_without_items_or_documents(spark):
    none = spark.createDataFrame([], ITEMS)
    assert not decontaminate.decontaminate(documents(spark), none).filter("n_hit > 0 OR contaminated").count()
    assert decontaminate.decontaminate(documents(spark, []), none).collect() == []


def test_index_finds_all_phrases():
    rnd = np.random.default_rng(7)
    text = rnd.integers(1, 6, 3000)
    index = decontaminate.FMIndex(text)
    phrases = rnd.integers(1, 8, (200, 4))
    rows, low, high = index.search(phrases)
    found = {int(r): sorted(index.locate(np.arange(a, b)).tolist()) for r, a, b in zip(rows, low, high, strict=True)}
    for i, p in enumerate(phrases):
        want = [j for j in range(2997) if (text[j : j + 4] == p).all()]
        assert found.get(i, []) == want


# ---- token counts --------------------------------------------------------------------------------------


def test_token_counts_equal_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rnd = random.Random(1)
    alphabet = [*"ab 'sSté\n\t\x1c\x1f\x85\xa0½²٣你😀​́_-.<|>", "'ll", " the", "<|endoftext|>"]
    rows = edge_documents()
    rows += [(5000 + i, "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))), "en", "a", 1) for i in range(400)]
    docs = documents(spark, rows).withColumn("n_bytes", F.lit("clash"))
    got = tokens.count_tokens(docs, path).select("text", "n_bytes", "n_tokens", "over_limit").collect()
    assert len(got) == len(rows)
    for r in got:
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 512)
    assert tokens.count_tokens(documents(spark, []), path).collect() == []


# ---- language model --------------------------------------------------------------------------------------


def lm_rows():
    rnd = random.Random(4)
    vocabulary = [f"w{''.join(rnd.choice('aeiost') for _ in range(rnd.randint(1, 6)))}" for _ in range(120)]
    rows = [(r[0], r[1], *r[2:]) for r in edge_documents() if r[0] not in (9, 10)]
    return rows + [(100 + i, " ".join(rnd.choices(vocabulary, k=30)), "en", "a", 1) for i in range(60)]


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 10])
def test_scores_equal_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    monkeypatch.setattr(lm.frequent_words, "__defaults__", (frequent,))
    rows = lm_rows()
    path = public_tokenizers.path(lm.VOCABULARY)
    got = lm.score_documents(documents(spark, rows), path).collect()
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2 for r in rows]
    texts = [words((r[1] or "").translate(FOLD)) for r in rows]
    counts = Counter(w for t, h in zip(texts, held, strict=True) if not h for w in t)
    ends = held.count(False)
    total, distinct = sum(counts.values()) + ends, len(counts) + 1
    base = lambda c: math.log10((c + 1) / (total + distinct + 1))
    own = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = Counter()
    for w, c in counts.items():
        for i in own.encode(w):
            pieces[i] += c
    usable = [i for i in range(own.vocab_size()) if not (own.is_control(i) or own.is_unknown(i))]
    mass = sum(pieces[i] for i in usable) + ends + 0.5 * (len(usable) + 1)
    p = {own.id_to_piece(i): (pieces[i] + 0.5) / mass for i in usable}
    longest = max(map(len, p))

    def word(w):  # plain sums of products over all segmentations
        s = "▁" + w
        a = [1.0] + [0.0] * len(s)
        for j in range(1, len(s) + 1):
            for i in range(max(0, j - longest), j):
                a[j] += a[i] * p.get(s[i:j], 0.0)
            spelt = 1.0
            for b in s[j - 1].encode():
                spelt *= p[f"<0x{b:02X}>"]
            a[j] += a[j - 1] * spelt
        return math.log10(a[-1])

    want = []
    for r, t, h in zip(rows, texts, held, strict=True):
        known = sum(counts[w] > 0 for w in t) + 1
        want.append((r[0], h, len(t) + 1, known, total, sum(base(counts[w]) for w in t) + base(ends), sum(map(word, t)) + math.log10((ends + 0.5) / mass)))
    order = lambda x: repr(x[:5]) + f"{x[5]:.4f}"
    for mine, theirs in zip(sorted(map(tuple, got), key=order), sorted(want, key=order), strict=True):
        assert mine[:5] == theirs[:5]
        assert mine[5:] == pytest.approx(theirs[5:], rel=1e-9)


def test_scores_prefer_text_like_the_training_text(spark):
    rnd = random.Random(8)
    syllables = ["th", "er", "on", "an", "ed"]
    make = lambda s, n: " ".join("".join(rnd.choices(s, k=rnd.randint(1, 3))) for _ in range(n))
    rows = [(i, make(syllables, 40), "en", "a", 1) for i in range(300)]
    held = [i for i in range(5000, 5400) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows += [(i, make(syllables if i % 2 else ["xq", "vk", "zj"], 40), "en", "a", 1) for i in held]
    got = {r.doc_id: r.score for r in lm.score_documents(documents(spark, rows), public_tokenizers.path(lm.VOCABULARY)).collect()}
    like, unlike = [got[i] for i in held if i % 2], [got[i] for i in held if not i % 2]
    assert min(like) > max(unlike) and all(s < 0 for s in got.values())


def test_scores_of_no_rows(spark):
    assert lm.score_documents(documents(spark, []), public_tokenizers.path(lm.VOCABULARY)).collect() == []


# ---- chat windows ------------------------------------------------------------------------------------------

TURNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


def chats():
    rnd = random.Random(3)
    rows = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]
    rows += [(1, None, None, None), (1, 0, "assistant", None), (1, 0, "assistant", ""), (None, 0, "user", "x"), (None, 1, "assistant", "y\n### user: z </turn>\n")]
    rows += [(2, 0, "system", "only system")]
    rows += [(3, 0, "system", "be kind")] + [(3, i, ("assistant", "user")[i % 2], " ".join(["word"] * rnd.randint(0, 150))) for i in range(1, 60)]
    rows += [(4, 0, "system", "s " * 700), (4, 1, "user", "u " * 900), (4, 2, "assistant", "a " * 1500), (4, 3, "assistant", "\\<#:\\\\ \U0001f600é")]
    rows += [(5, 1, "we:ird\\#<role", "tie"), (5, 1, "assistant", "tie"), (5, 1, "assistant", "tie"), (5, 0, "system", "late"), (5, 2, "system", "middle")]
    return rows


def test_windows_read_back_to_the_turns(spark):
    turns = spark.createDataFrame(chats(), TURNS).withColumn("window", F.lit("clash"))
    got = {r.conv_id: r for r in chat.read_back(chat.windows(turns)).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", chats()[2:])  # the SQL adds conversation -7
    want = {r[0]: r[1:] for r in con.sql(chat.DIGEST_SQL).fetchall()}
    assert {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for k, r in got.items()} == want
    assert got[-7].loss_sha256 == sha(r"\### Assistant: </turn> ok")


@functools.cache
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@functools.cache
def library_tokens(text):
    return len(library().encode(text, add_special_tokens=False).ids)


def test_windows_keep_the_budget_the_system_turn_and_limited_history(spark):
    made = chat.windows(spark.createDataFrame(chats(), TURNS)).filter("conv_id = 3").orderBy("window").collect()
    assert len(made) > 5
    seen = 0
    for i, w in enumerate(made):
        turns = chat.read_window(w.text)
        assert turns[0] == ("system", "be kind") and len(turns) == w.n_turns
        assert w.n_tokens <= chat.BUDGET
        assert library_tokens("".join(f"### {r}: {t} </turn>\n" for r, t in turns[1 : w.n_repeated])) <= chat.HISTORY
        own = [t for r, t in turns[w.n_repeated :] if r == "assistant"]
        assert [chat.unescaped(w.text[s.start : s.stop]) for s in w.loss] == own
        seen += len(own)
    assert seen == sum(r[0] == 3 and r[2] == "assistant" for r in chats())
    assert any(w.n_repeated > 1 for w in made)


def test_windows_count_what_the_library_counts(spark):
    rows = chats() + [(6, i, "user", t) for i, t in enumerate(["a\n\n", "\n", "  ", "<|endoftext|>", "x\x85\xa0", "'s \t"])]
    for w in chat.windows(spark.createDataFrame(rows, TURNS)).collect():
        assert w.n_tokens == library_tokens(w.text), w.text


def by_the_rules(rows, budget=chat.BUDGET, history=chat.HISTORY):
    """The windows of one conversation, made turn by turn: (text, n_turns, n_repeated)."""
    mark = lambda t, m: "".join("\\" + c if c in m else c for c in t)
    turns = sorted((t is not None, t or 0, r or "", x or "") for _, t, r, x in rows)
    made = [f"### {mark(r, '\\<#:')}: {mark(x, '\\<#')} </turn>\n" for *_, r, x in turns]
    head = [made.pop(0)] if turns[0][2] == "system" else []
    room = max(budget // 4, budget - history - sum(map(library_tokens, head)))
    before, at, out = 0, [], {}
    for x in made:
        n = library_tokens(x)
        block = before // room
        out.setdefault((block, before > 0 and (before + n - 1) // room > block), []).append((before, x))
        at.append((before, x))
        before += n
    if not out:
        return [("".join(head), 1, 0)]
    windows = []
    for i, (_, own) in enumerate(sorted(out.items())):
        again = [x for b, x in at if own[0][0] - history <= b < own[0][0]]
        windows.append(("".join([*head, *again, *(x for _, x in own)]), len(head) + len(again) + len(own), len(again) + (len(head) if i else 0)))
    return windows


@pytest.mark.parametrize("ranges", ["1", "13"])
def test_windows_of_conversations_over_many_ranges(spark, ranges):
    rnd = random.Random(6)
    rows = chats() + [(None, None, "user", "again")] * 40
    rows += [(9, i // 3, rnd.choice(["user", "assistant"]), " ".join(["hot"] * rnd.randint(0, 60))) for i in range(300)] + [(9, -1, "system", "hot")]
    keys = {"spark.sql.shuffle.partitions": ranges, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        got = chat.windows(spark.createDataFrame(rows, TURNS)).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for conv in {r[0] for r in rows}:
        mine = [(w.text, w.n_turns, w.n_repeated) for w in sorted((w for w in got if w.conv_id == conv), key=lambda w: w.window)]
        assert mine == by_the_rules([r for r in rows if r[0] == conv])


def test_no_turns(spark):
    assert chat.read_back(chat.windows(spark.createDataFrame([], TURNS))).collect() == []
