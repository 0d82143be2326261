"""Near-duplicate groups by an n-gram Jaccard join with adaptive multi-match prefixes (operator 7)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from actionspark.llm.common import LOWER, UPPER, WORD, WordHashes, gram_hashes, if_small, mixed, on_workers, own_names, row_number_of, stored, table

GRAM = 5
PERCENT = 75
MOST_MATCHES = 4
VERIFY_COST = 0.25
SKETCH_BITS = 18
CHUNK = 1 << 14
BROADCAST_KEYS = 1_000_000
BLOCK = 2_000
MEET = 256  # nodes that stand in one row when the nodes of a token meet
FEW = 32  # nodes of one component in a token that are given rows of their own
OUTPUTS = ("n_shingles", "component_id", "component")
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


def shingles(text: str | None, known: WordHashes, gram: int = GRAM) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles; of fewer words than a shingle, of all of them as one."""
    words = (text or "").encode("utf-8").translate(_FOLD).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    k = min(gram, len(words))
    found = gram_hashes(known.of(words), k)
    return np.unique(found if k == gram else mixed(found + np.uint64(k)))


def node_of(found: np.ndarray) -> int:
    """A set's number: documents with equal sets are one node of the join."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).view(np.int64)))


class Sketch:
    """Estimated document frequency of shingles: two rows of counters of fixed size, the smaller one counts.

    What hash collisions add on average is taken off. The estimate is a function of the shingle alone, so (estimate, hash)
    is one order for all documents; only the cost, never the result, depends on how good it is.
    """

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.bits = int(counts.shape[1]).bit_length() - 1
        self.noise = [int(np.percentile(row, 10)) for row in counts]

    @staticmethod
    def places(found: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        low = np.uint64((1 << bits) - 1)
        return (found & low).astype(np.int64), ((found >> np.uint64(64 - bits)) & low).astype(np.int64)

    def __call__(self, found: np.ndarray) -> np.ndarray:
        a, b = self.places(found, self.bits)
        return np.maximum(1, np.minimum(self.counts[0][a] - self.noise[0], self.counts[1][b] - self.noise[1]))

    def prefix(self, found: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, int]:
        """The prefix of a set and the number of matches it asks for.

        Sets with a similarity of ``percent`` share at least that share of the larger one's shingles, so their prefixes
        of (size - that + m), rarest first, share m or more. Of m from 1 on, the one whose prefix is estimated to
        cost least is taken: its postings, and a verification for each candidate they can make with m matches. That
        number is far too high, as near copies match in dozens of tokens, not in m, so a verification weighs a quarter
        of a posting.
        """
        n = len(found)
        needed = -(-n * percent // 100)
        times = self(found)
        order = np.lexsort((found, times))
        running = np.cumsum(times[order])
        matches = np.arange(1, min(MOST_MATCHES, needed) + 1)
        size = n - needed + matches
        cost = running[size - 1] + VERIFY_COST * (running[size - 1] - size) / matches
        best = int(np.argmin(cost))
        return found[order[: size[best]]], int(matches[best])


def _read(rows: DataFrame, bits: int) -> DataFrame:
    """One pass over the texts: per row its key, number of shingles and node, and per task the sketch in chunks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        sketch = np.zeros((2, 1 << bits), dtype=np.int64)
        for batch in batches:
            nodes, sizes, sets = [], [], [np.empty(0, dtype=np.uint64)]
            for text in batch.column(1):
                found = shingles(text.as_py(), known)
                nodes.append(node_of(found))
                sizes.append(len(found))
                sets.append(found)
            for row, place in zip(sketch, Sketch.places(np.concatenate(sets), bits), strict=True):
                row += np.bincount(place, minlength=1 << bits)
            n = len(nodes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                names=names,
            )
        chunks = sketch.reshape(-1, CHUNK)
        n = len(chunks)
        yield pa.RecordBatch.from_arrays(
            [*(pa.nulls(n, pa.int64()),) * 3, pa.array(range(n), pa.int32()), pa.array([c.tobytes() for c in chunks], pa.binary())],
            names=names,
        )

    names = ["row", "node", "n", "chunk", "counts"]
    return rows.mapInArrow(read, "row long, node long, n long, chunk int, counts binary")


def _sketch(read: DataFrame, bits: int) -> Sketch:
    """The tasks' sketches added up, chunk by chunk; of fixed size, whatever the number of documents."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.frombuffer(counts, dtype=np.int64)
                total[chunk] = total[chunk] + found if chunk in total else found
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())], names=["chunk", "counts"]
            )

    chunks = read.filter("chunk IS NOT NULL").select("chunk", "counts")
    rows = chunks.repartition("chunk").mapInArrow(add, "chunk int, counts binary").collect()
    counts = np.zeros((2 << bits) // CHUNK * CHUNK, dtype=np.int64).reshape(-1, CHUNK)
    for row in rows:
        counts[row.chunk] = np.frombuffer(row.counts, dtype=np.int64)
    return Sketch(counts.reshape(2, -1))


def _postings(rows: DataFrame, sketch: Sketch, percent: int) -> DataFrame:
    """(token, node, size) of each node's prefix; a task gives a node once. ``size`` packs the number of shingles, the
    token's place in the node's order and the matches that the prefix asks for."""
    sent = rows.sparkSession.sparkContext.broadcast(sketch.counts)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sketch, met = WordHashes(), Sketch(sent.value), set()
        for batch in batches:
            parts = []
            for text in batch.column(0):
                found = shingles(text.as_py(), known)
                node = node_of(found)
                if len(found) and node not in met:
                    met.add(node)
                    prefix, m = sketch.prefix(found, percent)
                    size = (len(found) << 32) + (np.arange(len(prefix)) << 3) + m
                    parts.append((prefix.view(np.int64), np.full(len(prefix), node), size))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names=["token", "node", "size"])

    return rows.mapInArrow(post, "token long, node long, size long")


def _shared(postings: DataFrame) -> DataFrame:
    """The postings of tokens that two or more nodes have, with their number.

    Sorted by token and node and read as a stream; groups of any size pass through in pieces.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None  # the last row met, and whether it is given already
        for batch in batches:
            token, node, size = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(token):
                continue
            if carried is not None:
                token, node, size = (np.append(c, x) for c, x in zip(carried[0], (token, node, size), strict=True))
            distinct = np.concatenate(([True], (token[1:] != token[:-1]) | (node[1:] != node[:-1])))
            token, node, size = token[distinct], node[distinct], size[distinct]
            same = token[1:] == token[:-1]
            some = np.zeros(len(token), dtype=bool)
            some[1:] |= same
            some[:-1] |= same
            given = carried is not None and carried[1]
            last = bool(some[-1]) or (len(token) == 1 and given)
            if given:
                some[0] = False
            carried = ([c[-1:] for c in (token, node, size)], last)
            if some.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[some]) for c in (token, node, size)], names=["token", "node", "size"])

    dealt = postings.repartition("token").sortWithinPartitions("token", "node")
    return dealt.mapInArrow(keep, "token long, node long, size long")


def _unpack(size: str | Column) -> tuple[Column, Column, Column]:
    """Number of shingles, place of the token, demanded matches."""
    packed = F.col(size) if isinstance(size, str) else size
    return F.shiftright(packed, 32), F.shiftright(packed, 3).bitwiseAND((1 << 29) - 1), packed.bitwiseAND(7)


def _may_match(a: str | Column, b: str | Column, percent: int) -> Column:
    """Whether a token shared by two nodes counts: the sizes are close enough, and it stands in both prefixes as they
    are for just these sizes. A similar pair shares t shingles, so it has m matches among the first
    (size - t + m) of both, m being the smaller demand."""
    (x, i, k), (y, j, m) = _unpack(a), _unpack(b)
    t = F.ceil(percent * (x + y) / F.lit(100 + percent))
    demand = F.least(k, m)
    return (
        (100 * x >= percent * y) & (100 * y >= percent * x) & (i < x - t + demand) & (j < y - t + demand)
    )


def _best_stars(shared: DataFrame, percent: int) -> DataFrame:
    """For each node the partner that shares most prefix tokens with it among the tokens' centres.

    A token's centre is its most popular node: the one whose tokens are shared most, as an original is among its
    copies. A node meets only the centres of its tokens, so there are no more pairs than postings.
    """
    times = shared.groupBy("token").agg(F.count(F.lit(1)).alias("times"))
    popular = shared.join(times, "token").groupBy("node").agg(F.sum("times").alias("popular"))
    ranked = stored(shared.join(popular, "node"), "ranked")
    centre = ranked.groupBy("token").agg(F.max(F.struct("popular", "node", "size")).alias("c"))
    met = ranked.join(centre, "token").filter("node <> c.node").filter(_may_match("size", "c.size", percent))
    pairs = met.groupBy("node", F.col("c.node").alias("other")).agg(F.count(F.lit(1)).alias("matches"))
    best = pairs.groupBy("node").agg(F.max(F.struct("matches", "other")).alias("b"))
    return best.select(F.col("b.other").alias("a"), F.col("node").alias("b"))


def _placed(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """The postings with their node's component and their token's number of postings, of tokens that nodes of different
    components have."""
    placed = shared.join(labels, "node", "left").withColumn("label", F.coalesce(F.col("label"), F.col("node")))
    both = placed.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("times"))
    return stored(placed.join(both.filter("x < y").select("token", "times"), "token"), "placed")


def _band(size: str, percent: int) -> Column:
    """Sizes that are similar by ``percent`` are in one band or in two that follow each other."""
    n = _unpack(size)[0]
    return n if percent >= 100 else F.floor(F.log(n) / F.lit(math.log(100 / percent) * (1 + 1e-9)))


def _gathered(side: DataFrame, keys: list[str], suffix: str) -> DataFrame:
    """``side`` by its keys, at most about MEET nodes a row, dealt by another hash than the blocks.

    A component with FEW or more nodes of a token stands in rows of its own, labelled, so that it does not meet itself;
    the nodes of the others are mixed in rows without a label, so that the rows grow with the nodes, not the components.
    """
    parts = F.ceil(F.col("times") / MEET).cast("int")
    side = side.withColumn("part", F.pmod(F.xxhash64("node", F.lit("part")), parts))
    label = F.when(F.col("many") >= FEW, F.col("label")).alias(f"label_{suffix}")
    nodes = F.collect_list(F.struct("node", "size", "label")).alias(f"nodes_{suffix}")
    return side.groupBy(*keys, label, "part").agg(nodes).drop("part")


def _meetings(placed: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """(token, band, block) with the nodes of two different components that meet there, a row for each two parts.

    Nodes meet within a token and a band of sizes, the smaller node going to the next band too. The nodes of a token with over
    ``block`` postings are dealt to blocks of about that many by their hash, and each block is met by all, so such a token
    is many tasks. The nodes of a component are gathered first, so that a large component meets the others, not itself.
    """
    placed = placed.withColumn("many", F.count(F.lit(1)).over(Window.partitionBy("token", "label")))
    blocks = F.ceil(F.col("times") / block).cast("int")
    band = _band("size", percent)
    smaller = placed.withColumn("band", F.explode(F.array(band, band + 1)))
    smaller = smaller.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    larger = placed.withColumn("band", band).withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    keys = ["token", "band", "block"]
    apart = "NOT (label_a <=> label_b) OR label_a IS NULL"
    return _gathered(smaller, keys, "a").join(_gathered(larger, keys, "b"), keys).filter(apart)


def _across(placed: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """Pairs of nodes in different components that share as many prefix tokens as the smaller demand of the two."""

    def met(p: Column, q: Column) -> Column:
        (x, _, _), (y, _, _) = _unpack(p.getField("size")), _unpack(q.getField("size"))
        ordered = (x < y) | ((x == y) & (p.getField("node") < q.getField("node")))
        return ordered & (p.getField("label") != q.getField("label")) & _may_match(p.getField("size"), q.getField("size"), percent)

    def pair(p: Column, q: Column) -> Column:
        (_, _, k), (_, _, m) = _unpack(p.getField("size")), _unpack(q.getField("size"))
        return F.struct(p.getField("node").alias("a"), q.getField("node").alias("b"), F.least(k, m).alias("demand"))

    each = F.transform("nodes_a", lambda p: F.transform(F.filter("nodes_b", lambda q: met(p, q)), lambda q: pair(p, q)))
    found = _meetings(placed, percent, block).select(F.explode(F.flatten(each)).alias("p")).select("p.*")
    pairs = found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("matches"), F.first("demand").alias("demand"))
    return pairs.filter("matches >= demand").select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets reach the similarity; ``texts`` holds one text per node."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last, left = WordHashes(), None, None
        for batch in batches:
            out = []
            for a, b, x, y in zip(*(batch.column(i) for i in range(4)), strict=True):
                a = a.as_py()
                if a != last:
                    last, left = a, shingles(x.as_py(), known)
                right = shingles(y.as_py(), known)
                both = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * both >= percent * (len(left) + len(right) - both):
                    out.append((a, b.as_py()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])

    right = pairs.join(texts.withColumnRenamed("text", "y"), F.col("b") == F.col("node")).drop("node")
    both = right.join(texts.withColumnRenamed("text", "x"), F.col("a") == F.col("node"))
    return both.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes with an edge: the smallest node connected with each.

    Each round every node moves to its smallest neighbour, edges move along, and those within a node go. Nodes are
    hashes, so an expected share of them goes each round. A node's neighbours are only ever reduced to their minimum.
    """
    edges = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    labels = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy("a").agg(F.min("b").alias("to")).select("a", F.least("a", "to").alias("to"))
        step = stored(step, "step")
        if labels is None:
            labels = step.select(F.col("a").alias("node"), F.col("to").alias("label"))
        else:
            moved = labels.join(step, F.col("label") == F.col("a"), "left")
            labels = stored(moved.select("node", F.coalesce("to", "label").alias("label")), "labels")
        moved = edges.join(step.select("a", F.col("to").alias("x")), "a")
        moved = moved.join(step.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
        moved = moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a <> b")
        edges = stored(moved.distinct(), "edges")
        if edges.isEmpty():
            return labels


@own_names(OUTPUTS, "key", "text")
def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, sketch_bits: int = SKETCH_BITS
) -> DataFrame:
    """``docs`` with n_shingles, component_id (the smallest key reachable over links of Jaccard ``percent`` or more) and
    component (a number of the component itself, whatever the keys).

    Documents with equal shingle sets are one node. Each node's prefix, the rarest shingles first by a sketch of
    fixed size over all documents, is as long as is estimated to cost least, and a longer prefix asks for more
    shared tokens. First every node is verified against the one centre it shares most with, and what is linked is
    one component. Then all pairs of nodes of different components with enough shared prefix tokens, at places in the
    prefixes that the two sizes allow, are verified. Pairs within a component need no test, so a group of copies costs its size, not its square, and no link
    between components is lost.

    Edge cases: a NULL or empty text has no shingles and is linked with nothing, its component_id is its own key, component is NULL; a
    text of fewer words than a shingle is one shingle; repeated rows are copies; a NULL key is never the
    smallest, a component of NULL keys has NULL; an empty table gives an empty one. Input columns named like an
    output are replaced. Sets are told apart by 64 bits.
    """
    on_workers(docs.sparkSession)
    rows = docs.withColumn("_row", row_number_of(key, text))
    texts = rows.select("_row", F.col(text).alias("text"))
    read = stored(_read(texts, sketch_bits), "read")
    nodes = read.filter("row IS NOT NULL").select("row", "node", "n")
    shared = stored(_shared(_postings(texts.select("text"), _sketch(read, sketch_bits), percent)), "shared")

    pairs = stored(_best_stars(shared, percent), "stars")
    links = stored(_verified(pairs, _texts_of(pairs, nodes, texts), percent), "links")
    placed = _placed(shared, components(links))
    pairs = stored(_across(placed, percent), "across")
    more = stored(_verified(pairs, _texts_of(pairs, nodes, texts), percent), "links")
    labels = components(links.unionAll(more))

    keyed = rows.select(F.col(key).alias("_key"), "_row").distinct()
    ids = nodes.filter("n > 0").select("row", "node").distinct().join(keyed, F.col("row") == F.col("_row"))
    least = ids.groupBy("node").agg(F.min("_key").alias("least")).join(labels, "node", "left")
    least = least.withColumn("label", F.coalesce("label", "node"))
    group = least.groupBy("label").agg(F.min("least").alias("component_id"))
    found = least.select("node", "label").join(group, "label").select("node", "component_id", F.col("label").alias("component"))
    sizes = nodes.select("row", "node", F.col("n").alias("n_shingles")).distinct().join(found, "node", "left").drop("node")
    out = rows.join(sizes, F.col("_row") == F.col("row")).drop("_row", "row")
    return out.withColumn("component_id", F.when(F.col("n_shingles") == 0, F.col(key)).otherwise(F.col("component_id")))


def one_of_each(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``near_duplicates`` that stay: of each component the one with its smallest key, and all empty ones.

    A plain filter, but for keys that several rows have, and components without any: those few rows are dealt by
    component, and one of equals stays.
    """
    stays = found.filter((F.col("n_shingles") == 0) | F.col(key).eqNullSafe(F.col("component_id")))
    linked = stays.filter("n_shingles > 0")
    unclear = linked.groupBy(F.col(key).alias("_again")).agg(F.count(F.lit(1)).alias("_times"))
    unclear = if_small(stored(unclear.filter("_times > 1 OR _again IS NULL").select("_again"), "unclear"))
    again = F.col(key).eqNullSafe(F.col("_again")) & (F.col("n_shingles") > 0)
    return stays.join(unclear, again, "left_anti").unionByName(
        stays.join(unclear, again, "left_semi").dropDuplicates(["component"])
    )


def _texts_of(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """One text for each node in a pair. Only the rows' numbers are sent to the scan, if they are few; else joined."""
    wanted = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct()
    chosen = nodes.join(wanted, "node").groupBy("node").agg(F.min("row").alias("row"))
    chosen = if_small(stored(chosen, "chosen"), BROADCAST_KEYS)
    found = texts.join(chosen, F.col("_row") == F.col("row")).select("node", "text")
    return stored(found, "texts")


def op7_near_duplicates(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id")


QUERIES = {"op7_near_duplicates": op7_near_duplicates}

SQL = {
    "op7_near_duplicates": f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS ws FROM documents),
s AS (
  SELECT r, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {GRAM} THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - {GRAM - 2}), lambda i: array_to_string(ws[i:i+{GRAM - 1}], ' '))) END AS g FROM d),
e AS (SELECT r, len(g) AS n, unnest(g) AS g FROM s),
l AS (
  SELECT a.r AS a, b.r AS b FROM e a JOIN e b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r, a.n, b.n
  HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT r AS a, r AS b FROM s UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
c AS (SELECT reach.a AS r, min(doc_id) AS component_id FROM reach JOIN s ON reach.b = s.r GROUP BY reach.a)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id FROM s JOIN c USING (r)"""
}
