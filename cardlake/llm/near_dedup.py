"""Near-duplicate groups by chosen-path set similarity join.

Documents are sets of word shingles with a min-wise signature. In each of several
independent trees a node branches on a few randomly chosen signature positions: documents
with the same min-wise token there go to the same child, so a similar pair stays together in
some child with constant probability. Small nodes are compared exhaustively, large ones
branch on. Copies of a set are one representative.

What keeps groups of thousands linear: only documents of different components are compared,
and components merge as early as possible. First each document is compared with a node's
pivot and with its nearest neighbour by sketch, then with the nearest of another component:
each time one candidate of a document. What is left is compared whole inside the nodes: the
full sets of a node's documents come to its task, which confirms pairs of different components
and returns only the links that join two, so fewer than the node has documents. Candidates pass
a one-bit sketch of the signature first. A node that is still wide at the last level, or whose
sets are large, is compared in blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from cardlake.llm.common import col, corpus_hashes, gram_hashes, map_batches, materialise, may_match, mix, utf8
from cardlake.llm.components import components

SHINGLE = 5          # words
SIMILARITY = 75      # per cent: links have 100 * intersection >= 75 * union
POSITIONS = 32       # of the signature
TREES = 10           # a pair of similarity 0.75 is missed by all with p < 0.002 at every depth
SMALL = 64           # documents of a node that is compared by a join
LARGE = 2048         # of a block; a node of at most two blocks is compared whole, a wider one branches
DEPTH = 4            # levels of branching; wider nodes are then compared block by block
NEAREST_ROUNDS = 2
SET_BYTES = 16 << 20  # of the full sets of a block; a node with more falls into more blocks
AT_ONCE = 1 << 22    # shingles of the sets that one set is compared with at a time
BITS_APART = 19      # of 64 sketch bits; a pair of similarity 0.75 differs in more with p < 0.0002
BYTES = 256          # of the byte sketch that large nodes use
BYTES_SAME = 171     # of them; a pair of similarity 0.75 agrees in fewer with p < 0.002
_U = np.uint64
_RANDOM = np.random.Generator(np.random.PCG64(75))
_A = _RANDOM.integers(1, 1 << 31, BYTES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RANDOM.integers(0, 1 << 32, BYTES, dtype=np.uint32)
_SALT = _RANDOM.integers(1, 1 << 62, POSITIONS, dtype=np.uint64)


# ---------------------------------------------------------------- sets and signatures

def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles; a shorter text is one shingle."""
    n = min(SHINGLE, len(words))
    return np.unique(gram_hashes(words, n)) if n else np.zeros(0, np.uint64)


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest value of each of the min-wise hash functions: the first ``POSITIONS`` of them
    whole (they branch trees), and a byte of each (they estimate similarity)."""
    out = np.full(BYTES, 0xFFFFFFFF, np.uint32)
    short = (shingles >> _U(32)).astype(np.uint32)
    for a in range(0, len(short), 1024):
        values = short[None, a:a + 1024] * _A[:, None] + _B[:, None]
        np.minimum(out, values.min(axis=1), out=out)
    return out[:POSITIONS], (mix(out.astype(np.uint64)) & _U(255)).astype(np.uint8)


def sign(docs: DataFrame, text_col: str, id_col: str, row_col: str | None) -> DataFrame:
    """doc_id, rid, n_shingles, digest of the set, signature (packed uint32), byte sketch."""
    rid = col(row_col).cast("long") if row_col else F.lit(None).cast("long")
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), rid.alias("rid"), utf8(text_col).alias("bytes"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, digest, sig, sketch = [], [], [], []
        for _, words in corpus_hashes(batch.column("bytes").to_pylist(), lower=True):
            shingles = shingle_set(words)
            n.append(len(shingles))
            digest.append(set_digest(shingles))
            whole, short = signature(shingles)
            sig.append(whole.tobytes())
            sketch.append(short.tobytes())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("rid"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
             pa.array(sig, pa.binary()), pa.array(sketch, pa.binary())],
            ["doc_id", "rid", "n_shingles", "digest", "sig", "sketch"])

    return map_batches(rows, run, "doc_id long, rid long, n_shingles long, digest binary, sig binary, sketch binary")


# ---------------------------------------------------------------- branching

def _uniform(x: np.ndarray) -> np.ndarray:
    return (mix(x) >> _U(11)).astype(np.float64) / float(1 << 53)


def _chosen(node: np.ndarray) -> np.ndarray:
    """For each node the positions it branches on (nodes x positions): each with probability
    1 / (similarity * positions), and one at least, so that no node drops its documents."""
    u = _uniform(node[:, None] * _U(0x9E3779B97F4A7C15) + _SALT[None, :])
    pick = u < 100 / (SIMILARITY * POSITIONS)
    pick[np.arange(len(node)), u.argmin(axis=1)] = True
    return pick


def _child(node: np.ndarray, position: np.ndarray, value: np.ndarray) -> np.ndarray:
    return mix(mix(node * _U(0xD6E8FEB86659FD93) + position.astype(np.uint64)) + value.astype(np.uint64))


def _signatures(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("sig").to_pylist()), "<u4").reshape(batch.num_rows, POSITIONS)


_NODES = "node long, slot int, id long, n long, bits long"
_ROWS = ("node", "slot", "id", "n", "bits")


def _branch(batch: pa.RecordBatch, nodes: np.ndarray, root: bool) -> pa.RecordBatch:
    """Rows of the children of ``nodes`` (one node per row of the batch)."""
    sig = _signatures(batch)
    row, position = np.nonzero(_chosen(nodes))
    child = _child(nodes[row], position, sig[row, position]).view(np.int64)
    kept = batch.select(["id", "n", "bits"]).take(pa.array(row))
    places = np.full(POSITIONS, -1, np.int32)
    if root:  # all rows are of one root
        for slot, (tree, p) in enumerate(_SLOTS):
            if tree == int(nodes[0]):
                places[p] = slot
    return pa.RecordBatch.from_arrays([pa.array(child), pa.array(places[position]), *kept.columns], list(_ROWS))


def _roots() -> np.ndarray:
    return mix(np.arange(1, TREES + 1).astype(np.uint64))


# the branches of all roots, as (root, position); a row of the first level has its index as slot
_SLOTS = [(int(r), int(p)) for r in _roots() for p in np.flatnonzero(_chosen(np.array([r], np.uint64))[0])]


def _first_level(reps: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for root in _roots():
                if batch.num_rows:
                    yield _branch(batch, np.full(batch.num_rows, root), True)
    return reps.select("id", "n", "bits", "sig").mapInArrow(run, _NODES)


def _next_level(large: DataFrame, reps: DataFrame) -> DataFrame:
    rows = large.select("node", "id", "n", "bits").join(may_match(reps.select("id", "sig"), "id", large.select("id")), "id")
    return map_batches(rows, lambda b: _branch(b, b.column("node").to_numpy().view(np.uint64), False), _NODES)


# ---------------------------------------------------------------- candidates and confirmation

def _may_link(n1: str, n2: str, bits1: str, bits2: str) -> Column:
    """Sizes allow the similarity, and the sketches are near."""
    return F.expr(f"100 * least({n1}, {n2}) >= {SIMILARITY} * greatest({n1}, {n2}) "
                  f"and bit_count({bits1} ^ {bits2}) <= {BITS_APART}")


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("label", F.col("id"))
    return rows.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))


def _open_nodes(rows: DataFrame) -> DataFrame:
    """The rows of nodes with documents of more than one component, with the node's count and
    pivot (the smallest id; ids are random numbers). The nodes are counted first: most have one
    document, and their rows need not be shuffled whole. Near copies share most of their nodes: of
    nodes of the same documents that are compared whole one stays, as the others compare the same pairs."""
    nodes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles"), F.min("id").alias("pivot"),
                                     F.min("label").alias("low"), F.max("label").alias("high"),
                                     F.bit_xor("id").alias("ids"), F.bit_xor(F.xxhash64("id")).alias("marks"))
    nodes = nodes.where("low != high").drop("low", "high")
    same = nodes.groupBy("docs", "shingles", "pivot", "ids", "marks", F.expr(f"if(docs > {2 * LARGE}, node, null)").alias("wide")).agg(F.min("node").alias("node"))
    nodes = materialise(same.select("node", "docs", "shingles", "pivot"), "near-nodes")
    return may_match(rows, "node", nodes.select("node")).join(nodes, "node")


def _stars(rows: DataFrame) -> DataFrame:
    """Pairs of a document and its node's pivot; of a document's pivots the smallest."""
    pivots = rows.where("id = pivot").select(
        "node", F.col("n").alias("n2"), F.col("bits").alias("bits2"), F.col("label").alias("label2"))
    return (rows.join(pivots, "node").where("label != label2").where(_may_link("n", "n2", "bits", "bits2"))
            .groupBy("id").agg(F.min("pivot").alias("v")).select(F.col("id").alias("u"), "v"))


def _small_pairs(rows: DataFrame) -> DataFrame:
    """u, v, apart: pairs of documents of different components in nodes of at most ``SMALL``."""
    a = rows.select("node", "id", "n", "bits", "label")
    b = rows.select("node", *[F.col(c).alias(f"{c}2") for c in ("id", "n", "bits", "label")])
    return a.join(b, (a["node"] == b["node"]) & F.expr("id > id2 and label != label2") & _may_link("n", "n2", "bits", "bits2")).select(
        F.col("id").alias("u"), F.col("id2").alias("v"), (4 * F.expr("bit_count(bits ^ bits2)")).alias("apart"))


def _near(bits: np.ndarray, n: np.ndarray, x: slice) -> np.ndarray:
    """Of the rows ``x`` with all rows: sizes allow the similarity, and the bit sketches are near."""
    least, most = np.minimum(n[x, None], n[None, :]), np.maximum(n[x, None], n[None, :])
    return (np.bitwise_count(bits[x, None] ^ bits[None, :]) <= BITS_APART) & (100 * least >= SIMILARITY * most)


def _sketches(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(table), BYTES)


def _same_bytes(sketch: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(0, int), *[
        (sketch[u[k:k + 65536]] == sketch[v[k:k + 65536]]).sum(axis=1) for k in range(0, len(u), 65536)]])


def _nearest_pairs(rows: DataFrame, ids: DataFrame, reps: DataFrame) -> DataFrame:
    """The nearest one of each document in larger nodes, one node (or pair of blocks) of at most
    2 * ``LARGE`` documents in a task at a time, compared in strips; the byte sketch sharpens the choice."""
    def run(table: pa.Table) -> pa.Table:
        ids, n, bits, label, side = (table.column(c).to_numpy() for c in ("id", "n", "bits", "label", "side"))
        bits, sketch, out = bits.view(np.uint64), _sketches(table), []
        blocks = (side != side[0]).any()
        for a in range(0, len(ids), 64):
            x = slice(a, a + 64)
            near = _near(bits, n, x) & (label[x, None] != label[None, :])
            if blocks:
                near &= side[x, None] != side[None, :]   # two blocks: only between them
            u, v = np.nonzero(near)
            same = _same_bytes(sketch, a + u, v)
            keep = same >= BYTES_SAME
            u, v, same = a + u[keep], v[keep], same[keep]
            order = np.lexsort((ids[v], -same, u))
            first = np.concatenate([[True], np.diff(u[order]) > 0])[:len(u)]
            u, v, same = u[order][first], v[order][first], same[order][first]
            out.append((ids[u], ids[v], (BYTES - same).astype(np.int32)))
        u, v, apart = (np.concatenate([o[k] for o in out]) for k in range(3))
        return pa.table({"u": u, "v": v, "apart": apart})

    rows = rows.join(may_match(reps.select("id", "sketch"), "id", ids), "id")
    return rows.groupBy("node", "low", "high").applyInArrow(run, "u long, v long, apart int")


def _in_blocks(rows: DataFrame, sets: bool = False) -> DataFrame:
    """Large nodes as groups (node, low, high): up to ``LARGE`` documents (and with ``sets`` up to
    ``SET_BYTES`` of full sets) one group, beyond that the documents fall into blocks by a hash, and
    each pair of blocks is a group."""
    blocks = f"(docs - 1) div {LARGE} + 1"
    if sets:
        blocks = f"greatest({blocks}, least(docs, (8 * shingles - 1) div {SET_BYTES} + 1))"
    rows = rows.withColumn("blocks", F.expr(blocks)).withColumn("side", F.expr("pmod(xxhash64(id), blocks)"))
    copies = rows.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    return copies.withColumn("low", F.least("side", "other")).withColumn("high", F.greatest("side", "other"))


def _nearest(level: DataFrame, reps: DataFrame) -> DataFrame:
    """u, v of open nodes: for each document the nearest one of another component by sketch."""
    large = level.where(F.col("docs") > SMALL)
    pairs = _small_pairs(level.where(F.col("docs") <= SMALL)).unionByName(_nearest_pairs(_in_blocks(large), large.select("id"), reps))
    ends = F.explode(F.array(F.struct(F.col("u").alias("of"), F.col("v").alias("to")),
                             F.struct(F.col("v").alias("of"), F.col("u").alias("to")))).alias("end")
    return (pairs.select(ends, "apart").groupBy("end.of").agg(F.min(F.struct("apart", "end.to")).alias("best"))
            .select(F.col("of").alias("u"), F.col("best.to").alias("v")))


def _join_sets(table: pa.Table) -> pa.Table:
    """u, v: links of one node (or pair of blocks) that join two components, confirmed on full sets.

    Every pair of different components whose sketches are near is looked at, unless links found
    before have joined the two; so the links are a forest, however many pairs there are. In a
    large node a pair is left to the first of the large nodes of the first level that share it.
    """
    names = ("id", "n", "bits", "label", "side", "slot", "slots")
    ids, n, bits, label, side, slot, slots = (table.column(c).to_numpy() for c in names)
    size, bits, links = len(ids), bits.view(np.uint64), []
    codes = np.unique(np.frombuffer(b"".join(table.column("set").to_pylist()), "<u8"), return_inverse=True)[1].astype(np.int32)
    ends = np.cumsum(n)
    sets = [codes[e - k:e] for e, k in zip(ends.tolist(), n.tolist())]
    held = np.zeros(int(codes.max()) + 1, bool)
    part = np.unique(label, return_inverse=True)[1]
    blocks, large = (side != side[0]).any(), size > SMALL
    if large:
        sketch, tokens = _sketches(table), np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u4").reshape(size, POSITIONS)
        earlier = [(1 << k, p) for k, (_, p) in enumerate(_SLOTS) if k < slot[0]]
    for a in range(0, size, 64):
        x = slice(a, a + 64)
        near = _near(bits, n, x) & (part[x, None] != part[None, :]) & (ids[x, None] > ids[None, :])
        if blocks:
            near &= side[x, None] != side[None, :]
        u, v = np.nonzero(near)
        u = a + u
        if large:
            keep = _same_bytes(sketch, u, v) >= BYTES_SAME
            u, v = u[keep], v[keep]
            for bit, position in earlier:
                other = (slots[u] & slots[v] & bit != 0) & (tokens[u, position] == tokens[v, position])
                u, v = u[~other], v[~other]
        for one in np.unique(u):
            others = v[u == one]
            others = others[part[others] != part[one]]
            cuts = np.flatnonzero(np.diff(np.cumsum(n[others]) // AT_ONCE)) + 1
            held[sets[one]] = True
            for some in np.split(others, cuts):
                if not len(some):
                    continue
                starts = np.cumsum(n[some]) - n[some]
                both = np.add.reduceat(held[np.concatenate([sets[k] for k in some])], starts, dtype=np.int64)
                for k in some[100 * both >= SIMILARITY * (n[one] + n[some] - both)]:
                    if part[k] != part[one]:
                        links.append((ids[one], ids[k]))
                        part[part == part[k]] = part[one]
            held[sets[one]] = False
    u, v = np.array(links, np.int64).reshape(-1, 2).T
    return pa.table({"u": u, "v": v})


def _links_in_nodes(level: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """u, v: confirmed links between components, of all open nodes; at most one per document and group."""
    ids = level.select("id").distinct()
    if level.isEmpty():
        return level.select(F.col("id").alias("u"), F.col("id").alias("v"))
    # only the slots at which a document's node is compared whole
    slots = level.groupBy("id").agg(F.expr("bit_or(if(slot < 0, 0L, shiftleft(1L, slot)))").alias("slots"))
    level = level.join(slots, "id")

    def to_sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(words).tobytes() for _, words in corpus_hashes(batch.column("bytes").to_pylist(), lower=True)]
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.binary())], ["id", "set"])

    sets = map_batches(may_match(texts, "id", ids).join(ids, "id", "left_semi").dropDuplicates(["id"]), to_sets, "id long, set binary")
    sets = materialise(sets.join(may_match(reps.select("id", "sig", "sketch"), "id", ids), "id"), "near-sets")
    rows = _in_blocks(level, sets=True).select("node", "low", "high", "id", "n", "bits", "label", "side", "slot", "slots")
    return rows.join(sets, "id").groupBy("node", "low", "high").applyInArrow(_join_sets, "u long, v long")


def _fetch_texts(docs: DataFrame, reps: DataFrame, ids: DataFrame, text_col: str, key_col: str) -> DataFrame:
    """id, bytes: a text of each of the representatives ``ids``. The only time that whole texts are
    joined, and few others than those found are shuffled. Of rows that repeat an id a task passes
    one; several tasks may pass the same."""
    heads = materialise(reps.join(ids, "id", "left_semi").select("id", "digest", F.col("head.key").alias("key")), "near-heads")
    rows = docs.select(col(key_col).cast("long").alias("key"), utf8(text_col).alias("bytes"))
    found = may_match(rows, "key", heads.select("key")).join(heads, "key").select("id", "digest", "bytes")
    nameless = heads.where("key is null").select("id", "digest").withColumn("mark", F.xxhash64("digest"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            keep, out = [], []
            for i, words in corpus_hashes(batch.column("bytes").to_pylist(), lower=True):
                digest = set_digest(shingle_set(words))
                if digest not in seen:
                    seen.add(digest)
                    keep.append(i)
                    out.append(digest)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.binary()), batch.column("bytes").take(pa.array(keep, pa.int64()))], ["digest", "bytes"])

    if not nameless.isEmpty():  # all rows of these sets have a null key: their digest finds them
        unnamed = rows.where("key is null").select("bytes").mapInArrow(digests, "digest binary, bytes binary")
        unnamed = may_match(unnamed.withColumn("mark", F.xxhash64("digest")), "mark", nameless.select("mark"))
        found = found.unionByName(unnamed.select("digest", "bytes").join(nameless, "digest").select("id", "digest", "bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keep, ids_, wanted = [], batch.column("id").to_pylist(), batch.column("digest").to_pylist()
            for i, words in corpus_hashes(batch.column("bytes").to_pylist(), lower=True):
                # rows may repeat a doc_id with another text
                if ids_[i] not in seen and set_digest(shingle_set(words)) == wanted[i]:
                    seen.add(ids_[i])
                    keep.append(i)
            yield batch.select(["id", "bytes"]).take(pa.array(keep, pa.int64()))

    return materialise(found.mapInArrow(run, "id long, bytes binary"), "near-texts")


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar."""
    def side(end: str, name: str) -> DataFrame:
        # one text of each id; the exchange by id is also the join's
        return may_match(texts, "id", pairs.select(end)).dropDuplicates(["id"]).select(F.col("id").alias(end), F.col("bytes").alias(name))

    rows = pairs.join(side("v", "right"), "v").join(side("u", "left"), "u").select("u", "v", "left", "right")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, sets = [], {}
        for side in ("u", "v"):
            wanted = dict(zip(batch.column(side).to_pylist(), batch.column("left" if side == "u" else "right").to_pylist()))
            wanted = {i: t for i, t in wanted.items() if i not in sets}
            names = list(wanted)
            sets.update((names[k], shingle_set(words)) for k, words in corpus_hashes(list(wanted.values()), lower=True))
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            a, b = sets[u], sets[v]
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * both >= SIMILARITY * (len(a) + len(b) - both))
        return batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return map_batches(rows, run, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", row_col: str | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; with ``row_col`` (a unique long) also rid.

    component_id is the smallest doc_id of the component. kept marks the rows whose doc_id that
    is; with ``row_col`` exactly one row of each component (of rows repeating the doc_id, one).
    Null and empty texts, and texts of blanks, have no shingles: each row is its own component
    and kept. Rows with equal sets are one class, whatever their number. Rows with a null doc_id
    are linked like any other; a component whose ids are all null has a null component_id, and
    without ``row_col`` all its rows are kept. An empty table gives an empty table.
    """
    signed = materialise(sign(docs, text_col, id_col, row_col), "near-signed")
    key_col = row_col or id_col
    key = F.col("rid") if row_col else F.col("doc_id")
    head = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid", key.alias("key"))

    def sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
        short = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(batch.num_rows, BYTES)
        bits = np.packbits(short[:, :64] & 1, axis=1).view(">i8").ravel().astype(np.int64)
        ids = mix(batch.column("number").to_numpy().view(np.uint64)).view(np.int64)  # a bijection
        return pa.RecordBatch.from_arrays(
            [pa.array(ids), batch.column("n"), pa.array(bits), *[batch.column(c) for c in ("digest", "head", "sig", "sketch")]],
            ["id", "n", "bits", "digest", "head", "sig", "sketch"])

    classes = (signed.where("n_shingles > 0").groupBy("digest")
               .agg(F.min(head).alias("head"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("sketch").alias("sketch"))
               .withColumn("number", F.monotonically_increasing_id()))
    reps = materialise(map_batches(classes, sketch, StructType([
        StructField("id", LongType()), StructField("n", LongType()), StructField("bits", LongType()),
        StructField("digest", BinaryType()), classes.schema["head"], StructField("sig", BinaryType()),
        StructField("sketch", BinaryType())])), "near-classes")

    # nodes to compare: those of the first level, but of too wide ones the children
    level, waiting = materialise(_open_nodes(_labelled(_first_level(reps), None)), "near-level"), []
    for depth in range(1, DEPTH + 1):
        wide = level.where(F.col("docs") > 2 * LARGE)
        if depth == DEPTH or wide.isEmpty():
            waiting.append(level)
            break
        waiting.append(level.where(F.col("docs") <= 2 * LARGE))
        level = materialise(_open_nodes(_labelled(_next_level(wide, reps), None)), "near-level")
    level = reduce(DataFrame.unionByName, waiting)

    # every document with a candidate has a nearest one: their texts are all that confirming needs
    first = materialise(_nearest(level, reps), "near-first")
    ids = first.select("u").distinct().withColumnRenamed("u", "id")
    texts = _fetch_texts(docs, reps, ids, text_col, key_col)
    stars = _stars(level).join(ids, F.col("u") == F.col("id"), "left_semi").join(ids, F.col("v") == F.col("id"), "left_semi")
    labels: DataFrame | None = None
    tried: list[DataFrame] = []

    def link(found: DataFrame) -> bool:
        """Merge the components that the confirmed links join."""
        nonlocal labels
        found = materialise(found, "near-edges")
        if found.isEmpty():
            return False
        if labels is not None:  # a star of each component stands for its links
            found = found.unionByName(labels.select(F.col("id").alias("u"), F.col("label").alias("v")))
        labels = components(found)
        return True

    pairs = first.unionByName(stars)
    level = level.join(ids, "id", "left_semi")   # a document without a candidate has none later
    for again in range(NEAREST_ROUNDS):
        pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        for done in tried:
            pairs = pairs.join(done, ["u", "v"], "left_anti")
        pairs = materialise(pairs, "near-pairs")
        tried.append(pairs)
        if not link(_confirm(pairs, texts)):
            break
        level = materialise(_open_nodes(_labelled(level.select(*_ROWS), labels)), "near-level")
        if again + 1 < NEAREST_ROUNDS:
            pairs = _nearest(level, reps)
    link(_links_in_nodes(level, reps, texts))

    classed = _labelled(reps.select("id", "digest", "head"), labels)
    first = classed.groupBy("label").agg(F.min("head").alias("first"))
    classed = classed.join(first, "label").select("digest", "first")
    out = signed.drop("sig", "sketch").join(classed, "digest", "left")
    component = F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))
    kept = F.col("first").isNull() | (F.col("rid").eqNullSafe(F.col("first.rid")) if row_col
                                      else F.col("doc_id").eqNullSafe(F.col("first.doc_id")))
    out = out.select("doc_id", "rid", "n_shingles", component.alias("component_id"), kept.alias("kept"))
    return out if row_col else out.drop("rid")
