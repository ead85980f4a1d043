"""Helpers shared by the text operators: scratch tables, Arrow batches, word hashing.

Words are maximal runs of bytes other than space, tab, LF, VT, FF, CR of the UTF-8
text: the pattern ``[^\\x20\\x09-\\x0D]+``, and also what ``bytes.split()`` yields.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardlake.session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"

# ---------------------------------------------------------------- scratch tables


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint folder of the cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a scratch table and read it back: cuts the lineage, fixes generated
    ids, and survives lost executors, as the folder is shared."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def utf8(text_col: str = "text") -> Column:
    """The text as UTF-8 bytes, null as empty."""
    return F.coalesce(col(text_col).cast("binary"), F.lit(b""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- prefilter of joins

FILTER_CHUNKS = 1024      # of 4096 bytes: a filter is 4 MB, whatever the input
_CHUNK_BITS = 4096 * 8


def may_match(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows whose ``key`` may be in the one (long) column of ``keys``: all that are, and a few others.

    To be put before a join that would shuffle whole rows of which few match. The keys set bits
    of a bitmap of fixed size, which is all that is broadcast; with more keys than it has bits it
    lets more rows pass and loses none. Null keys may pass, as in any other row.
    """
    def chunk(c: Column) -> Column:
        return F.pmod(F.xxhash64(c.cast("long")), F.lit(FILTER_CHUNKS))

    def place(c: Column) -> Column:
        return F.pmod(F.shiftright(F.xxhash64(c.cast("long")), 16), F.lit(_CHUNK_BITS))

    own = F.col(keys.columns[0])
    bitmap = (keys.select(chunk(own).alias("filter_chunk"), place(own).alias("filter_place")).repartition("filter_chunk")
              .groupBy("filter_chunk").agg(F.bitmap_construct_agg("filter_place").alias("filter_bits")))
    marked = rows.withColumn("filter_chunk", chunk(F.col(key))).withColumn("filter_place", place(F.col(key)).cast("int"))
    byte = F.conv(F.hex(F.expr("substring(filter_bits, filter_place div 8 + 1, 1)")), 16, 10).cast("int")
    bit = F.expr("shiftleft(1, filter_place % 8)")
    return marked.join(F.broadcast(bitmap), "filter_chunk").where(byte.bitwiseAND(bit) != 0).select(*rows.columns)


# ---------------------------------------------------------------- Arrow batches

def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch],
                schema: StructType | str) -> DataFrame:
    """``mapInArrow`` of a function of one batch; the function must not keep state."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)
    return df.mapInArrow(run, schema)


def blocks(texts: list[bytes], limit: int = 1 << 16) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes each (a longer text is alone in its range)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


# ---------------------------------------------------------------- word hashing

_U = np.uint64
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so invertible modulo 2**64
_CODE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64)
_CODE[_BLANK] = 0
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept, and grown when more are needed."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix64)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_bounds(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words in an array of bytes."""
    inside = np.zeros(len(a) + 2, np.int8)
    inside[1:-1] = ~_BLANK[a]
    turn = np.diff(inside)
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


def _hash_piece(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end = word_bounds(a)
    if not len(start):
        return start, np.zeros(0, np.uint64)
    value = _CODE[a] * powers(_BASE, len(a))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
    h = (total[end] - total[start]) * powers(pow(_BASE, -1, 1 << 64), len(a))[start]
    return start, mix(h ^ mix((end - start).astype(np.uint64)))


def word_hashes(text: bytes, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Start offsets and 64-bit hashes of the words of a text. Equal words have equal hashes
    everywhere. Long texts go in pieces that end at a blank, so memory stays a small
    multiple of the text."""
    a = np.frombuffer(text, np.uint8)
    if lower:
        a = _LOWER[a]
    if len(a) <= 1 << 21:
        return _hash_piece(a)
    starts, hashes, at = [], [], 0
    while at < len(a):
        stop = min(at + (1 << 20), len(a))
        while stop < len(a) and not _BLANK[a[stop]]:
            later = np.flatnonzero(_BLANK[a[stop:stop + (1 << 20)]])
            stop = min(len(a), stop + (int(later[0]) if len(later) else 1 << 20))
        s, h = _hash_piece(a[at:stop])
        starts.append(s + at)
        hashes.append(h)
        at = stop
    return np.concatenate(starts), np.concatenate(hashes)


def corpus_hashes(texts: list[bytes], lower: bool = False) -> Iterator[tuple[int, np.ndarray]]:
    """(index, word hashes) of each text; many short texts are hashed in one array."""
    for a, b in blocks(texts):
        start, h = word_hashes(b"\n".join(texts[a:b]), lower)
        ends = np.cumsum([len(t) + 1 for t in texts[a:b]])
        cut = np.searchsorted(start, ends)
        at = 0
        for i, stop in enumerate(cut.tolist()):
            yield a + i, h[at:stop]
            at = stop


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        out = out * _U(0xD6E8FEB86659FD93) + words[j:j + len(out)]
    return mix(out)


def word_counts(texts: pa.Array) -> np.ndarray:
    """Number of words of each text of a binary Arrow array, without a Python object per text."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    n = len(texts)
    large = pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if large else np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = texts.buffers()[2]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    out = np.zeros(n, np.int64)
    at = 0
    while at < n:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (1 << 22), side="right")) - 1)
        stop = min(stop, n)
        a = bytes_[offsets[at]:offsets[stop]]
        if len(a):
            inside = ~_BLANK[a]
            first = inside.copy()
            first[1:] &= ~inside[:-1]
            heads = offsets[at:stop] - offsets[at]
            full = offsets[at + 1:stop + 1] > offsets[at:stop]
            first[heads[full]] = inside[heads[full]]  # a word that begins a text
            total = np.concatenate([[0], np.cumsum(first)])
            out[at:stop] = total[offsets[at + 1:stop + 1] - offsets[at]] - total[heads]
        at = stop
    return out
