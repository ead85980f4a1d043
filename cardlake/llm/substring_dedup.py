"""Removal of repeated passages: Rabin-Karp hashes of every window of 50 words.

Documents are cut into units of a few MB, contiguous in doc_id. A unit sends the distinct
hashes of its windows, packed by hash range; per range Spark finds for each hash the first
unit that has it, and answers each unit with a bit per hash: an earlier unit has it too.
Repeats inside a unit it sees itself. So a window moves as 7 bytes, once, and no matter how
many documents share a passage, it counts once per unit. Repeated windows merge into
maximal intervals, which are removed.

A window is known by 56 bits of its hash and the range (together about 62 bits on 70
ranges): two different windows among 10**8 meet with a probability of about 0.002.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import col, map_batches, mix, powers, shuffle_partitions, utf8, word_hashes
from cardlake.llm.sharding import prefix_sums

WINDOW = 50
UNIT_BYTES = 8 << 20     # text of a unit; one is in a task's memory at a time
RANGE_BYTES = 16 << 20   # text whose windows fall into one hash range, on average
_U = np.uint64
_BASE = 0x2545F4914F6CDD1D
_NO_ID = (1 << 63) - 1


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Rolling polynomial hash of each run of ``n`` words, by prefix sums modulo 2**64."""
    count = max(0, len(words) - n + 1)
    if not count:
        return np.zeros(0, np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers(_BASE, len(words)), dtype=np.uint64)])
    return mix((total[n:n + count] - total[:count]) * powers(pow(_BASE, -1, 1 << 64), count))


class Unit:
    """The documents of a unit in the order of doc_id (null last) and their windows."""

    def __init__(self, table: pa.Table, window: int):
        ids = np.array([_NO_ID if x is None else x for x in table.column("doc_id").to_pylist()], np.int64)
        self.order = np.argsort(ids, kind="stable")
        self.ids = ids[self.order]
        texts = table.column("bytes").to_pylist()
        self.texts = [texts[i] for i in self.order]
        hashes, self.n_words, doc = [], [], []
        for i, text in enumerate(self.texts):
            words = word_hashes(text)[1]
            self.n_words.append(len(words))
            hashes.append(window_hashes(words, window))
            doc.append(np.full(len(hashes[-1]), i, np.int32))
        self.n_windows = [len(h) for h in hashes]
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        doc = np.concatenate(doc) if doc else np.zeros(0, np.int32)
        self.distinct, first, self.place = np.unique(flat, return_index=True, return_inverse=True)
        # repeated inside the unit: the first document with this hash has a smaller id
        self.repeated = self.ids[doc] > self.ids[doc[first]][self.place]


def _range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return (((hashes >> _U(32)) * _U(ranges)) >> _U(32)).astype(np.int64)


def _pack(hashes: np.ndarray) -> bytes:
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 7, 8), np.uint8)
    out[:, :7] = np.frombuffer(packed, np.uint8).reshape(-1, 7)
    return out.view("<u8").ravel()


def remove_repeats(docs: DataFrame, window: int = WINDOW, text_col: str = "text", id_col: str = "doc_id",
                   unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, spans (array of maximal removed word intervals [start, end)) and
    kept_text (UTF-8 bytes: the kept words joined by one space) for every row.

    A word goes if a window over it also starts in a document with a smaller doc_id, judged on
    the input. Null text has no words. Documents of fewer words than a window stay whole. Rows
    with the same doc_id do not remove from each other; rows with a null id come after all
    others and not before each other. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    sums = prefix_sums(docs, text_col, id_col).select("doc_id", F.expr(f"bytes_before div {unit_bytes}").alias("unit"), "total")
    starts = sums.groupBy("unit").agg(F.min("doc_id").alias("start"), F.max("total").alias("total")).collect()  # a row per unit
    total = max([1, *(r.total for r in starts)])
    bounds = np.array(sorted(r.start for r in starts if r.start is not None)[1:], np.int64)
    ranges = max(shuffle_partitions(spark), -(-total // RANGE_BYTES))

    def to_unit(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = np.array([_NO_ID if x is None else x for x in batch.column("doc_id").to_pylist()], np.int64)
        unit = np.searchsorted(bounds, ids, side="right").astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(unit), *batch.columns], ["unit", "doc_id", "bytes"])

    placed = map_batches(docs.select(col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("bytes")), to_unit,
                         "unit long, doc_id long, bytes binary")

    def send(key: tuple, table: pa.Table) -> pa.Table:
        hashes = Unit(table, window).distinct
        of = _range_of(hashes, ranges)
        cut = np.searchsorted(of, np.arange(ranges + 1))
        full = [r for r in range(ranges) if cut[r + 1] > cut[r]]
        return pa.table({"range": pa.array(full, pa.int64()), "unit": pa.array([key[0].as_py()] * len(full), pa.int64()),
                         "hashes": pa.array([_pack(hashes[cut[r]:cut[r + 1]]) for r in full], pa.binary())})

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("unit")
        units = table.column("unit").to_numpy()
        parts = [_unpack(p) for p in table.column("hashes").to_pylist()]
        sizes = [len(p) for p in parts]
        hashes = np.concatenate(parts)
        order = np.argsort(hashes, kind="stable")  # equal hashes stay in the order of the units
        ranked = hashes[order]
        later = np.zeros(len(hashes), bool)
        later[order[1:]] = ranked[1:] == ranked[:-1]
        bits = [np.packbits(x).tobytes() for x in np.split(later, np.cumsum(sizes)[:-1])]
        return pa.table({"unit": pa.array(units), "range": pa.array([key[0].as_py()] * len(bits), pa.int64()),
                         "bits": pa.array(bits, pa.binary())})

    sent = placed.groupBy("unit").applyInArrow(send, "range long, unit long, hashes binary")
    answers = sent.groupBy("range").applyInArrow(answer, "unit long, range long, bits binary")

    def remove(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        unit = Unit(left, window)
        of = _range_of(unit.distinct, ranges)
        cut = np.searchsorted(of, np.arange(ranges + 1))
        earlier = np.zeros(len(unit.distinct), bool)
        for r, bits in zip(right.column("range").to_pylist(), right.column("bits").to_pylist()):
            n = int(cut[r + 1] - cut[r])
            earlier[cut[r]:cut[r + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
        repeated = unit.repeated | earlier[unit.place]
        out: dict[str, list] = {"n_removed": [], "spans": [], "kept_text": []}
        at = 0
        for text, n, windows in zip(unit.texts, unit.n_words, unit.n_windows):
            hit = np.flatnonzero(repeated[at:at + windows])
            at += windows
            words = text.split()
            spans = []
            if len(hit):
                gap = np.flatnonzero(np.diff(hit) > window)  # windows further apart leave words between
                begin = hit[np.concatenate([[0], gap + 1])]
                end = hit[np.concatenate([gap, [len(hit) - 1]])] + window
                spans = [{"start": int(a), "end": int(b)} for a, b in zip(begin, end)]
                for s in reversed(spans):
                    del words[s["start"]:s["end"]]
            out["n_removed"].append(n - len(words))
            out["spans"].append(spans)
            out["kept_text"].append(b" ".join(words))
        ids = left.column("doc_id").combine_chunks().take(pa.array(unit.order))
        return pa.table({"doc_id": ids, "n_words": pa.array(unit.n_words, pa.int64()),
                         "n_removed": pa.array(out["n_removed"], pa.int64()),
                         "spans": pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                         "kept_text": pa.array(out["kept_text"], pa.binary())})

    return placed.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(
        remove, "doc_id long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept_text binary")
