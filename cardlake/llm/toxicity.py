"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of the words in
it; the document's is their noisy-or, 1 - prod(1 - p). Only documents have labels: the word
weights are trained through the noisy-or, so a toxic document explains itself by the
sentences that differ from clean ones, and those can be pointed at afterwards.

The model is fitted on the driver from a bounded sample (``Sample``); scoring reads every
whole text in one pass without a shuffle. Only the text enters a score.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from cardlake.llm.common import col, map_batches, utf8

LOCATED = 0.3   # sentences of at least this score are located
# ASCII letters in lower case; sentence ends to \0; other ASCII but letters, digits, - and ' to blanks
_TABLE = bytes(0 if c in b"\0.!?\n\r" else c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() or c in b"-'" else 32
               for c in range(256))


@dataclass(frozen=True)
class Sample:
    """Bounds of the training sample: documents of each class, and bytes of a document (longer
    ones are not trained on; they are scored like all others)."""
    toxic: int = 2000
    clean: int = 4000
    bytes: int = 200_000


@dataclass(frozen=True)
class Model:
    """Word weights and bias of the sentence score."""
    weights: dict[bytes, float]
    bias: float

    def sentences(self, text: bytes) -> list[tuple[int, int, float]]:
        """(start byte, end byte, score) of each sentence with a word that has a weight."""
        out, at, get = [], 0, self.weights.get
        for sentence in text.translate(_TABLE).split(b"\0"):
            hits = [w for w in map(get, sentence.split()) if w is not None]
            if hits:
                out.append((at, at + len(sentence), 1 / (1 + math.exp(-min(30.0, max(-30.0, self.bias + sum(hits)))))))
            at += len(sentence) + 1
        return out

    def score(self, sentences: list[tuple[int, int, float]]) -> float:
        """Noisy-or. Sentences without a weighted word are clean by definition and count nothing,
        so a text's length alone does not make it toxic; a text without any scores 0."""
        return -math.expm1(sum(math.log1p(-min(p, 1 - 1e-12)) for _, _, p in sentences)) + 0.0


def train_sample(docs: DataFrame, labels: DataFrame, sample: Sample = Sample(), text_col: str = "text",
                 id_col: str = "doc_id", label_col: str = "toxic") -> list[tuple[bytes, int]]:
    """(text, label) of a bounded sample of the labelled documents, in a fixed order.

    ``labels`` must hold training rows only. Rows without id or label do not take part; of rows
    that repeat an id the largest label counts; equal texts count once.
    """
    known = (labels.select(col(id_col).cast("long").alias("id"), col(label_col).cast("int").alias("label"))
             .where("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label")))
    picked = [known.where(F.col("label") == y).orderBy(F.xxhash64(F.lit(11), "id"), "id").limit(n)
              for y, n in ((1, sample.toxic), (0, sample.clean))]
    picked = F.broadcast(picked[0].unionByName(picked[1]))  # sample.toxic + sample.clean rows at most
    rows = docs.select(col(id_col).cast("long").alias("id"), utf8(text_col).alias("bytes")).join(picked, "id")
    rows = rows.where(F.length("bytes") <= sample.bytes).select("bytes", "label")
    return sorted({bytes(r.bytes): int(r.label) for r in rows.toLocalIterator()}.items())


def fit(rows: list[tuple[bytes, int]], min_documents: int = 5, steps: int = 300, rate: float = 0.1, decay: float = 2e-4) -> Model:
    """Train word weights by full-batch Adam on the noisy-or likelihood, classes weighing the same.

    Words of fewer than ``min_documents`` sample documents have no weight. Without both classes
    there is nothing to learn, and the model scores everything 0.
    """
    bags = [[s.split() for s in text.translate(_TABLE).split(b"\0")] for text, _ in rows]
    y = np.array([label for _, label in rows], bool)
    if not y.any() or y.all():
        return Model({}, 0.0)
    counts = [Counter(), Counter()]
    for bag, label in zip(bags, y):
        counts[int(label)].update({w for s in bag for w in s})
    words = sorted(w for w in counts[0] | counts[1] if counts[0][w] + counts[1][w] >= min_documents)
    place = {w: i for i, w in enumerate(words)}
    clean, toxic = (np.array([c[w] for w in words], float) for c in counts)
    odds = np.log((toxic + 0.5) / (y.sum() + 1)) - np.log((clean + 0.5) / ((~y).sum() + 1))

    flat, first, doc_of = [], [], []  # words by sentence, sentences by document
    for d, bag in enumerate(bags):
        for s in bag:
            hits = {place[w] for w in s if w in place}
            if hits:
                first.append(len(flat))
                flat += sorted(hits)
                doc_of.append(d)
    flat, first, doc_of = np.array(flat), np.array(first), np.array(doc_of)
    sentence_of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(flat))))
    theta = np.append(np.maximum(odds, 0.0), -6.0)  # weights and bias
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    share = np.where(y, 0.5 / y.sum(), 0.5 / (~y).sum())
    for step in range(1, steps + 1):
        z = np.add.reduceat(theta[flat], first) + theta[-1]
        clean_log = np.bincount(doc_of, np.logaddexp(0, z), len(y))   # -log P(document is clean)
        pull = share * np.where(y, -1 / np.maximum(np.expm1(np.minimum(clean_log, 50)), 1e-6), 1.0)
        slope = pull[doc_of] / (1 + np.exp(-z))
        grad = np.append(np.bincount(flat, slope[sentence_of], len(words)), slope.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        theta[:-1] = np.sign(theta[:-1]) * np.maximum(np.abs(theta[:-1]) - rate * decay, 0)  # few words matter
    return Model({w: float(t) for w, t in zip(words, theta) if abs(t) > 1e-3}, float(theta[-1]))


def score_documents(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, score (0 to 1) and offending (array of start byte, end byte, score of the sentences of
    score ``LOCATED`` and more) for every row. Null and empty texts score 0. Null and repeated ids
    pass through, other columns are not looked at, an empty table gives an empty table."""
    spans = StructType([StructField("start", LongType()), StructField("end", LongType()), StructField("score", DoubleType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        score, offending = [], []
        for text in batch.column("bytes").to_pylist():
            found = model.sentences(text)
            score.append(model.score(found))
            offending.append([{"start": a, "end": b, "score": p} for a, b, p in found if p >= LOCATED])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(score, pa.float64()), pa.array(offending, kind)], ["doc_id", "score", "offending"])

    rows = docs.select(col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("bytes"))
    return map_batches(rows, run, StructType([rows.schema["doc_id"], StructField("score", DoubleType()),
                                              StructField("offending", ArrayType(spans))]))
