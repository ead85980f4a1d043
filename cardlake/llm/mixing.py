"""Mixing sources to target weights by cube-method balanced sampling.

A source's target over its size is the ratio r by which its documents are taken: each is
taken floor(r) times, and once more with inclusion probability r - floor(r). The cube
method turns these fractions into whole decisions: it moves the probabilities of three
undecided documents along the null space of the constraints (word total, document total)
until one of them is 0 or 1, again and again. A block of n documents ends with at most two
undecided ones; those of many blocks meet in the next round, until a source is one block,
whose last two (the landing) are rounded to the nearest totals.

Blocks have a bounded size, so a source with a third of all rows is many blocks.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from functools import reduce
from itertools import product

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cardlake.llm.common import col, map_batches, materialise, utf8, word_counts

WEIGHTS = (5, 2, 1)   # by rank of the source, repeating
CAP = 3               # a document is taken so many times at most
BLOCK = 20_000        # documents of one flight
EPS = 1e-9


def sizes(docs: DataFrame, text_col: str = "text", source_col: str = "source",
          carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """source, size (number of words; null text: 0), check (of the text), row (the carried columns)."""
    rows = docs.select(col(source_col).cast("string").alias("source"), F.crc32(utf8(text_col)).alias("check"),
                       F.struct(*[col(c).alias(c) for c in carry]).alias("row"), utf8(text_col).alias("bytes"))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        size = pa.array(word_counts(batch.column("bytes")), pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("source"), batch.column("check"), batch.column("row"), size], ["source", "check", "row", "size"])

    schema = StructType([rows.schema["source"], rows.schema["check"], rows.schema["row"], StructField("size", LongType())])
    return map_batches(rows, count, schema)


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """source, source_size, n_docs, target: one row per source (the windows see no other rows).

    Sources rank by code point, null last, and weigh ``weights``, repeating. The targets share
    the whole of all sizes by weight; one above ``cap`` times its source's size stops there and
    its excess goes to the others by weight. In order of cap over weight the stopped sources
    come first; the level (target per weight) if k of them stop rises until the right k.
    """
    order = [F.col("source").isNull(), F.col("source")]
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(Window.orderBy(*order)) - 1) % len(weights) + 1).cast("int"))
    totals = (sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
              .withColumn("weight", weight).withColumn("cap", (F.lit(cap) * F.col("source_size")).cast("double")))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), *order)
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    return (totals.withColumn("level", level).withColumn("level", F.max("level").over(whole))
            .select("source", "source_size", "n_docs", F.least("cap", F.col("level") * F.col("weight")).alias("target")))


def flight(p: list[float], size: list[int], rnd: random.Random) -> None:
    """Move the probabilities ``p`` in place until at most two lie between 0 and 1, keeping the
    sums of p and of p * size."""
    active: list[int] = []
    queue = iter(range(len(p)))
    while True:
        for i in queue if len(active) < 3 else ():
            if EPS < p[i] < 1 - EPS:
                active.append(i)
                if len(active) == 3:
                    break
        if len(active) == 3:
            a, b, c = (size[i] for i in active)
            u = (b - c, c - a, a - b)  # cross product of the sizes and ones
            if not any(u):
                u = (1, -1, 0)
        elif len(active) == 2 and size[active[0]] == size[active[1]]:
            u = (1, -1)
        else:
            return
        up = min((1 - p[i]) / v if v > 0 else p[i] / -v for i, v in zip(active, u) if v)
        down = min(p[i] / v if v > 0 else (1 - p[i]) / -v for i, v in zip(active, u) if v)
        step = up if rnd.random() * (up + down) < down else -down
        for i, v in zip(active, u):
            x = p[i] + step * v
            p[i] = 0.0 if x <= EPS else 1.0 if x >= 1 - EPS else x
        active = [i for i in active if 0 < p[i] < 1]


def land(p: list[float], size: list[int]) -> None:
    """Round the few probabilities left so that both totals stay nearest."""
    left = [i for i, x in enumerate(p) if 0 < x < 1]
    unit = max([1, *(size[i] for i in left)])
    best = min(product((0.0, 1.0), repeat=len(left)), key=lambda s: (
        round(abs(sum((x - p[i]) * size[i] for x, i in zip(s, left))) / unit, 9),
        round(abs(sum(x - p[i] for x, i in zip(s, left))), 9), s))
    for x, i in zip(best, left):
        p[i] = x


def mix_sources(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id",
                weights: Sequence[float] = WEIGHTS, cap: int = CAP, block: int = BLOCK, seed: int = 7,
                row_col: str | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, copies (times the mix takes the row), taken
    (copies * size) for every row; with ``row_col`` (a unique long) also rid.

    Reruns agree: blocks and their order come from a hash of doc_id and text, the random
    numbers from the seed and the block. Null text has size 0, null sources are one source.
    A source of size 0 has target 0 and copies 0. Rows repeating doc_id and text are decided
    one by one (they share a block). An empty table gives an empty table.
    """
    rid = F.col("row")[row_col] if row_col else F.lit(None)
    sized = materialise(sizes(docs, text_col, source_col, [id_col, row_col] if row_col else [id_col]).select(
        F.col("row")[id_col].cast("long").alias("doc_id"), rid.cast("long").alias("rid"), "source", "size", "check"), "mix-sizes")
    targets = source_targets(sized, weights, cap)
    ratio = F.when(F.col("source_size") > 0, F.least(F.lit(float(cap)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    units = (sized.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
             .withColumn("ratio", ratio).withColumn("whole", F.floor(F.col("ratio") + EPS).cast("int"))
             .withColumn("p", F.greatest(F.lit(0.0), F.col("ratio") - F.col("whole")))
             .withColumn("spot", F.xxhash64(F.lit(seed), "doc_id", "check"))
             .withColumn("blocks", F.ceil(F.col("n_docs") / block)))
    units = materialise(units.withColumn("block", F.expr("pmod(spot, blocks)"))
                        .drop("check", "ratio", "n_docs"), "mix-units")
    decided = [units.where(F.col("p") <= EPS).withColumn("p", F.lit(0.0))]
    left = units.where(F.col("p") > EPS)
    rounds = left.agg(F.max("blocks")).first()[0] or 0
    while rounds:
        def fly(key, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["spot", "doc_id", "size"], kind="stable")
            p, size = rows["p"].tolist(), rows["size"].tolist()
            flight(p, size, random.Random(f"{seed}/{key[0]}/{key[1]}/{len(p)}"))
            if rows["blocks"].iloc[0] == 1:
                land(p, size)
            return rows.assign(p=p)

        flown = materialise(left.groupBy("source", "block").applyInPandas(fly, left.schema), "mix-flown")
        decided.append(flown.where("p = 0 or p = 1"))
        # at most two of each block go on, so block // 2 blocks of the next round hold as many rows
        wide = max(2, block // 2)
        left = (flown.where("p > 0 and p < 1").withColumn("block", F.expr(f"block div {wide}"))
                .withColumn("blocks", F.ceil(F.col("blocks") / wide)))
        rounds = -(-rounds // wide) if rounds > 1 else 0
    copies = (F.col("whole") + F.col("p")).cast("int")
    return reduce(DataFrame.unionByName, decided).select(
        "doc_id", *(["rid"] if row_col else []), "source", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"))
