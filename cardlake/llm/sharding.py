"""Contiguous balanced shards from global byte-size prefix sums.

Rows (id and size only, no text) are range partitioned by id. Each partition's total gives
the prefix sum in front of it; inside a partition a running sum completes it. The global
sum is cut at equal targets. What meets in one place is one row per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlake.llm.common import col, materialise, shuffle_partitions, utf8


def prefix_sums(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, bytes_before (sizes of all rows in front), rank (rows in front) and
    total (of all sizes) for every row, in the order of doc_id, text_crc32, size (nulls first)."""
    text = utf8(text_col)
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), (F.length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).cast("long").alias("text_crc32"))
    order = ["doc_id", "text_crc32", "size"]
    # written, so that the partition of a row stays what it is in every later step
    placed = materialise(rows.repartitionByRange(shuffle_partitions(docs.sparkSession), *order)
                         .withColumn("part", F.spark_partition_id()), "shard-rows")
    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    offsets = totals.select(  # one row per partition
        "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("part_bytes"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_rows"), F.sum("bytes").over(whole).alias("total"))
    inner = Window.partitionBy("part").orderBy(*order)
    running = F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, 0))
    return placed.join(offsets, "part").select(
        "doc_id", "size", "text_crc32", (F.col("part_bytes") + running - F.col("size")).alias("bytes_before"),
        (F.col("part_rows") + F.row_number().over(inner) - 1).alias("rank"), "total")


def shard_by_bytes(docs: DataFrame, shards: int = 8, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row.

    size is the text's UTF-8 bytes plus 1 (null and empty text: 1). Shards are contiguous in
    the order of doc_id (nulls first; rows repeating an id by checksum and size); a row goes
    to the shard in which the middle of its bytes falls, so a shard misses its target by at
    most half a row's size at either end. slot counts a shard's rows from 0 without gaps. With
    fewer rows than shards some shards are empty; an empty table gives an empty table.
    """
    # twice the middle of the row's bytes times shards over twice the total, in whole numbers
    shard = f"cast((cast(2 * bytes_before + size as decimal(38,0)) * {shards}) div (2 * total) as int)"
    ranked = materialise(prefix_sums(docs, text_col, id_col).select(
        "doc_id", "size", "text_crc32", "rank", F.expr(shard).alias("shard")), "shard-ranked")
    first = ranked.groupBy("shard").agg(F.min("rank").alias("first"))  # one row per shard
    return ranked.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).alias("slot"))
