"""Exact deduplication by distributed MSD radix partitioning.

The digit of a round is the next run of bytes of the normalised text. A round groups the
rows by (group so far, digit): a group with one row or whose text has ended is final, the
others go on with the bytes behind the digit. Equality is decided by the bytes alone; no
digest takes part. Digits grow from round to round, so texts of n bytes need about
log(n) rounds, and only rows that still share a prefix with another row are carried on.

Counting a digit combines map-side, so a group holding a third of all rows moves one row
per task. The join that hands rows their next group is an equi join that AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import SPACES, col, materialise

FIRST_DIGIT = 64          # bytes of the first digit
GROWTH = 4                # each digit is so many times longer than the one before
LONGEST_DIGIT = 1 << 24   # bytes; bounds the grouping key of a row


def normalised(text_col: str = "text") -> Column:
    """Runs of blanks as one space, as UTF-8 bytes; null counts as empty."""
    return F.regexp_replace(F.coalesce(col(text_col), F.lit("")), SPACES, " ").cast("binary")


def _rest(column: str, used: int) -> Column:
    return F.substring(F.col(column), F.lit(used + 1), F.length(column))


def exact_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                carry: Sequence[str] = ()) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, row.

    ``row`` is a struct of the ``carry`` columns (for callers that go on with whole rows;
    null without any). keep_id is the smallest doc_id among the rows of equal normalised
    text, group_size their number; exactly one of them is kept: of rows repeating the
    smallest doc_id, one. Null ids sort last (keep_id is null only if all are). Null text
    counts as empty; empty texts equal each other. An empty table gives an empty table.
    Columns of other names are not looked at, so clashes do not matter.
    """
    row = F.struct(*[col(c).alias(c) for c in carry]) if carry else F.lit(None).cast("struct<none:int>")
    base = docs.select(col(id_col).cast("long").alias("doc_id"), normalised(text_col).alias("bytes"), row.alias("row"))
    base = base.withColumn("digit", F.substring("bytes", 1, FIRST_DIGIT))
    shared = materialise(
        base.groupBy("digit").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("digit", F.monotonically_increasing_id().alias("gid")), "radix-first")
    state = materialise(
        # a shuffle join at every size: AQE splits the rows of a hot digit
        base.join(shared.hint("merge"), "digit", "left").select(
            "doc_id", "row", "gid", F.sha2("bytes", 256).alias("text_sha256"),
            F.when(F.col("gid").isNotNull(), _rest("bytes", FIRST_DIGIT)).alias("rest"))
        .withColumn("rid", F.monotonically_increasing_id()), "radix-state")

    final = ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "row"]
    done = [state.where("gid is null").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256", "row")]
    active, width = state.where("gid is not null"), FIRST_DIGIT
    while not active.isEmpty():
        width = min(width * GROWTH, LONGEST_DIGIT)
        rows = active.withColumn("digit", F.substring("rest", 1, width))
        order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")
        groups = rows.groupBy("gid", "digit").agg(F.count(F.lit(1)).alias("group_size"), F.min(order).alias("head"))
        ended = (F.col("group_size") == 1) | (F.length("digit") < width)
        state = materialise(
            rows.join(groups.hint("merge"), ["gid", "digit"]).select(
                "doc_id", "row", "rid", "text_sha256", "group_size", F.col("head.doc_id").alias("keep_id"),
                (F.col("rid") == F.col("head.rid")).alias("kept"), ended.alias("ended"),
                F.when(~ended, F.col("head.rid")).alias("gid"),
                F.when(~ended, _rest("rest", width)).alias("rest")), "radix-state")
        done.append(state.where("ended").select(*final))
        active = state.where("not ended").select("doc_id", "row", "rid", "text_sha256", "gid", "rest")
    return reduce(DataFrame.unionByName, done)
