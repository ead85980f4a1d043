"""Joins: lookup (left) join, as-of join, interval join, deck valuation, reference checks.

No broadcast hints are forced: Spark broadcasts a side only when its estimated
size is under ``spark.sql.autoBroadcastJoinThreshold`` and, with AQE, re-plans a
sort-merge join into a broadcast join when the *measured* shuffle output of a side
is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``. Above those checked
limits the join stays a sort-merge join whose skewed partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlake.operators.aggregates import latest_row
from cardlake.session import cut_lineage


def enrich_prices(prices: DataFrame, cards_latest: DataFrame, price_key: str = "card_uuid",
                  card_key: str = "card_uuid") -> DataFrame:
    """prices LEFT JOIN latest cards on the card key (stream-static in streaming)."""
    cond = prices[price_key] == cards_latest[card_key]
    return prices.join(cards_latest, cond, "left").drop(cards_latest[card_key])


def asof_join(facts: DataFrame, versions: DataFrame, key: str, fact_ts: str, version_ts: str,
              version_cols: list[str], version_tiebreak: str | None = None,
              bucket: str = "1 hour") -> DataFrame:
    """For every fact, the newest version with the same key and version_ts <= fact_ts
    (LEFT semantics: facts without an earlier version get NULLs).

    Skew-safe plan: time is cut into ``bucket``s. Within a (key, bucket) a running
    ``last(..., ignorenulls)`` over the union of both sides finds the in-bucket
    version; the newest version of any *earlier* bucket comes from a per-(key,
    bucket) summary (one row per bucket, built with a partial aggregate) carried
    forward by a window over buckets. A hot key is therefore spread over its
    buckets instead of being sorted in a single task. Pick ``bucket`` so that one
    key's rows in one bucket fit a task; finer buckets only add one small row per
    non-empty (key, bucket) to the carry-in step.
    """
    vt = version_tiebreak or version_ts
    vstruct = F.struct(*[F.col(c).alias(c) for c in version_cols])

    def bucket_of(c):
        return F.window(c, bucket).start

    f = facts.withColumn("_b", bucket_of(fact_ts))
    v = versions.select(F.col(key).alias("_k"), F.col(version_ts).alias("_vts"), F.col(vt).alias("_vtb"),
                        vstruct.alias("_v")).withColumn("_b", bucket_of("_vts"))

    # 1) in-bucket: union, order by (ts, side) so a version at the same instant counts
    fact_cols = facts.columns
    tb_type = v.schema["_vtb"].dataType
    fu = f.select(F.col(key).alias("_k"), F.col("_b"), F.col(fact_ts).alias("_ts"), F.lit(1).alias("_side"),
                  F.lit(None).cast(tb_type).alias("_vtb_o"), F.lit(None).cast(v.schema["_v"].dataType).alias("_v"),
                  F.struct(*[F.col(c) for c in fact_cols]).alias("_f"))
    vu = v.select("_k", "_b", F.col("_vts").alias("_ts"), F.lit(0).alias("_side"), F.col("_vtb").alias("_vtb_o"),
                  "_v", F.lit(None).cast(fu.schema["_f"].dataType).alias("_f"))
    w = (Window.partitionBy("_k", "_b").orderBy("_ts", "_side", "_vtb_o")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inb = (fu.unionByName(vu).withColumn("_in", F.last("_v", ignorenulls=True).over(w))
           .where(F.col("_side") == 1).select("_k", "_b", "_f", "_in"))

    # 2) carry-in: newest version of each earlier bucket, per key
    per_bucket = v.groupBy("_k", "_b").agg(F.max_by("_v", F.struct("_vts", "_vtb")).alias("_last"))
    fact_buckets = f.select(F.col(key).alias("_k"), "_b").distinct()
    wb = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = (fact_buckets.join(per_bucket, ["_k", "_b"], "full")
             .withColumn("_carry", F.last("_last", ignorenulls=True).over(wb))
             .select("_k", "_b", "_carry"))

    out = inb.join(carry, ["_k", "_b"], "left").withColumn("_m", F.coalesce("_in", "_carry"))
    return out.select("_f.*", *[F.col(f"_m.{c}").alias(c) for c in version_cols])


def asof_join_pieces(facts: DataFrame, versions: DataFrame, key: str, fact_ts: str, version_ts: str,
                     version_cols: list[str], version_tiebreak: str | None = None) -> DataFrame:
    """``asof_join`` whose tasks are even whatever a key or an instant holds.

    Both sides are range partitioned together by (key, time, side) and a random last key, so the rows of one key,
    even of one instant, fill as many pieces as they need. Within a piece a running ``last`` finds the
    version; the newest version of a key's earlier pieces comes from one row per (piece, key), carried forward over
    the pieces. The partitioned rows are checkpointed in the shared folder, as the pieces must be the same in both steps. Null keys
    and null times match nothing.
    """
    vt = version_tiebreak or version_ts
    v = versions.where(F.col(key).isNotNull() & F.col(version_ts).isNotNull()).select(
        F.col(key).alias("_k"), F.col(version_ts).alias("_ts"), F.lit(0).alias("_side"), F.col(vt).alias("_tb"),
        F.struct(*[F.col(c).alias(c) for c in version_cols]).alias("_v"))
    f = facts.select(F.col(key).alias("_k"), F.col(fact_ts).alias("_ts"), F.lit(1).alias("_side"), F.lit(None).cast(v.schema["_tb"].dataType).alias("_tb"),
                     F.lit(None).cast(v.schema["_v"].dataType).alias("_v"), F.struct(*[F.col(c) for c in facts.columns]).alias("_f"))
    rows = f.unionByName(v, allowMissingColumns=True).withColumn("_salt", F.rand(5))
    placed = cut_lineage(rows.repartitionByRange("_k", "_ts", "_side", "_tb", "_salt").withColumn("_piece", F.spark_partition_id()).drop("_salt"))
    running = Window.partitionBy("_piece", "_k").orderBy("_ts", "_side", "_tb").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = placed.withColumn("_in", F.last("_v", ignorenulls=True).over(running)).where("_side = 1").select("_piece", "_k", "_f", "_in")
    newest = placed.groupBy("_k", "_piece").agg(F.max_by("_v", F.when(F.col("_side") == 0, F.struct("_ts", "_tb"))).alias("_last"))
    earlier = Window.partitionBy("_k").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)   # a row per piece
    carry = newest.select("_k", "_piece", F.last("_last", ignorenulls=True).over(earlier).alias("_carry")).where(F.col("_carry").isNotNull())
    out = seen.join(carry, ["_piece", "_k"], "left").withColumn("_m", F.coalesce("_in", "_carry"))
    return out.select("_f.*", *[F.col("_m")[c].alias(c) for c in version_cols])


def asof_join_simple(facts: DataFrame, versions: DataFrame, key: str, fact_ts: str, version_ts: str,
                     version_cols: list[str]) -> DataFrame:
    """Reference form of the as-of join (one window per key); used by tests only."""
    fu = facts.select("*", F.lit(1).alias("_side"), F.col(fact_ts).alias("_ts"))
    vs = versions.select(F.col(key), F.col(version_ts).alias("_ts"),
                         F.struct(*version_cols).alias("_v"), F.lit(0).alias("_side"))
    u = fu.unionByName(vs, allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy("_ts", "_side").rowsBetween(Window.unboundedPreceding, 0)
    r = u.withColumn("_m", F.last("_v", ignorenulls=True).over(w)).where(F.col("_side") == 1)
    return r.select(*facts.columns, *[F.col(f"_m.{c}").alias(c) for c in version_cols])


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def _seconds(within: str) -> int:
    n, unit = within.split()
    return int(n) * _UNIT_SECONDS[unit.lower().rstrip("s")]


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  left_ts: str, right_ts: str, within: str = "1 hour", how: str = "inner") -> DataFrame:
    """Equi-join on the key with |left_ts - right_ts| <= within (both directions).

    Besides the key, both sides are matched on a time bucket of width ``within``:
    each right row is copied into its own and both neighbouring buckets, so a left
    row is compared only with right rows at most one band away (never with every
    row of its key, which would be quadratic for a hot key). Every qualifying pair
    meets in exactly one bucket. Only inner and left joins are offered: the copies of a
    right row would each come out unmatched in a right or full join. The time range stays a plain predicate, so on
    streams the watermarks on both sides bound the join state.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"interval_join is inner or left, not {how!r}")
    w = _seconds(within)
    lb = F.floor(F.unix_seconds(left[left_ts].cast("timestamp")) / F.lit(w)).cast("long")
    rb = F.floor(F.unix_seconds(right[right_ts].cast("timestamp")) / F.lit(w)).cast("long")
    lft = left.withColumn("_ij_b", lb)
    rgt = right.withColumn("_ij_b", F.explode(F.array(rb - 1, rb, rb + 1)))
    cond = ((lft[left_key] == rgt[right_key]) & (lft["_ij_b"] == rgt["_ij_b"])
            & (rgt[right_ts] >= lft[left_ts] - F.expr(f"INTERVAL {within}"))
            & (rgt[right_ts] <= lft[left_ts] + F.expr(f"INTERVAL {within}")))
    return lft.join(rgt, cond, how).drop(lft["_ij_b"]).drop(rgt["_ij_b"])


def value_decks(deck_cards: DataFrame, cards: DataFrame, prices: DataFrame,
                default_price: float | None = None, deck_key: str = "deck_id",
                name_col: str = "card_name", qty_col: str = "quantity",
                card_name_col: str = "name", card_key: str = "uuid",
                price_key: str = "card_uuid", price_col: str = "price",
                price_order: list[str] | None = None) -> DataFrame:
    """Price each deck: Σ quantity × latest price of the card with that exact name.

    A name maps to one card (the smallest uuid among its printings); the price
    is the newest price row of that card. Lines without a price use
    ``default_price`` (NULL -> they add nothing) and are counted as unpriced.
    """
    names = cards.groupBy(F.col(card_name_col).alias("_name")).agg(F.min(card_key).alias("_uuid"))
    order = price_order or [price_col]
    latest = latest_row(prices, [price_key], order, [price_col]).select(
        F.col(price_key).alias("_uuid"), F.col(price_col).alias("_price"))
    lines = (deck_cards.join(names, deck_cards[name_col] == names["_name"], "left")
             .join(latest, "_uuid", "left"))
    unit = F.coalesce(F.col("_price"), F.lit(default_price)) if default_price is not None else F.col("_price")
    line_value = F.col(qty_col).cast("decimal(20,0)") * unit.cast("decimal(18,2)")
    return lines.groupBy(deck_key).agg(
        F.sum(F.col(qty_col)).alias("total_cards"),
        F.coalesce(F.sum(line_value), F.lit(0)).cast("double").alias("total_value"),
        F.count_if(F.col("_price").isNull()).alias("unpriced_lines"),
    )


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent row (a failed REFERENCES check)."""
    p = parent.select(F.col(parent_key).alias("_pk")).distinct()
    return child.join(p, child[child_key] == p["_pk"], "left_anti")


def reference_checks(refs: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Many REFERENCES checks in one pass: (relation, child rows, orphan child rows,
    childless parent keys) per relation.

    refs: (relation, child, child_key, parent, parent_key). A table is read once for all relations in which it is
    the child, and once for those in which it is the parent; its rows are counted per (relation, key) before
    anything moves, so counts are joined, not rows. Integral keys are compared as bigint, anything else as text.
    """
    types = {df.schema[k].dataType.simpleString() for _, c, ck, p, pk in refs for df, k in ((c, ck), (p, pk))}
    key_type = "bigint" if types <= {"tinyint", "smallint", "int", "bigint"} else "string"

    def counted(side: list[tuple[str, DataFrame, str]], name: str) -> DataFrame:
        tables: dict[int, tuple[DataFrame, list[tuple[str, str]]]] = {}
        for rel, df, key in side:
            tables.setdefault(id(df), (df, []))[1].append((rel, key))
        keys = None
        for df, relations in tables.values():
            entries = F.array(*[F.struct(F.lit(rel).alias("relation"), F.col(key).cast(key_type).alias("_k")) for rel, key in relations])
            part = df.select(F.explode(entries).alias("e")).select("e.*").groupBy("relation", "_k").agg(F.count(F.lit(1)).alias(name))
            keys = part if keys is None else keys.unionByName(part)
        return keys

    child = counted([(rel, c, ck) for rel, c, ck, _, _ in refs], "_n")
    parent = counted([(rel, p, pk) for rel, _, _, p, pk in refs], "_p").where(F.col("_k").isNotNull())
    met = child.join(parent, ["relation", "_k"], "full")
    return met.groupBy("relation").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("child_rows"),
        F.coalesce(F.sum(F.when(F.col("_p").isNull() & F.col("_k").isNotNull(), F.col("_n"))), F.lit(0)).alias("orphan_rows"),
        F.count_if(F.col("_n").isNull()).alias("childless_parents"))
