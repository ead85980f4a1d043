"""Aggregations, rankings and shares.

Every aggregate here is algebraic (count/sum/min/max/max_by), so Spark runs it as
partial aggregation before the shuffle: a key holding a third of all rows is
combined map-side and only one partial row per task crosses the network.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlake.functions import columns as C


def _cols(xs):
    return [C.col_(x) for x in ([xs] if isinstance(xs, (str, Column)) else xs)]


def money_sum(c) -> Column:
    """Sum of prices as exact decimal (result independent of addition order), as double."""
    return F.sum(C.col_(c).cast("decimal(18,2)")).cast("double")


def money_avg(c) -> Column:
    """Average price = exact decimal sum / count, as double."""
    return F.sum(C.col_(c).cast("decimal(18,2)")).cast("double") / F.count(C.col_(c))


def latest_by(df: DataFrame, keys, order_cols, value_cols, ignore_nulls: bool = True,
              last_order_name: str | None = None) -> DataFrame:
    """Newest value per key and per column (LATEST_BY_OFFSET semantics).

    ``order_cols`` give the recency order (e.g. event time, then offset). With
    ignore_nulls, each column independently takes its newest non-NULL value.
    """
    order = F.struct(*_cols(order_cols))
    aggs = []
    for name in value_cols:
        c = F.col(name)
        ordering = F.when(c.isNotNull(), order) if ignore_nulls else order
        aggs.append(F.max_by(c, ordering).alias(name))
    if last_order_name:
        aggs.append(F.max(order).alias(last_order_name))
    return df.groupBy(*_cols(keys)).agg(*aggs)


def latest_row(df: DataFrame, keys, order_cols, value_cols) -> DataFrame:
    """Newest whole row per key (unlike latest_by, NULLs of the newest row are kept)."""
    order = F.struct(*_cols(order_cols))
    packed = F.max_by(F.struct(*_cols(value_cols)), order).alias("_r")
    return df.groupBy(*_cols(keys)).agg(packed).select(*[C.col_(k) for k in keys], "_r.*")


def distribution(df: DataFrame, key, count_name: str = "count", with_share: bool = False,
                 drop_null_keys: bool = False, share_name: str = "pct",
                 latest_per: tuple[list[str], list[str]] | None = None) -> DataFrame:
    """COUNT(*) per key; optional share of the total in percent.

    The total is a scalar subquery (a partial count, one row per task), so the
    share needs no single-partition window however many keys there are.
    ``latest_per=(entity_keys, order_cols)`` counts each entity once, by its newest
    row (a stream that re-sends the same cards counts cards, not events).
    """
    if latest_per is not None:
        ids, order = latest_per
        df = latest_row(df, ids, order, [key] if isinstance(key, str) else list(key))
    src = df.where(C.col_(key).isNotNull()) if drop_null_keys else df
    out = src.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
    if with_share:
        total = src.select(F.count(F.lit(1))).scalar()
        out = out.withColumn(share_name, (F.col(count_name) * F.lit(100.0)) / total)
    return out


def price_stats(df: DataFrame, by, price_col: str, min_price: float = 0.0, prefix: str = "") -> DataFrame:
    """count / avg / max / min of prices above ``min_price`` per group."""
    p = F.col(price_col)
    return (df.where(p > F.lit(min_price)).groupBy(*_cols(by))
            .agg(F.count(F.lit(1)).alias(f"{prefix}total_prices"),
                 money_avg(p).alias(f"{prefix}avg_price"),
                 F.max(p).alias(f"{prefix}max_price"),
                 F.min(p).alias(f"{prefix}min_price")))


def expensive(df: DataFrame, keys, price_col: str, min_price: float = 100.0) -> DataFrame:
    """MAX(price), COUNT(*) per key over prices above ``min_price``."""
    p = F.col(price_col)
    return (df.where(p > F.lit(min_price)).groupBy(*_cols(keys))
            .agg(F.max(p).alias("max_price"), F.count(F.lit(1)).alias("price_points")))


def topk(df: DataFrame, order_cols, k: int, rank_name: str = "rank") -> DataFrame:
    """First ``k`` rows by ``order_cols`` (give a total order), numbered 1..k.

    orderBy+limit runs as a per-partition top-k merged on the driver-side of the
    final stage (TakeOrderedAndProject); only k rows per task move.
    """
    top = df.orderBy(*order_cols).limit(k)
    return top.withColumn(rank_name, F.row_number().over(Window.orderBy(*order_cols)))


def conditional_counts(df: DataFrame, by, conditions: dict[str, Column]) -> DataFrame:
    """COUNT(*) plus COUNT(CASE WHEN cond THEN 1 END) per named condition."""
    aggs = [F.count(F.lit(1)).alias("total")] + [F.count_if(c).alias(n) for n, c in conditions.items()]
    g = df.groupBy(*_cols(by)) if by else df.groupBy()
    return g.agg(*aggs)


def portfolio_stats(latest: DataFrame, value_col: str = "total_value", extra: list[Column] | None = None) -> DataFrame:
    """Global count / sum / avg / max / min of deck values (one row), plus ``extra`` aggregates."""
    v = F.col(value_col)
    return latest.agg(F.count(F.lit(1)).alias("total_decks"), money_sum(v).alias("combined_value"),
                      money_avg(v).alias("average_deck_value"), F.max(v).alias("most_expensive_deck"),
                      F.min(v).alias("cheapest_deck"), *(extra or []))


def bucket_stats(latest: DataFrame, cards_col: str = "total_cards", value_col: str = "total_value") -> DataFrame:
    """Decks per format bucket: count and average value."""
    return (latest.withColumn("format", C.deck_bucket(cards_col)).groupBy("format")
            .agg(F.count(F.lit(1)).alias("deck_count"), money_avg(value_col).alias("avg_value")))


def set_statistics(cards: DataFrame, set_col: str, rarity_col: str, cmc_col: str,
                   ts_col: str | None = None, window: str = "5 minutes") -> DataFrame:
    """Per set (and per tumbling event-time window when ``ts_col`` is given):
    total cards, mythic/rare/uncommon/common counts, average converted mana cost."""
    keys = [F.col(set_col).alias("set_code")]
    if ts_col:
        keys = [F.window(ts_col, window).alias("w")] + keys
    r = F.col(rarity_col)
    out = cards.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_cards"),
        F.count_if(r == "mythic").alias("mythic_count"),
        F.count_if(r == "rare").alias("rare_count"),
        F.count_if(r == "uncommon").alias("uncommon_count"),
        F.count_if(r == "common").alias("common_count"),
        F.avg(F.col(cmc_col)).alias("avg_converted_mana_cost"),
    )
    if ts_col:
        out = out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                         *[c for c in out.columns if c != "w"])
    return out


def tumbling_reduce(df: DataFrame, ts_col: str, key_col: str, qty_col: str, name_col: str,
                    size: str = "10 seconds", unit_price: float = 5.0, tiebreak: str | None = None) -> DataFrame:
    """Windowed deck reduce: Σ quantity, first name, line count and estimated value
    per (tumbling window, deck). The card-name list of the source reduce is never
    emitted downstream, so it is not built (it would grow without bound)."""
    order = F.struct(F.col(ts_col), F.col(tiebreak)) if tiebreak else F.col(ts_col)
    out = df.groupBy(F.window(ts_col, size).alias("w"), F.col(key_col).alias("deck_id")).agg(
        F.min_by(F.col(name_col), order).alias("deck_name"),
        F.sum(F.col(qty_col).cast("bigint")).alias("total_cards"),
        F.count(F.lit(1)).alias("card_events"),
    )
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "deck_id", "deck_name", "total_cards", "card_events",
                      C.estimate_value("total_cards", unit_price).alias("total_value"))


def running_changes(df: DataFrame, keys: list[str], batch_col: str, aggs: dict[str, tuple[str, Column]]) -> DataFrame:
    """EMIT CHANGES of a running aggregate over batches: keys, seq (1, 2, ... per key), batch, before and after.

    ``aggs`` names each value with its kind ('sum', 'max' or 'min') and the column of ``df``; a count is the
    sum of 1. A row comes out for each batch that changes a key's values (compared with NULLs equal); before is
    NULL in a key's first row. Applying the rows in order of seq to an empty table gives the running table.
    Rows are combined per key and batch before the window, so a hot key costs one row per batch.
    """
    fold = {"sum": F.sum, "max": F.max, "min": F.min}
    per_batch = df.groupBy(*keys, F.col(batch_col).alias("batch")).agg(*[fold[kind](c).alias(name) for name, (kind, c) in aggs.items()])
    by_key = Window.partitionBy(*keys).orderBy("batch")
    so_far = by_key.rowsBetween(Window.unboundedPreceding, 0)
    after = F.struct(*[fold[kind](name).over(so_far).alias(name) for name, (kind, _) in aggs.items()])
    images = per_batch.select(*keys, "batch", after.alias("after")).withColumn("before", F.lag("after").over(by_key))
    changed = images.where(~F.col("before").eqNullSafe(F.col("after")))
    return changed.select(*keys, F.row_number().over(by_key).cast("long").alias("seq"), "batch", "before", "after")
