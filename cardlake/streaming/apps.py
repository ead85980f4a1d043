"""The continuous flows (cards, deck values, portfolio, prices) wired from ``streaming.jobs``.

Each function starts its streaming queries and returns them; sources are any
(key, value) message streams (Kafka topics on a cluster, landed files in tests).
Every query checkpoints under ``<checkpoint_root>/<name>``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardlake import schemas
from cardlake.functions import columns as C
from cardlake.operators import aggregates as A
from cardlake.operators import joins as J
from cardlake.operators import sinks as S
from cardlake.session import checkpoint_path
from cardlake.sources import envelopes as E
from cardlake.streaming import jobs as SJ


def _ck(df: DataFrame, root: str | None, name: str) -> str:
    return os.path.join(root, name) if root else checkpoint_path(df.sparkSession, f"streams/{name}")


def start_card_flow(card_messages: DataFrame, out_dir: str, trigger: dict | None = None,
                    checkpoint_root: str | None = None) -> list[StreamingQuery]:
    """cards -> enriched cards -> (Parquet archive + card table upsert) and per-set
    5-minute statistics (append: a window is emitted once the watermark closes it)."""
    enriched = SJ.enriched_cards_stream(card_messages)
    q1 = SJ.run_stream(enriched, "card_sinks", sink=SJ.card_sink_batch(os.path.join(out_dir, "enriched"),
                                                                        os.path.join(out_dir, "cards")),
                       trigger=trigger, checkpoint=_ck(card_messages, checkpoint_root, "card_sinks"))
    stats = SJ.set_statistics_stream(SJ.decode_cards(card_messages))
    q2 = SJ.run_stream(stats, "card_statistics", sink="json", path=os.path.join(out_dir, "statistics"),
                       mode="append", trigger=trigger,
                       checkpoint=_ck(card_messages, checkpoint_root, "card_statistics"))
    return [q1, q2]


def start_deck_value_flow(deck_card_messages: DataFrame, out_dir: str, trigger: dict | None = None,
                          checkpoint_root: str | None = None, window: str = "10 seconds",
                          watermark: str = "5 seconds") -> StreamingQuery:
    """deck.card events -> windowed deck values -> deck.value.calculated events (JSON)."""
    values = SJ.deck_values_stream(deck_card_messages, watermark=watermark, window=window)
    events = SJ.deck_value_events(values)
    return SJ.run_stream(events, "deck_values", sink="json", path=os.path.join(out_dir, "deck-values"),
                         mode="append", trigger=trigger,
                         checkpoint=_ck(deck_card_messages, checkpoint_root, "deck_values"))


def start_portfolio_flow(value_messages: DataFrame, out_dir: str, trigger: dict | None = None,
                         checkpoint_root: str | None = None) -> StreamingQuery:
    """deck.value events -> latest value per deck (table) -> portfolio statistics."""
    latest = SJ.latest_table_stream(value_messages)
    return SJ.run_stream(latest, "portfolio", mode="update", trigger=trigger,
                         sink=SJ.portfolio_batch(os.path.join(out_dir, "deck-values-latest"),
                                                 os.path.join(out_dir, "portfolio")),
                         checkpoint=_ck(value_messages, checkpoint_root, "portfolio"))


def price_batch(cards_table: str, out_dir: str, alert_threshold: float = 500.0):
    """foreachBatch body: enrich the batch of prices with the card table as it is *now*
    (re-read every batch, so new card versions are seen), append alerts and enriched rows."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = S.read_if_there(spark, cards_table)
        if table is None:  # no card table yet: every price is unmatched
            table = spark.createDataFrame([], "uuid string, name string, rarity string, type string")
        cards = table.select(F.col("uuid").alias("card_uuid"), "name", "rarity", F.col("type").alias("card_type"))
        e = J.enrich_prices(batch, cards).persist()
        try:
            # outputs are keyed by batch id: a replayed batch replaces, never duplicates
            S.write_enriched_parquet(e.withColumn("batch_id", F.lit(batch_id)),
                                     os.path.join(out_dir, "enriched-prices"), partition_col="batch_id")
            S.write_batch_json(e.where(F.col("price") > alert_threshold)
                               .select("card_uuid", F.col("name").alias("card_name"), "price",
                                       F.col("date").alias("price_date"),
                                       C.alert_message("name", "price").alias("alert_message")),
                               os.path.join(out_dir, "price-alerts"), batch_id)
        finally:
            e.unpersist()
    return write


def running_table_batch(path: str, keys: list[str], n_buckets: int = 16):
    """foreachBatch body of an update-mode aggregate: the changed rows replace those of their
    keys in the table at ``path``, which other jobs can read and a restart goes on with."""
    def write(batch: DataFrame, batch_id: int) -> None:
        values = [c for c in batch.columns if c not in keys]
        S.write_upsert(batch.withColumn("_at", F.current_timestamp()), path, keys, ["_at"], values, "_at", n_buckets=n_buckets)
    return write


def start_price_flow(price_messages: DataFrame, cards_table: str, out_dir: str, trigger: dict | None = None,
                     checkpoint_root: str | None = None, alert_threshold: float = 500.0,
                     expensive_threshold: float = 100.0) -> list[StreamingQuery]:
    """prices -> enriched prices + alerts (against the current card table), and the
    running expensive-card and daily price statistics tables (update mode, upserted into
    ``out_dir``/expensive-cards and ``out_dir``/daily-price-stats)."""
    rows = E.decode_envelope(price_messages, schemas.PRICE_ROW).where(F.col("_error").isNull()).select("data.*")
    q1 = SJ.run_stream(rows, "price_enrich", sink=price_batch(cards_table, out_dir, alert_threshold),
                       trigger=trigger, checkpoint=_ck(price_messages, checkpoint_root, "price_enrich"))
    expensive = A.expensive(rows, ["card_uuid"], "price", expensive_threshold)
    q2 = SJ.run_stream(expensive, "expensive_cards", mode="update", trigger=trigger,
                       sink=running_table_batch(os.path.join(out_dir, "expensive-cards"), ["card_uuid"]),
                       checkpoint=_ck(price_messages, checkpoint_root, "expensive_cards"))
    daily = A.price_stats(rows, ["date"], "price", 0.0)
    q3 = SJ.run_stream(daily, "daily_price_stats", mode="update", trigger=trigger,
                       sink=running_table_batch(os.path.join(out_dir, "daily-price-stats"), ["date"]),
                       checkpoint=_ck(price_messages, checkpoint_root, "daily_price_stats"))
    return [q1, q2, q3]
