"""Structured Streaming jobs. They reuse the batch operators unchanged: every
operator in ``cardlake.operators`` is DataFrame -> DataFrame and works on a
streaming DataFrame too, except where noted.

Sources are pluggable: ``kafka_source`` on a cluster with the Kafka connector,
``file_source`` (JSON lines / Parquet landed in a folder) everywhere else.
Checkpoints live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from cardlake import schemas
from cardlake.operators import aggregates as A
from cardlake.operators import joins as J
from cardlake.operators import sinks as S
from cardlake.operators import transforms as T
from cardlake.functions import columns as C
from cardlake.session import checkpoint_path
from cardlake.sources import envelopes as E

VALUE_SCHEMA = StructType([StructField("key", StringType()), StructField("value", StringType())])


# ----------------------------------------------------------------------------- sources
def kafka_source(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """(key, value, topic, partition, offset, timestamp) from a Kafka topic.

    'earliest' = committed-else-earliest (the resume point is the checkpoint),
    'latest' = only new messages. Needs the spark-sql-kafka package on the cluster.
    """
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().select(F.col("key").cast("string"), F.col("value").cast("string"), "topic",
                           "partition", "offset", "timestamp")


def file_source(spark: SparkSession, path: str, schema: StructType = VALUE_SCHEMA, fmt: str = "json",
                max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """A folder of landed message files read as a stream (one row per message)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


# ----------------------------------------------------------------------------- runner
def run_stream(df: DataFrame, name: str, sink: str | Callable = "memory", mode: str = "append",
               trigger: dict | None = None, checkpoint: str | None = None, path: str | None = None,
               options: dict | None = None) -> StreamingQuery:
    """Start a streaming query.

    sink: 'memory' (tests), 'parquet' / 'json' (path), 'console', or a
    foreachBatch function ``f(batch_df, batch_id)``. trigger: e.g.
    {'processingTime': '60 seconds'} or {'availableNow': True}.
    """
    w = df.writeStream.queryName(name).outputMode(mode).option(
        "checkpointLocation", checkpoint or checkpoint_path(df.sparkSession, f"streams/{name}"))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    if callable(sink):
        w = w.foreachBatch(sink)
    else:
        w = w.format(sink)
        if path:
            w = w.option("path", path)
    return w.start()


# ----------------------------------------------------------------------------- jobs
def decode_cards(messages: DataFrame) -> DataFrame:
    """Card envelopes -> card rows with the event time (bad messages dropped here;
    ``decode_envelope`` keeps them with ``_error`` for a reject sink)."""
    d = E.decode_envelope(messages, schemas.CARD, payload_key="card")
    return d.where(F.col("_error").isNull()).select(
        "event_ts", F.col("card.uuid").alias("uuid"), F.col("card.name").alias("name"),
        F.col("card.manaCost").alias("mana_cost"), F.col("card.type").alias("type"),
        F.col("card.rarity").alias("rarity"), F.col("card.setCode").alias("set_code"),
        F.col("card.convertedManaCost").alias("cmc"), F.col("card.colors").alias("colors"))


def enriched_cards_stream(messages: DataFrame) -> DataFrame:
    """Card stream -> enriched cards (colour count, multicolour flag, cost tier)."""
    return T.enrich_cards(decode_cards(messages))


def card_sink_batch(parquet_path: str, table_path: str, n_buckets: int = 64) -> Callable:
    """foreachBatch body: archive the enriched batch to Parquet and upsert the card
    table on uuid (newest event wins). Replaying a batch id gives the same table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            S.write_enriched_parquet(batch.withColumn("batch_id", F.lit(batch_id)), parquet_path,
                                     partition_col="batch_id")
            S.write_upsert(batch.select("uuid", "name", "mana_cost", "type", "rarity", "set_code", "event_ts"),
                           table_path, ["uuid"], ["event_ts"],
                           ["name", "mana_cost", "type", "rarity", "set_code"], "event_ts", n_buckets=n_buckets)
        finally:
            batch.unpersist()
    return write


def set_statistics_stream(cards: DataFrame, watermark: str = "20 seconds", window: str = "5 minutes") -> DataFrame:
    """Per set and 5-minute event-time window card statistics (update/append mode)."""
    return A.set_statistics(cards.withWatermark("event_ts", watermark), "set_code", "rarity", "cmc",
                            ts_col="event_ts", window=window)


def deck_values_stream(deck_card_messages: DataFrame, watermark: str = "5 seconds",
                       window: str = "10 seconds", unit_price: float = 5.0) -> DataFrame:
    """deck.card events -> windowed deck values (Σ quantity × unit price) per deck."""
    d = E.decode_envelope(deck_card_messages, schemas.DECK_CARD).where(F.col("_error").isNull())
    cards = d.select("event_ts", "data.*").withWatermark("event_ts", watermark)
    return A.tumbling_reduce(cards, "event_ts", "deck_id", "quantity", "deck_name", size=window,
                             unit_price=unit_price)


def deck_value_events(values: DataFrame) -> DataFrame:
    """Windowed values -> deck.value.calculated envelopes (timestamp in epoch millis)."""
    return E.build_envelope(
        values.withColumn("calculated_at", F.unix_millis("window_end")),
        schemas.EVENT_DECK_VALUE, schemas.SOURCE_DECK_VALUES, schemas.VERSION_DECKS,
        payload=["deck_id", "deck_name", "total_cards", "total_value", "calculated_at"],
        timestamp=F.col("window_end"), timestamp_as_millis=True)


def price_alerts_stream(price_messages: DataFrame, cards_latest: DataFrame, threshold: float = 500.0) -> DataFrame:
    """Prices (stream) LEFT JOIN the current card table (static) -> alerts above a threshold."""
    p = E.decode_envelope(price_messages, schemas.PRICE_ROW).where(F.col("_error").isNull()).select("data.*")
    e = J.enrich_prices(p, cards_latest)
    return e.where(F.col("price") > threshold).select(
        "card_uuid", F.col("name").alias("card_name"), "price", F.col("date").alias("price_date"),
        C.alert_message("name", "price").alias("alert_message"))


def latest_table_stream(value_messages: DataFrame) -> DataFrame:
    """Running latest value per deck (LATEST_BY_OFFSET), for outputMode('update')."""
    d = E.decode_envelope(value_messages, schemas.DECK_VALUE, keep=("offset",)).where(F.col("_error").isNull())
    rows = d.select("offset", "data.*")
    return A.latest_by(rows, ["deck_id"], ["calculated_at", "offset"],
                       ["deck_name", "total_cards", "total_value", "calculated_at"])


def portfolio_batch(table_path: str, stats_path: str, n_buckets: int = 64) -> Callable:
    """foreachBatch body for the two-level aggregate: upsert the latest-per-deck rows,
    then recompute the portfolio statistics over the materialised table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        upd = batch.withColumn("_ts", F.timestamp_millis("calculated_at"))
        S.write_upsert(upd, table_path, ["deck_id"], ["_ts"], ["deck_name", "total_cards", "total_value"],
                       "_ts", n_buckets=n_buckets)
        stats = A.portfolio_stats(spark.read.parquet(table_path)).withColumn("batch_id", F.lit(batch_id))
        stats.write.mode("overwrite").parquet(stats_path)
    return write


def enriched_decks_stream(decks: DataFrame, values: DataFrame, within: str = "1 hour",
                          watermark: str = "1 hour") -> DataFrame:
    """decks ⋈ deck values on id within ±1 hour of event time (stream-stream join)."""
    d = decks.withWatermark("d_ts", watermark)
    v = values.withWatermark("v_ts", watermark)
    j = J.interval_join(d, v, "id", "deck_id", "d_ts", "v_ts", within=within)
    return j.select(F.col("name").alias("deck_name"), "unique_cards", d["total_cards"].alias("total_cards"),
                    "total_value", C.avg_item_value("total_value", d["total_cards"]).alias("avg_card_value"),
                    "file_path")


def dedupe_replays(df: DataFrame, keys: list[str], ts_col: str, watermark: str = "1 day") -> DataFrame:
    """Drop re-sent copies of the same fact (same business key, any event id) that
    arrive within the watermark; older replays are absorbed by the keyed upsert."""
    return df.withWatermark(ts_col, watermark).dropDuplicatesWithinWatermark(keys)


def progress_counters(query: StreamingQuery) -> dict:
    """Live counters of a running query from its last progress report: input rows,
    input and processing rates (rows/s) of the last micro-batch, per source."""
    p = query.lastProgress or {}
    return {
        "batch_id": p.get("batchId"),
        "num_input_rows": p.get("numInputRows", 0),
        "input_rows_per_second": p.get("inputRowsPerSecond", 0.0),
        "processed_rows_per_second": p.get("processedRowsPerSecond", 0.0),
        "sources": {s.get("description"): s.get("numInputRows", 0) for s in p.get("sources", [])},
    }
