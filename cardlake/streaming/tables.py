"""Continuous flows over versioned tables: running tables with change logs, replay-safe joins, nothing uncounted.

Every flow is a ``foreachBatch`` body or starts one. A batch decodes its messages once: rows that decode go
on, the others to ``rejects/<flow>``, and ``ledger/<flow>`` gets a line per batch with its input, accepted
and rejected counts (by reason). All outputs are keyed by the batch id, so a micro-batch that
Spark runs again after a failure replaces or finds its own output:

* card tables: the card table takes the batch by an atomic commit with its change log, and the counts per rarity,
  type and colours follow the log: -1 for the group a card leaves, +1 for the one it comes to;
* price tables: the batch is joined with the card table's version that it met when it first ran;
* deck values: the newest value per deck, and by the buckets that a batch touches the portfolio's statistics and leading decks;
* running tables: an update-mode aggregate's changed rows, ordered by batch id, with EMIT CHANGES as log.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cardlake import schemas
from cardlake.functions import columns as C
from cardlake.operators import joins as J
from cardlake.operators import sinks as S
from cardlake.operators import derived as DV
from cardlake.operators import versioned as V
from cardlake.session import checkpoint_path
from cardlake.sources import envelopes as E
from cardlake.streaming import jobs as SJ

GROUPS = ("rarity", "type", "color_identity")
CARD_VALUES = ["name", "mana_cost", "type", "rarity", "set_code", "color_identity"]
CARD_ORDER = ["event_ts", "event_id"]


def _checkpoint(df: DataFrame, root: str | None, name: str) -> str:
    return os.path.join(root, name) if root else checkpoint_path(df.sparkSession, f"streams/{name}")


# ---------------------------------------------------------------- one decode, two outputs

def decoded_batch(out_dir: str, flow: str, payload: StructType, payload_key: str, accept: Callable[[DataFrame, int], None]) -> Callable:
    """foreachBatch body: decode a batch of messages once, give the good rows to ``accept``, write the others to
    ``rejects/<flow>`` with their reason, and the counts to ``ledger/<flow>``: input = accepted + rejected.

    A message without an event time counts as rejected ('missing_time'): windows and versions need one."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = E.decode_envelope(batch, payload, payload_key=payload_key, keep=("value",)).withColumn(
            "_error", F.coalesce("_error", F.when(F.col("event_ts").isNull(), "missing_time"))).persist()
        try:
            reasons = {r[0]: r[1] for r in rows.groupBy("_error").count().collect()}   # a few reasons
            bad = rows.where(F.col("_error").isNotNull()).select(F.col("_error").alias("reason"), "value")
            S.write_batch_json(bad, os.path.join(out_dir, "rejects", flow), batch_id)
            accept(rows.where(F.col("_error").isNull()).drop("_error", "value"), batch_id)
            accepted = reasons.pop(None, 0)
            line = {"batch_id": batch_id, "input": accepted + sum(reasons.values()), "accepted": accepted,
                    "rejected": sum(reasons.values()), "reasons": reasons}
            ledger = V.Files(spark, os.path.join(out_dir, "ledger", flow))
            if f"{batch_id}.json" not in ledger.names(""):
                ledger.create(f"{batch_id}.json", json.dumps(line))
        finally:
            rows.unpersist()
    return write


def ledger(spark, out_dir: str, flow: str) -> DataFrame:
    """The lines of a flow's ledger: batch_id, input, accepted, rejected and reasons (a map)."""
    return spark.read.schema("batch_id long, input long, accepted long, rejected long, reasons map<string,long>") \
        .json(os.path.join(out_dir, "ledger", flow))


# ---------------------------------------------------------------- cards

def card_table(spark, out_dir: str, n_buckets: int = 64) -> V.VersionedTable:
    return V.VersionedTable(spark, os.path.join(out_dir, "card-table"), ["uuid"], n_buckets)


def count_table(spark, out_dir: str, group: str) -> V.VersionedTable:
    return V.VersionedTable(spark, os.path.join(out_dir, f"cards-by-{group}"), [group], 4)


def take_cards(out_dir: str, n_buckets: int = 64) -> Callable:
    """Takes decoded card events: card table with log, then the counts per group follow the log. After a failure
    between the two the counts catch up, as they know the version they hold."""
    def accept(rows: DataFrame, batch_id: int) -> None:
        c = F.col("card")
        cards = rows.select(
            "event_ts", F.col("eventId").alias("event_id"), c.uuid.alias("uuid"), c["name"].alias("name"), c.manaCost.alias("mana_cost"),
            c["type"].alias("type"), c.rarity.alias("rarity"), c.setCode.alias("set_code"),
            F.array_join(F.array_sort(c.colorIdentity), ",").alias("color_identity"))
        table = card_table(rows.sparkSession, out_dir, n_buckets)
        table.upsert(cards, CARD_ORDER, CARD_VALUES, "event_ts", writer="cards", batch_id=batch_id, log=True)
        for group in GROUPS:
            V.count_by_group(table, count_table(rows.sparkSession, out_dir, group), group, log=True)
    return accept


def start_card_tables(messages: DataFrame, out_dir: str, trigger: dict | None = None, checkpoint_root: str | None = None,
                      n_buckets: int = 64) -> StreamingQuery:
    """Card events -> card table (versions, log) and running counts of cards per rarity, type and colour identity."""
    body = decoded_batch(out_dir, "cards", schemas.CARD, "card", take_cards(out_dir, n_buckets))
    return SJ.run_stream(messages, "card_tables", sink=body, trigger=trigger, checkpoint=_checkpoint(messages, checkpoint_root, "card_tables"))


# ---------------------------------------------------------------- prices

def take_prices(out_dir: str, alert_threshold: float = 500.0, n_buckets: int = 64) -> Callable:
    """Takes decoded prices: joined with the card table's version that was the newest when the batch first ran. Its
    number is written down before the join, so a replay joins the same version, whatever was committed since."""
    def accept(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        table = card_table(spark, out_dir, n_buckets)
        version = V.pinned_version(table, V.Files(spark, os.path.join(out_dir, "card-versions-met")), batch_id)
        known = table.read(version) if version else spark.createDataFrame([], "uuid string, name string, rarity string, type string")
        cards = known.select(F.col("uuid").alias("card_uuid"), "name", "rarity", F.col("type").alias("card_type"))
        e = J.enrich_prices(rows.select("data.*"), cards).persist()
        try:
            S.write_enriched_parquet(e.withColumn("batch_id", F.lit(batch_id)).withColumn("card_version", F.lit(version)),
                                     os.path.join(out_dir, "priced"), partition_col="batch_id")
            alerts = e.where(F.col("price") > alert_threshold).select(
                "card_uuid", F.col("name").alias("card_name"), "price", F.col("date").alias("price_date"), C.alert_message("name", "price").alias("alert_message"))
            S.write_batch_json(alerts, os.path.join(out_dir, "alerts"), batch_id)
        finally:
            e.unpersist()
    return accept


def start_price_tables(messages: DataFrame, out_dir: str, trigger: dict | None = None, checkpoint_root: str | None = None,
                       alert_threshold: float = 500.0, n_buckets: int = 64) -> StreamingQuery:
    """Prices -> enriched prices and alerts, against the card table of ``start_card_tables`` in the same folder."""
    body = decoded_batch(out_dir, "prices", schemas.PRICE_ROW, "data", take_prices(out_dir, alert_threshold, n_buckets))
    return SJ.run_stream(messages, "price_tables", sink=body, trigger=trigger, checkpoint=_checkpoint(messages, checkpoint_root, "price_tables"))


def versions_met(spark, out_dir: str, last: int = 100) -> set[int]:
    """Card table versions that the last price batches met: to be held when the card table is swept."""
    pins = V.Files(spark, os.path.join(out_dir, "card-versions-met"))
    batches = sorted(int(n.removesuffix(".json")) for n in pins.names("") if n.endswith(".json") and not n.startswith("."))
    return {json.loads(pins.text(f"{b}.json")) for b in batches[-last:]} - {0}


# ---------------------------------------------------------------- deck values

DECK_VALUES = ["deck_name", "total_cards", "total_value", "calculated_at"]
DECK_BUCKETS = 64


def deck_table(spark, out_dir: str, n_buckets: int = DECK_BUCKETS) -> V.VersionedTable:
    return V.VersionedTable(spark, os.path.join(out_dir, "deck-table"), ["deck_id"], n_buckets)


def deck_totals(spark, out_dir: str) -> V.VersionedTable:
    return V.VersionedTable(spark, os.path.join(out_dir, "deck-totals"), ["bucket", "format"], 1)


def deck_leaders(spark, out_dir: str) -> V.VersionedTable:
    return V.VersionedTable(spark, os.path.join(out_dir, "deck-leaders"), ["bucket", "place"], 1)


def take_deck_values(out_dir: str, k: int = 10, n_buckets: int = DECK_BUCKETS) -> Callable:
    """Takes decoded deck values: the newest value of each deck, then the totals per format and the k leading decks follow
    by the buckets that the batch touched. A failure between the commits is caught up by the next batch or a replay."""
    def accept(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        decks = deck_table(spark, out_dir, n_buckets)
        values = rows.select("event_ts", F.col("eventId").alias("event_id"), "data.*")
        decks.upsert(values, ["calculated_at", "event_ts", "event_id"], DECK_VALUES, "event_ts", writer="deck-values", batch_id=batch_id)
        if decks.manifest().schema:
            DV.follow_totals(decks, deck_totals(spark, out_dir), "total_value", {"format": C.deck_bucket("total_cards")})
            DV.follow_ranking(decks, deck_leaders(spark, out_dir), "total_value", k, show=["deck_name"])
    return accept


def start_portfolio_tables(messages: DataFrame, out_dir: str, trigger: dict | None = None, checkpoint_root: str | None = None,
                           k: int = 10, n_buckets: int = DECK_BUCKETS) -> StreamingQuery:
    """Deck value events -> newest value per deck, portfolio statistics, statistics per format and the leading decks."""
    body = decoded_batch(out_dir, "deck-values", schemas.DECK_VALUE, "data", take_deck_values(out_dir, k, n_buckets))
    return SJ.run_stream(messages, "portfolio_tables", sink=body, trigger=trigger, checkpoint=_checkpoint(messages, checkpoint_root, "portfolio_tables"))


def portfolio(spark, out_dir: str) -> DataFrame:
    """The statistics of ``aggregates.portfolio_stats``, from the partial totals."""
    return DV.merge_totals(deck_totals(spark, out_dir).read()).select(
        F.col("n").alias("total_decks"), F.col("total").alias("combined_value"), F.col("average").alias("average_deck_value"),
        F.col("largest").alias("most_expensive_deck"), F.col("least").alias("cheapest_deck"))


def formats(spark, out_dir: str) -> DataFrame:
    """The statistics of ``aggregates.bucket_stats``, from the partial totals."""
    return DV.merge_totals(deck_totals(spark, out_dir).read(), ["format"]).select(
        "format", F.col("n").alias("deck_count"), F.col("average").alias("avg_value"))


def leading_decks(spark, out_dir: str, k: int = 10) -> DataFrame:
    """The k most valuable decks with rank and label; k as the flow keeps them, or fewer."""
    return DV.ranking(deck_leaders(spark, out_dir).read(), ["deck_id"], "total_value", k)


# ---------------------------------------------------------------- sent again, met within an hour

def start_distinct_facts(messages: DataFrame, out_dir: str, keys: list[str], payload: StructType = schemas.PRICE_ROW, payload_key: str = "data",
                         watermark: str = "1 day", trigger: dict | None = None, checkpoint_root: str | None = None) -> StreamingQuery:
    """Facts without copies that were sent again (same business keys, whatever event id) within the watermark, as Parquet
    in ``distinct-facts``. Messages that do not decode are not facts: ``decoded_batch`` of the flow that uses them counts them."""
    d = E.decode_envelope(messages, payload, payload_key=payload_key).where(F.col("_error").isNull() & F.col("event_ts").isNotNull())
    facts = SJ.dedupe_replays(d.select("event_ts", f"{payload_key}.*"), keys, "event_ts", watermark)
    return SJ.run_stream(facts, "distinct_facts", sink="parquet", path=os.path.join(out_dir, "distinct-facts"), trigger=trigger,
                         checkpoint=_checkpoint(messages, checkpoint_root, "distinct_facts"))


def start_enriched_decks(deck_messages: DataFrame, value_messages: DataFrame, out_dir: str, within: str = "1 hour", watermark: str = "1 hour",
                         trigger: dict | None = None, checkpoint_root: str | None = None) -> StreamingQuery:
    """Decks and their values within an hour of each other's event time (a stream-stream join), as Parquet in ``enriched-decks``."""
    d = E.decode_envelope(deck_messages, schemas.DECK).where(F.col("_error").isNull())
    v = E.decode_envelope(value_messages, schemas.DECK_VALUE).where(F.col("_error").isNull())
    decks = d.select(F.col("event_ts").alias("d_ts"), "data.id", "data.name", "data.unique_cards", "data.total_cards", "data.file_path")
    values = v.select(F.col("event_ts").alias("v_ts"), "data.deck_id", "data.total_value")
    joined = SJ.enriched_decks_stream(decks, values, within, watermark)
    return SJ.run_stream(joined, "enriched_decks", sink="parquet", path=os.path.join(out_dir, "enriched-decks"), trigger=trigger,
                         checkpoint=_checkpoint(deck_messages, checkpoint_root, "enriched_decks"))


# ---------------------------------------------------------------- running aggregates

def running_table(table_path: str, keys: list[str], n_buckets: int = 16) -> Callable:
    """foreachBatch body of an update-mode aggregate: its changed rows go into a versioned table, ordered by batch
    id (not by a clock), each batch once, and its log is the aggregate's EMIT CHANGES."""
    def write(batch: DataFrame, batch_id: int) -> None:
        values = [c for c in batch.columns if c not in keys]
        table = V.VersionedTable(batch.sparkSession, table_path, keys, n_buckets)
        rows = batch.withColumn("_batch", F.lit(batch_id).cast("long")).withColumn("_at", F.current_timestamp())
        table.upsert(rows, ["_batch"], values, "_at", writer="batches", batch_id=batch_id, log=True)
    return write


def start_running_table(aggregate: DataFrame, name: str, out_dir: str, keys: list[str], trigger: dict | None = None,
                        checkpoint_root: str | None = None, n_buckets: int = 16) -> StreamingQuery:
    """A streaming aggregate kept as a versioned table ``<out_dir>/<name>`` with its change log."""
    return SJ.run_stream(aggregate, name, sink=running_table(os.path.join(out_dir, name), keys, n_buckets), mode="update", trigger=trigger,
                         checkpoint=_checkpoint(aggregate, checkpoint_root, name))
