"""Versioned tables, change logs and running tables over ``conversations`` read as a card stream.

Analogue: a conversation is a card, each of its rows one event of that card: event time = turn (seconds),
name = md5 of the whole text, rarity = role, size = length of the text. Events of one time are ordered by rarity and
name. They arrive in ``BATCHES`` batches, batch = turn modulo 3, so batches bring late and out-of-order events.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake import schemas
from cardlake.operators import aggregates as A
from cardlake.operators import derived as DV
from cardlake.operators import versioned as V
from cardlake.plans import register, table
from cardlake.session import checkpoint_path, spread
from cardlake.sources import decks as D
from cardlake.sources import envelopes as E

BATCHES = 3
BUCKETS = 8
ORDER = ["turn", "rarity", "name"]
VALUES = ["name", "rarity", "size"]

SQL_EVENTS = f"""
SELECT conv_id AS uuid, turn, turn % {BATCHES} AS batch, md5(coalesce(text, '')) AS name, role AS rarity,
       CAST(length(coalesce(text, '')) AS BIGINT) AS size, make_timestamp(turn * 1000000) AS seen FROM conversations
"""


def card_events(spark: SparkSession, sf: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("uuid"), "turn", (F.col("turn") % BATCHES).alias("batch"), F.md5(text.cast("binary")).alias("name"),
        F.col("role").alias("rarity"), F.length(text).cast("long").alias("size"), F.timestamp_seconds("turn").cast("timestamp_ntz").alias("seen"))


def _fresh(spark: SparkSession, name: str) -> str:
    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex}")


def card_table(spark: SparkSession, sf: str, log: bool, replay: bool = False) -> V.VersionedTable:
    """The card table after all batches; with ``replay`` each batch is delivered twice."""
    events = card_events(spark, sf)
    cards = V.VersionedTable(spark, _fresh(spark, "cards"), ["uuid"], BUCKETS)
    for batch in range(BATCHES):
        for _ in range(1 + replay):
            cards.upsert(events.where(F.col("batch") == batch), ORDER, VALUES, "seen", writer="cards", batch_id=batch, log=log)
    return cards


@register("versioned_upsert", f"""
WITH e AS ({SQL_EVENTS}), first AS (SELECT uuid, min(batch) AS batch FROM e GROUP BY uuid),
c AS (SELECT uuid, max(seen) AS created_at FROM e JOIN first USING (uuid, batch) GROUP BY uuid)
SELECT uuid, arg_max(name, (turn, rarity, name)) AS name, arg_max(rarity, (turn, rarity, name)) AS rarity,
       arg_max(size, (turn, rarity, name)) AS size, any_value(created_at) AS created_at, max(seen) AS updated_at
FROM e JOIN c USING (uuid) GROUP BY uuid
""")
def versioned_upsert(spark, sf):
    """The card table through atomic commits of out-of-order batches, each delivered twice."""
    return card_table(spark, sf, log=False, replay=True).read()


@register("upsert_change_log", f"""
WITH e AS ({SQL_EVENTS}),
n AS (SELECT x.uuid, b.range AS batch, arg_max(name, (turn, rarity, name)) AS name, arg_max(rarity, (turn, rarity, name)) AS rarity,
             arg_max(size, (turn, rarity, name)) AS size FROM e x JOIN range({BATCHES}) b ON x.batch <= b.range GROUP BY ALL),
l AS (SELECT *, lag(name) OVER w AS before_name, lag(rarity) OVER w AS before_rarity, lag(size) OVER w AS before_size, lag(batch) OVER w AS prior
      FROM n WINDOW w AS (PARTITION BY uuid ORDER BY batch))
SELECT uuid, row_number() OVER (PARTITION BY uuid ORDER BY batch) AS seq, batch + 1 AS version, before_name, before_rarity, before_size,
       name AS after_name, rarity AS after_rarity, size AS after_size FROM l
WHERE prior IS NULL OR (name, rarity, size) IS DISTINCT FROM (before_name, before_rarity, before_size)
""")
def upsert_change_log(spark, sf):
    """Every change of the card table: number per card, version, and the images before and after."""
    log = card_table(spark, sf, log=True).changes()
    return log.select("uuid", "seq", "version", *[F.col(side)[c].alias(f"{side}_{c}") for side in ("before", "after") for c in VALUES])


@register("running_change_log", f"""
WITH e AS ({SQL_EVENTS}),
p AS (SELECT uuid, batch, count(*) AS events, max(size) AS largest, min(size) AS smallest FROM e GROUP BY uuid, batch),
r AS (SELECT uuid, batch, CAST(sum(events) OVER w AS BIGINT) AS events, max(largest) OVER w AS largest, min(smallest) OVER w AS smallest
      FROM p WINDOW w AS (PARTITION BY uuid ORDER BY batch ROWS UNBOUNDED PRECEDING))
SELECT uuid, row_number() OVER w AS seq, batch, lag(events) OVER w AS before_events, lag(largest) OVER w AS before_largest,
       lag(smallest) OVER w AS before_smallest, events AS after_events, largest AS after_largest, smallest AS after_smallest
FROM r WINDOW w AS (PARTITION BY uuid ORDER BY batch)
""")
def running_change_log(spark, sf):
    """EMIT CHANGES of the running count, largest and smallest event per card, in its batch form."""
    log = A.running_changes(card_events(spark, sf), ["uuid"], "batch", {
        "events": ("sum", F.lit(1)), "largest": ("max", F.col("size")), "smallest": ("min", F.col("size"))})
    return log.select("uuid", "seq", "batch", *[F.col(side)[c].alias(f"{side}_{c}") for side in ("before", "after") for c in ("events", "largest", "smallest")])


@register("retracted_counts", f"""
WITH e AS ({SQL_EVENTS}), l AS (SELECT uuid, arg_max(rarity, (turn, rarity, name)) AS rarity, arg_max(size, (turn, rarity, name)) AS size FROM e GROUP BY uuid)
SELECT 'rarity' AS grouped_by, rarity AS "group", count(*) AS cards FROM l GROUP BY rarity
UNION ALL SELECT 'size', CAST(size AS VARCHAR), count(*) FROM l GROUP BY size
""")
def retracted_counts(spark, sf):
    """Cards per rarity and per size, kept by retraction: a card that is sent again leaves its old group."""
    events = card_events(spark, sf)
    cards = V.VersionedTable(spark, _fresh(spark, "cards"), ["uuid"], BUCKETS)
    counts = {c: V.VersionedTable(spark, _fresh(spark, f"counts-{c}"), [c], BUCKETS) for c in ("rarity", "size")}
    for batch in range(BATCHES):
        cards.upsert(events.where(F.col("batch") == batch), ORDER, VALUES, "seen", writer="cards", batch_id=batch, log=True)
        for group, table_ in counts.items():
            V.count_by_group(cards, table_, group)
    rows = [t.read().select(F.lit(c).alias("grouped_by"), F.col(c).cast("string").alias("group"), F.col("n").alias("cards")) for c, t in counts.items()]
    return rows[0].unionByName(rows[1])


@register("prices_at_arrival", f"""
WITH e AS ({SQL_EVENTS}),
v AS (SELECT x.uuid, b.range AS batch, arg_max(name, (turn, rarity, name)) AS name, arg_max(rarity, (turn, rarity, name)) AS rarity
      FROM e x JOIN range({BATCHES}) b ON x.batch <= b.range GROUP BY ALL)
SELECT e.uuid, e.turn, e.name AS event, v.name, v.rarity FROM e LEFT JOIN v ON v.uuid = e.uuid AND v.batch = e.batch
""")
def prices_at_arrival(spark, sf):
    """Each event joined with the card's image in the version that held when the event arrived, whatever came later."""
    versions = V.history(card_table(spark, sf, log=True).changes(), ["uuid"], ["name", "rarity"])
    # batch b made version b + 1
    facts = card_events(spark, sf).select(F.col("uuid").alias("card"), "turn", F.col("name").alias("event"), (F.col("batch") + 1).alias("met"))
    joined = V.join_at_arrival(facts, versions, "card", "uuid", "met")
    return joined.select(F.col("card").alias("uuid"), "turn", "event", "name", "rarity")


@register("published_decks", """
WITH l AS (SELECT '/decks/' || conv_id || '.deck' AS file_path, turn + 1 AS quantity, md5(coalesce(text, '')) AS name FROM conversations),
d AS (SELECT file_path, md5(file_path) AS h, CAST(sum(quantity) AS BIGINT) AS total, count(*) AS lines,
             string_agg('{"quantity":' || quantity || ',"name":"' || name || '"}', ',' ORDER BY name, quantity) AS cards FROM l GROUP BY file_path)
SELECT 'eventType=deck.ingested;source=deck-ingester' AS headers, file_path,
       '{"eventType":"deck.ingested","eventId":"' || h || '","timestamp":"2024-01-01T00:00:00.000000Z","source":"deck-ingester","version":"v1","data":{"id":"'
       || h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] || '","name":"' || regexp_extract(file_path, '([0-9]+)', 1) || '","file_path":"' || file_path
       || '","total_cards":' || total || ',"unique_cards":' || lines || ',"ingested_at":"2024-01-01 00:00:00","cards":[' || cards || ']}}' AS value
FROM d
""")
def published_decks(spark, sf):
    """Deck events as published, with headers and the cards of the deck: a conversation is a deck file, each row a line of it."""
    rows = spread(table(spark, sf, "conversations"))
    lines = rows.select(F.concat(F.lit("/decks/"), F.col("conv_id").cast("string"), F.lit(".deck")).alias("file_path"),
                        F.concat((F.col("turn") + 1).cast("string"), F.lit(" "), F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("line"))
    graded = D.parse_deck_lines(lines, keep_rejects=True)
    decks = D.with_cards(D.summarise_decks(graded), graded).withColumn("ingested_at", F.lit("2024-01-01 00:00:00"))
    events = E.build_envelope(decks, schemas.EVENT_DECK, schemas.SOURCE_DECKS, schemas.VERSION_DECKS,
                              payload=["id", "name", "file_path", "total_cards", "unique_cards", "ingested_at", "cards"],
                              event_id=F.md5("file_path"), timestamp=F.lit("2024-01-01 00:00:00").cast("timestamp"), headers=True, key=F.col("file_path"))
    shown = F.array_join(F.transform("headers", lambda h: F.concat_ws("=", h["key"], h["value"].cast("string"))), ";")
    return events.select(shown.alias("headers"), F.col("key").alias("file_path"), "value")


SQL_NEWEST = f"""
SELECT uuid, arg_max(rarity, (turn, rarity, name)) AS rarity, arg_max(size, (turn, rarity, name)) AS size FROM ({SQL_EVENTS}) e GROUP BY uuid
"""


@register("totals_by_buckets", f"""
SELECT rarity, COUNT(*) AS n, CAST(SUM(CAST(size AS DECIMAL(18,2))) AS DOUBLE) AS total,
       CAST(SUM(CAST(size AS DECIMAL(18,2))) AS DOUBLE) / COUNT(size) AS average, MIN(size) AS least, MAX(size) AS largest
FROM ({SQL_NEWEST}) c GROUP BY rarity
""")
def totals_by_buckets(spark, sf):
    """Totals per rarity of the card table, brought up to date after each batch by the buckets that it touched."""
    return DV.merge_totals(_followed(spark, sf, "totals", ["bucket", "rarity"], lambda cards, totals: DV.follow_totals(cards, totals, "size", {"rarity": F.col("rarity")})), ["rarity"])


@register("ranking_by_buckets", f"""
SELECT uuid, size, rarity, row_number() OVER (ORDER BY size DESC, uuid) AS rank, '#' || row_number() OVER (ORDER BY size DESC, uuid) AS label
FROM ({SQL_NEWEST}) c WHERE size IS NOT NULL ORDER BY size DESC, uuid LIMIT 25
""")
def ranking_by_buckets(spark, sf, k: int = 25):
    """The k cards of largest size, from the leaders of each bucket kept after each batch."""
    leaders = _followed(spark, sf, "leaders", ["bucket", "place"], lambda cards, kept: DV.follow_ranking(cards, kept, "size", k, show=["rarity"]))
    return DV.ranking(leaders, ["uuid"], "size", k)


def _followed(spark: SparkSession, sf: str, name: str, keys: list[str], follow) -> DataFrame:
    events = card_events(spark, sf)
    cards = V.VersionedTable(spark, _fresh(spark, "cards"), ["uuid"], BUCKETS)
    derived = V.VersionedTable(spark, _fresh(spark, name), keys, BUCKETS)
    for batch in range(BATCHES):
        cards.upsert(events.where(F.col("batch") == batch), ORDER, VALUES, "seen", writer="cards", batch_id=batch)
        follow(cards, derived)
    return derived.read()
