"""Event-stream queries over ``events`` (event_id = topic offset, user_id = key).

Envelope analogue: each event is published as
{"eventType": <event_type>, "eventId": "<event_id>", "timestamp": <ts>, "source": "events",
 "version": "v1", "data": <props>}
where ts is epoch millis, except 'signup' events, which carry RFC-3339 text. In
``events_as_messages`` 'error' events are cut short (malformed JSON);
``events_as_whole_messages`` cuts none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cardlake.functions import columns as C
from cardlake.operators import aggregates as A
from cardlake.operators import joins as J
from cardlake.plans import register, table
from cardlake.session import spread
from cardlake.sources import envelopes as E

PROPS = StructType([StructField("k", LongType())])


def events_as_whole_messages(ev: DataFrame) -> DataFrame:
    ts_text = F.concat(F.lit('"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit('Z"'))
    ts_val = F.when(F.col("event_type") == "signup", ts_text).otherwise(
        F.unix_millis(F.col("ts").cast("timestamp")).cast("string"))
    full = F.concat(F.lit('{"eventType":"'), F.col("event_type"), F.lit('","eventId":"'),
                    F.col("event_id").cast("string"), F.lit('","timestamp":'), ts_val,
                    F.lit(',"source":"events","version":"v1","data":'), F.col("props"), F.lit("}"))
    return ev.select(F.col("event_id").alias("offset"), full.alias("value"), "event_type")


def _cut(value):
    return F.substring(value, 1, 30)


def events_as_messages(ev: DataFrame) -> DataFrame:
    value = F.when(F.col("event_type") == "error", _cut("value")).otherwise(F.col("value"))
    return events_as_whole_messages(ev).select("offset", value.alias("value"))


def _events(spark, sf):
    return table(spark, sf, "events")


@register("envelope_decode", """
SELECT event_id AS "offset",
       CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS eventType,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id AS VARCHAR) END AS eventId,
       CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' THEN ts
            ELSE make_timestamp(epoch_us(ts) // 1000 * 1000) END AS event_ts,
       CASE WHEN event_type = 'error' THEN NULL ELSE 'events' END AS source,
       CAST(json_extract(props, '$.k') AS BIGINT) * CASE WHEN event_type = 'error' THEN NULL ELSE 1 END AS k,
       CASE WHEN event_type = 'error' THEN 'malformed' END AS _error
FROM events
""")
def envelope_decode(spark, sf):
    return _decoded(events_as_messages(spread(_events(spark, sf))))  # JSON parse per message: use every core


def _decoded(msgs: DataFrame) -> DataFrame:
    d = E.decode_envelope(msgs, PROPS, keep=("offset",))
    return d.select("offset", "eventType", "eventId", F.col("event_ts").cast("timestamp_ntz").alias("event_ts"),
                    "source", F.col("data.k").alias("k"), "_error")


CUT_OFFSET = 2_000_000_000_000  # the cut copies of the error messages come under new offsets


@register("envelope_decode_whole", """
SELECT event_id AS "offset", event_type AS eventType, CAST(event_id AS VARCHAR) AS eventId,
       CASE WHEN event_type = 'signup' THEN ts ELSE make_timestamp(epoch_us(ts) // 1000 * 1000) END AS event_ts,
       'events' AS source, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS _error
FROM events
UNION ALL
SELECT event_id + 2000000000000, NULL, NULL, NULL, NULL, NULL, 'malformed' FROM events WHERE event_type = 'error'
""")
def envelope_decode_whole(spark, sf):
    """Every message decoded whole; the malformed ones are rows of their own beside them."""
    msgs = events_as_whole_messages(spread(_events(spark, sf)))
    cut = msgs.where(F.col("event_type") == "error").select(
        (F.col("offset") + F.lit(CUT_OFFSET)).alias("offset"), _cut("value").alias("value"))
    return _decoded(msgs.select("offset", "value").unionByName(cut))


@register("topic_preview", """
SELECT event_id AS "offset", event_type, user_id, ts, value FROM events ORDER BY event_id LIMIT 10
""")
def topic_preview(spark, sf, n: int = 10):
    """First n messages of the topic from the beginning."""
    return _events(spark, sf).orderBy("event_id").limit(n).select(
        F.col("event_id").alias("offset"), "event_type", "user_id", "ts", "value")


def _with_nulls(ev: DataFrame) -> DataFrame:
    """Producers omit fields: error events carry no value, view events no props."""
    return ev.select("user_id", "ts", "event_id", "event_type",
                     F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
                     F.when(F.col("event_type") != "view", F.col("props")).alias("props"))


@register("latest_by_offset", """
WITH e AS (SELECT user_id, ts, event_id, event_type,
                  CASE WHEN event_type <> 'error' THEN value END AS value,
                  CASE WHEN event_type <> 'view' THEN props END AS props FROM events)
SELECT user_id,
       arg_max(event_type, (ts, event_id)) FILTER (WHERE event_type IS NOT NULL) AS event_type,
       arg_max(value, (ts, event_id)) FILTER (WHERE value IS NOT NULL) AS value,
       arg_max(props, (ts, event_id)) FILTER (WHERE props IS NOT NULL) AS props,
       max(event_id) AS last_offset
FROM e GROUP BY user_id
""")
def latest_by_offset(spark, sf):
    e = _with_nulls(_events(spark, sf))
    out = A.latest_by(e, ["user_id"], ["ts", "event_id"], ["event_type", "value", "props"], last_order_name="_last")
    return out.select("user_id", "event_type", "value", "props", F.col("_last.event_id").alias("last_offset"))


REPLAY_OFFSET = 1_000_000_000_000  # the daily replay re-sends every event under a new id


@register("dedupe_business_key", """
WITH r AS (SELECT * FROM events UNION ALL SELECT event_id + 1000000000000, ts, user_id, event_type, value, props FROM events)
SELECT user_id, ts, event_type, value, MIN(event_id) AS event_id, COUNT(*) AS copies
FROM r GROUP BY user_id, ts, event_type, value
""")
def dedupe_business_key(spark, sf):
    """Replays re-send the same facts with new event ids: dedupe on the business key."""
    ev = _events(spark, sf)
    replay = ev.withColumn("event_id", F.col("event_id") + F.lit(REPLAY_OFFSET))
    both = ev.unionByName(replay)
    return both.groupBy("user_id", "ts", "event_type", "value").agg(
        F.min("event_id").alias("event_id"), F.count(F.lit(1)).alias("copies"))


def events_as_cards(ev: DataFrame) -> DataFrame:
    """Card stream analogue: set = event type, rarity by value, cmc = user_id % 8."""
    v = F.col("value")
    rarity = (F.when(v > 400, "mythic").when(v > 200, "rare").when(v > 100, "uncommon").otherwise("common"))
    return ev.select(F.col("ts").cast("timestamp").alias("ts"), "event_id", F.col("event_type").alias("set_code"),
                     rarity.alias("rarity"), (F.col("user_id") % 8).alias("cmc"))


@register("set_statistics", """
SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start,
       time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS window_end,
       event_type AS set_code, COUNT(*) AS total_cards,
       COUNT(*) FILTER (WHERE value > 400) AS mythic_count,
       COUNT(*) FILTER (WHERE value > 200 AND value <= 400) AS rare_count,
       COUNT(*) FILTER (WHERE value > 100 AND value <= 200) AS uncommon_count,
       COUNT(*) FILTER (WHERE value <= 100) AS common_count,
       AVG(user_id % 8) AS avg_converted_mana_cost
FROM events GROUP BY 1, 2, 3
""")
def set_statistics(spark, sf):
    s = A.set_statistics(events_as_cards(_events(spark, sf)), "set_code", "rarity", "cmc", ts_col="ts",
                         window="5 minutes")
    return s.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")) \
        .withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


def events_as_deck_cards(ev: DataFrame) -> DataFrame:
    """Deck-card event analogue: deck = user, card = event type, quantity = props.k."""
    return ev.select(F.col("ts").cast("timestamp").alias("ts"), "event_id",
                     F.concat(F.lit("deck-"), F.col("user_id").cast("string")).alias("deck_id"),
                     F.concat(F.lit("Deck "), F.col("user_id").cast("string")).alias("deck_name"),
                     F.col("event_type").alias("card_name"),
                     F.from_json("props", PROPS)["k"].alias("quantity"))


@register("tumbling_deck_reduce", """
SELECT time_bucket(INTERVAL '10 seconds', ts) AS window_start,
       time_bucket(INTERVAL '10 seconds', ts) + INTERVAL '10 seconds' AS window_end,
       'deck-' || user_id AS deck_id, arg_min('Deck ' || user_id, (ts, event_id)) AS deck_name,
       SUM(CAST(json_extract(props, '$.k') AS BIGINT)) AS total_cards, COUNT(*) AS card_events,
       SUM(CAST(json_extract(props, '$.k') AS BIGINT)) * 5.0 AS total_value
FROM events GROUP BY 1, 2, 3
""")
def tumbling_deck_reduce(spark, sf):
    r = A.tumbling_reduce(events_as_deck_cards(_events(spark, sf)), "ts", "deck_id", "quantity", "deck_name",
                          size="10 seconds", tiebreak="event_id")
    return r.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")) \
        .withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


@register("epoch_ms_format", """
SELECT event_id, epoch_us(ts) // 1000 AS calculated_at,
       strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%d %H:%M:%S') AS calculated_time
FROM events
""")
def epoch_ms_format(spark, sf):
    ev = _events(spark, sf).select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("calculated_at"))
    return ev.withColumn("calculated_time", C.epoch_ms_text("calculated_at"))


@register("enriched_prices_asof", """
SELECT f.event_id, f.user_id, f.ts, f.value,
       v.event_id AS version_event_id, v.event_type AS version_type, v.value AS version_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') f
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type IN ('view', 'click')) v
  ON f.user_id = v.user_id AND f.ts >= v.ts
""")
def enriched_prices_asof(spark, sf):
    """Version at arrival in event time: each purchase (price) sees the newest
    view/click (card version) of the same key at or before its time."""
    ev = _events(spark, sf)
    facts = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    versions = ev.where(F.col("event_type").isin("view", "click")).select(
        "user_id", "ts", F.col("event_id").alias("version_event_id"),
        F.col("event_type").alias("version_type"), F.col("value").alias("version_value"))
    return J.asof_join(facts, versions, "user_id", "ts", "ts",
                       ["version_event_id", "version_type", "version_value"],
                       version_tiebreak="version_event_id", bucket="1 day")


@register("interval_join_within", """
SELECT o.o_orderkey, o.o_orderdate, l.l_linenumber, l.l_shipdate, l.l_quantity
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
 AND l.l_shipdate BETWEEN o.o_orderdate - INTERVAL 30 DAY AND o.o_orderdate + INTERVAL 30 DAY
""")
def interval_join_within(spark, sf):
    """Decks x deck values within a time band (here orders x line items within 30 days)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    j = J.interval_join(o, li, "o_orderkey", "l_orderkey", "o_orderdate", "l_shipdate", within="30 days")
    return j.select("o_orderkey", "o_orderdate", "l_linenumber", "l_shipdate", "l_quantity")


@register("topic_counters", """
SELECT 'cards' AS topic, COUNT(*) AS messages, NULL::DOUBLE AS avg_price, arg_max(p_name, p_partkey) AS latest_key FROM part
UNION ALL
SELECT 'prices', COUNT(*), CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(l_extendedprice),
       CAST(arg_max(l_partkey, (l_shipdate, l_orderkey, l_linenumber, l_extendedprice, l_partkey)) AS VARCHAR) FROM lineitem
UNION ALL
SELECT 'decks', COUNT(*), CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_totalprice),
       CAST(arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS VARCHAR) FROM orders
UNION ALL
SELECT 'events', COUNT(*), CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(value),
       arg_max(event_type, (ts, event_id)) FROM events
""")
def topic_counters(spark, sf):
    """Dashboard counters: messages per topic, average price, newest key."""
    part, li, o, ev = (table(spark, sf, n) for n in ("part", "lineitem", "orders", "events"))

    def one(df, topic, price, latest, order):
        return df.agg(F.lit(topic).alias("topic"), F.count(F.lit(1)).alias("messages"),
                      (A.money_avg(price) if price else F.lit(None).cast("double")).alias("avg_price"),
                      F.max_by(F.col(latest).cast("string"), F.struct(*order)).alias("latest_key"))

    return (one(part, "cards", None, "p_name", ["p_partkey"])
            .unionByName(one(li, "prices", "l_extendedprice", "l_partkey",
                             ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey"]))
            .unionByName(one(o, "decks", "o_totalprice", "o_orderkey", ["o_orderdate", "o_orderkey"]))
            .unionByName(one(ev, "events", "value", "event_type", ["ts", "event_id"])))


@register("rarity_distribution_latest", """
WITH l AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id),
e AS (SELECT event_type, COUNT(*) AS events FROM events GROUP BY event_type),
c AS (SELECT event_type, COUNT(*) AS cards FROM l GROUP BY event_type)
SELECT e.event_type, e.events, COALESCE(c.cards, 0) AS cards FROM e LEFT JOIN c ON e.event_type = c.event_type
""")
def rarity_distribution_latest(spark, sf):
    """A card stream re-sends cards: count per category both per event and per card
    (each card's newest event), here with users as cards and event types as categories."""
    ev = _events(spark, sf)
    per_event = A.distribution(ev, "event_type", count_name="events")
    per_card = A.distribution(ev, "event_type", count_name="cards", latest_per=(["user_id"], ["ts", "event_id"]))
    return per_event.join(per_card, "event_type", "left").select(
        "event_type", "events", F.coalesce("cards", F.lit(0)).alias("cards"))


# Whole siblings of queries whose SQL blanks values or leaves rows out

@register("latest_by_offset_whole", """
SELECT user_id, arg_max(event_type, (ts, event_id)) FILTER (WHERE event_type IS NOT NULL) AS event_type,
       arg_max(value, (ts, event_id)) FILTER (WHERE value IS NOT NULL) AS value,
       arg_max(props, (ts, event_id)) FILTER (WHERE props IS NOT NULL) AS props, arg_max(event_id, (ts, event_id)) AS last_offset
FROM events GROUP BY user_id
""")
def latest_by_offset_whole(spark, sf):
    """Newest value per user and column over the events as they are."""
    out = A.latest_by(_events(spark, sf), ["user_id"], ["ts", "event_id"], ["event_type", "value", "props"], last_order_name="_last")
    return out.select("user_id", "event_type", "value", "props", F.col("_last.event_id").alias("last_offset"))


@register("enriched_prices_asof_whole", """
WITH v AS (SELECT user_id, ts, max(event_id) AS event_id FROM events GROUP BY user_id, ts)
SELECT f.event_id, f.user_id, f.ts, f.value, e.event_id AS version_event_id, e.event_type AS version_type, e.value AS version_value
FROM events f ASOF LEFT JOIN (SELECT user_id, ts + INTERVAL 1 MICROSECOND AS ts, event_id FROM v) v ON f.user_id = v.user_id AND f.ts >= v.ts
LEFT JOIN events e ON e.event_id = v.event_id
""")
def enriched_prices_asof_whole(spark, sf):
    """Every event sees the newest earlier event of its user, whatever their types: of one instant the last by id."""
    ev = _events(spark, sf)
    versions = ev.select("user_id", (F.col("ts") + F.expr("INTERVAL '0.000001' SECOND")).alias("known"), F.col("event_id").alias("version_event_id"),
                         F.col("event_type").alias("version_type"), F.col("value").alias("version_value"))
    return J.asof_join_pieces(ev.select("event_id", "user_id", "ts", "value"), versions, "user_id", "ts", "known",
                              ["version_event_id", "version_type", "version_value"], version_tiebreak="version_event_id")
