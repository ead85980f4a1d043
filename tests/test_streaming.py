"""Streaming jobs over file sources: stream = batch, watermarks, joins, upsert, restart."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from cardlake import schemas
from cardlake.operators import aggregates as A
from cardlake.sources import envelopes as E
from cardlake.streaming import jobs as SJ

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _ms(t):
    return int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1000)


def _land(spark, folder, messages):
    """Append (key, value) messages as one new JSON-lines file in ``folder``."""
    rows = [(None, json.dumps(m) if not isinstance(m, str) else m) for m in messages]
    spark.createDataFrame(rows, "key string, value string").coalesce(1).write.mode("append").json(folder)


def _deck_card(deck, name, qty, t):
    return {"eventType": "deck.card", "eventId": f"{deck}-{name}-{_ms(t)}", "timestamp": _ms(t),
            "source": "deck-ingester", "version": "v1",
            "data": {"deck_id": deck, "deck_name": deck.title(), "card_name": name, "quantity": qty}}


def _drain(q):
    q.processAllAvailable()
    q.stop()


def test_deck_values_stream_equals_batch(spark, tmp):
    src = os.path.join(tmp, "deck-cards")
    msgs = [_deck_card(f"d{i % 3}", f"c{i}", 1 + i % 4, T0 + dt.timedelta(seconds=3 * i)) for i in range(40)]
    msgs.append("{broken")
    _land(spark, src, msgs)
    stream = SJ.deck_values_stream(SJ.file_source(spark, src))
    _drain(SJ.run_stream(stream, "deck_values_eq", mode="update", trigger={"availableNow": True},
                         checkpoint=os.path.join(tmp, "ck1")))
    got = sorted(tuple(r) for r in spark.sql("SELECT deck_id, window_start, total_cards, total_value FROM deck_values_eq")
                 .collect())
    batch_in = E.decode_envelope(spark.read.schema(SJ.VALUE_SCHEMA).json(src), schemas.DECK_CARD) \
        .where(F.col("_error").isNull()).select("event_ts", "data.*")
    want = sorted(tuple(r) for r in A.tumbling_reduce(batch_in, "event_ts", "deck_id", "quantity", "deck_name")
                  .select("deck_id", "window_start", "total_cards", "total_value").collect())
    assert got == want and len(got) > 0


def test_late_rows_are_dropped_after_watermark(spark, tmp):
    src = os.path.join(tmp, "late")
    _land(spark, src, [_deck_card("d", "a", 1, T0), _deck_card("d", "b", 1, T0 + dt.timedelta(seconds=60))])
    stream = SJ.deck_values_stream(SJ.file_source(spark, src), watermark="5 seconds")
    q = SJ.run_stream(stream, "late_vals", mode="append", checkpoint=os.path.join(tmp, "ck2"))
    q.processAllAvailable()
    # a row 55 s behind the watermark for an already closed window, then one that moves time on
    _land(spark, src, [_deck_card("d", "late", 5, T0 + dt.timedelta(seconds=2)),
                       _deck_card("d", "c", 1, T0 + dt.timedelta(seconds=120))])
    q.processAllAvailable()
    _land(spark, src, [_deck_card("d", "e", 1, T0 + dt.timedelta(seconds=300))])
    _drain(q)
    rows = {r.window_start: r.total_cards for r in spark.sql("SELECT * FROM late_vals").collect()}
    assert rows[T0] == 1                      # the late row did not change the closed window
    assert rows[T0 + dt.timedelta(seconds=60)] == 1


def test_interval_join_stream(spark, tmp):
    dsrc, vsrc = os.path.join(tmp, "decks"), os.path.join(tmp, "values")
    decks = spark.createDataFrame([("d1", "Deck One", 80, 100, "/x/d1.deck", T0)],
                                  "id string, name string, unique_cards int, total_cards int, file_path string, d_ts timestamp")
    decks.write.parquet(dsrc)
    offs = [-90, -30, 30, 59, 61]
    vals = spark.createDataFrame([("d1", 5.0 * m, T0 + dt.timedelta(minutes=m)) for m in offs],
                                 "deck_id string, total_value double, v_ts timestamp")
    vals.write.parquet(vsrc)
    d = SJ.file_source(spark, dsrc, decks.schema, fmt="parquet")
    v = SJ.file_source(spark, vsrc, vals.schema, fmt="parquet")
    _drain(SJ.run_stream(SJ.enriched_decks_stream(d, v), "enriched_decks", trigger={"availableNow": True},
                         checkpoint=os.path.join(tmp, "ck3")))
    got = sorted(r.total_value / 5.0 for r in spark.sql("SELECT * FROM enriched_decks").collect())
    assert got == [-30, 30, 59]


def test_price_alerts_stream_static_join(spark, tmp):
    src = os.path.join(tmp, "prices")
    cards = spark.createDataFrame([("u1", "Lotus")], "card_uuid string, name string")

    def price(u, p):
        return {"eventType": "price.updated", "eventId": u, "timestamp": "2024-01-01T00:00:00Z", "source": "s",
                "version": "v5", "data": {"card_uuid": u, "format": "paper", "source": "ck", "type": "retail",
                                          "foil": False, "date": "2024-01-01", "price": p}}
    _land(spark, src, [price("u1", 900.0), price("u2", 800.0), price("u1", 10.0)])
    _drain(SJ.run_stream(SJ.price_alerts_stream(SJ.file_source(spark, src), cards), "alerts",
                         trigger={"availableNow": True}, checkpoint=os.path.join(tmp, "ck4")))
    msgs = sorted(r.alert_message for r in spark.sql("SELECT * FROM alerts").collect())
    assert msgs == ["ALERT:  is priced at $800.0", "ALERT: Lotus is priced at $900.0"]


def _value(deck, total, t, n=100):
    return {"eventType": "deck.value.calculated", "eventId": f"{deck}{_ms(t)}", "timestamp": _ms(t),
            "source": schemas.SOURCE_DECK_VALUES, "version": "v1",
            "data": {"deck_id": deck, "deck_name": deck, "total_cards": n, "total_value": total,
                     "calculated_at": _ms(t)}}


def test_two_level_aggregate_and_restart(spark, tmp):
    src = os.path.join(tmp, "vals")
    table, stats = os.path.join(tmp, "latest"), os.path.join(tmp, "stats")
    ck = os.path.join(tmp, "ck5")
    _land(spark, src, [_value("a", 100.0, T0), _value("b", 50.0, T0), _value("a", 300.0, T0 + dt.timedelta(minutes=1))])
    msgs = SJ.file_source(spark, src).withColumn("offset", F.col("value"))

    def run():
        _drain(SJ.run_stream(SJ.latest_table_stream(msgs), "portfolio", sink=SJ.portfolio_batch(table, stats, 4),
                             mode="update", trigger={"availableNow": True}, checkpoint=ck))

    run()
    s = spark.read.parquet(stats).first()
    assert (s.total_decks, s.combined_value, s.most_expensive_deck) == (2, 350.0, 300.0)
    # restart from the checkpoint with one more file: only the new data is processed
    _land(spark, src, [_value("b", 75.0, T0 + dt.timedelta(minutes=2)), _value("c", 10.0, T0)])
    run()
    s = spark.read.parquet(stats).first()
    assert (s.total_decks, s.combined_value, s.cheapest_deck) == (3, 385.0, 10.0)
    latest = {r.deck_id: r.total_value for r in spark.read.parquet(table).collect()}
    assert latest == {"a": 300.0, "b": 75.0, "c": 10.0}


def test_dedupe_replays_on_business_key(spark, tmp):
    src = os.path.join(tmp, "replays")
    rows = [("u1", "2024-01-01", 1.0, T0, "e1"), ("u1", "2024-01-01", 1.0, T0, "e9"),   # replay, new id
            ("u2", "2024-01-01", 2.0, T0, "e2")]
    spark.createDataFrame(rows, "card_uuid string, date string, price double, ts timestamp, event_id string") \
        .write.parquet(src)
    schema = spark.read.parquet(src).schema
    s = SJ.dedupe_replays(SJ.file_source(spark, src, schema, fmt="parquet"), ["card_uuid", "date"], "ts")
    _drain(SJ.run_stream(s, "dedup", trigger={"availableNow": True}, checkpoint=os.path.join(tmp, "ck6")))
    assert sorted(r.card_uuid for r in spark.sql("SELECT * FROM dedup").collect()) == ["u1", "u2"]


def test_card_flow_sinks(spark, tmp):
    src = os.path.join(tmp, "cards")

    def card(u, name, rarity, t, colors=None):
        c = {"uuid": u, "name": name, "setCode": "AAA", "rarity": rarity, "convertedManaCost": 3.0, "type": "Instant"}
        if colors:
            c["colors"] = colors
        return {"eventType": "card.created", "eventId": u + name, "timestamp": _ms(t), "source": "mtgjson",
                "version": "v5", "card": c}
    _land(spark, src, [card("u1", "Bolt", "common", T0, ["R"]), card("u1", "Bolt v2", "rare", T0 + dt.timedelta(seconds=5)),
                       card("u2", "Wrath", "mythic", T0, ["W", "U"])])
    enriched = SJ.enriched_cards_stream(SJ.file_source(spark, src))
    pq, tbl = os.path.join(tmp, "pq"), os.path.join(tmp, "tbl")
    _drain(SJ.run_stream(enriched, "cards_sink", sink=SJ.card_sink_batch(pq, tbl, 4), trigger={"availableNow": True},
                         checkpoint=os.path.join(tmp, "ck7")))
    assert spark.read.parquet(pq).count() == 3
    t = {r.uuid: (r.name, r.rarity) for r in spark.read.parquet(tbl).collect()}
    assert t == {"u1": ("Bolt v2", "rare"), "u2": ("Wrath", "mythic")}
    stats_q = SJ.run_stream(SJ.set_statistics_stream(SJ.decode_cards(SJ.file_source(spark, src))), "set_stats",
                            mode="update", trigger={"availableNow": True}, checkpoint=os.path.join(tmp, "ck8"))
    _drain(stats_q)
    r = spark.sql("SELECT * FROM set_stats").collect()
    assert [(x.set_code, x.total_cards, x.rare_count, x.mythic_count) for x in r] == [("AAA", 3, 1, 1)]


def test_kafka_source_needs_the_connector(spark):
    import pytest
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        SJ.kafka_source(spark, "localhost:9", "cards")
