"""End-to-end flows: deck files -> events -> windowed values -> latest -> portfolio;
cards -> card table; prices -> alerts against the current card table."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from cardlake import cli
from cardlake.streaming import apps
from cardlake.streaming import jobs as SJ
from test_deck_directory import FIX

T0 = dt.datetime(2024, 1, 1)


def _ms(t):
    return int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1000)


def test_deck_files_to_portfolio(spark, tmp):
    events = os.path.join(tmp, "events")
    cli.ingest_decks(spark, FIX, out=events)
    # deck-card events carry the ingest time; re-stamp them into one event-time window
    cards = spark.read.json(os.path.join(events, "deck-cards"))
    restamped = cards.select(F.regexp_replace("value", r'"timestamp":"[^"]*"', f'"timestamp":{_ms(T0)}').alias("value"))
    src = os.path.join(tmp, "deck-cards-src")
    restamped.write.json(src)
    # a later event moves the watermark past the first window
    late = json.dumps({"eventType": "deck.card", "eventId": "x", "timestamp": _ms(T0 + dt.timedelta(minutes=5)),
                       "source": "s", "version": "v1",
                       "data": {"deck_id": "other", "deck_name": "Other", "card_name": "c", "quantity": 1}})
    spark.createDataFrame([(late,)], "value string").write.mode("append").json(src)
    out = os.path.join(tmp, "out")
    q = apps.start_deck_value_flow(SJ.file_source(spark, src), out, trigger={"availableNow": True},
                                   checkpoint_root=os.path.join(tmp, "ck"))
    q.processAllAvailable(); q.stop()
    vals = SJ.file_source(spark, os.path.join(out, "deck-values")).withColumn("offset", F.col("value"))
    q = apps.start_portfolio_flow(vals, out, trigger={"availableNow": True}, checkpoint_root=os.path.join(tmp, "ck"))
    q.processAllAvailable(); q.stop()
    p = spark.read.parquet(os.path.join(out, "portfolio")).first()
    # fixture decks: 23 + 25 cards at $5 (the 0-card deck emits no card events)
    assert (p.total_decks, p.combined_value) == (2, 240.0)


def test_card_and_price_flows(spark, tmp):
    def card(u, name, t):
        return json.dumps({"eventType": "card.created", "eventId": u, "timestamp": _ms(t), "source": "s",
                           "version": "v5", "card": {"uuid": u, "name": name, "setCode": "AAA", "rarity": "rare",
                                                     "type": "Artifact", "convertedManaCost": 0.0}})

    def price(u, p):
        return json.dumps({"eventType": "price.updated", "eventId": u, "timestamp": _ms(T0), "source": "s",
                           "version": "v5", "data": {"card_uuid": u, "format": "paper", "source": "ck",
                                                     "type": "retail", "foil": False, "date": "2024-01-01",
                                                     "price": p}})
    csrc, psrc, out = (os.path.join(tmp, x) for x in ("cards", "prices", "out"))
    spark.createDataFrame([(card("u1", "Lotus", T0),), (card("u2", "Mox", T0),)], "value string").write.json(csrc)
    for q in apps.start_card_flow(SJ.file_source(spark, csrc), out, trigger={"availableNow": True},
                                  checkpoint_root=os.path.join(tmp, "ck")):
        q.processAllAvailable(); q.stop()
    spark.createDataFrame([(price("u1", 900.0),), (price("u3", 700.0),), (price("u2", 5.0),)], "value string") \
        .write.json(psrc)
    qs = apps.start_price_flow(SJ.file_source(spark, psrc), os.path.join(out, "cards"), out,
                               trigger={"availableNow": True}, checkpoint_root=os.path.join(tmp, "ck"))
    for q in qs:
        q.processAllAvailable(); q.stop()
    alerts = sorted(r.alert_message for r in spark.read.json(os.path.join(out, "price-alerts")).collect())
    assert alerts == ["ALERT:  is priced at $700.0", "ALERT: Lotus is priced at $900.0"]
    assert spark.read.parquet(os.path.join(out, "expensive-cards")).count() == 2
    # a restart from the checkpoint goes on with the tables
    spark.createDataFrame([(price("u4", 800.0),), (price("u1", 950.0),)], "value string").write.mode("append").json(psrc)
    for q in apps.start_price_flow(SJ.file_source(spark, psrc), os.path.join(out, "cards"), out,
                                   trigger={"availableNow": True}, checkpoint_root=os.path.join(tmp, "ck")):
        q.processAllAvailable(); q.stop()
    expensive = {r.card_uuid for r in spark.read.parquet(os.path.join(out, "expensive-cards")).collect()}
    assert expensive == {"u1", "u3", "u4"}
    assert spark.read.parquet(os.path.join(out, "daily-price-stats")).count() == 1
    assert spark.read.parquet(os.path.join(out, "enriched")).count() == 2


def test_replayed_micro_batch_does_not_duplicate(spark, tmp):
    out, tbl = os.path.join(tmp, "out"), os.path.join(tmp, "cards")
    batch = spark.createDataFrame([("u1", "paper", "ck", "retail", False, "2024-01-01", 900.0)],
                                  "card_uuid string, format string, source string, type string, foil boolean, "
                                  "date string, price double")
    write = apps.price_batch(tbl, out, alert_threshold=500.0)
    write(batch, 7)
    write(batch, 7)          # the same micro-batch again after a failure
    write(batch, 8)
    assert spark.read.parquet(os.path.join(out, "enriched-prices")).count() == 2
    assert spark.read.json(os.path.join(out, "price-alerts")).count() == 2
    cards = SJ.card_sink_batch(os.path.join(tmp, "arch"), os.path.join(tmp, "t"), 4)
    cb = spark.createDataFrame([("u1", "Bolt", None, "Instant", "common", "AAA", T0)],
                               "uuid string, name string, mana_cost string, type string, rarity string, "
                               "set_code string, event_ts timestamp")
    cards(cb, 1)
    cards(cb, 1)
    assert spark.read.parquet(os.path.join(tmp, "arch")).count() == 1
    assert spark.read.parquet(os.path.join(tmp, "t")).count() == 1
