"""Flows of deck values, distinct facts and enriched decks: restarts, falling values, copies, the bounds of an interval."""

from __future__ import annotations

import datetime as dt
import json
import os
import random

from pyspark.sql import functions as F

from cardlake.operators import aggregates as A
from cardlake.streaming import jobs as SJ
from cardlake.streaming import tables as T

T0 = int((dt.datetime(2024, 1, 1) - dt.datetime(1970, 1, 1)).total_seconds())
NOW = {"availableNow": True}


def message(data, event, seconds=0, kind="deck.value.calculated"):
    return json.dumps({"eventType": kind, "eventId": event, "timestamp": 1000 * (T0 + seconds), "source": "s", "version": "v1", "data": data})


def land(spark, folder, messages):
    spark.createDataFrame([(m,) for m in messages], "value string").coalesce(1).write.mode("append").json(folder)


def drain(q):
    q.processAllAvailable()
    q.stop()


def test_portfolio_follows_the_decks(spark, tmp):
    rng = random.Random(8)
    out, src = os.path.join(tmp, "out"), os.path.join(tmp, "in")
    newest = {}
    for step in range(3):
        sent = []
        for i in range(12):
            deck, at = f"d{rng.randrange(7)}", rng.randrange(40)
            value, cards = rng.choice([0.5, 20.0, 300.25, 4000.0]) if step < 2 else 1.0, rng.choice([40, 60, 75, 100, 120])
            sent.append(message({"deck_id": deck, "deck_name": deck.upper(), "total_cards": cards, "total_value": value, "calculated_at": at}, f"e{step}-{i:02d}"))
            newest[deck] = max(newest.get(deck, ((-1, ""),)), ((at, f"e{step}-{i:02d}"), cards, value), key=lambda x: x[0])
        land(spark, src, [*sent, sent[0], "{broken"])
        drain(T.start_portfolio_tables(SJ.file_source(spark, src), out, NOW, os.path.join(tmp, "ck"), k=3, n_buckets=3))
        whole = spark.createDataFrame([(d, x[1], x[2]) for d, x in newest.items()], "deck_id string, total_cards long, total_value double")
        assert T.portfolio(spark, out).collect() == A.portfolio_stats(whole).collect()
        assert sorted(map(str, T.formats(spark, out).collect())) == sorted(map(str, A.bucket_stats(whole).collect()))
        first = [r.deck_id for r in whole.orderBy(F.desc("total_value"), "deck_id").limit(3).collect()]
        got = T.leading_decks(spark, out, 3).orderBy("rank").collect()
        assert [r.deck_id for r in got] == first and [r.label for r in got] == ["#1", "#2", "#3"]
    sums = T.ledger(spark, out, "deck-values").agg(F.sum("input"), F.sum("accepted"), F.sum("rejected")).first()
    assert tuple(sums) == (42, 39, 3)


def test_distinct_facts_over_a_restart(spark, tmp):
    def price(uuid, p, event, seconds=0):
        return message({"card_uuid": uuid, "format": "paper", "source": "ck", "type": "retail", "foil": False, "date": "2024-01-01", "price": p}, event, seconds, "price.updated")

    out, src = os.path.join(tmp, "out"), os.path.join(tmp, "in")
    keys = ["card_uuid", "source", "type", "foil", "date"]
    for sent in ([price("a", 1.0, "1"), price("a", 1.0, "2", 5), price("b", 2.0, "3")], [price("a", 1.0, "4", 60), price("c", 3.0, "5"), "{"]):
        land(spark, src, sent)
        drain(T.start_distinct_facts(SJ.file_source(spark, src), out, keys, trigger=NOW, checkpoint_root=os.path.join(tmp, "ck")))
    assert sorted(r.card_uuid for r in spark.read.parquet(os.path.join(out, "distinct-facts")).collect()) == ["a", "b", "c"]


def test_enriched_decks_within_an_hour_over_a_restart(spark, tmp):
    out, decks, values = (os.path.join(tmp, x) for x in ("out", "decks", "values"))

    def deck(i, seconds):
        return message({"id": i, "name": i.upper(), "file_path": f"/{i}", "total_cards": 60, "unique_cards": 9}, i, seconds, "deck.ingested")

    def value(i, v, seconds):
        return message({"deck_id": i, "total_value": v}, f"v{i}", seconds)

    def run():
        drain(T.start_enriched_decks(SJ.file_source(spark, decks), SJ.file_source(spark, values), out, trigger=NOW, checkpoint_root=os.path.join(tmp, "ck")))

    land(spark, decks, [deck("a", 0), deck("b", 0), deck("c", 0)])
    land(spark, values, [value("a", 120.0, 3600), value("b", 5.0, 3601)])
    run()
    land(spark, values, [value("c", 30.0, -1800)])      # its deck came in the batch before
    land(spark, decks, [deck("d", 0)])
    run()
    got = {r.deck_name: (r.total_value, r.avg_card_value) for r in spark.read.parquet(os.path.join(out, "enriched-decks")).collect()}
    assert got == {"A": (120.0, 2.0), "C": (30.0, 0.5)}
