"""Flows over versioned tables: restarts, replays, out-of-order and repeated cards, rejects, change logs."""

from __future__ import annotations

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from cardlake import schemas
from cardlake.operators import aggregates as A
from cardlake.operators import versioned as V
from cardlake.sources import envelopes as E
from cardlake.streaming import jobs as SJ
from cardlake.streaming import tables as T

T0 = dt.datetime(2024, 1, 1)
NOW = {"availableNow": True}


def ms(seconds):
    return int((T0 - dt.datetime(1970, 1, 1)).total_seconds() * 1000) + 1000 * seconds


def card(uuid, rarity, seconds, event, colors=(), name="n"):
    return json.dumps({"eventType": "card.created", "eventId": event, "timestamp": ms(seconds), "source": "s", "version": "v5",
                       "card": {"uuid": uuid, "name": name, "setCode": "AAA", "rarity": rarity, "type": f"T{rarity}", "colorIdentity": list(colors)}})


def price(uuid, p):
    return json.dumps({"eventType": "price.updated", "eventId": uuid, "timestamp": ms(0), "source": "s", "version": "v5",
                       "data": {"card_uuid": uuid, "format": "paper", "source": "ck", "type": "retail", "foil": False, "date": "2024-01-01", "price": p}})


def land(spark, folder, messages):
    spark.createDataFrame([(m,) for m in messages], "value string").coalesce(1).write.mode("append").json(folder)


def batch_of(spark, messages):
    return spark.createDataFrame([(None, m) for m in messages], "key string, value string")


def drain(q):
    q.processAllAvailable()
    q.stop()


def test_card_tables_follow_out_of_order_repeated_and_replayed_cards(spark, tmp):
    rnd = random.Random(4)
    out, src = os.path.join(tmp, "out"), os.path.join(tmp, "cards")
    newest, sent = {}, 0
    for step in range(3):
        events = []
        for i in range(20):
            uuid, rarity, at, event = f"u{rnd.randrange(12)}", rnd.choice(["rare", "common", None]), rnd.randrange(50), f"e{step}-{i:02d}"
            colors = rnd.choice([(), ("W",), ("U", "B"), ("B", "U")])
            events.append(card(uuid, rarity, at, event, colors))
            newest[uuid] = max(newest.get(uuid, ((-1, ""),)), ((at, event), rarity, ",".join(sorted(colors))), key=lambda x: x[0])
        land(spark, src, [*events, events[0], "{broken", '{"eventType":"card.created","timestamp":1}',
                          card("u0", "mythic", 0, "none").replace(str(ms(0)), '"not a time"')])
        sent += 24
        drain(T.start_card_tables(SJ.file_source(spark, src), out, NOW, os.path.join(tmp, "ck"), n_buckets=2))    # each start is a restart
    table = T.card_table(spark, out, 2)
    assert {r.uuid: (r.rarity, r.color_identity) for r in table.read().collect()} == {u: x[1:] for u, x in newest.items()}
    for group, place in (("rarity", 1), ("color_identity", 2)):
        want = {}
        for x in newest.values():
            want[x[place]] = want.get(x[place], 0) + 1
        counts = T.count_table(spark, out, group)
        assert {r[group]: r.n for r in counts.read().collect()} == want
        assert {r[group]: r.n for r in V.replay(counts.changes(), [group], ["n"]).collect()} == want
    lines = T.ledger(spark, out, "cards").collect()
    assert sum(r.input for r in lines) == sent and all(r.input == r.accepted + r.rejected for r in lines)
    reasons = {}
    for r in spark.read.json(os.path.join(out, "rejects", "cards")).collect():
        reasons[r.reason] = reasons.get(r.reason, 0) + 1
    assert reasons == {"malformed": 3, "missing_payload": 3, "missing_time": 3} and sum(r.rejected for r in lines) == 9


def test_counts_catch_up_after_a_failure_behind_the_card_commit(spark, tmp, monkeypatch):
    out = os.path.join(tmp, "out")
    write = T.decoded_batch(out, "cards", schemas.CARD, "card", T.take_cards(out, 2))
    write(batch_of(spark, [card("a", "rare", 0, "1"), card("b", "rare", 0, "2")]), 0)
    moved = batch_of(spark, [card("a", "common", 1, "3")])
    with monkeypatch.context() as m:
        m.setattr(V, "count_by_group", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            write(moved, 1)
    write(moved, 1)
    write(moved, 1)
    assert {r.rarity: r.n for r in T.count_table(spark, out, "rarity").read().collect()} == {"rare": 1, "common": 1}
    assert T.ledger(spark, out, "cards").count() == 2


def test_replayed_prices_meet_the_same_card_version(spark, tmp):
    out = os.path.join(tmp, "out")
    cards = T.decoded_batch(out, "cards", schemas.CARD, "card", T.take_cards(out, 2))
    prices = T.decoded_batch(out, "prices", schemas.PRICE_ROW, "data", T.take_prices(out, 500.0, 2))
    batch = batch_of(spark, [price("a", 900.0), price("x", 700.0), price("a", 1.0), "?"])

    def alerts():
        return sorted(r.alert_message for r in spark.read.json(os.path.join(out, "alerts")).where("batch_id = 1").collect())
    prices(batch, 0)                                    # before any card: version 0
    cards(batch_of(spark, [card("a", "rare", 0, "1", name="Old")]), 0)
    prices(batch, 1)
    first, rows = alerts(), spark.read.parquet(os.path.join(out, "priced")).count()
    cards(batch_of(spark, [card("a", "rare", 5, "2", name="New"), card("x", "rare", 5, "3", name="X")]), 1)
    T.card_table(spark, out, 2).sweep(keep=1, hold=T.versions_met(spark, out))
    prices(batch, 1)
    assert first == alerts() == ["ALERT:  is priced at $700.0", "ALERT: Old is priced at $900.0"]
    assert spark.read.parquet(os.path.join(out, "priced")).count() == rows == 6
    prices(batch, 2)
    assert {r.name for r in spark.read.parquet(os.path.join(out, "priced")).where("batch_id = 2 and card_uuid = 'a'").collect()} == {"New"}


def test_change_log_of_a_stream_equals_its_batch_form(spark, tmp):
    rnd = random.Random(1)
    src, out = os.path.join(tmp, "prices"), os.path.join(tmp, "out")
    landed = []
    for batch in range(4):
        rows = [(f"u{rnd.randrange(5)}", float(rnd.randrange(1, 400))) for _ in range(rnd.randrange(1, 12))]
        landed += [(u, p, batch) for u, p in rows]
        land(spark, src, [price(u, p) for u, p in rows])
        stream = E.decode_envelope(SJ.file_source(spark, src), schemas.PRICE_ROW).where("_error is null").select("data.*")
        running = stream.groupBy("card_uuid").agg(F.count(F.lit(1)).alias("n"), F.max("price").alias("top"))
        drain(T.start_running_table(running, "stats", out, ["card_uuid"], NOW, os.path.join(tmp, "ck"), 2))       # restarts
    table = V.VersionedTable(spark, os.path.join(out, "stats"), ["card_uuid"], 2)
    want = A.running_changes(spark.createDataFrame(landed, "card_uuid string, price double, batch int"), ["card_uuid"], "batch",
                             {"n": ("sum", F.lit(1)), "top": ("max", F.col("price"))})

    def rows_of(df):
        return sorted(map(str, df.select("card_uuid", "seq", F.col("before.n").alias("bn"), F.col("before.top").alias("bt"), "after.n", "after.top").collect()))
    assert rows_of(table.changes()) == rows_of(want)
    got = {r.card_uuid: (r.n, r.top) for r in V.replay(table.changes(), ["card_uuid"], ["n", "top"]).collect()}
    assert got == {r.card_uuid: (r.n, r.top) for r in table.read().collect()}
