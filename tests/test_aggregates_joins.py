"""latest_by NULL semantics, as-of join against a brute-force reference, interval join bounds."""

import datetime as dt

from pyspark.sql import functions as F

from cardlake.operators import aggregates as A
from cardlake.operators import joins as J
from cardlake.operators import sinks as S
from conftest import SF_SMOKE


def test_latest_by_ignores_newer_nulls(spark):
    rows = [("k", 1, "a", 10.0), ("k", 2, None, 20.0), ("k", 3, None, None), ("j", 1, None, None)]
    df = spark.createDataFrame(rows, "key string, off int, name string, price double")
    got = {r.key: (r.name, r.price) for r in A.latest_by(df, ["key"], ["off"], ["name", "price"]).collect()}
    assert got == {"k": ("a", 20.0), "j": (None, None)}
    row = {r.key: (r.name, r.price) for r in A.latest_row(df, ["key"], ["off"], ["name", "price"]).collect()}
    assert row["k"] == (None, None)


def _brute_asof(facts, versions):
    out = []
    for f in facts:
        best = None
        for v in versions:
            if v[0] == f[1] and v[1] <= f[2] and (best is None or (v[1], v[2]) > (best[1], best[2])):
                best = v
        out.append((f[0], best[2] if best else None))
    return sorted(out)


def test_asof_join_matches_brute_force(spark):
    ev = spark.read.parquet(f"{SF_SMOKE}/events.parquet")
    facts_df = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    vers_df = ev.where(F.col("event_type").isin("view", "click")).select(
        "user_id", "ts", F.col("event_id").alias("vid"))
    got = sorted((r.event_id, r.vid) for r in
                 J.asof_join(facts_df, vers_df, "user_id", "ts", "ts", ["vid"], version_tiebreak="vid",
                             bucket="1 day").collect())
    facts = [tuple(r) for r in facts_df.collect()]
    versions = [tuple(r) for r in vers_df.collect()]
    assert got == _brute_asof(facts, versions)
    simple = sorted((r.event_id, r.vid) for r in
                    J.asof_join_simple(facts_df, vers_df, "user_id", "ts", "ts", ["vid"]).collect())
    assert got == simple


def test_asof_join_carries_across_buckets(spark):
    t = dt.datetime(2024, 1, 1)
    facts = spark.createDataFrame([(1, "k", t + dt.timedelta(days=3)), (2, "k", t - dt.timedelta(days=1)),
                                   (3, "k", t)], "fid int, key string, ts timestamp")
    vers = spark.createDataFrame([("k", t, 10), ("k", t + dt.timedelta(hours=1), 11)], "key string, ts timestamp, v int")
    got = {r.fid: r.v for r in J.asof_join(facts, vers, "key", "ts", "ts", ["v"], bucket="1 day").collect()}
    assert got == {1: 11, 2: None, 3: 10}      # same instant counts; 3 days later carries the last version


def test_interval_join_bounds(spark):
    t = dt.datetime(2024, 1, 1, 12)
    left = spark.createDataFrame([("d1", t)], "id string, lts timestamp")
    offs = [-90, -30, 30, 59, 60, 61, 90]
    right = spark.createDataFrame([("d1", t + dt.timedelta(minutes=m), m) for m in offs],
                                  "deck_id string, rts timestamp, m int")
    got = sorted(r.m for r in J.interval_join(left, right, "id", "deck_id", "lts", "rts", "1 hour").collect())
    assert got == [-30, 30, 59, 60]


def test_value_decks_counts_unpriced(spark):
    lines = spark.createDataFrame([("d", "Bolt", 4), ("d", "Unknown", 2), ("e", "Bolt", 1)],
                                  "deck_id string, card_name string, quantity long")
    cards = spark.createDataFrame([("Bolt", "b2"), ("Bolt", "b1")], "name string, uuid string")
    prices = spark.createDataFrame([("b1", 1.25, 1), ("b1", 2.5, 2), ("b2", 100.0, 3)],
                                   "card_uuid string, price double, ts int")
    got = {r.deck_id: (r.total_cards, r.total_value, r.unpriced_lines)
           for r in J.value_decks(lines, cards, prices, price_order=["ts"]).collect()}
    assert got == {"d": (6, 10.0, 1), "e": (1, 2.5, 0)}


def test_merge_latest_keeps_created(spark):
    t0, t1, t2 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))
    target = spark.createDataFrame([("a", "A", t0, t0), ("b", "B", t0, t0)],
                                   "uuid string, name string, created_at timestamp, updated_at timestamp")
    upd = spark.createDataFrame([("a", "A2", t1), ("a", "A3", t2), ("c", "C", t1)], "uuid string, name string, ts timestamp")
    got = {r.uuid: (r.name, r.created_at, r.updated_at)
           for r in S.merge_latest(target, upd, ["uuid"], ["ts"], ["name"], "ts").collect()}
    assert got == {"a": ("A3", t0, t2), "b": ("B", t0, t0), "c": ("C", t1, t1)}


def test_write_upsert_is_idempotent(spark, tmp):
    path = f"{tmp}/cards"
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    b1 = spark.createDataFrame([("a", "A", t1), ("b", "B", t1)], "uuid string, name string, ts timestamp")
    b2 = spark.createDataFrame([("a", "A2", t2)], "uuid string, name string, ts timestamp")
    S.write_upsert(b1, path, ["uuid"], ["ts"], ["name"], "ts", n_buckets=4)
    S.write_upsert(b2, path, ["uuid"], ["ts"], ["name"], "ts", n_buckets=4)
    first = sorted(tuple(r) for r in spark.read.parquet(path).drop("_bucket").collect())
    S.write_upsert(b2, path, ["uuid"], ["ts"], ["name"], "ts", n_buckets=4)   # replayed batch
    again = sorted(tuple(r) for r in spark.read.parquet(path).drop("_bucket").collect())
    assert first == again
    assert {r[0]: r[1] for r in first} == {"a": "A2", "b": "B"}


def test_null_group_key_kept_or_dropped(spark):
    # D13: SQL keeps a NULL group; the stream engine of the source dropped it
    df = spark.createDataFrame([("rare",), (None,), (None,)], "rarity string")
    kept = {r.rarity: r.n for r in A.distribution(df, "rarity", count_name="n").collect()}
    dropped = {r.rarity: r.n for r in A.distribution(df, "rarity", count_name="n", drop_null_keys=True).collect()}
    assert kept == {"rare": 1, None: 2} and dropped == {"rare": 1}
