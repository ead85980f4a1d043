"""Totals and ranked lists kept by the buckets that change equal those of the whole table after every batch."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from cardlake.operators import derived as DV
from cardlake.operators import versioned as V

BUCKETS, K = 6, 4


def tables(spark, root):
    decks = V.VersionedTable(spark, os.path.join(root, "decks"), ["deck_id"], BUCKETS)
    totals = V.VersionedTable(spark, os.path.join(root, "totals"), ["bucket", "kind"], BUCKETS)
    leaders = V.VersionedTable(spark, os.path.join(root, "leaders"), ["bucket", "place"], BUCKETS)
    return decks, totals, leaders


def put(spark, decks, n, rows):
    batch = spark.createDataFrame([(d, kind, v, n) for d, kind, v in rows], "deck_id string, kind string, total_value double, seq long")
    return decks.upsert(batch.withColumn("at", F.timestamp_seconds("seq")), ["seq"], ["kind", "total_value"], "at", writer="w", batch_id=n)


def follow(decks, totals, leaders):
    DV.follow_totals(decks, totals, "total_value", {"kind": F.col("kind")})
    return DV.follow_ranking(decks, leaders, "total_value", K, show=["kind"])


def check(decks, totals, leaders, want):
    got = {r.kind: (r.n, r.total, r.average, r.least, r.largest) for r in DV.merge_totals(totals.read(), ["kind"]).collect()}
    expected = {}
    for kind in {k for k, _ in want.values()}:
        all_, v = [x for k, x in want.values() if k == kind], [x for k, x in want.values() if k == kind and x is not None]
        expected[kind] = (len(all_), sum(v) if v else None, sum(v) / len(v) if v else None, min(v, default=None), max(v, default=None))
    assert got == expected
    first = sorted(((-v, d, k) for d, (k, v) in want.items() if v is not None))[:K]
    ranked = DV.ranking(leaders.read(), ["deck_id"], "total_value", K).orderBy("rank").collect()
    assert [(-r.total_value, r.deck_id, r.kind) for r in ranked] == first
    assert [r.label for r in ranked] == [f"#{i + 1}" for i in range(len(first))]


def test_after_every_batch_with_rising_falling_and_moving_values(spark, tmp):
    rng = random.Random(5)
    decks, totals, leaders = tables(spark, tmp)
    want = {}
    for n in range(4):
        rows = {f"d{rng.randrange(14)}": (rng.choice(["a", "b", None]), rng.choice([None, *(x / 2 for x in range(12))])) for _ in range(9)}
        if n == 2:      # the leader falls, and its group loses it
            rows = {max(want, key=lambda d: want[d][1] or 0): ("c", 0.0)}
        put(spark, decks, n, [(d, *v) for d, v in rows.items()])
        want |= rows
        follow(decks, totals, leaders)
        check(decks, totals, leaders, want)


def test_only_changed_buckets_are_read_and_versions_count_once(spark, tmp, monkeypatch):
    decks, totals, leaders = tables(spark, tmp)
    want = {f"d{i}": ("a", float(i)) for i in range(30)}
    put(spark, decks, 0, [(d, *v) for d, v in want.items()])
    follow(decks, totals, leaders)
    read = []
    stored = V.VersionedTable._stored
    put(spark, decks, 1, [("d29", "a", 0.5)])
    want["d29"] = ("a", 0.5)
    monkeypatch.setattr(V.VersionedTable, "_stored", lambda self, m, b=None: (read.append(b) if self is decks else None, stored(self, m, b))[1])
    follow(decks, totals, leaders)
    assert [len(b) for b in read] == [1, 1]
    before = totals.manifest().version, leaders.manifest().version
    follow(decks, totals, leaders)      # nothing new
    assert (totals.manifest().version, leaders.manifest().version) == before and len(read) == 2
    check(decks, totals, leaders, want)


def test_versions_missed_or_swept_are_caught_up(spark, tmp, monkeypatch):
    decks, totals, leaders = tables(spark, tmp)
    want = {f"d{i}": ("a", float(i)) for i in range(8)}
    put(spark, decks, 0, [(d, *v) for d, v in want.items()])
    follow(decks, totals, leaders)
    with monkeypatch.context() as m:    # the driver dies before the derived commit
        m.setattr(V.VersionedTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            put(spark, decks, 1, [("d1", "b", 50.0)])
    for n, (d, v) in enumerate([("d1", 50.0), ("d7", None), ("d3", 2.0)], start=1):
        put(spark, decks, n, [(d, "b", v)])
        want[d] = ("b", v)
    decks.sweep(keep=1)                 # the version that the totals hold is gone
    follow(decks, totals, leaders)
    check(decks, totals, leaders, want)
