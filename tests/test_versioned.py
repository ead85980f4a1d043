"""Versioned tables: commits as a whole, pinned readers, replays, logs of changes, retraction, compaction."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from cardlake.operators import versioned as V

SCHEMA = "uuid string, name string, rarity string, ts long, off long"


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("at", F.timestamp_seconds("ts"))


def put(table, df, batch_id=None, log=True):
    return table.upsert(df, ["ts", "off"], ["name", "rarity"], "at", writer="cards", batch_id=batch_id, log=log)


def rows_of(df, *cols):
    return sorted(map(str, (tuple(r[c] for c in cols) for r in df.collect())))


def cards(spark, tmp, n=4):
    return V.VersionedTable(spark, os.path.join(tmp, "cards"), ["uuid"], n)


def test_failure_between_data_and_manifest_leaves_the_table(spark, tmp, monkeypatch):
    t = cards(spark, tmp)
    assert t.read() is None and t.changes() is None and t.manifest().version == 0
    put(t, batch(spark, [("a", "A", "rare", 1, 0), ("b", "B", "rare", 1, 1), (None, "N", None, 1, 2)]), 0)
    before = rows_of(t.read(), "uuid", "name")
    with monkeypatch.context() as m:
        m.setattr(V.VersionedTable, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost driver")))
        with pytest.raises(OSError):
            put(t, batch(spark, [("a", "A2", "common", 2, 0), ("c", "C", "rare", 2, 1)]), 1)
    assert rows_of(t.read(), "uuid", "name") == before and t.changes().count() == 3
    version = put(t, batch(spark, [("a", "A2", "common", 2, 0), ("c", "C", "rare", 2, 1)]), 1)     # the same batch again
    assert version == 3 and rows_of(t.read(), "uuid", "name") == sorted(map(str, [("a", "A2"), ("b", "B"), ("c", "C"), (None, "N")]))
    assert t.changes().count() == 5
    assert "data/v=2" in t.sweep(keep=2) and len(t.read().collect()) == 4 and len(t.read(1).collect()) == 3


def test_reader_keeps_its_version_while_others_are_committed(spark, tmp):
    t = cards(spark, tmp)
    put(t, batch(spark, [(f"u{i}", "old", "rare", 1, i) for i in range(50)]))
    reader = t.read()
    put(t, batch(spark, [(f"u{i}", "new", "common", 2, i) for i in range(50)]))
    assert {r.name for r in reader.collect()} == {"old"} and {r.name for r in t.read().collect()} == {"new"}
    assert {r.name for r in t.read(1).collect()} == {"old"}


def test_replayed_batch_and_second_writer(spark, tmp):
    t, other = cards(spark, tmp), cards(spark, tmp)
    first = batch(spark, [("a", "A", "rare", 1, 0)])
    assert put(t, first, 7) == 1 and put(t, first, 7) == 1 and t.versions() == [1] and t.changes().count() == 1
    assert t.batch_version("cards", 7) == 1 and t.batch_version("cards", 8) is None
    base = other.manifest()
    put(t, batch(spark, [("b", "B", "rare", 1, 0)]), 8)
    with pytest.raises(V.CommitConflict):
        other._commit(base, V.Manifest(2, base.schema, base.parts))
    other.manifest = lambda version=None: base
    with pytest.raises(V.CommitConflict):
        put(other, batch(spark, [("c", "C", "rare", 1, 0)]), 9)
    assert rows_of(t.read(), "uuid") == ["('a',)", "('b',)"]


def random_batches(rnd, batches, keys):
    return [[(rnd.choice([None, *(f"u{k}" for k in range(keys))]), f"n{rnd.randrange(4)}", rnd.choice(["rare", "common", "mythic", None]),
              rnd.randrange(20), b * 100 + i) for i in range(rnd.randrange(0, 25))] for b in range(batches)]


def test_any_order_of_batches_gives_the_newest_rows_and_a_whole_log(spark, tmp):
    rnd = random.Random(2)
    batches = random_batches(rnd, 7, 12)
    t, counts = cards(spark, tmp), V.VersionedTable(spark, os.path.join(tmp, "counts"), ["rarity"], 2)
    for i, rows in enumerate(batches):
        put(t, batch(spark, rows), i)
        if i % 3 == 1:
            put(t, batch(spark, rows), i)                       # replayed
        if i in (0, 3, 6):                                       # counts lag behind and catch up
            V.count_by_group(t, counts, "rarity", log=True)
            V.count_by_group(t, counts, "rarity")
    newest = {}
    for r in sorted((r for b in batches for r in b), key=lambda r: (r[3], r[4])):
        newest[r[0]] = r
    assert rows_of(t.read(), "uuid", "name", "rarity") == sorted(map(str, [r[:3] for r in newest.values()]))
    log = t.changes()
    assert rows_of(V.replay(log, ["uuid"], ["name", "rarity"]), "uuid", "name", "rarity") == sorted(map(str, [r[:3] for r in newest.values()]))
    per_key = {}
    for r in sorted(log.collect(), key=lambda r: r.seq):
        images = per_key.setdefault(r.uuid, [None])
        assert r.seq == len(images) and r.before == images[-1] and r.before != r.after
        images.append(r.after)
    want = {}
    for r in newest.values():
        want[r[2]] = want.get(r[2], 0) + 1
    assert {r.rarity: r.n for r in counts.read().collect()} == want
    assert rows_of(V.replay(counts.changes(), ["rarity"], ["n"]), "rarity", "n") == sorted(map(str, want.items()))


def test_history_and_join_at_arrival(spark, tmp):
    t = cards(spark, tmp)
    for i, name in enumerate(["one", "two", "two", "three"]):
        put(t, batch(spark, [("a", name, "rare", i, i), (f"x{i}", "x", "rare", i, i)]), i)
    h = V.history(t.changes(), ["uuid"], ["name"])
    assert rows_of(h.where("uuid = 'a'"), "name", "from_version", "to_version") == sorted(["('one', 1, 2)", "('two', 2, 4)", "('three', 4, None)"])
    facts = spark.createDataFrame([("a", v) for v in (0, 1, 2, 3, 4, 9)] + [("b", 1), (None, 1)], "card string, met long")
    got = V.join_at_arrival(facts, h, "card", "uuid", "met")
    assert rows_of(got, "card", "met", "name") == sorted(map(str, [("a", 0, None), ("a", 1, "one"), ("a", 2, "two"), ("a", 3, "two"), ("a", 4, "three"), ("a", 9, "three"), ("b", 1, None), (None, 1, None)]))


def test_pins_survive_later_versions(spark, tmp):
    t, pins = cards(spark, tmp), V.Files(spark, os.path.join(tmp, "pins"))
    put(t, batch(spark, [("a", "old", "rare", 1, 0)]))
    assert V.pinned_version(t, pins, 5) == 1
    put(t, batch(spark, [("a", "new", "rare", 2, 0)]))
    assert V.pinned_version(t, pins, 5) == 1 and V.pinned_version(t, pins, 6) == 2
    t.sweep(keep=1, hold={1})
    assert t.read(1).first().name == "old"


def test_compaction_packs_small_files_and_leaves_readers_alone(spark, tmp):
    t = V.VersionedTable(spark, os.path.join(tmp, "log"), ["uuid"], 1)
    for i in range(40):
        t.append(spark.createDataFrame([(f"u{i}", i), (f"w{i}", -i)], "uuid string, n int").coalesce(1), batch_id=i)
    t.append(spark.createDataFrame([("again", 0)], "uuid string, n int"), batch_id=39)      # replayed
    reader, want = t.read(), rows_of(t.read(), "uuid", "n")

    def files():
        return sum(n.endswith(".parquet") for b, vs in t.manifest().parts.items() for v in vs for n in t.files.names(f"data/v={v}/_bucket={b}"))
    assert files() == 40 and len(want) == 80
    t.compact()
    assert files() == 1 and rows_of(t.read(), "uuid", "n") == want == rows_of(reader, "uuid", "n")
    assert t.compact() is None
    t.append(spark.createDataFrame([("later", 1)], "uuid string, n int"), batch_id=40)
    t.sweep(keep=1)
    assert len(t.read().collect()) == 81 and t.files.names("manifests") == ["000000000042.json"]
    t.compact(target_bytes=600)                                 # folders of a full file stay
    assert len(t.read().collect()) == 81


def test_upsert_without_rows(spark, tmp):
    t = cards(spark, tmp)
    assert put(t, batch(spark, []), 0) == 1 and t.read().isEmpty()
    put(t, batch(spark, [("a", "A", "rare", 1, 0)]), 1)
    put(t, batch(spark, []), 2)
    assert t.read().count() == 1 and t.manifest().version == 3
