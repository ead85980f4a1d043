"""Listing of files without a byte, decks with their cards, even as-of joins, reference checks by counts."""

from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from cardlake import cli
from cardlake.operators import joins as J
from cardlake.sources import decks as D
from cardlake.sources.files import list_files


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_list_of_files(spark, tmp):
    for name, text in (("a b%é.deck", "1 Island\n"), ("empty.deck", ""), ("note.txt", "x"), (".hidden.deck", ""), ("_x.deck", "")):
        write(tmp, name, text)
    write(os.path.join(tmp, "sub", "deep"), "c.deck", "22")
    got = {r.path: r.length for r in list_files(spark, tmp, patterns=("*.deck",)).collect()}
    seen = {r.file_path for r in D.read_deck_lines(spark, tmp).collect()}
    assert sorted(got.values()) == [0, 9] and seen < set(got)
    assert list_files(spark, tmp, recursive=True).where("length = 2").count() == 1
    with pytest.raises(Exception):
        list_files(spark, os.path.join(tmp, "nowhere")).collect()


def test_empty_deck_files_are_decks_and_decks_carry_their_cards(spark, tmp, capsys):
    write(tmp, "one.deck", "3 Swamp\n// x\n2 Island\n3 Swamp\n")
    write(tmp, "none.deck", "")
    write(tmp, "bad.deck.txt", "no cards here\n")
    cli.ingest_decks(spark, tmp, out=os.path.join(tmp, "_events"), empty_files=True)
    data = {os.path.basename(d["file_path"]).partition(".")[0]: d for d in (json.loads(r.value)["data"] for r in spark.read.json(os.path.join(tmp, "_events", "decks")).collect())}
    assert {n: (d["total_cards"], d["unique_cards"]) for n, d in data.items()} == {"one": (8, 3), "none": (0, 0), "bad": (0, 0)}
    assert data["one"]["cards"] == [{"quantity": 3, "name": "Swamp"}, {"quantity": 2, "name": "Island"}, {"quantity": 3, "name": "Swamp"}]
    assert all(d["cards"] == [] for n, d in data.items() if n != "one")
    cli.ingest_decks(spark, tmp, dry_run=True, empty_files=True)
    shown = capsys.readouterr().out
    assert shown.count('"ingested_at"') == 3 and shown.count('"quantity": 3') == 2


def test_published_headers(spark, tmp):
    sets = os.path.join(tmp, "sets")
    spark.createDataFrame([("A", json.dumps({"code": "A", "cards": [{"uuid": "u", "name": "n"}]}))], "key string, doc string").write.json(sets)
    cli.ingest_catalog(spark, os.path.join(tmp, "out"), sets_path=sets)
    for folder, event in (("sets", "set.created"), ("cards", "card.created")):
        r = spark.read.json(os.path.join(tmp, "out", folder)).selectExpr("transform(headers, h -> concat(h.key, '=', cast(unbase64(h.value) as string))) h").first()
        assert r.h == [f"eventType={event}", "source=mtgjson"]


@pytest.mark.parametrize("partitions", [1, 7])
def test_asof_pieces_equal_the_simple_form(spark, partitions):
    rnd = random.Random(partitions)
    hot = [("hot", 5, i) for i in range(300)]                       # a third of all rows in one instant
    facts = hot + [(rnd.choice(["hot", "a", "b", None]), rnd.choice([None, *range(12)]), 1000 + i) for i in range(300)]
    versions = [(rnd.choice(["hot", "a", None]), rnd.choice([None, *range(12)]), i, f"v{i}") for i in range(200)]
    f = spark.createDataFrame(facts, "k string, ts int, id int")
    v = spark.createDataFrame(versions, "k string, vts int, tb int, name string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions * 3))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = J.asof_join_pieces(f, v, "k", "ts", "vts", ["name"], version_tiebreak="tb")
        got = {r.id: r.name for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for k, ts, i in facts:
        best = max(((x[1], x[2], x[3]) for x in versions if k is not None and ts is not None and x[0] == k and x[1] is not None and x[1] <= ts), default=None)
        assert got[i] == (best[2] if best else None), (k, ts, i)
    assert len(got) == len(facts)


def test_reference_checks_by_counts(spark):
    child = spark.createDataFrame([(1, 5), (1, 6), (2, None), (None, 9), (7, 5)], "a int, b long")
    p, q = spark.createDataFrame([(1,), (2,), (3,), (None,), (3,)], "k int"), spark.createDataFrame([(5,)], "k long")
    got = {r.relation: (r.child_rows, r.orphan_rows, r.childless_parents) for r in J.reference_checks(
        [("a", child, "a", p, "k"), ("b", child, "b", q, "k"), ("none", child.limit(0), "a", q, "k")]).collect()}
    assert got == {"a": (5, 1, 1), "b": (5, 2, 0), "none": (0, 0, 1)}
    plan = J.reference_checks([("a", child, "a", p, "k"), ("b", child, "b", q, "k")])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 3
