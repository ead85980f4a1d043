"""Landed documents, raw archive, observed ingest counters, CLI ingest, suspect flag."""

import json
import os

from pyspark.sql import functions as F

from cardlake import cli
from cardlake.sources import catalog as CAT
from cardlake.sources import decks as D
from cardlake.sources.tables import archive_raw, observe_rejects
from test_deck_directory import FIX


def test_read_landed_keeps_doc_text(spark, tmp):
    path = os.path.join(tmp, "landed.jsonl")
    with open(path, "w") as f:
        f.write(json.dumps({"key": "u1", "doc": {"paper": {"s": {"retail": {"normal": {"2024-01-01": 2.5}}}}}}) + "\n")
        f.write(json.dumps({"key": "u2", "doc": {"paper": {"s": {"currency": "USD"}}}}) + "\n")
    docs = CAT.read_landed(spark, path)
    rows = CAT.flatten_price_tree(docs).collect()
    assert [(r.card_uuid, r.price) for r in rows] == [("u1", 2.5)]
    archive_raw(docs, os.path.join(tmp, "raw"), "prices", ingest_date=F.lit("2024-01-01").cast("date"))
    back = spark.read.parquet(os.path.join(tmp, "raw"))
    assert back.count() == 2 and {r.source for r in back.collect()} == {"prices"}


def test_observed_counters(spark):
    rows = [("d", "1 A"), ("d", "// c"), ("d", "x y"), ("d", "")]
    df = spark.createDataFrame(rows, "file_path string, line string")
    graded, obs = observe_rejects(D.parse_deck_lines(df, keep_rejects=True), "t")
    graded.write.format("noop").mode("overwrite").save()
    m = obs.get
    assert (m["accepted"], m["comment"], m["malformed"], m["blank"]) == (1, 1, 1, 1)


def test_cli_ingest_writes_events(spark, tmp):
    counts = cli.ingest_decks(spark, FIX, out=tmp)
    assert counts["accepted"] == 8
    decks = spark.read.json(os.path.join(tmp, "decks"))
    cards = spark.read.json(os.path.join(tmp, "deck-cards"))
    assert decks.count() == 3 and cards.count() == 8
    types = cards.select(F.get_json_object("value", "$.eventType").alias("t")).distinct().collect()
    assert [r.t for r in types] == ["deck.card"]


def test_cli_sql(spark):
    r = cli.run_sql(spark, "/root/testdata/sf0.001", "SELECT count(*) AS n FROM region").first()
    assert r.n == 5


def test_suspect_flag(spark):
    rows = [("d", "1 Sol Ring -OK"), ("d", "1 Island -> Swamp"), ("d", "1 Bolt - proxy"), ("d", "250 words in a sentence"),
            ("d", "4 Lightning Bolt")]
    parsed = D.flag_suspect(D.parse_deck_lines(spark.createDataFrame(rows, "file_path string, line string")))
    got = {r.card_name: r.suspect for r in parsed.collect()}
    assert got == {"Sol Ring -OK": True, "Island -> Swamp": True, "Bolt - proxy": True,
                   "words in a sentence": True, "Lightning Bolt": False}


def test_catalog_ingest_to_events(spark, tmp):
    land = os.path.join(tmp, "land")
    os.makedirs(land)
    card = {"uuid": "c1", "name": "Bolt", "setCode": "AAA", "rarity": "common", "colors": ["R"]}
    with open(os.path.join(land, "sets.jsonl"), "w") as f:
        f.write(json.dumps({"key": "AAA", "doc": {"code": "AAA", "name": "Alpha", "cards": [card, dict(card, uuid="c2")]}}) + "\n")
    with open(os.path.join(land, "atomic.jsonl"), "w") as f:
        f.write(json.dumps({"key": "Bolt", "doc": [{"uuid": "c9", "name": "Bolt"}]}) + "\n")
    with open(os.path.join(land, "prices.jsonl"), "w") as f:
        f.write(json.dumps({"key": "c1", "doc": {"paper": {"ck": {"currency": "USD",
                                                 "retail": {"normal": {"2024-01-01": 1.5, "2024-01-02": 2}}}}}}) + "\n")
    out = os.path.join(tmp, "events")
    cli.ingest_catalog(spark, out, os.path.join(land, "sets.jsonl"), os.path.join(land, "atomic.jsonl"),
                       os.path.join(land, "prices.jsonl"))
    sets = spark.read.json(os.path.join(out, "sets")).collect()
    cards = spark.read.json(os.path.join(out, "cards")).collect()
    prices = spark.read.json(os.path.join(out, "prices")).collect()
    assert [r.key for r in sets] == ["AAA"] and "cards" not in json.loads(sets[0].value)["set"]
    assert sorted(r.key for r in cards) == ["c1", "c2", "c9"]
    assert sorted(r.key for r in prices) == ["price-c1-2024-01-01", "price-c1-2024-01-02"]
    assert {json.loads(r.value)["eventType"] for r in cards} == {"card.created"}


def test_read_table_with_schema(spark):
    from cardlake.sources.tables import read_table
    df = read_table(spark, "/root/testdata/sf0.001/region.parquet", schema=None)
    assert df.count() == 5 and "r_name" in df.columns
