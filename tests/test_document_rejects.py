"""Set documents of any size pass; documents that give no event are written as rejects."""

import json
import os

from pyspark.sql import functions as F

from cardlake import cli
from cardlake.sources import catalog as CAT

CARDS = [{"uuid": "u1", "name": "n"}]


def test_set_document_above_the_variant_limit(spark):
    filler = F.expr("repeat(concat('\"', repeat('x', 1000), '\",'), 140000)")   # 140 MB
    doc = F.concat(F.lit('{"filler":['), filler, F.lit('0],"code":"BIG","cards":' + json.dumps(CARDS) + "}"))
    df = spark.range(1).select(F.lit("K").alias("key"), doc.alias("doc"))
    sets, cards = CAT.flatten_sets(df)
    assert [r.code for r in sets.select("code").collect()] == ["BIG"]
    assert [(r.set_code, r.uuid) for r in cards.select("set_code", "uuid").collect()] == [("BIG", "u1")]


def test_set_documents_judged_by_their_own_parse(spark):
    docs = [("A", json.dumps({"code": "A", "cards": CARDS})), ("B", "\n" + json.dumps({"data": {"code": "B", "cards": CARDS}})),
            ("C", json.dumps({"code": "C", "cards": CARDS})[:-3]), ("D", json.dumps([{"code": "D"}])), ("E", None), ("F", "text"),
            ("G", json.dumps({"code": "G", "cards": CARDS, "releaseDate": {"odd": 1}}))]
    df = spark.createDataFrame(docs, "key string, doc string")
    sets, cards = CAT.flatten_sets(df)
    assert sorted(r.code for r in sets.collect()) == ["A", "B", "G"] and {r.set_code for r in cards.collect()} >= {"A", "B"}
    assert {r.key: r.reason for r in CAT.document_rejects(df, kind="sets").collect()} == {
        "C": "broken", "D": "not_an_object", "E": "missing", "F": "not_an_object"}


def test_catalogue_ingest_writes_rejects_of_all_inputs(spark, tmp):
    good = {"sets": {"code": "A", "cards": CARDS}, "atomic": [{"uuid": "u2", "name": "m"}],
            "prices": {"paper": {"ck": {"retail": {"normal": {"2024-01-01": 1.5}}}}}}
    paths = {}
    for kind, doc in good.items():
        paths[kind] = os.path.join(tmp, f"{kind}.json")
        with open(paths[kind], "w") as f:
            f.write("\n".join(json.dumps({"key": k, "doc": d}) for k, d in (("good", doc), ("bad", "{broken"), ("none", None), ("odd", 5))) + "\n")
    out = os.path.join(tmp, "events")
    cli.ingest_catalog(spark, out, paths["sets"], paths["atomic"], paths["prices"])
    got = sorted((r.input, r.key, r.reason) for r in spark.read.json(os.path.join(out, "rejects")).collect())
    assert got == sorted([
        ("sets", "bad", "broken"), ("sets", "none", "missing"), ("sets", "odd", "not_an_object"),
        ("atomic", "bad", "not_a_list"), ("atomic", "none", "missing"), ("atomic", "odd", "not_a_list"),
        ("prices", "bad", "broken_or_too_large"), ("prices", "none", "missing"), ("prices", "odd", "not_an_object")])
    assert [spark.read.json(os.path.join(out, d)).count() for d in ("sets", "cards", "prices")] == [1, 2, 1]
