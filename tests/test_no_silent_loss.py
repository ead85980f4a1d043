"""Nothing is dropped, capped or overwritten silently."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.errors import AnalysisException

from cardlake import cli, session
from cardlake.functions import columns as C
from cardlake.operators import joins as J
from cardlake.operators import sinks as S
from cardlake.sources import catalog as CAT
from cardlake.sources import decks as D
from cardlake.streaming import apps
from pyspark.sql import functions as F


def test_long_line_keeps_its_file(spark):
    lines = spark.createDataFrame([("a", "1 " + "x" * 100_000), ("a", "2 Island"), ("b", "3 Swamp")], "file_path string, line string")
    got = {(r.file_path, r.quantity) for r in D.parse_deck_lines(lines, rule="library").collect()}
    assert got == {("a", 1), ("a", 2), ("b", 3)}


def test_dry_run_prints_every_deck(spark, tmp, capsys):
    for i in range(25):
        with open(os.path.join(tmp, f"deck-{i:02d}.deck"), "w") as f:
            f.write(f"{i + 1} Island\n")
    cli.ingest_decks(spark, tmp, dry_run=True)
    assert capsys.readouterr().out.count('"total_cards"') == 25


def test_documents_that_do_not_parse_are_listed(spark):
    cards = [{"uuid": "u1", "name": "n"}]
    docs = [("A", json.dumps({"data": {"code": "A", "cards": cards}, "meta": {}})), ("B", json.dumps({"code": "B", "cards": cards})),
            ("C", "{broken"), ("D", None), ("E", "text")]
    df = spark.createDataFrame(docs, "key string, doc string")
    sets, set_cards = CAT.flatten_sets(df)
    assert {r.code for r in sets.collect()} == {"A", "B"} and {r.set_code for r in set_cards.collect()} == {"A", "B"}
    assert {r.key: r.reason for r in CAT.document_rejects(df).collect()} == {
        "C": "broken_or_too_large", "D": "missing", "E": "not_an_object"}


def test_late_update_and_replay_do_not_replace_a_newer_row(spark, tmp):
    def batch(*rows):
        return spark.createDataFrame(rows, "uuid string, name string, day string").withColumn("ts", F.to_timestamp("day")).drop("day")

    path = os.path.join(tmp, "t")
    new, old = batch(("a", "NEW", "2024-02-01"), ("b", "B", "2024-02-01")), batch(("a", "OLD", "2024-01-01"))
    for rows in (old, new, old, new):
        S.write_upsert(rows, path, ["uuid"], ["ts"], ["name"], "ts", n_buckets=2)
    got = {r.uuid: r for r in spark.read.parquet(path).collect()}
    assert got["a"].name == "NEW" and got["a"].updated_at > got["a"].created_at and len(got) == 2


def test_card_table_without_a_column_is_an_error(spark, tmp):
    spark.createDataFrame([("u", "n")], "uuid string, name string").write.parquet(os.path.join(tmp, "cards"))
    prices = spark.createDataFrame([("u", 900.0)], "card_uuid string, price double")
    with pytest.raises(AnalysisException):
        apps.price_batch(os.path.join(tmp, "cards"), tmp)(prices, 0)


def test_checkpoint_folder_and_joins_and_large_prices(spark):
    assert session.is_local("local") and session.is_local("local[8]")
    assert not session.is_local("local-cluster[3,2,1024]") and not session.is_local("yarn")
    df = spark.range(1).selectExpr("id", "current_timestamp() as ts")
    with pytest.raises(ValueError):
        J.interval_join(df, df, "id", "id", "ts", "ts", how="full")
    rows = spark.createDataFrame([(12345678.5,), (20000000.0,), (7.25,)], "p double").select(C.alert_message(F.lit("x"), "p").alias("m")).collect()
    assert [r.m.rsplit("$")[1] for r in rows] == ["12345678.5", "20000000.0", "7.25"]
