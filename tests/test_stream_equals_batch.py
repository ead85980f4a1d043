"""Continuous queries over the driver's events table read as a file stream
(trigger availableNow, update mode) equal the batch queries."""

import os

from pyspark.sql import functions as F

from cardlake.operators import aggregates as A
from cardlake.plans.events import events_as_cards, events_as_deck_cards
from cardlake.streaming import jobs as SJ
from conftest import SF_SMOKE


def _events_stream(spark):
    schema = spark.read.parquet(f"{SF_SMOKE}/events.parquet").schema
    return SJ.file_source(spark, SF_SMOKE, schema, fmt="parquet", pathGlobFilter="events.parquet")


def _run(spark, df, name, tmp, mode="update"):
    q = SJ.run_stream(df, name, mode=mode, trigger={"availableNow": True}, checkpoint=os.path.join(tmp, name))
    q.processAllAvailable()
    q.stop()
    return spark.sql(f"SELECT * FROM {name}")


def _same(a, b):
    cols = sorted(a.columns)
    return sorted(tuple(r) for r in a.select(cols).collect()) == sorted(tuple(r) for r in b.select(cols).collect())


def test_set_statistics_stream_equals_batch(spark, tmp):
    cards = events_as_cards(_events_stream(spark)).withWatermark("ts", "20 seconds")
    s = _run(spark, A.set_statistics(cards, "set_code", "rarity", "cmc", ts_col="ts"), "ss_stream", tmp)
    b = A.set_statistics(events_as_cards(spark.read.parquet(f"{SF_SMOKE}/events.parquet")), "set_code", "rarity",
                         "cmc", ts_col="ts")
    assert b.count() > 0 and _same(s, b)


def test_latest_by_stream_equals_batch(spark, tmp):
    ev = _events_stream(spark).withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    s = _run(spark, A.latest_by(ev, ["user_id"], ["ts", "event_id"], ["event_type", "value"]), "lb_stream", tmp)
    bev = spark.read.parquet(f"{SF_SMOKE}/events.parquet") \
        .withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    b = A.latest_by(bev, ["user_id"], ["ts", "event_id"], ["event_type", "value"])
    assert _same(s, b)


def test_tumbling_reduce_stream_equals_batch(spark, tmp):
    d = events_as_deck_cards(_events_stream(spark)).withWatermark("ts", "5 seconds")
    s = _run(spark, A.tumbling_reduce(d, "ts", "deck_id", "quantity", "deck_name"), "tr_stream", tmp)
    b = A.tumbling_reduce(events_as_deck_cards(spark.read.parquet(f"{SF_SMOKE}/events.parquet")), "ts",
                          "deck_id", "quantity", "deck_name")
    assert _same(s, b)
