"""Command line: deck directory ingest (or dry run), catalogue ingest, ad-hoc SQL.

  python -m cardlake.cli decks DIR [--rule cli|library] [--dry-run] [--out EVENTS_DIR]
  python -m cardlake.cli catalog EVENTS_DIR [--sets LANDED] [--atomic LANDED] [--prices LANDED] [--dumps]
  python -m cardlake.cli sql TABLES_DIR "SELECT ..." (--out DIR | --show N)
"""

from __future__ import annotations

import argparse
import json
import os
from datetime import datetime, timezone

from pyspark.sql import functions as F

from cardlake import schemas
from cardlake.functions import columns as C
from cardlake.session import build_session
from cardlake.sources import catalog as CAT
from cardlake.sources import decks as D
from cardlake.sources import dumps as DUMPS
from cardlake.sources import envelopes as E
from cardlake.sources.tables import observe_rejects

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def ingest_decks(spark, directory: str, rule: str = "cli", out: str | None = None,
                 dry_run: bool = False, empty_files: bool = False) -> dict:
    """Deck files -> deck and deck-card events (or printed decks). ``empty_files``: files without a byte are decks of
    no cards too, as the command line has it."""
    lines = D.read_deck_lines(spark, directory, with_place=True)
    graded, obs = observe_rejects(D.parse_deck_lines(lines, rule=rule, keep_rejects=True), "deck_lines")
    accepted = graded.where(F.col("reject_reason").isNull()).drop("reject_reason")
    decks = D.summarise_decks(graded, rule=rule)
    if empty_files:
        decks = decks.unionByName(D.empty_decks(spark, directory, rule))
    decks = D.with_cards(decks, graded).withColumn("ingested_at", F.current_timestamp().cast("string"))
    if dry_run:
        # every deck is printed; one partition at a time is on the driver
        for js in decks.orderBy("file_path").toJSON().toLocalIterator():
            print(json.dumps(json.loads(js), indent=2))
    else:
        target = out or os.path.join(directory, "_events")
        deck_ev = E.build_envelope(decks, schemas.EVENT_DECK, schemas.SOURCE_DECKS, schemas.VERSION_DECKS,
                                   payload=["id", "name", "file_path", "total_cards", "unique_cards", "ingested_at", "cards"])
        card_ev = E.build_envelope(D.deck_cards(accepted, rule=rule), schemas.EVENT_DECK_CARD, schemas.SOURCE_DECKS,
                                   schemas.VERSION_DECKS, payload=["deck_id", "deck_name", "card_name", "quantity"])
        deck_ev.write.mode("append").json(os.path.join(target, "decks"))
        card_ev.write.mode("append").json(os.path.join(target, "deck-cards"))
    return obs.get


def ingest_catalog(spark, out: str, sets_path: str | None = None, atomic_path: str | None = None,
                   prices_path: str | None = None, dumps: bool = False) -> None:
    """Landed catalogue dumps (with ``dumps`` folders of whole ones as published, {meta, data}; else one ``{"key", "doc"}`` JSON object per line) -> event
    folders standing in for topics: sets (cards stripped, key = set code), cards (one
    per card of every set and per atomic card, key = uuid) and prices (one per price
    leaf, key = price-<uuid>-<date>). All events of one ingest share one stamp. Documents that
    give no event go to the folder rejects (input, key, reason, length, stamp)."""
    stamp = F.lit(datetime.now(timezone.utc)).cast("timestamp")
    landed = DUMPS.read_documents if dumps else CAT.read_landed
    for kind, path in (("sets", sets_path), ("atomic", atomic_path), ("prices", prices_path)):
        if path:
            rejects = DUMPS.price_dump_rejects(spark, path) if dumps and kind == "prices" else CAT.document_rejects(landed(spark, path), kind=kind)
            rejects.select(
                F.lit(kind).alias("input"), "key", "reason", "length", stamp.alias("ingested_at")) \
                .write.mode("append").json(os.path.join(out, "rejects"))
    card_events = []
    if sets_path:
        sets, cards = CAT.flatten_sets(landed(spark, sets_path), processed_at=stamp)
        E.build_envelope(sets, schemas.EVENT_SET, schemas.SOURCE_CATALOGUE, schemas.VERSION_CATALOGUE,
                         payload=sets.columns, payload_key="set", timestamp=stamp, key=F.col("code"), headers=True) \
            .write.mode("append").json(os.path.join(out, "sets"))
        card_events.append(cards.drop("set_code"))
    if atomic_path:
        card_events.append(CAT.first_variant(landed(spark, atomic_path))
                           .withColumn("processedAt", stamp.cast("string")))
    for cards in card_events:
        E.build_envelope(cards, schemas.EVENT_CARD, schemas.SOURCE_CATALOGUE, schemas.VERSION_CATALOGUE,
                         payload=cards.columns, payload_key="card", timestamp=stamp, key=F.col("uuid"), headers=True) \
            .write.mode("append").json(os.path.join(out, "cards"))
    if prices_path:
        rows = DUMPS.read_price_dump(spark, prices_path) if dumps else CAT.flatten_price_tree(CAT.read_landed(spark, prices_path))
        key = C.price_event_key("card_uuid", F.to_date("date"))
        E.build_envelope(rows, schemas.EVENT_PRICE, schemas.SOURCE_CATALOGUE, schemas.VERSION_CATALOGUE,
                         payload=["card_uuid", "format", "source", "type", "foil", "date", "price"],
                         timestamp=stamp, key=key, headers=True) \
            .write.mode("append").json(os.path.join(out, "prices"))


def run_sql(spark, tables_dir: str, text: str):
    for t in TABLES:
        path = os.path.join(tables_dir, f"{t}.parquet")
        if os.path.exists(path):
            spark.read.parquet(path).createOrReplaceTempView(t)
    return spark.sql(text)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="cardlake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("decks")
    d.add_argument("directory")
    d.add_argument("--rule", default="cli", choices=["cli", "library"])
    d.add_argument("--dry-run", action="store_true")
    d.add_argument("--out")
    c = sub.add_parser("catalog")
    c.add_argument("out")
    c.add_argument("--sets")
    c.add_argument("--atomic")
    c.add_argument("--prices")
    c.add_argument("--dumps", action="store_true", help="the inputs are folders of whole dumps, {meta, data}")
    q = sub.add_parser("sql")
    q.add_argument("tables_dir")
    q.add_argument("text")
    where = q.add_mutually_exclusive_group(required=True)
    where.add_argument("--out", help="folder for the whole result as JSON lines")
    where.add_argument("--show", type=int, help="print so many rows")
    a = ap.parse_args(argv)
    spark = build_session(app_name=f"cardlake-{a.cmd}")
    if a.cmd == "decks":
        print(json.dumps({"line_counts": ingest_decks(spark, a.directory, a.rule, a.out, a.dry_run, empty_files=True)}))
    elif a.cmd == "catalog":
        ingest_catalog(spark, a.out, a.sets, a.atomic, a.prices, a.dumps)
    else:
        result = run_sql(spark, a.tables_dir, a.text)
        result.write.json(a.out) if a.out else result.show(a.show, truncate=False)


if __name__ == "__main__":
    main()
