"""Explicit schemas of every landed document and event payload (no inference)."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, LongType,
                               MapType, StringType, StructField, StructType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


STR_ARRAY = ArrayType(StringType())

CARD = _s(
    ("uuid", StringType()), ("name", StringType()), ("manaCost", StringType()),
    ("convertedManaCost", DoubleType()), ("type", StringType()), ("text", StringType()),
    ("power", StringType()), ("toughness", StringType()), ("colors", STR_ARRAY),
    ("colorIdentity", STR_ARRAY), ("setCode", StringType()), ("rarity", StringType()),
    ("artist", StringType()), ("number", StringType()), ("layout", StringType()),
    ("legalities", MapType(StringType(), StringType())), ("subtypes", STR_ARRAY),
    ("supertypes", STR_ARRAY), ("types", STR_ARRAY), ("keywords", STR_ARRAY),
    ("processedAt", StringType()),
)

SET = _s(
    ("code", StringType()), ("name", StringType()), ("type", StringType()),
    ("releaseDate", StringType()), ("baseSetSize", IntegerType()), ("totalSetSize", IntegerType()),
    ("cards", ArrayType(CARD)), ("processedAt", StringType()),
)
SET_NO_CARDS = StructType([f for f in SET.fields if f.name != "cards"])

PRICE_ROW = _s(
    ("card_uuid", StringType()), ("format", StringType()), ("source", StringType()),
    ("type", StringType()), ("foil", BooleanType()), ("date", StringType()), ("price", DoubleType()),
)

DECK_CARD = _s(("deck_id", StringType()), ("deck_name", StringType()),
               ("card_name", StringType()), ("quantity", LongType()))

DECK = _s(("id", StringType()), ("name", StringType()), ("file_path", StringType()),
          ("total_cards", LongType()), ("unique_cards", LongType()), ("ingested_at", StringType()))

DECK_VALUE = _s(("deck_id", StringType()), ("deck_name", StringType()), ("total_cards", LongType()),
                ("total_value", DoubleType()), ("calculated_at", LongType()))

# Envelope header; the payload sits under a per-event key (card | set | data).
# ``timestamp`` is read as text: producers write RFC-3339 text or epoch millis.
ENVELOPE_HEADER = [("eventType", StringType()), ("eventId", StringType()),
                   ("timestamp", StringType()), ("source", StringType()), ("version", StringType())]


def envelope(payload: StructType, payload_key: str = "data") -> StructType:
    return _s(*ENVELOPE_HEADER, (payload_key, payload))


# ---------------------------------------------------------------------------
# Fixed values written into event envelopes; consumers match on them, so they
# must equal the values of the system being replaced.
# ---------------------------------------------------------------------------
EVENT_CARD = "card.created"
EVENT_SET = "set.created"
EVENT_PRICE = "price.updated"
EVENT_DECK = "deck.ingested"
EVENT_DECK_CARD = "deck.card"
EVENT_DECK_VALUE = "deck.value.calculated"
SOURCE_CATALOGUE = "mtgjson"
SOURCE_DECKS = "deck-ingester"
SOURCE_DECK_VALUES = "flink-deck-processor"
VERSION_CATALOGUE = "v5"
VERSION_DECKS = "v1"
# ---------------------------------------------------------------------------
