"""Catalogue document queries: set dumps with nested cards and atomic-card dumps,
landed one document per line and built here from ``part`` (one document per part,
so each document stays bounded in size however large the table grows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake import schemas
from cardlake.plans import register, table
from cardlake.plans.cards import SQL_CARDS, part_cards
from cardlake.sources import catalog as CAT
from cardlake.session import spread

FIXED_TS = "2024-01-01 00:00:00"


def _card_struct(c: DataFrame, suffix: str = "") -> F.Column:
    return F.struct(
        F.concat(F.col("uuid"), F.lit(suffix)).alias("uuid"),
        F.concat(F.col("name"), F.lit(" (alt)" if suffix else "")).alias("name"),
        F.col("cmc").alias("convertedManaCost"), F.col("card_type").alias("type"),
        F.col("colors").alias("colors"), F.col("set_code").alias("setCode"), F.col("rarity").alias("rarity"))


def set_documents(part: DataFrame) -> DataFrame:
    """(key = set code, doc = Set JSON with 1-2 cards); SMALL parts land wrapped in {meta, data}."""
    c = part_cards(part).join(part.select(F.col("p_partkey").cast("string").alias("uuid"), "p_size", "p_type"),
                              "uuid")
    cards = F.when(F.col("p_size") > 25, F.array(_card_struct(c), _card_struct(c, "-alt"))) \
        .otherwise(F.array(_card_struct(c)))
    s = F.struct(F.col("set_code").alias("code"), F.concat(F.lit("Set "), F.col("set_code")).alias("name"),
                 F.lit("expansion").alias("type"), F.col("p_size").alias("baseSetSize"),
                 (F.col("p_size") + 1).alias("totalSetSize"), cards.alias("cards"))
    doc = F.to_json(s)
    doc = F.when(F.col("p_type") == "SMALL", F.concat(F.lit('{"meta":{"version":"5"},"data":'), doc, F.lit("}"))) \
        .otherwise(doc)
    return c.select(F.col("set_code").alias("key"), doc.alias("doc"))


SQL_SET_CARDS = f"""
SELECT c.set_code, c.uuid, c.name, c.rarity, c.card_type AS type, c.cmc AS convertedManaCost FROM ({SQL_CARDS}) c
UNION ALL
SELECT c.set_code, c.uuid || '-alt', c.name || ' (alt)', c.rarity, c.card_type, c.cmc
FROM ({SQL_CARDS}) c JOIN part p ON c.uuid = CAST(p.p_partkey AS VARCHAR) WHERE p.p_size > 25
"""


@register("set_catalog_flatten", SQL_SET_CARDS)
def set_catalog_flatten(spark, sf):
    _, cards = CAT.flatten_sets(set_documents(spread(table(spark, sf, "part"))),
                                processed_at=F.lit(FIXED_TS).cast("timestamp"))
    return cards.select("set_code", "uuid", "name", "rarity", "type", "convertedManaCost")


@register("set_fanout_cards", f"""
SELECT 'set.created' AS eventType, p_brand AS key, p_brand AS set_code, NULL AS card_uuid,
       '{FIXED_TS}' AS processed_at FROM part
UNION ALL
SELECT 'card.created', uuid, set_code, uuid, '{FIXED_TS}' FROM ({SQL_SET_CARDS}) s
""")
def set_fanout_cards(spark, sf):
    """One set event per set document (cards stripped) and one card event per card,
    all carrying the same ingest stamp."""
    sets, cards = CAT.flatten_sets(set_documents(spread(table(spark, sf, "part"))),
                                   processed_at=F.lit(FIXED_TS).cast("timestamp"))
    set_ev = sets.select(F.lit(schemas.EVENT_SET).alias("eventType"), F.col("code").alias("key"),
                         F.col("code").alias("set_code"), F.lit(None).cast("string").alias("card_uuid"),
                         F.col("processedAt").alias("processed_at"))
    card_ev = cards.select(F.lit(schemas.EVENT_CARD).alias("eventType"), F.col("uuid").alias("key"), "set_code",
                           F.col("uuid").alias("card_uuid"), F.col("processedAt").alias("processed_at"))
    return set_ev.unionByName(card_ev)


def atomic_documents(part: DataFrame) -> DataFrame:
    """(key = card name, doc = JSON list of variants). Per part type:
    STANDARD -> first variant is not an object (skipped), MEDIUM -> empty list (skipped),
    ECONOMY -> first variant has no name, PROMO -> first variant has no uuid."""
    c = part_cards(part).join(part.select(F.col("p_partkey").cast("string").alias("uuid"), "p_type"), "uuid")
    key = F.concat(F.col("name"), F.lit(" #"), F.col("uuid"))
    t = F.col("p_type")
    first = F.to_json(F.struct(
        F.when(t != "PROMO", F.col("uuid")).alias("uuid"),
        F.when(t != "ECONOMY", F.col("name")).alias("name"),
        F.col("cmc").alias("convertedManaCost"), F.col("rarity").alias("rarity"),
        F.col("set_code").alias("setCode")))
    second = F.to_json(F.struct(F.concat(F.col("uuid"), F.lit("-v2")).alias("uuid"), F.col("name").alias("name")))
    doc = (F.when(t == "STANDARD", F.concat(F.lit('["bad",'), first, F.lit("]")))
           .when(t == "MEDIUM", F.lit("[]"))
           .otherwise(F.concat(F.lit("["), first, F.lit(","), second, F.lit("]"))))
    return c.select(key.alias("key"), doc.alias("doc"))


@register("first_variant_canonical", f"""
WITH c AS ({SQL_CARDS}), p AS (SELECT c.*, part.p_type, c.name || ' #' || c.uuid AS k
                               FROM c JOIN part ON c.uuid = CAST(part.p_partkey AS VARCHAR))
SELECT CASE WHEN p_type = 'PROMO'
            THEN substr(md5(k),1,8)||'-'||substr(md5(k),9,4)||'-'||substr(md5(k),13,4)||'-'||substr(md5(k),17,4)||'-'||substr(md5(k),21,12)
            ELSE uuid END AS uuid,
       CASE WHEN p_type = 'ECONOMY' THEN k ELSE name END AS name,
       rarity, set_code AS setCode, cmc AS convertedManaCost
FROM p WHERE p_type NOT IN ('STANDARD', 'MEDIUM')
""")
def first_variant_canonical(spark, sf):
    cards = CAT.first_variant(atomic_documents(spread(table(spark, sf, "part"))))
    return cards.select("uuid", "name", "rarity", "setCode", "convertedManaCost")
