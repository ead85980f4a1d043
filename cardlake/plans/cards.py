"""Card queries over ``part`` read as a card catalogue.

Analogue (every column derived from the row):
  uuid = p_partkey, name = p_name, set_code = p_brand, card_type = last word of p_name,
  rarity = PROMO->mythic, LARGE->rare, MEDIUM->uncommon, else common,
  cmc = p_size % 8, colors = sorted distinct vowels of p_name, except: p_size < 3 -> []
  (colorless), p_size > 48 -> all five, ECONOMY parts -> NULL (list omitted).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.functions import columns as C
from cardlake.operators import aggregates as A
from cardlake.operators import transforms as T
from cardlake.plans import register, table
from cardlake.sources import envelopes as E
from cardlake import schemas

FIXED_TS = "2024-01-01 00:00:00"


def part_cards(part: DataFrame) -> DataFrame:
    vowels = F.array_sort(F.array_distinct(F.regexp_extract_all(F.col("p_name"), F.lit("[aeiou]"), 0)))
    colors = (F.when(F.col("p_type") == "ECONOMY", F.lit(None).cast("array<string>"))
              .when(F.col("p_size") < 3, F.array().cast("array<string>"))
              .when(F.col("p_size") > 48, F.array(*[F.lit(x) for x in "aeiou"]))
              .otherwise(vowels))
    rarity = (F.when(F.col("p_type") == "PROMO", "mythic").when(F.col("p_type") == "LARGE", "rare")
              .when(F.col("p_type") == "MEDIUM", "uncommon").otherwise("common"))
    return part.select(
        F.col("p_partkey").cast("string").alias("uuid"), F.col("p_name").alias("name"),
        F.col("p_brand").alias("set_code"), F.regexp_extract("p_name", r"(\S+)$", 1).alias("card_type"),
        rarity.alias("rarity"), (F.col("p_size") % 8).cast("double").alias("cmc"), colors.alias("colors"),
        F.col("p_retailprice").alias("list_price"))


SQL_CARDS = r"""
SELECT CAST(p_partkey AS VARCHAR) AS uuid, p_name AS name, p_brand AS set_code,
       regexp_extract(p_name, '(\S+)$', 1) AS card_type,
       CASE p_type WHEN 'PROMO' THEN 'mythic' WHEN 'LARGE' THEN 'rare' WHEN 'MEDIUM' THEN 'uncommon' ELSE 'common' END AS rarity,
       CAST(p_size % 8 AS DOUBLE) AS cmc,
       CASE WHEN p_type = 'ECONOMY' THEN NULL WHEN p_size < 3 THEN []::VARCHAR[]
            WHEN p_size > 48 THEN ['a','e','i','o','u']
            ELSE list_sort(list_distinct(regexp_extract_all(p_name, '[aeiou]'))) END AS colors,
       p_retailprice AS list_price
FROM part
"""


def _cards(spark, sf):
    return part_cards(table(spark, sf, "part"))


@register("card_enrichment_tier", f"""
WITH c AS ({SQL_CARDS})
SELECT uuid, name, rarity, cmc, COALESCE(len(colors), 0) AS color_count, COALESCE(len(colors), 0) > 1 AS multicolored,
       CASE WHEN COALESCE(cmc, 0) <= 2 THEN 'low' WHEN COALESCE(cmc, 0) <= 4 THEN 'medium' ELSE 'high' END AS mana_cost_tier
FROM c
""")
def card_enrichment_tier(spark, sf):
    e = T.enrich_cards(_cards(spark, sf), processed_at=F.lit(FIXED_TS).cast("timestamp"))
    return e.select("uuid", "name", "rarity", "cmc", "color_count", "multicolored", "mana_cost_tier")


@register("color_category_distribution", f"""
WITH c AS ({SQL_CARDS})
SELECT CASE len(colors) WHEN 0 THEN 'Colorless' WHEN 1 THEN 'Monocolored' WHEN 2 THEN 'Two-colored'
            WHEN 3 THEN 'Three-colored' WHEN 4 THEN 'Four-colored' WHEN 5 THEN 'Five-colored' ELSE 'Unknown' END
         AS color_category,
       COUNT(*) AS card_count
FROM c GROUP BY 1
""")
def color_category_distribution(spark, sf):
    c = _cards(spark, sf).withColumn("color_category", C.color_category("colors"))
    return A.distribution(c, "color_category", count_name="card_count")


@register("array_group_count", f"""
WITH c AS ({SQL_CARDS})
SELECT array_to_string(colors, ',') AS colors_key, colors IS NULL AS colors_missing, COUNT(*) AS count
FROM c GROUP BY colors
""")
def array_group_count(spark, sf):
    g = A.distribution(_cards(spark, sf), "colors", count_name="count")
    return g.select(F.array_join("colors", ",").alias("colors_key"),
                    F.col("colors").isNull().alias("colors_missing"), "count")


@register("rare_filter", f"""
WITH c AS ({SQL_CARDS})
SELECT uuid, name AS card_name, rarity, card_type FROM c WHERE rarity IN ('rare', 'mythic')
""")
def rare_filter(spark, sf):
    c = _cards(spark, sf)
    return c.where(F.col("rarity").isin("rare", "mythic")).select(
        "uuid", F.col("name").alias("card_name"), "rarity", "card_type")


def card_search_df(cards: DataFrame, term: str, limit: int = 10, literal: bool = False) -> DataFrame:
    """Case-insensitive name search; '%'/'_' in the term act as wildcards unless literal."""
    name = F.lower(F.col("name"))
    cond = name.contains(term.lower()) if literal else name.like(f"%{term.lower()}%")
    return cards.where(cond).orderBy("name", "uuid").limit(limit)


@register("card_search", f"""
WITH c AS ({SQL_CARDS})
SELECT name, card_type, rarity, uuid FROM c WHERE lower(name) LIKE lower('%Ring%') ORDER BY name, uuid LIMIT 10
""")
def card_search(spark, sf):
    return card_search_df(_cards(spark, sf), "Ring").select("name", "card_type", "rarity", "uuid")


@register("rarity_distribution", f"""
WITH c AS ({SQL_CARDS}) SELECT rarity, COUNT(*) AS card_count FROM c GROUP BY rarity
""")
def rarity_distribution(spark, sf):
    return A.distribution(_cards(spark, sf), "rarity", count_name="card_count")


@register("type_counts", f"""
WITH c AS ({SQL_CARDS}) SELECT card_type, COUNT(*) AS count FROM c GROUP BY card_type
""")
def type_counts(spark, sf):
    return A.distribution(_cards(spark, sf), "card_type", count_name="count")


@register("cards_by_set", f"""
WITH c AS ({SQL_CARDS})
SELECT set_code, COUNT(*) AS card_count FROM c GROUP BY set_code ORDER BY card_count DESC, set_code LIMIT 10
""")
def cards_by_set(spark, sf):
    d = A.distribution(_cards(spark, sf), "set_code", count_name="card_count")
    return d.orderBy(F.desc("card_count"), "set_code").limit(10)


@register("conditional_counts", f"""
WITH c AS ({SQL_CARDS})
SELECT COUNT(*) AS total, COUNT(CASE WHEN rarity = 'mythic' THEN 1 END) AS mythic_count,
       COUNT(CASE WHEN rarity = 'rare' THEN 1 END) AS rare_count FROM c
""")
def conditional_counts(spark, sf):
    r = F.col("rarity")
    return A.conditional_counts(_cards(spark, sf), None, {"mythic_count": r == "mythic", "rare_count": r == "rare"})


@register("rarity_share", f"""
WITH c AS ({SQL_CARDS}), g AS (SELECT rarity, COUNT(*) AS card_count FROM c GROUP BY rarity)
SELECT rarity, card_count, CAST(card_count * 100.0 AS DOUBLE) / SUM(card_count) OVER () AS pct FROM g
""")
def rarity_share(spark, sf):
    return A.distribution(_cards(spark, sf), "rarity", count_name="card_count", with_share=True)


@register("card_details_view", """
SELECT s.s_suppkey AS code, s.s_name AS name, s.s_acctbal AS balance,
       COALESCE(n.n_name, 'Unknown') AS set_name, n.n_regionkey AS region
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
""")
def card_details_view(spark, sf):
    """cards LEFT JOIN sets on the set code (here: supplier -> nation);
    a card without a set shows the default."""
    sup = table(spark, sf, "supplier")
    nat = table(spark, sf, "nation")
    j = sup.join(nat, sup["s_nationkey"] == nat["n_nationkey"], "left")
    return j.select(F.col("s_suppkey").alias("code"), F.col("s_name").alias("name"),
                    F.col("s_acctbal").alias("balance"),
                    F.coalesce("n_name", F.lit("Unknown")).alias("set_name"), F.col("n_regionkey").alias("region"))


@register("event_envelope_build", f"""
WITH c AS ({SQL_CARDS})
SELECT uuid AS key, 'card.created' AS eventType, md5('card|' || uuid) AS eventId, 'mtgjson' AS source, 'v5' AS version,
       uuid, name, set_code AS setCode, rarity, cmc AS convertedManaCost, array_to_string(colors, ',') AS colors
FROM c
""")
def event_envelope_build(spark, sf):
    c = _cards(spark, sf)
    ev = E.build_envelope(
        c, schemas.EVENT_CARD, schemas.SOURCE_CATALOGUE, schemas.VERSION_CATALOGUE, payload_key="card",
        payload=["uuid", "name", F.col("set_code").alias("setCode"), "rarity",
                 F.col("cmc").alias("convertedManaCost"), "colors"],
        event_id=F.md5(F.concat(F.lit("card|"), F.col("uuid"))),
        timestamp=F.lit(FIXED_TS).cast("timestamp"), key=F.col("uuid"))
    dec = E.decode_envelope(ev, schemas.CARD, payload_key="card", keep=("key",))
    return dec.select("key", "eventType", "eventId", "source", "version", "card.uuid", "card.name",
                      "card.setCode", "card.rarity", "card.convertedManaCost",
                      F.array_join("card.colors", ",").alias("colors"))


@register("child_table_explode", f"""
WITH c AS ({SQL_CARDS}),
lg AS (SELECT uuid, 'standard' AS k, CASE WHEN rarity = 'mythic' THEN 'banned' ELSE 'legal' END AS v FROM c
       UNION ALL SELECT uuid, 'commander', CASE WHEN cmc > 5 THEN 'restricted' ELSE 'legal' END FROM c)
SELECT 'card_legalities' AS "table", uuid AS card_uuid, k AS key, v AS value FROM lg
UNION ALL
SELECT DISTINCT 'card_subtypes', uuid, unnest(string_split(name, ' ')), NULL FROM c
UNION ALL
SELECT DISTINCT 'card_keywords', uuid, unnest(colors), NULL FROM c
""")
def child_table_explode(spark, sf):
    c = _cards(spark, sf).withColumn(
        "legalities", F.create_map(
            F.lit("standard"), F.when(F.col("rarity") == "mythic", "banned").otherwise("legal"),
            F.lit("commander"), F.when(F.col("cmc") > 5, "restricted").otherwise("legal"))
    ).withColumn("subtypes", F.split("name", " "))
    return T.child_tables(c, key="uuid", legalities="legalities",
                          arrays={"card_subtypes": "subtypes", "card_keywords": "colors"})


@register("result_json_rows", """
SELECT s_suppkey AS id,
       '{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '","n_name":' ||
       COALESCE('"' || n_name || '"', 'null') || '}' AS json,
       COALESCE(n_name, '-') AS n_name_display
FROM supplier LEFT JOIN nation n ON s_nationkey = n_nationkey
""")
def result_json_rows(spark, sf):
    """Result rows rendered for display: the row as JSON, NULLs shown as '-'."""
    sup = table(spark, sf, "supplier")
    nat = table(spark, sf, "nation")
    j = sup.join(nat, sup["s_nationkey"] == nat["n_nationkey"], "left").select("s_suppkey", "s_name", "n_name")
    return j.select(F.col("s_suppkey").alias("id"),
                    F.to_json(F.struct("s_suppkey", "s_name", "n_name"), {"ignoreNullFields": "false"}).alias("json"),
                    F.coalesce("n_name", F.lit("-")).alias("n_name_display"))
