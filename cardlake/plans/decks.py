"""Deck queries over deck text generated from ``lineitem`` (one deck file per order).

Each line item becomes one deck line whose shape depends on its return flag, so
both parse rules are exercised on the whole table:
  R -> '+<qty> Part <partkey>'          (CLI keeps, library rejects the sign)
  A -> '<qty>\\tPart <partkey>'          (library keeps, CLI has no space after the number)
  N -> ' <qty> Part <partkey> \\r'       (both keep after trimming)
and some items add a junk line: a '//' comment (open items), a blank line (no
discount) or a 'Sideboard' header (no tax).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake import schemas
from cardlake.functions import columns as C
from cardlake.operators import aggregates as A
from cardlake.operators import joins as J
from cardlake.plans import register, table
from cardlake.session import spread
from cardlake.sources import decks as D
from cardlake.sources import envelopes as E

FIXED_TS = "2024-01-01 00:00:00"  # deterministic ingest stamp for reproducible events


def lineitem_deck_lines(li: DataFrame) -> DataFrame:
    qty = F.col("l_quantity").cast("int").cast("string")
    key = F.col("l_partkey").cast("string")
    path = F.concat(F.lit("decks/order-"), F.col("l_orderkey").cast("string"), F.lit(".deck"))
    main = (F.when(F.col("l_returnflag") == "R", F.concat(F.lit("+"), qty, F.lit(" Part "), key))
            .when(F.col("l_returnflag") == "A", F.concat(qty, F.lit("\tPart "), key))
            .otherwise(F.concat(F.lit(" "), qty, F.lit(" Part "), key, F.lit(" \r"))))
    extra = (F.when(F.col("l_linestatus") == "O",
                    F.concat(F.lit("// shipped "), F.date_format("l_shipdate", "yyyy-MM-dd")))
             .when(F.col("l_discount") == 0, F.lit(""))
             .when(F.col("l_tax") == 0, F.lit("Sideboard")))
    return (li.select(path.alias("file_path"), F.explode(F.array(main, extra)).alias("line"))
            .where(F.col("line").isNotNull()))


def _lines(spark, sf):
    # parsing is per-line CPU work: spread the (single-split) table over every core
    return lineitem_deck_lines(spread(table(spark, sf, "lineitem")))


# SQL pieces shared by the oracles ------------------------------------------------
SQL_PATH = "('decks/order-' || l_orderkey || '.deck')"
SQL_ID = ("(substr(md5({p}),1,8)||'-'||substr(md5({p}),9,4)||'-'||substr(md5({p}),13,4)||'-'||"
          "substr(md5({p}),17,4)||'-'||substr(md5({p}),21,12))")
SQL_LINES = f"""
  SELECT {SQL_PATH} AS file_path,
         CASE WHEN l_returnflag = 'R' THEN '+' || CAST(CAST(l_quantity AS INT) AS VARCHAR) || ' Part ' || l_partkey
              WHEN l_returnflag = 'A' THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) || chr(9) || 'Part ' || l_partkey
              ELSE ' ' || CAST(CAST(l_quantity AS INT) AS VARCHAR) || ' Part ' || l_partkey || ' ' || chr(13) END AS line
  FROM lineitem
  UNION ALL
  SELECT {SQL_PATH},
         CASE WHEN l_linestatus = 'O' THEN '// shipped ' || strftime(l_shipdate, '%Y-%m-%d')
              WHEN l_discount = 0 THEN ''
              WHEN l_tax = 0 THEN 'Sideboard' END
  FROM lineitem
  WHERE l_linestatus = 'O' OR l_discount = 0 OR l_tax = 0
"""


@register("deck_total_unique", f"""
SELECT {SQL_ID.format(p=SQL_PATH)} AS id,
       'Order ' || l_orderkey AS name,
       {SQL_PATH} AS file_path,
       SUM(CASE WHEN l_returnflag <> 'A' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS total_cards,
       COUNT(*) FILTER (WHERE l_returnflag <> 'A') AS unique_cards
FROM lineitem GROUP BY l_orderkey
""")
def deck_total_unique(spark, sf):
    graded = D.parse_deck_lines(_lines(spark, sf), rule="cli", keep_rejects=True)
    return D.summarise_decks(graded, rule="cli")


_CLI_SQL = r"""
WITH l AS ({lines}), t AS (SELECT file_path, trim(line, ' ' || chr(9) || chr(10) || chr(13)) AS t FROM l)
SELECT file_path, TRY_CAST(regexp_extract(t, '(?s)^([+-]?[0-9]+) (.*)$', 1) AS BIGINT) AS quantity,
       trim(regexp_extract(t, '(?s)^([+-]?[0-9]+) (.*)$', 2), ' ' || chr(9) || chr(10) || chr(13)) AS card_name
FROM t
WHERE t <> '' AND NOT starts_with(t, '//') AND NOT starts_with(t, '#')
  AND regexp_matches(t, '(?s)^([+-]?[0-9]+) (.*)$')
  AND TRY_CAST(regexp_extract(t, '(?s)^([+-]?[0-9]+) (.*)$', 1) AS BIGINT) > 0
  AND trim(regexp_extract(t, '(?s)^([+-]?[0-9]+) (.*)$', 2), ' ' || chr(9) || chr(10) || chr(13)) <> ''
"""


@register("deck_line_parse", _CLI_SQL.format(lines=SQL_LINES))
def deck_line_parse(spark, sf):
    return D.parse_deck_lines(_lines(spark, sf), rule="cli").select("file_path", "quantity", "card_name")


_LIB_SQL = r"""
WITH l AS ({lines}),
t AS (SELECT file_path, regexp_replace(line, '^[\t\n\x0B\f\r \x{{85}}\x{{A0}}]+|[\t\n\x0B\f\r \x{{85}}\x{{A0}}]+$', '', 'g') AS t FROM l)
SELECT file_path, TRY_CAST(regexp_extract(t, '(?s)^([0-9]+)[\t\n\f\r ]+(.+)$', 1) AS BIGINT) AS quantity,
       regexp_replace(regexp_extract(t, '(?s)^([0-9]+)[\t\n\f\r ]+(.+)$', 2),
                      '^[\t\n\x0B\f\r \x{{85}}\x{{A0}}]+|[\t\n\x0B\f\r \x{{85}}\x{{A0}}]+$', '', 'g') AS card_name
FROM t
WHERE t <> '' AND NOT starts_with(t, '//') AND NOT starts_with(t, '#')
  AND regexp_matches(t, '(?s)^([0-9]+)[\t\n\f\r ]+(.+)$')
  AND TRY_CAST(regexp_extract(t, '(?s)^([0-9]+)[\t\n\f\r ]+(.+)$', 1) AS BIGINT) >= 0
"""


@register("deck_line_parse_lib", _LIB_SQL.format(lines=SQL_LINES))
def deck_line_parse_lib(spark, sf):
    return D.parse_deck_lines(_lines(spark, sf), rule="library").select("file_path", "quantity", "card_name")


# Deck paths built from part names and types: 'SMALL' parts get '.deck.txt',
# 'PROMO' parts a bare '.txt', the rest '.deck'; words joined by '-' or '_'.
def _part_paths(part: DataFrame) -> DataFrame:
    stem = F.concat(F.lower(F.col("p_type")), F.lit("_"), F.regexp_replace("p_name", " ", "-"),
                    F.lit("-"), F.col("p_partkey").cast("string"), F.lit("."), F.lower(F.col("p_brand")))
    ext = (F.when(F.col("p_type") == "SMALL", ".deck.txt")
           .when(F.col("p_type") == "PROMO", ".txt").otherwise(".deck"))
    return part.select(F.col("p_partkey"), F.concat(F.lit("/decks/"), stem, ext).alias("file_path"))


SQL_PART_PATH = ("('/decks/' || lower(p_type) || '_' || replace(p_name, ' ', '-') || '-' || p_partkey || '.' "
                 "|| lower(p_brand) || CASE WHEN p_type = 'SMALL' THEN '.deck.txt' WHEN p_type = 'PROMO' THEN '.txt' "
                 "ELSE '.deck' END)")


@register("deck_name_from_path", f"""
WITH p AS (SELECT p_partkey, {SQL_PART_PATH} AS file_path FROM part),
n AS (SELECT p_partkey, file_path,
             replace(replace(regexp_replace(regexp_replace(regexp_extract(file_path, '[^/]*$', 0),
                     '(?s)^(.*)\\.deck.*$', '\\1'), '(?s)^(.*)\\.txt.*$', '\\1'), '-', ' '), '_', ' ') AS n FROM p)
SELECT p_partkey, file_path,
       array_to_string(list_transform(string_split(n, ' '),
           lambda w: CASE WHEN substr(w, 1, 1) >= 'a' AND substr(w, 1, 1) <= 'z'
                     THEN upper(substr(w, 1, 1)) || substr(w, 2) ELSE w END), ' ') AS deck_name
FROM n
""")
def deck_name_from_path(spark, sf):
    p = _part_paths(table(spark, sf, "part"))
    return p.select("p_partkey", "file_path", C.deck_name("file_path", "cli").alias("deck_name"))


@register("deck_name_from_path_lib", f"""
WITH p AS (SELECT p_partkey, {SQL_PART_PATH} AS file_path FROM part),
n AS (SELECT p_partkey, file_path,
             replace(replace(regexp_replace(regexp_replace(regexp_extract(file_path, '[^/]*$', 0),
                     '\\.deck$', ''), '\\.txt$', ''), '-', ' '), '_', ' ') AS n FROM p)
SELECT p_partkey, file_path,
       array_to_string(list_transform(
           regexp_extract_all(n, '([\\x00-\\x2F\\x3A-\\x40\\x5B-\\x5E\\x60\\x7B-\\x7F]*)([^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x5E\\x60\\x7B-\\x7F]*)', 0),
           lambda t: regexp_extract(t, '^([\\x00-\\x2F\\x3A-\\x40\\x5B-\\x5E\\x60\\x7B-\\x7F]*)', 1)
                || upper(substr(regexp_extract(t, '([^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x5E\\x60\\x7B-\\x7F]*)$', 1), 1, 1))
                || substr(regexp_extract(t, '([^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x5E\\x60\\x7B-\\x7F]*)$', 1), 2)), '') AS deck_name
FROM n
""")
def deck_name_from_path_lib(spark, sf):
    p = _part_paths(table(spark, sf, "part"))
    return p.select("p_partkey", "file_path", C.deck_name("file_path", "library").alias("deck_name"))


@register("deck_card_events", f"""
SELECT 'deck.card' AS eventType, md5({SQL_ID.format(p=SQL_PATH)} || '|' || 'Part ' || l_partkey || '|' || CAST(l_quantity AS BIGINT)) AS eventId,
       'deck-ingester' AS source, 'v1' AS version,
       {SQL_ID.format(p=SQL_PATH)} AS deck_id, 'Order ' || l_orderkey AS deck_name,
       'Part ' || l_partkey AS card_name, CAST(l_quantity AS BIGINT) AS quantity
FROM lineitem WHERE l_returnflag <> 'A'
""")
def deck_card_events(spark, sf):
    parsed = D.parse_deck_lines(_lines(spark, sf), rule="cli")
    cards = D.deck_cards(parsed)
    ev = E.build_envelope(
        cards, schemas.EVENT_DECK_CARD, schemas.SOURCE_DECKS, schemas.VERSION_DECKS,
        payload=["deck_id", "deck_name", "card_name", "quantity"],
        event_id=F.md5(F.concat_ws("|", F.col("deck_id"), F.col("card_name"), F.col("quantity").cast("string"))),
        timestamp=F.lit(FIXED_TS).cast("timestamp"))
    # round trip: decode what was published
    dec = E.decode_envelope(ev, schemas.DECK_CARD)
    return dec.select("eventType", "eventId", "source", "version", "data.*")


@register("deck_json_preview", f"""
SELECT {SQL_PATH} AS file_path,
       '{{"id":"' || {SQL_ID.format(p=SQL_PATH)} || '","name":"Order ' || l_orderkey || '","file_path":"' || {SQL_PATH}
       || '","total_cards":' || SUM(CASE WHEN l_returnflag <> 'A' THEN CAST(l_quantity AS BIGINT) ELSE 0 END)
       || ',"unique_cards":' || COUNT(*) FILTER (WHERE l_returnflag <> 'A') || '}}' AS json
FROM lineitem GROUP BY l_orderkey
""")
def deck_json_preview(spark, sf):
    decks = D.summarise_decks(D.parse_deck_lines(_lines(spark, sf), keep_rejects=True))
    return decks.select("file_path", F.to_json(F.struct(*decks.columns)).alias("json"))


@register("ingest_counters", f"""
WITH l AS ({SQL_LINES})
SELECT CASE WHEN trim(line, ' ' || chr(9) || chr(10) || chr(13)) = '' THEN 'blank'
            WHEN starts_with(trim(line, ' ' || chr(9) || chr(10) || chr(13)), '//') THEN 'comment'
            WHEN line LIKE '%' || chr(9) || '%' OR line = 'Sideboard' THEN 'malformed'
            ELSE 'accepted' END AS outcome,
       COUNT(*) AS n_lines
FROM l GROUP BY 1
""")
def ingest_counters(spark, sf):
    """Accepted / rejected-by-reason line counts of a deck ingest (what the job logs)."""
    parsed = D.parse_deck_lines(_lines(spark, sf), keep_rejects=True)
    return (parsed.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n_lines")))


# ---------------------------------------------------------------------------
# Deck values: one value event per order (deck = customer, total_value =
# o_totalprice, total_cards = Σ quantity of the order's line items, calculated_at =
# order date in epoch millis, offset = order key). Customers re-value their
# deck with every order, so "latest per deck" matters.
# ---------------------------------------------------------------------------
def deck_value_events(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    cards = lineitem.groupBy("l_orderkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("total_cards"))
    o = orders.join(cards, orders["o_orderkey"] == cards["l_orderkey"], "inner")
    return o.select(
        F.concat(F.lit("deck-"), F.col("o_custkey").cast("string")).alias("deck_id"),
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("deck_name"),
        "total_cards", F.col("o_totalprice").alias("total_value"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("calculated_at"),
        F.col("o_orderkey").alias("offset"))


SQL_VALUE_EVENTS = """
SELECT 'deck-' || o_custkey AS deck_id, 'Customer ' || o_custkey AS deck_name, c.total_cards,
       o_totalprice AS total_value, epoch_us(o_orderdate) // 1000 AS calculated_at, o_orderkey AS "offset"
FROM orders JOIN (SELECT l_orderkey, SUM(CAST(l_quantity AS BIGINT)) AS total_cards FROM lineitem GROUP BY 1) c
  ON o_orderkey = c.l_orderkey
"""
SQL_LATEST = f"""
SELECT deck_id, arg_max(deck_name, (calculated_at, "offset")) AS deck_name,
       arg_max(total_cards, (calculated_at, "offset")) AS total_cards,
       arg_max(total_value, (calculated_at, "offset")) AS total_value,
       arg_max(calculated_at, (calculated_at, "offset")) AS last_updated
FROM ({SQL_VALUE_EVENTS}) v GROUP BY deck_id
"""


def _value_events(spark, sf):
    return deck_value_events(table(spark, sf, "orders"), table(spark, sf, "lineitem"))


def deck_values_latest(events: DataFrame) -> DataFrame:
    latest = A.latest_by(events, ["deck_id"], ["calculated_at", "offset"],
                         ["deck_name", "total_cards", "total_value", "calculated_at"])
    return latest.withColumnRenamed("calculated_at", "last_updated")


def _latest(spark, sf):
    return deck_values_latest(_value_events(spark, sf))


@register("deck_value_event", f"""
SELECT 'deck.value.calculated' AS eventType, md5('value|' || "offset") AS eventId, calculated_at AS "timestamp",
       'flink-deck-processor' AS source, 'v1' AS version, deck_id, deck_name, total_cards, total_value, calculated_at
FROM ({SQL_VALUE_EVENTS}) v
""")
def deck_value_event(spark, sf):
    v = _value_events(spark, sf)
    ev = E.build_envelope(v, schemas.EVENT_DECK_VALUE, schemas.SOURCE_DECK_VALUES, schemas.VERSION_DECKS,
                          payload=["deck_id", "deck_name", "total_cards", "total_value", "calculated_at"],
                          event_id=F.md5(F.concat(F.lit("value|"), F.col("offset").cast("string"))),
                          timestamp=F.timestamp_millis("calculated_at"), timestamp_as_millis=True)
    d = E.decode_envelope(ev, schemas.DECK_VALUE)
    return d.select("eventType", "eventId", F.unix_millis("event_ts").alias("timestamp"), "source", "version",
                    "data.*")


@register("deck_value_estimated", f"""
SELECT {SQL_PATH} AS file_path,
       SUM(CASE WHEN l_returnflag <> 'A' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS total_cards,
       SUM(CASE WHEN l_returnflag <> 'A' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) * 5.0 AS estimated_value
FROM lineitem GROUP BY l_orderkey
""")
def deck_value_estimated(spark, sf, unit_price: float = 5.0):
    decks = D.summarise_decks(D.parse_deck_lines(_lines(spark, sf), keep_rejects=True))
    return decks.select("file_path", "total_cards", C.estimate_value("total_cards", unit_price).alias("estimated_value"))


@register("deck_portfolio_value", """
WITH d AS (SELECT SUM(CASE WHEN l_returnflag <> 'A' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) * 5.0 AS v,
                  SUM(CASE WHEN l_returnflag <> 'A' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS n
           FROM lineitem GROUP BY l_orderkey)
SELECT COUNT(*) AS total_decks, SUM(n) AS total_cards, CAST(SUM(CAST(v AS DECIMAL(18,2))) AS DOUBLE) AS combined_value,
       CAST(SUM(CAST(v AS DECIMAL(18,2))) AS DOUBLE) / COUNT(v) AS average_deck_value,
       MAX(v) AS most_expensive_deck, MIN(v) AS cheapest_deck
FROM d
""")
def deck_portfolio_value(spark, sf, unit_price: float = 5.0):
    """Flagship: a directory of deck texts -> per-deck totals -> estimated values -> portfolio."""
    decks = D.summarise_decks(D.parse_deck_lines(_lines(spark, sf), keep_rejects=True))
    valued = decks.withColumn("total_value", C.estimate_value("total_cards", unit_price))
    return A.portfolio_stats(valued, extra=[F.sum("total_cards").alias("total_cards")])


@register("deck_value_priced", f"""
WITH lines AS (SELECT {SQL_ID.format(p=SQL_PATH)} AS deck_id, 'Part ' || l_partkey AS card_name,
                      CAST(l_quantity AS BIGINT) AS quantity FROM lineitem WHERE l_returnflag <> 'A'),
names AS (SELECT 'Part ' || p_partkey AS name, MIN(CAST(p_partkey AS VARCHAR)) AS uuid FROM part GROUP BY 1),
latest AS (SELECT CAST(l_partkey AS VARCHAR) AS uuid,
                  arg_max(l_extendedprice, (l_shipdate, l_orderkey, l_linenumber, l_extendedprice)) AS price
           FROM lineitem GROUP BY 1)
SELECT deck_id, SUM(quantity) AS total_cards,
       CAST(COALESCE(SUM(CAST(quantity AS DECIMAL(20,0)) * CAST(price AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_value,
       COUNT(*) FILTER (WHERE price IS NULL) AS unpriced_lines
FROM lines LEFT JOIN names ON lines.card_name = names.name LEFT JOIN latest ON names.uuid = latest.uuid
GROUP BY deck_id
""")
def deck_value_priced(spark, sf):
    """Decks valued with real prices: line name -> card -> newest price; unmatched lines are
    counted, not guessed."""
    cards = D.deck_cards(D.parse_deck_lines(_lines(spark, sf)))
    part = table(spark, sf, "part")
    catalogue = part.select(F.concat(F.lit("Part "), F.col("p_partkey").cast("string")).alias("name"),
                            F.col("p_partkey").cast("string").alias("uuid"))
    li = spread(table(spark, sf, "lineitem"))  # sort-based latest-price aggregate: use every core
    prices = li.select(F.col("l_partkey").cast("string").alias("card_uuid"), F.col("l_extendedprice").alias("price"),
                       "l_shipdate", "l_orderkey", "l_linenumber")
    return J.value_decks(cards, catalogue, prices,
                         price_order=["l_shipdate", "l_orderkey", "l_linenumber", "price"])


@register("deck_avg_card_value", f"""
SELECT deck_name, total_cards, total_value, CAST(total_value AS DOUBLE) / total_cards AS avg_card_value
FROM ({SQL_LATEST}) l WHERE total_value > 0 ORDER BY total_value DESC
""")
def deck_avg_card_value(spark, sf):
    latest = _latest(spark, sf).where(F.col("total_value") > 0)
    return latest.select("deck_name", "total_cards", "total_value",
                         C.avg_item_value("total_value", "total_cards").alias("avg_card_value")) \
        .orderBy(F.desc("total_value"))


@register("deck_over_threshold", f"""
SELECT deck_name, total_value, total_cards FROM ({SQL_LATEST}) l WHERE total_value > 400000
""")
def deck_over_threshold(spark, sf, threshold: float = 400000.0):
    return _latest(spark, sf).where(F.col("total_value") > threshold).select("deck_name", "total_value", "total_cards")


@register("deck_format_bucket", f"""
SELECT CASE WHEN total_cards <= 60 THEN 'Standard (60 cards)' WHEN total_cards <= 75 THEN 'Limited (75 cards)'
            WHEN total_cards = 100 THEN 'Commander (100 cards)' ELSE 'Other' END AS format,
       COUNT(*) AS deck_count, CAST(SUM(CAST(total_value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(total_value) AS avg_value
FROM ({SQL_LATEST}) l GROUP BY 1
""")
def deck_format_bucket(spark, sf):
    return A.bucket_stats(_latest(spark, sf))


@register("portfolio_stats", f"""
SELECT COUNT(*) AS total_decks, CAST(SUM(CAST(total_value AS DECIMAL(18,2))) AS DOUBLE) AS combined_value,
       CAST(SUM(CAST(total_value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(total_value) AS average_deck_value,
       MAX(total_value) AS most_expensive_deck, MIN(total_value) AS cheapest_deck
FROM ({SQL_LATEST}) l
""")
def portfolio_stats(spark, sf):
    """Portfolio over the *latest* value of each deck (two-level aggregate)."""
    return A.portfolio_stats(_latest(spark, sf))


@register("deck_value_raw_stats", f"""
SELECT COUNT(*) AS total_decks, CAST(SUM(CAST(total_value AS DECIMAL(18,2))) AS DOUBLE) AS combined_value,
       CAST(SUM(CAST(total_value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(total_value) AS average_deck_value,
       MAX(total_value) AS most_expensive_deck, MIN(total_value) AS cheapest_deck
FROM ({SQL_VALUE_EVENTS}) v
""")
def deck_value_raw_stats(spark, sf):
    """The same statistics over every value event (no latest-dedupe): re-valued decks count again."""
    return A.portfolio_stats(_value_events(spark, sf))


@register("deck_value_lines", f"""
SELECT DISTINCT deck_name || ': $' || regexp_replace(regexp_replace(CAST(CAST(total_value AS DECIMAL(18,2)) AS VARCHAR),
                '(\\.[0-9]*?)0+$', '\\1'), '\\.$', '') || ' (' || total_cards || ' cards)' AS line
FROM ({SQL_VALUE_EVENTS}) v ORDER BY line
""")
def deck_value_lines(spark, sf):
    """'<name>: $<value> (<n> cards)' per value event, distinct and sorted."""
    v = _value_events(spark, sf)
    line = F.concat(F.col("deck_name"), F.lit(": $"), C.money_text("total_value"), F.lit(" ("),
                    F.col("total_cards").cast("string"), F.lit(" cards)"))
    return v.select(line.alias("line")).distinct().orderBy("line")


@register("deck_composition_view", """
SELECT o.o_orderkey AS deck_id, 'Order ' || o.o_orderkey AS deck_name, p.p_name AS card_name,
       CAST(l.l_quantity AS BIGINT) AS quantity, l.l_returnflag = 'R' AS is_sideboard, p.p_size % 8 AS cmc
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN part p ON l.l_partkey = p.p_partkey
ORDER BY deck_name, is_sideboard, cmc, card_name
""")
def deck_composition_view(spark, sf):
    """decks ⋈ deck_cards ⋈ cards, ordered by deck, sideboard, cmc, name."""
    o = table(spark, sf, "orders").select("o_orderkey")
    li = spread(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag"))
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    j = o.join(li, o["o_orderkey"] == li["l_orderkey"]).join(p, li["l_partkey"] == p["p_partkey"])
    out = j.select(F.col("o_orderkey").alias("deck_id"),
                   F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("deck_name"),
                   F.col("p_name").alias("card_name"), F.col("l_quantity").cast("bigint").alias("quantity"),
                   (F.col("l_returnflag") == "R").alias("is_sideboard"), (F.col("p_size") % 8).alias("cmc"))
    return out.orderBy("deck_name", "is_sideboard", "cmc", "card_name")
