"""Row transforms: card enrichment, child tables, price-table shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.functions import columns as C
from cardlake.operators.aggregates import latest_row


def enrich_cards(cards: DataFrame, colors_col: str = "colors", cmc_col: str = "cmc",
                 processed_at=None) -> DataFrame:
    """Add color_count, multicolored, mana_cost_tier and processed_at.

    A card without a colour list (empty lists are omitted on write, so they read
    as NULL) keeps the defaults 0 / false. A missing cost counts as 0 -> 'low'.
    """
    colors = F.col(colors_col)
    n = F.coalesce(F.array_size(colors), F.lit(0))
    stamp = processed_at if processed_at is not None else F.current_timestamp()
    return cards.select(
        "*",
        n.cast("int").alias("color_count"),
        (n > 1).alias("multicolored"),
        C.mana_cost_tier(cmc_col).alias("mana_cost_tier"),
        stamp.alias("processed_at"),
    )


def child_tables(cards: DataFrame, key: str = "uuid", legalities: str | None = "legalities",
                 arrays: dict[str, str] | None = None) -> DataFrame:
    """Normalise a card's map and array columns into child rows
    (table, card_uuid, key, value), deduplicated on each child table's primary key.

    legalities map -> ('card_legalities', uuid, format, legality), PK (uuid, format);
    arrays         -> (<table>, uuid, value, NULL), PK (uuid, value).
    """
    parts = []
    if legalities:
        lg = cards.select(F.col(key).alias("card_uuid"), F.explode(legalities).alias("key", "value"))
        lg = lg.groupBy("card_uuid", "key").agg(F.min("value").alias("value"))
        parts.append(lg.select(F.lit("card_legalities").alias("table"), "card_uuid", "key", "value"))
    for table_name, col in (arrays or {}).items():
        a = cards.select(F.col(key).alias("card_uuid"), F.explode(col).alias("key")).distinct()
        parts.append(a.select(F.lit(table_name).alias("table"), "card_uuid", "key",
                              F.lit(None).cast("string").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def to_price_table(rows: DataFrame, order_cols: list[str], uuid_col: str = "card_uuid",
                   source_col: str = "source", foil_col: str = "foil", date_col: str = "date",
                   price_col: str = "price", currency_col: str = "currency",
                   default_currency: str = "USD") -> DataFrame:
    """Flattened price rows -> card_prices shape, one row per unique key
    (card_uuid, source, price_type, price_date), newest row (by ``order_cols``) wins.
    price_type is 'foil' / 'normal'; price is DECIMAL(10,2); date a DATE; currency comes
    from the flattened tree's currency sibling when present, else ``default_currency``."""
    shaped = rows.select(
        F.col(uuid_col).alias("card_uuid"), F.col(source_col).alias("source"),
        F.when(F.col(foil_col), "foil").otherwise("normal").alias("price_type"),
        F.to_date(F.col(date_col)).alias("price_date"),
        F.col(price_col).cast("decimal(10,2)").alias("price"),
        (F.coalesce(F.col(currency_col), F.lit(default_currency)) if currency_col in rows.columns
         else F.lit(default_currency)).alias("currency"),
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)],
    )
    return latest_row(shaped, ["card_uuid", "source", "price_type", "price_date"],
                      [f"_o{i}" for i in range(len(order_cols))], ["price", "currency"])
