"""Validation and merge queries: referential checks and the latest-wins upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardlake.operators import joins as J
from cardlake.operators import sinks as S
from cardlake.plans import register, table
from cardlake.session import spread

# (relation, child table, child key, parent table, parent key)
REFERENCES = [
    ("lineitem.l_orderkey->orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem.l_partkey->part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem.l_suppkey->supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders.o_custkey->customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("customer.c_nationkey->nation", "customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier.s_nationkey->nation", "supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation.n_regionkey->region", "nation", "n_regionkey", "region", "r_regionkey"),
    ("labels.doc_id->documents", "labels", "doc_id", "documents", "doc_id"),
]


def _sql_ref(rel, child, ck, parent, pk):
    return (f"SELECT '{rel}' AS relation, (SELECT COUNT(*) FROM {child}) AS child_rows, "
            f"(SELECT COUNT(*) FROM {child} WHERE {ck} IS NOT NULL AND {ck} NOT IN (SELECT {pk} FROM {parent} WHERE {pk} IS NOT NULL)) AS orphan_rows, "
            f"(SELECT COUNT(DISTINCT {pk}) FROM {parent} WHERE {pk} NOT IN (SELECT {ck} FROM {child} WHERE {ck} IS NOT NULL)) AS childless_parents")


@register("orphan_check", "\nUNION ALL\n".join(_sql_ref(*r) for r in REFERENCES))
def orphan_check(spark, sf):
    """Every declared REFERENCES relation checked as one batch job (one shared join)."""
    tables = {}

    def t(name):
        if name not in tables:
            tables[name] = table(spark, sf, name)
        return tables[name]
    return J.reference_checks([(rel, t(child), ck, t(parent), pk) for rel, child, ck, parent, pk in REFERENCES])


@register("upsert_latest_wins", """
WITH target AS (SELECT CAST(p_partkey AS VARCHAR) AS uuid, p_name AS name, p_retailprice AS price,
                       TIMESTAMP '1994-01-01 00:00:00' AS created_at,
                       CASE WHEN p_partkey % 10 = 7 THEN TIMESTAMP '2030-01-01 00:00:00' ELSE TIMESTAMP '1994-01-01 00:00:00' END AS updated_at
                FROM part),
upd AS (SELECT CAST(l_partkey AS VARCHAR) AS uuid,
               arg_max(l_extendedprice, (l_shipdate, l_orderkey, l_linenumber, l_extendedprice)) AS price,
               arg_max('Part ' || l_partkey || ' rev ' || l_orderkey, (l_shipdate, l_orderkey, l_linenumber, l_extendedprice)) AS name,
               MAX(l_shipdate) AS ts
        FROM lineitem GROUP BY 1)
SELECT t.uuid, t.name, t.price, t.created_at, t.updated_at FROM target t WHERE t.uuid NOT IN (SELECT uuid FROM upd)
UNION ALL
SELECT u.uuid, CASE WHEN t.updated_at > u.ts THEN t.name ELSE u.name END AS name,
       CASE WHEN t.updated_at > u.ts THEN t.price ELSE u.price END AS price, COALESCE(t.created_at, u.ts) AS created_at,
       CASE WHEN t.updated_at > u.ts THEN t.updated_at ELSE u.ts END AS updated_at
FROM upd u LEFT JOIN target t ON u.uuid = t.uuid
""")
def upsert_latest_wins(spark, sf):
    """Card table (parts) upserted with a batch of card updates (one per line item): the newest
    update per card wins, created_at is kept, and rows newer than every update stay."""
    part = table(spark, sf, "part")
    newer = F.when(F.col("p_partkey") % 10 == 7, F.lit("2030-01-01 00:00:00")).otherwise(F.lit("1994-01-01 00:00:00"))
    target = part.select(F.col("p_partkey").cast("string").alias("uuid"), F.col("p_name").alias("name"),
                         F.col("p_retailprice").alias("price"),
                         F.lit("1994-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
                         newer.cast("timestamp_ntz").alias("updated_at"))
    li = spread(table(spark, sf, "lineitem"))  # sort-based newest-update aggregate: use every core
    updates = li.select(F.col("l_partkey").cast("string").alias("uuid"),
                        F.concat(F.lit("Part "), F.col("l_partkey").cast("string"), F.lit(" rev "),
                                 F.col("l_orderkey").cast("string")).alias("name"),
                        F.col("l_extendedprice").alias("price"), F.col("l_shipdate").alias("ts"),
                        "l_orderkey", "l_linenumber")
    return S.merge_latest(target, updates, ["uuid"], ["ts", "l_orderkey", "l_linenumber", "price"],
                          ["name", "price"], "ts")
