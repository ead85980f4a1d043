"""Relational tables (Parquet or JDBC), raw-document archive and ingest metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path_or_table: str, schema: StructType | None = None,
               jdbc_url: str | None = None, jdbc_props: dict | None = None,
               partition_column: str | None = None, bounds: tuple[int, int] | None = None,
               num_partitions: int = 64) -> DataFrame:
    """A relational table: Parquet folder by default, JDBC when ``jdbc_url`` is given.

    JDBC reads are split on ``partition_column`` within ``bounds`` so the table is
    fetched by ``num_partitions`` parallel tasks instead of one connection.
    """
    if jdbc_url is None:
        r = spark.read.schema(schema) if schema is not None else spark.read
        return r.parquet(path_or_table)
    r = spark.read.format("jdbc").option("url", jdbc_url).option("dbtable", path_or_table)
    for k, v in (jdbc_props or {}).items():
        r = r.option(k, v)
    if schema is not None:
        r = r.option("customSchema", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields))
    if partition_column and bounds:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", bounds[0])
             .option("upperBound", bounds[1]).option("numPartitions", num_partitions))
    return r.load()


def archive_raw(docs: DataFrame, path: str, source: str, key_col: str = "key", doc_col: str = "doc",
                ingest_date: Column | None = None) -> None:
    """Keep landed documents unchanged as Parquet (ingest_date, source, key, doc),
    partitioned by ingest date, before any parsing."""
    d = ingest_date if ingest_date is not None else F.current_date()
    (docs.select(d.alias("ingest_date"), F.lit(source).alias("source"), F.col(key_col).cast("string").alias("key"),
                 F.col(doc_col).cast("string").alias("doc"))
     .write.mode("append").partitionBy("ingest_date").parquet(path))


def observe_rejects(df: DataFrame, name: str, reason_col: str = "reject_reason",
                    reasons: tuple[str, ...] = ("blank", "comment", "malformed", "bad_quantity",
                                                "non_positive", "empty_name")) -> tuple[DataFrame, Observation]:
    """Attach accepted / rejected-by-reason counters to ``df`` (collected as the job
    runs, without an extra pass); read them from the returned Observation after an action."""
    obs = Observation(name)
    r = F.col(reason_col)
    metrics = [F.count_if(r.isNull()).alias("accepted")] + [F.count_if(r == x).alias(x) for x in reasons]
    return df.observe(obs, *metrics), obs
