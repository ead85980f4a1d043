"""Sinks: latest-wins upsert (merge), bucketed upsert writer, event/file writers.

The upsert target is a Parquet table partitioned by ``_bucket = pmod(xxhash64(key), n)``.
A batch rewrites only the buckets its keys fall into (dynamic partition
overwrite), so the cost of a batch grows with the batch, not with the table.
The merge is deterministic (newest by the rows' own order columns, never by
arrival), so replaying a batch after a failure gives the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from cardlake.operators.aggregates import latest_row
from cardlake.session import cut_lineage

BUCKET_COL = "_bucket"


def merge_latest(target: DataFrame, updates: DataFrame, keys: list[str], order_cols: list[str],
                 value_cols: list[str], ts_col: str, created_col: str = "created_at",
                 updated_col: str = "updated_at") -> DataFrame:
    """INSERT ... ON CONFLICT (keys) DO UPDATE, newest update wins.

    target:  keys + value_cols + created_col + updated_col
    updates: keys + value_cols + order_cols (ts_col is the update's time)
    A key present in both keeps its created_at and gets updated_at = the newest
    update's time; a new key gets created_at = updated_at = that time; untouched
    target rows pass through, and so do target rows that are newer than every update of
    their key: a late or replayed update never replaces a newer row.
    """
    newest = latest_row(updates, keys, order_cols, value_cols + [ts_col])
    late = F.col("_updated") > F.col(ts_col)
    t = target.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in value_cols],
                      F.col(created_col).alias("_created"), F.col(updated_col).alias("_updated"))
    merged = newest.join(t, keys, "left").select(
        *keys, *[F.when(late, F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) for c in value_cols],
        F.coalesce(F.col("_created"), F.col(ts_col)).alias(created_col),
        F.when(late, F.col("_updated")).otherwise(F.col(ts_col)).alias(updated_col))
    untouched = target.join(newest.select(*keys), keys, "left_anti").select(
        *keys, *value_cols, created_col, updated_col)
    return untouched.unionByName(merged)


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None if there is none yet; any other error is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def with_bucket(df: DataFrame, keys: list[str], n_buckets: int) -> DataFrame:
    return df.withColumn(BUCKET_COL, F.pmod(F.xxhash64(*keys), F.lit(n_buckets)).cast("int"))


def write_upsert(batch: DataFrame, target_path: str, keys: list[str], order_cols: list[str],
                 value_cols: list[str], ts_col: str, n_buckets: int = 256,
                 created_col: str = "created_at", updated_col: str = "updated_at") -> None:
    """Merge ``batch`` into the bucketed Parquet table at ``target_path`` (foreachBatch body)."""
    upd = with_bucket(batch, keys, n_buckets)
    current = read_if_there(batch.sparkSession, target_path)
    if current is None:  # first batch
        current = upd.limit(0).select(*keys, *value_cols, F.col(ts_col).alias(created_col),
                                      F.col(ts_col).alias(updated_col))
    else:
        # Buckets touched by the batch: at most n_buckets small ints; the filter
        # prunes the read to those partition folders.
        touched = [r[0] for r in upd.select(BUCKET_COL).distinct().collect()]
        current = current.where(F.col(BUCKET_COL).isin(touched)).drop(BUCKET_COL)
    merged = merge_latest(current, upd.drop(BUCKET_COL), keys, order_cols, value_cols, ts_col,
                          created_col, updated_col)
    # The target is also an input: materialise the result before overwriting its buckets.
    out = cut_lineage(with_bucket(merged, keys, n_buckets))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET_COL).parquet(target_path)


def write_enriched_parquet(df: DataFrame, path: str, partition_col: str | None = None,
                           max_records_per_file: int = 1_000_000) -> None:
    """Append rows as Parquet; with ``partition_col`` only the partitions present in
    ``df`` are replaced (dynamic overwrite), so re-writing a micro-batch under its own
    batch id replaces it instead of duplicating it."""
    w = df.write.option("maxRecordsPerFile", max_records_per_file)
    if partition_col:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col)
    else:
        w = w.mode("append")
    w.parquet(path)


def write_batch_json(df: DataFrame, path: str, batch_id: int) -> None:
    """JSON lines under ``batch_id=<n>``; a replayed micro-batch replaces its folder."""
    df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").json(path)
