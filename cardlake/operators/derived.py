"""What follows from a versioned table bucket by bucket, and is brought up to date by the buckets that have changed.

A commit of a ``VersionedTable`` writes the buckets it touches; the manifests tell which. So a total over the
table need not be counted anew with each batch: partial results are kept per bucket in a table of their own, the
buckets that differ between the version they hold and the newest are read, and the partials of all buckets (a few rows
each) are merged when the result is asked for. As a touched bucket is derived from all its rows, values that fall or
leave need no special care: the largest one that falls gives way to the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlake.operators.versioned import BUCKET, VersionedTable

WRITER = "versions"


def changed_buckets(table: VersionedTable, since: int) -> tuple[int, list[int]]:
    """The newest version and the buckets whose rows differ from version ``since``: all there are if that is no longer kept."""
    newest = table.manifest()
    known = table.manifest(since).parts if since in table.versions() else None
    if known is None:
        return newest.version, list(range(table.n_buckets)) if since else [int(b) for b in newest.parts]
    return newest.version, [int(b) for b in newest.parts.keys() | known.keys() if newest.parts.get(b) != known.get(b)]


def follow(table: VersionedTable, derived: VersionedTable, derive: Callable[[DataFrame], DataFrame], value_cols: list[str]) -> int:
    """Bring ``derived`` (its first key is 'bucket') up to the newest version of ``table``; returns that version.

    ``derive`` maps rows with their bucket to derived rows, each from rows of one bucket. A derived key that its bucket
    no longer gives stays with null values. Each version counts once, and a failure before the commit leaves the
    derived table at the version it names, from which the next call goes on."""
    done = derived.manifest().writers.get(WRITER, [0])[0]
    version, buckets = changed_buckets(table, done)
    if version <= done or not buckets:
        return version
    manifest = table.manifest(version)
    rows = table._bucketed(table._stored(manifest, buckets)).withColumnRenamed(BUCKET, "bucket")
    new = derive(rows).select(*derived.keys, *value_cols)
    old = derived.read()
    if old is not None:
        keys = [F.col(k) for k in derived.keys]
        gone = old.where(F.col("bucket").isin(buckets)).select(*keys, F.lit(False).alias("_there"))
        marked = gone.unionByName(new.select(*keys, F.lit(True).alias("_there"))).groupBy(*keys).agg(F.max("_there").alias("_there"))
        empty = [F.lit(None).cast(new.schema[c].dataType).alias(c) for c in value_cols]
        new = new.unionByName(marked.where(~F.col("_there")).select(*keys, *empty))
    stamped = new.withColumn("_version", F.lit(version).cast("long")).withColumn("_at", F.current_timestamp())
    derived.upsert(stamped, ["_version"], value_cols, "_at", writer=WRITER, batch_id=version)
    return version


def follow_totals(table: VersionedTable, totals: VersionedTable, value: str | Column, by: dict[str, Column] | None = None) -> int:
    """Count, exact sum, least and largest value per bucket and per group of ``by`` (the further keys of ``totals``)."""
    v = F.col(value) if isinstance(value, str) else value

    def derive(rows: DataFrame) -> DataFrame:
        return rows.groupBy("bucket", *[c.alias(n) for n, c in (by or {}).items()]).agg(
            F.count(F.lit(1)).alias("n"), F.count(v).alias("valued"), F.sum(v.cast("decimal(18,2)")).alias("total"), F.min(v).alias("least"), F.max(v).alias("largest"))

    return follow(table, totals, derive, ["n", "valued", "total", "least", "largest"])


def merge_totals(partials: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The totals of all buckets: n, total, average, least and largest per group (one row if there is none)."""
    there = partials.where(F.col("n") > 0)
    return there.groupBy(*(by or [])).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"), F.sum("total").cast("double").alias("total"),
        (F.sum("total").cast("double") / F.nullif(F.sum("valued"), F.lit(0))).alias("average"), F.min("least").alias("least"), F.max("largest").alias("largest"))


def follow_ranking(table: VersionedTable, leaders: VersionedTable, value: str, k: int, show: list[str] | None = None) -> int:
    """The first ``k`` rows of each bucket by ``value`` (largest first, ties by the table's keys; rows without a value do not rank).

    ``leaders`` has the keys bucket and place. The first k of the table are among them."""
    order = [F.desc(value), *[F.asc(c) for c in table.keys]]

    def derive(rows: DataFrame) -> DataFrame:
        placed = rows.where(F.col(value).isNotNull()).withColumn("place", F.row_number().over(Window.partitionBy("bucket").orderBy(*order)))
        return placed.where(F.col("place") <= k)

    return follow(table, leaders, derive, [*table.keys, value, *(show or [])])


def ranking(leaders: DataFrame, keys: list[str], value: str, k: int) -> DataFrame:
    """The ranked list of the whole table, from at most ``k`` rows of each bucket: rank 1 to k and its label."""
    top = leaders.where(F.col(value).isNotNull()).orderBy(F.desc(value), *keys).limit(k).drop("bucket", "place", "created_at", "updated_at")
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(value), *keys)))     # k rows
    return ranked.withColumn("label", F.concat(F.lit("#"), F.col("rank").cast("string")))
