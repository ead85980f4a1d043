"""A keyed table in versions, committed as a whole, with the log of its changes.

Layout below the table's folder::

    data/v=<version>/_bucket=<n>/*.parquet    rows of the buckets that a version wrote
    changes/v=<version>/*.parquet             before/after rows of that version
    manifests/<version>.json                  which version's folder holds each bucket; written last

Rows lie in ``pmod(xxhash64(keys), n)``. A commit writes the buckets it touches into new folders and
then one small manifest, by rename: until then nothing refers to the new files, so a
driver that dies in between leaves the table as it was, and a reader that has taken a manifest goes on
reading the same files whatever is committed meanwhile. Folders that no kept manifest names are
swept. A manifest also holds the last batch id of each writer, so a replayed batch
changes nothing. One writer at a time commits to a table; a second one that has read the same
manifest is refused when it commits.

Nothing but manifests (one entry per bucket) passes through the driver.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardlake.operators.aggregates import latest_row

BUCKET = "_bucket"
ORDER, SEQ = "_order", "_seq"      # of a row: what it was ordered by, and how many changes made it


class Files:
    """Small files and folders of a shared file system, by Hadoop's file system API."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm = spark._jvm
        self._root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._root}/{name}" if name else self._root)

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path))

    def sizes(self, folder: str) -> dict[str, int]:
        """Names and lengths of the files right in a folder."""
        path = self._path(folder)
        return {s.getPath().getName(): s.getLen() for s in self._fs.listStatus(path)} if self._fs.exists(path) else {}

    def text(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a file that appears as a whole, or False if there is one of that name."""
        hidden = f".{uuid.uuid4().hex}"
        folder = name.rpartition("/")[0]
        temporary = self._path(f"{folder}/{hidden}" if folder else hidden)
        stream = self._fs.create(temporary, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self._fs.exists(self._path(name)) or not self._fs.rename(temporary, self._path(name)):
            self._fs.delete(temporary, False)
            return False
        return True

    def remove(self, folder: str) -> None:
        self._fs.delete(self._path(folder), True)


class CommitConflict(RuntimeError):
    """Another writer has committed since this one read the table."""


@dataclass(frozen=True)
class Manifest:
    version: int = 0                                                # 0: no version yet
    schema: str = ""                                                # of the data files, as JSON
    parts: dict[str, list[int]] = field(default_factory=dict)       # bucket -> versions whose folders hold its rows
    logged: list[int] = field(default_factory=list)                 # versions that have a log of changes
    writers: dict[str, list[int]] = field(default_factory=dict)     # writer -> [its last batch id, the version it made]

    def dump(self) -> str:
        return json.dumps(self.__dict__)


class VersionedTable:
    """The table of ``keys`` at ``path``; ``n_buckets`` stays what it is for a table's lifetime."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], n_buckets: int = 64) -> None:
        self.spark, self.path, self.keys, self.n_buckets = spark, path.rstrip("/"), keys, n_buckets
        self.files = Files(spark, self.path)

    # ------------------------------------------------------------ versions and reading

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.files.names("manifests") if n.endswith(".json") and not n.startswith(".")]

    def manifest(self, version: int | None = None) -> Manifest:
        """That of ``version``, or the newest; of version 0 before the first commit."""
        if version is None:
            version = max(self.versions(), default=0)
        return Manifest(**json.loads(self.files.text(f"manifests/{version:012d}.json"))) if version else Manifest()

    def _stored(self, manifest: Manifest, buckets: list[int] | None = None) -> DataFrame | None:
        if not manifest.schema:
            return None
        schema = StructType.fromJson(json.loads(manifest.schema))
        paths = [f"{self.path}/data/v={v}/{BUCKET}={b}" for b, versions in manifest.parts.items()
                 if buckets is None or int(b) in buckets for v in versions]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None, internal: bool = False) -> DataFrame | None:
        """The rows of a version (default: the newest), or None before the first commit. The frame is bound
        to that version's files, whatever is committed later."""
        rows = self._stored(self.manifest(version))
        return rows if rows is None or internal else rows.drop(ORDER, SEQ)

    def changes(self, after: int = 0, upto: int | None = None) -> DataFrame | None:
        """The logged changes of the versions above ``after``, up to ``upto``: the keys, seq (1, 2, ... per
        key), version, batch_id, before and after (structs of the values; null: no row); None if there are none."""
        manifest = self.manifest(upto)
        paths = [f"{self.path}/changes/v={v}" for v in manifest.logged if v > after]
        return self.spark.read.parquet(*paths) if paths else None

    def batch_version(self, writer: str, batch_id: int) -> int | None:
        """The version that a writer's batch made if it is its last, or None if it has not been committed;
        for earlier batches the newest version."""
        manifest = self.manifest()
        done = manifest.writers.get(writer)
        if done is None or done[0] < batch_id:
            return None
        return done[1] if done[0] == batch_id else manifest.version

    # ------------------------------------------------------------ writing

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.n_buckets)).cast("int"))

    def _next(self, base: Manifest) -> int:
        """A number above all folders there are, so that no leftover of a failed commit is taken for data."""
        used = [int(n[2:]) for folder in ("data", "changes") for n in self.files.names(folder) if n.startswith("v=")]
        return max([base.version, *used], default=0) + 1

    def _write(self, rows: DataFrame, version: int) -> list[str]:
        """Rows with their bucket into the version's folders, without more small files than needed; the buckets that got rows."""
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/data/v={version}")
        return [n.partition("=")[2] for n in self.files.names(f"data/v={version}") if n.startswith(f"{BUCKET}=")]

    def _commit(self, base: Manifest, manifest: Manifest) -> int:
        newest = max(self.versions(), default=0)
        if newest != base.version or not self.files.create(f"manifests/{manifest.version:012d}.json", manifest.dump()):
            raise CommitConflict(f"{self.path}: version {newest} was committed after version {base.version} had been read")
        return manifest.version

    def _apply(self, newest: DataFrame, value_cols: list[str], after: Column, order: Column | None, at: Column | None,
               created: Column | None, writer: str, batch_id: int | None, log: bool) -> int:
        """Merge one row per key into the table. ``newest``: the keys and a struct _new; ``after``: the row's values
        from _old and _new (structs; null: no row), or null for a row that goes."""
        base = self.manifest()
        if batch_id is not None and base.writers.get(writer, [-1])[0] >= batch_id:
            return base.version     # a replay
        newest = self._bucketed(newest).persist()
        try:
            touched = [r[0] for r in newest.select(BUCKET).distinct().collect()]  # at most n_buckets
            version = self._next(base)
            current = self._stored(base, touched)
            old = None if current is None else current.select(
                *[F.col(k).alias(f"_k_{k}") for k in self.keys], F.struct(*[c for c in current.columns if c not in self.keys]).alias("_old"))
            if old is None:
                joined = newest.withColumn("_old", self._empty_old(newest, value_cols, order))
            else:
                same = [newest[k].eqNullSafe(old[f"_k_{k}"]) for k in self.keys]
                condition = same[0]
                for c in same[1:]:
                    condition = condition & c
                joined = newest.join(old, condition, "full").select(
                    *[F.when(F.col("_new").isNull(), F.col(f"_k_{k}")).otherwise(F.col(k)).alias(k) for k in self.keys], "_new", "_old")
            untouched = F.col("_new").isNull()
            row = joined.select(*self.keys, "_old", "_new", F.when(untouched, F.struct(*[F.col("_old")[c].alias(c) for c in value_cols]))
                                .otherwise(after).alias("_after"))
            before = F.when(F.col("_old").isNotNull(), F.struct(*[F.col("_old")[c].alias(c) for c in value_cols]))
            row = row.withColumn("_before", before)
            row = row.withColumn("_changed", ~F.col("_before").eqNullSafe(F.col("_after")))
            taken = ~untouched & self._takes(order)
            seq = (F.coalesce(F.col("_old")[SEQ], F.lit(0)) + F.col("_changed").cast("int")).cast("long")
            extra = [seq.alias(SEQ)]
            if order is not None:
                extra += [F.when(taken, F.col("_new")[ORDER]).otherwise(F.col("_old")[ORDER]).alias(ORDER),
                          F.coalesce(F.col("_old")["created_at"], created).alias("created_at"),
                          F.when(taken, at).otherwise(F.col("_old")["updated_at"]).alias("updated_at")]
            row = row.select(*self.keys, "_before", "_after", "_changed", *extra).persist()
            rows = row.where(F.col("_after").isNotNull()).select(*self.keys, *[F.col("_after")[c].alias(c) for c in value_cols],
                                                                *[c for c in (("created_at", "updated_at") if order is not None else ())],
                                                                *([ORDER] if order is not None else []), SEQ)
            filled = self._write(self._bucketed(rows), version)
            if log:
                change = row.where("_changed").select(*self.keys, F.col(SEQ).alias("seq"), F.lit(version).cast("long").alias("version"),
                                                      F.lit(batch_id).cast("long").alias("batch_id"), F.col("_before").alias("before"), F.col("_after").alias("after"))
                change.hint("rebalance").write.parquet(f"{self.path}/changes/v={version}")
            parts = {b: v for b, v in base.parts.items() if int(b) not in touched} | {b: [version] for b in filled}
            writers = base.writers | ({writer: [batch_id, version]} if batch_id is not None else {})
            return self._commit(base, Manifest(version, json.dumps(rows.schema.jsonValue()), parts, base.logged + [version] * log, writers))
        finally:
            newest.unpersist()
            if "row" in locals():
                row.unpersist()

    def _empty_old(self, newest: DataFrame, value_cols: list[str], order: Column | None) -> Column:
        """A null of the type that a row of the table has."""
        new = newest.schema["_new"].dataType
        fields = {c: new[c].dataType for c in value_cols}
        if order is not None:
            fields |= {"created_at": new["_at"].dataType, "updated_at": new["_at"].dataType, ORDER: new[ORDER].dataType}
        struct = StructType()
        for name, kind in fields.items():
            struct = struct.add(name, kind)
        return F.lit(None).cast(struct.add(SEQ, "long"))

    @staticmethod
    def _takes(order: Column | None) -> Column:
        """Whether the new row replaces the old one: not if that is newer."""
        return F.lit(True) if order is None else F.col("_old").isNull() | ~(F.col("_old")[ORDER] > F.col("_new")[ORDER])

    def upsert(self, batch: DataFrame, order_cols: list[str], value_cols: list[str], ts_col: str, created_col: str | None = None,
               writer: str = "writer", batch_id: int | None = None, log: bool = False) -> int:
        """Merge a batch: of the rows of a key the newest by ``order_cols`` wins, within the batch and against
        the table, in whatever order batches come. created_at is the time (``ts_col``, or ``created_col`` where given) of a key's first
        batch, updated_at that of its newest row. Returns the version that holds the batch; a batch id
        that the writer has committed before changes nothing."""
        order = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)])
        at = F.col(ts_col)
        newest = latest_row(batch.select(*self.keys, F.struct(
            *[F.col(c) for c in value_cols], at.alias("_at"), (F.col(created_col) if created_col else at).alias("_created"), order.alias(ORDER)).alias("_new")),
            self.keys, [F.col("_new")[ORDER], F.col("_new")], ["_new"])
        new, old = F.col("_new"), F.col("_old")
        values = F.when(self._takes(order), F.struct(*[new[c].alias(c) for c in value_cols])).otherwise(F.struct(*[old[c].alias(c) for c in value_cols]))
        return self._apply(newest, value_cols, values, order, new["_at"], new["_created"], writer, batch_id, log)

    def add(self, deltas: DataFrame, amount_cols: list[str], writer: str = "writer", batch_id: int | None = None, log: bool = False) -> int:
        """Add amounts to the rows of their keys; a row whose amounts have all come to 0 goes."""
        summed = deltas.groupBy(*self.keys).agg(F.struct(*[F.sum(c).cast("long").alias(c) for c in amount_cols]).alias("_new"))
        total = F.struct(*[(F.coalesce(F.col("_old")[c], F.lit(0)) + F.col("_new")[c]).cast("long").alias(c) for c in amount_cols])
        gone = F.lit(True)
        for c in amount_cols:
            gone = gone & (F.coalesce(F.col("_old")[c], F.lit(0)) + F.col("_new")[c] == 0)
        return self._apply(summed, amount_cols, F.when(~gone, total), None, None, None, writer, batch_id, log)

    def append(self, rows: DataFrame, writer: str = "writer", batch_id: int | None = None) -> int:
        """Add rows as further files of their buckets, without reading what is there."""
        base = self.manifest()
        if batch_id is not None and base.writers.get(writer, [-1])[0] >= batch_id:
            return base.version
        version = self._next(base)
        filled = self._write(self._bucketed(rows), version)
        parts = {b: list(v) for b, v in base.parts.items()}
        for b in filled:
            parts.setdefault(b, []).append(version)
        writers = base.writers | ({writer: [batch_id, version]} if batch_id is not None else {})
        return self._commit(base, Manifest(version, json.dumps(rows.schema.jsonValue()), parts, base.logged, writers))

    # ------------------------------------------------------------ upkeep

    def compact(self, target_bytes: int = 128 << 20) -> int | None:
        """Rewrite the buckets that appends have left in several small folders as few files of about
        ``target_bytes``: folders of a bucket are packed in order into outputs until one is full; those that
        are full alone stay. None if there is nothing to pack."""
        base = self.manifest()
        sizes = {(v, b): sum(n for name, n in self.files.sizes(f"data/v={v}/{BUCKET}={b}").items() if name.endswith(".parquet"))
                 for b, versions in base.parts.items() for v in versions}
        parts, packed = {}, []
        for b, versions in base.parts.items():
            small = [v for v in versions if sizes[v, b] < target_bytes]
            parts[b] = [v for v in versions if v not in small] if len(small) > 1 else list(versions)
            packed += [(b, v) for v in small] if len(small) > 1 else []
        if not packed:
            return None
        version = self._next(base)
        rows = self._stored(Manifest(schema=base.schema, parts={b: [v for c, v in packed if c == b] for b, _ in packed}))
        n = max(1, -(-sum(sizes[v, b] for b, v in packed) // target_bytes))
        # a bucket's rows go to as many tasks as its bytes need, and the tasks of small buckets hold several of them
        rows = self._bucketed(rows).repartitionByRange(n, BUCKET, *self.keys) if n > 1 else self._bucketed(rows).coalesce(1)
        rows.write.partitionBy(BUCKET).parquet(f"{self.path}/data/v={version}")
        for b in {b for b, _ in packed}:
            parts[b] = [*parts[b], version]
        return self._commit(base, Manifest(version, base.schema, parts, base.logged, base.writers))

    def sweep(self, keep: int = 10, hold: set[int] | frozenset[int] = frozenset()) -> list[str]:
        """Remove the manifests but for the newest ``keep`` and the versions in ``hold``, then the data folders that
        none of those left names, and logs that the newest doesn't. Leftovers of failed commits go with them.
        No commit may be under way."""
        versions = self.versions()
        stay = set(versions[-keep:]) | hold
        kept = [self.manifest(v) for v in versions if v in stay]
        if not kept:
            return []
        used = {(str(v), b) for m in kept for b, vs in m.parts.items() for v in vs}
        removed = [f"manifests/{v:012d}.json" for v in versions if v not in stay]
        for folder in self.files.names("data"):
            buckets = [n for n in self.files.names(f"data/{folder}") if n.startswith(f"{BUCKET}=")]
            unused = [n for n in buckets if (folder[2:], n.partition("=")[2]) not in used]
            removed += [f"data/{folder}"] if len(unused) == len(buckets) else [f"data/{folder}/{n}" for n in unused]
        logged = {str(v) for v in kept[-1].logged}
        removed += [f"changes/{n}" for n in self.files.names("changes") if n[2:] not in logged]
        for name in removed:
            self.files.remove(name)
        return removed


# ---------------------------------------------------------------- what follows from a log of changes

def replay(changes: DataFrame, keys: list[str], value_cols: list[str]) -> DataFrame:
    """The table that a log gives when it is applied to an empty one: each key's newest image."""
    last = latest_row(changes.select(*keys, "seq", "after"), keys, ["seq"], ["after"])
    return last.where(F.col("after").isNotNull()).select(*keys, *[F.col("after")[c].alias(c) for c in value_cols])


def retractions(changes: DataFrame, group: str, name: str | None = None, amount: str = "n") -> DataFrame:
    """Deltas of a count per group: -1 for the group of a row's old image, +1 for that of its new one."""
    name = name or group
    images = changes.select(F.explode(F.array(
        F.struct(F.col("before").isNotNull().alias("there"), F.col("before")[group].alias(name), F.lit(-1).alias(amount)),
        F.struct(F.col("after").isNotNull().alias("there"), F.col("after")[group].alias(name), F.lit(1).alias(amount)))).alias("d"))
    return images.where("d.there").select(f"d.{name}", f"d.{amount}")


def count_by_group(table: VersionedTable, counts: VersionedTable, group: str, amount: str = "n", log: bool = False) -> int:
    """Bring the counts per group up to the newest version of ``table``, by what it logged since they were last.
    Each version counts once: the counts' manifest names the version they hold."""
    done = counts.manifest().writers.get("versions", [0])[0]
    upto = table.manifest().version
    changes = table.changes(after=done, upto=upto) if upto > done else None
    if changes is None:
        return counts.manifest().version
    deltas = retractions(changes, group, counts.keys[0], amount)
    return counts.add(deltas, [amount], writer="versions", batch_id=upto, log=log)


def history(changes: DataFrame, keys: list[str], value_cols: list[str]) -> DataFrame:
    """Validity intervals of a table's rows: keys, values, seq, from_version and to_version (exclusive; null: still valid).

    A row per change; a key's intervals are found by joining each change with its successor by number, so a
    key with very many changes is no single task's."""
    images = changes.select(*keys, "seq", "version", "after")
    following = changes.select(*[F.col(k).alias(f"_k_{k}") for k in keys], (F.col("seq") - 1).alias("_seq"), F.col("version").alias("to_version"))
    condition = images["seq"] == following["_seq"]
    for k in keys:
        condition = condition & images[k].eqNullSafe(following[f"_k_{k}"])
    return images.join(following, condition, "left").where(F.col("after").isNotNull()).select(
        *[images[k] for k in keys], *[F.col("after")[c].alias(c) for c in value_cols], "seq", F.col("version").alias("from_version"), "to_version")


def pinned_version(table: VersionedTable, pins: Files, batch_id: int) -> int:
    """The version of ``table`` a batch reads: the newest when the batch first ran, and the same in every replay."""
    name = f"{batch_id}.json"
    if name not in pins.names(""):
        pins.create(name, json.dumps(table.manifest().version))
    return json.loads(pins.text(name))


def join_at_arrival(facts: DataFrame, versions: DataFrame, fact_key: str, key: str, at_version: str) -> DataFrame:
    """Facts LEFT JOIN the images that were valid in the version each fact met (``at_version``): ``versions`` are
    intervals by ``history``; at most one matches."""
    condition = ((facts[fact_key] == versions[key]) & (versions["from_version"] <= facts[at_version])
                 & (versions["to_version"].isNull() | (versions["to_version"] > facts[at_version])))
    return facts.join(versions, condition, "left").drop(versions[key])
