"""Keyed tables on Parquet: full overwrite, upsert by delta files, compaction, committed by exclusive manifests.

Rows are bucketed by a hash of their key, or of the column ``by``. A bucket is a list of layers: the rows of the last
overwrite or compaction, and one delta for each upsert since, with the rows it brought and marks for the ones it
removed. An upsert writes its own rows only; readers take the newest row of every key. Compaction makes one layer of
many.

Every version has a manifest with the layers of all buckets, the schema, notes of the owner, and how far streams have
come. Readers follow the newest one, so they never see a half-written table, a finished version never changes, and of two
writers of a version exactly one succeeds.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeindex.session import fits_broadcast, stage
from skeindex.sources.commits import CommitLog, Conflict, names

__all__ = ["Conflict", "KeyedTable", "Manifest"]

GONE = "__gone"
# Layers from which a bucket is worth compacting.
MOST_LAYERS = 8


class Manifest(NamedTuple):
    """A finished version; ``layers`` has the tokens of each bucket that has rows, the oldest first."""

    version: int
    layers: dict[int, list[str]]
    buckets: int
    schema: T.StructType | None
    notes: dict[str, str]
    streams: dict[str, int]


@dataclass(frozen=True)
class KeyedTable:
    """``buckets`` counts for a new table only: a table keeps the number that it was made with.

    With ``by`` (a column path) the rows of one group share a bucket, and keys have to be unique within their group.
    """

    root: str
    key: str = "id"
    buckets: int = 64
    by: str | None = None
    sort: str | None = None

    def _bucket(self, buckets: int | None = None) -> Column:
        hashed = F.xxhash64(F.col(self.by or self.key))
        return F.pmod(hashed, F.lit(buckets or self.buckets)).cast("int")

    def _log(self, spark: SparkSession) -> CommitLog:
        return CommitLog(spark, f"{self.root}/commits")

    def manifest(self, spark: SparkSession, version: int | None = None) -> Manifest:
        """A version, by default the newest finished one; version 0 without any."""
        log = self._log(spark)
        version = log.newest() if version is None else version
        if version == 0:
            return Manifest(0, {}, self.buckets, None, {}, {})
        found = log.read(version)
        layers = {int(b): tokens for b, tokens in found["layers"].items()}
        return Manifest(version, layers, found["buckets"], T.StructType.fromJson(found["schema"]), found["notes"], found["streams"])

    def exists(self, spark: SparkSession) -> bool:
        return self.manifest(spark).version > 0

    def _files(self, spark: SparkSession, found: Manifest, places: list[tuple[int, str]], columns: list[T.StructField] = []) -> DataFrame:
        """The rows of some layers, with their bucket and token."""
        schema = T.StructType([*found.schema.fields, *columns, T.StructField("bucket", T.IntegerType()), T.StructField("token", T.StringType())])
        if not places:
            return spark.createDataFrame([], schema)
        paths = [f"{self.root}/data/token={t}/bucket={b}" for b, t in sorted(places)]
        return spark.read.option("basePath", f"{self.root}/data").schema(schema).parquet(*paths)

    def _read_buckets(self, spark: SparkSession, found: Manifest, only: set[int] | None = None) -> DataFrame:
        """The current rows of some buckets: of every key the row of its newest layer, unless that removes it."""
        layers = {b: tokens for b, tokens in found.layers.items() if only is None or b in only}
        plain = self._files(spark, found, [(b, tokens[0]) for b, tokens in layers.items()])
        deltas = [(b, t, i) for b, tokens in layers.items() for i, t in enumerate(tokens) if i]
        if not deltas:
            return plain.drop("token")
        gone = T.StructField(GONE, T.BooleanType())
        order = spark.createDataFrame(deltas, "bucket int, token string, layer int")  # a row for each bucket and delta
        newer = self._files(spark, found, [(b, t) for b, t, _ in deltas], [gone]).join(F.broadcast(order), ["bucket", "token"])
        where = ["bucket", self.key]
        latest = newer.groupBy(*where).agg(F.max("layer").alias("layer"))
        keys = newer.select(*where)
        keys = F.broadcast(keys) if fits_broadcast(newer, F.octet_length(F.col(self.key).cast("string")) + 24) else keys
        old = plain.drop("token").join(keys, where, "left_anti")
        new = newer.join(latest, [*where, "layer"], "left_semi").where(~F.col(GONE))
        return old.unionByName(new.drop("token", "layer", GONE)).select(*found.schema.names, "bucket")

    def read(self, spark: SparkSession, found: Manifest | None = None) -> DataFrame:
        """The rows of a version, by default the newest, with their ``bucket``; a table without rows is empty."""
        found = found or self.manifest(spark)
        if found.version == 0:
            raise LookupError(f"no table at {self.root}")
        return self._read_buckets(spark, found)

    def _write(self, rows: DataFrame) -> dict[int, str]:
        """Write bucketed rows under a fresh token; large buckets get several files."""
        spark, token = rows.sparkSession, uuid.uuid4().hex
        target = f"{self.root}/data/token={token}"
        dealt = rows.hint("rebalance", "bucket")
        if self.sort and self.sort in rows.columns:  # so that files can be skipped by it
            dealt = dealt.sortWithinPartitions("bucket", self.sort)
        dealt.write.partitionBy("bucket").parquet(target)
        return {int(n.split("=")[1]): token for n in names(spark, target) if n.startswith("bucket=")}

    def _commit(
        self, spark: SparkSession, before: Manifest, layers: dict[int, list[str]], schema: T.StructType,
        notes: dict[str, str] | None = None, batch: tuple[str, int] | None = None,
    ) -> int:
        """Write the version after ``before``; Conflict if another writer has."""
        kept = T.StructType([f for f in schema.fields if f.name not in ("bucket", GONE)])
        content = {
            "layers": {str(b): tokens for b, tokens in sorted(layers.items())}, "buckets": before.buckets, "schema": json.loads(kept.json()),
            "notes": before.notes | (notes or {}), "streams": before.streams | ({batch[0]: batch[1]} if batch else {}),
        }
        self._log(spark).commit(before.version + 1, content)
        return before.version + 1

    def overwrite(self, rows: DataFrame, notes: dict[str, str] | None = None, before: Manifest | None = None) -> int:
        """Replace the whole table, also by one without rows; returns the new version.

        ``notes`` are kept with this version and later ones. With ``before``, a version that was read, a commit since
        then is a conflict.
        """
        spark = rows.sparkSession
        before = before or self.manifest(spark)
        written = self._write(rows.withColumn("bucket", self._bucket(before.buckets)))
        return self._commit(spark, before, {b: [t] for b, t in written.items()}, rows.schema, notes)

    def applied(self, spark: SparkSession, batch: tuple[str, int] | None) -> bool:
        """Whether a stream's batch, as ``(stream, number)``, is part of the table."""
        return batch is not None and self.manifest(spark).streams.get(batch[0], -1) >= batch[1]

    def upsert(
        self, delta: DataFrame, group: str | None = None, batch: tuple[str, int] | None = None, before: Manifest | None = None
    ) -> int:
        """Insert or replace rows by key; what is written is the batch, not the buckets that it falls into.

        ``delta`` holds each key once; without rows nothing is committed. With ``group`` (a column path), rows of the
        groups in ``delta`` whose key is not in ``delta`` are removed as well; in a table bucketed by the group, only
        its buckets are read for that. A ``batch`` (stream and number) that is part of the table already changes nothing.
        With ``before``, a version that was read, a commit since then is a conflict.
        """
        spark = delta.sparkSession
        before = before or self.manifest(spark)
        if batch is not None and before.streams.get(batch[0], -1) >= batch[1]:
            return before.version
        # Used several times below, and computed from a long plan: written once.
        keyed = stage(delta.withColumn("bucket", self._bucket(before.buckets)), "delta")
        touched = {r["bucket"] for r in keyed.select("bucket").distinct().collect()}
        if not touched:
            return before.version
        if before.version == 0:
            return self._commit(spark, before, {b: [t] for b, t in self._write(keyed).items()}, keyed.schema, batch=batch)
        rows = keyed.withColumn(GONE, F.lit(False))
        if group is not None:
            named = F.col(group).alias("__group")
            near = touched if group == self.by else None
            old = self._read_buckets(spark, before, near).select(self.key, "bucket", named)
            groups = keyed.select(named).distinct()
            gone = old.join(groups, "__group", "left_semi").select(self.key, "bucket")
            stale = gone.join(keyed.select(self.key, "bucket"), [self.key, "bucket"], "left_anti")
            rows = rows.unionByName(stale.withColumn(GONE, F.lit(True)), allowMissingColumns=True)
        # A bucket without rows so far has no base: its delta is read as one, so it must not hold removals only.
        layers = {b: list(tokens) for b, tokens in before.layers.items()}
        first = [b for b in touched if b not in layers]
        plain = rows.where(~F.col(GONE)).drop(GONE)
        for b, t in (self._write(plain.where(F.col("bucket").isin(first))) if first else {}).items():
            layers[b] = [t]
        for b, t in self._write(rows.where(~F.col("bucket").isin(first)) if first else rows).items():
            layers[b].append(t)
        return self._commit(spark, before, layers, keyed.schema, batch=batch)

    def compact(self, spark: SparkSession, most_layers: int = 1) -> int:
        """Make one layer of each bucket that has more than ``most_layers``; returns the version, a new one if any had."""
        before = self.manifest(spark)
        deep = {b for b, tokens in before.layers.items() if len(tokens) > most_layers}
        if not deep:
            return before.version
        written = self._write(self._read_buckets(spark, before, deep))
        layers = {b: tokens for b, tokens in before.layers.items() if b not in deep} | {b: [t] for b, t in written.items()}
        return self._commit(spark, before, layers, before.schema)

    def unused(self, spark: SparkSession, keep_versions: int = 2) -> list[str]:
        """Data folders that none of the newest ``keep_versions`` versions names: safe to delete once readers are done."""
        newest = self._log(spark).newest()
        kept = [self.manifest(spark, v) for v in range(max(1, newest - keep_versions + 1), newest + 1)]
        used = {t for m in kept for tokens in m.layers.values() for t in tokens}
        tokens = [n.split("=")[1] for n in names(spark, f"{self.root}/data") if n.startswith("token=")] if newest else []
        spare = sorted(f"{self.root}/data/token={t}" for t in tokens if t not in used)
        return [folder for folder in spare if any(n.startswith("bucket=") for n in names(spark, folder))]
