"""Vector indexes: a catalog of settings and one keyed table of datapoints per index.

The cells for approximate search belong to a version of the table: its manifest names them, so a reader always gets rows
and the cells that they were dealt into, also while others train or update.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from skeindex.functions.vectors import DISTANCE_MEASURES, FEATURE_NORMS, norm, unit
from skeindex.operators import ann, quantise
from skeindex.operators.intake import last_per_key
from skeindex.operators.search import dense_topk
from skeindex.schemas import INDEX
from skeindex.sources.commits import names, put_if_absent, read_text
from skeindex.sources.keyed import MOST_LAYERS, Conflict, KeyedTable, Manifest
from skeindex.sources.objects import read_if_present
from skeindex.sources.postings import PostingStore

# What training adds to a datapoint.
PLACED = ("cell", "codes", "length")


@dataclass(frozen=True)
class IndexSettings:
    """Fixed default values of an index."""

    dims: int = 768
    metric: str = "DOT_PRODUCT_DISTANCE"
    norm: str = "UNIT_L2_NORM"
    leaf_size: int = 1000
    probe_pct: int = 10
    approximate_neighbors: int = 150


class IndexCatalog:
    """Indexes under one root folder."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64) -> None:
        self.spark, self.root, self.buckets = spark, root, buckets

    def _rows(self, name: str) -> list[Row]:
        """The settings stored under a name; if two writers created it, the ones that sort first."""
        catalog = read_if_present(self.spark, f"{self.root}/catalog", INDEX)
        if catalog is None:
            return []
        return catalog.where(F.col("name") == name).orderBy(*catalog.columns).limit(1).collect()

    def create(self, name: str, settings: IndexSettings = IndexSettings()) -> Row:
        """The index called ``name``, created when absent; an existing one keeps its settings."""
        if settings.metric not in DISTANCE_MEASURES or settings.norm not in FEATURE_NORMS:
            raise ValueError(f"unknown distance measure or norm: {settings}")
        found = self._rows(name)
        if found:
            return found[0]
        values = (
            name, settings.dims, settings.metric, settings.norm, settings.leaf_size,
            settings.probe_pct, settings.approximate_neighbors,
        )
        row = self.spark.createDataFrame([values], INDEX)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/catalog")
        return self._rows(name)[0]

    def find(self, name: str) -> Row:
        found = self._rows(name)
        if not found:
            raise LookupError(f"index {name!r} not found")
        return found[0]

    def table(self, name: str) -> KeyedTable:
        return KeyedTable(f"{self.root}/indexes/{name}", "id", self.buckets, sort="cell")

    def read(self, name: str) -> DataFrame:
        return self.read_cells(name).drop(*PLACED)

    def read_cells(self, name: str, version: Manifest | None = None) -> DataFrame:
        """The datapoints with the ``cell``, ``codes`` and ``length`` of their vector, null before cells were trained."""
        self.find(name)
        return self.table(name).read(self.spark, version).drop("bucket")

    def _trained(self, name: str, version: Manifest | None, what: str, schema: str) -> DataFrame | None:
        version = version or self.table(name).manifest(self.spark)
        cells = version.notes.get("cells")
        return None if cells is None else read_if_present(self.spark, f"{self.root}/cells/{name}/{cells}/{what}", schema)

    def centroids(self, name: str, version: Manifest | None = None) -> DataFrame | None:
        """The cells of a version of an index, by default the newest; None without any."""
        return self._trained(name, version, "centroids", ann.CELLS)

    def codebooks(self, name: str, version: Manifest | None = None) -> DataFrame | None:
        """The codebooks of a version of an index, by default the newest; None without any."""
        return self._trained(name, version, "codebooks", quantise.CODEBOOKS)

    def set_cells(self, name: str, centroids: DataFrame, before: Manifest | None = None, codebooks: DataFrame | None = None) -> int:
        """Store cells, and codebooks if given, and give every datapoint its own, in one commit.

        Later updates give theirs by the same cells and codebooks.
        """
        table, cells = self.table(name), uuid.uuid4().hex
        before = before or table.manifest(self.spark)
        centroids.write.parquet(f"{self.root}/cells/{name}/{cells}/centroids")
        if codebooks is not None:
            codebooks.write.parquet(f"{self.root}/cells/{name}/{cells}/codebooks")
        rows = self._placed(name, self.read_cells(name, before).drop(*PLACED), before._replace(notes={"cells": cells}))
        return table.overwrite(rows, {"cells": cells}, before)

    def _placed(self, name: str, rows: DataFrame, version: Manifest) -> DataFrame:
        """Rows with their cell and codes by what a version names, null where it names none."""
        centroids, codebooks = self.centroids(name, version), self.codebooks(name, version)
        rows = rows.withColumn("cell", F.lit(None).cast("int")) if centroids is None else ann.assign_cells(rows, centroids)
        if codebooks is not None:
            return quantise.with_codes(rows, codebooks)
        return rows.withColumn("codes", F.lit(None).cast("binary")).withColumn("length", F.lit(None).cast("double"))

    def train(self, name: str, seed: int = 7, iterations: int = 10) -> int:
        """Train the cells of an index on all of its vectors, one per ``leaf_size`` of them, and its codebooks."""
        leaf, before = self.find(name)["leaf_size"], self.table(name).manifest(self.spark)
        vectors = self.read_cells(name, before).select("id", "embedding")
        centroids = ann.train_cells(vectors, leaf, seed, iterations)
        return self.set_cells(name, centroids, before, quantise.train_codebooks(vectors, seed=seed))

    def search(self, name: str, queries: DataFrame, k: int, approximate: bool = True) -> DataFrame:
        """Dense ``(qid, rank, id, score)`` by the metric of the index: in ``probe_pct`` percent of its cells, or exact.

        With codebooks, ``approximate_neighbors`` ids of each query are shortlisted by their codes and scored exactly. An
        index without cells is searched exactly.
        """
        settings, version = self.find(name), self.table(name).manifest(self.spark)
        centroids, codebooks, rows = self.centroids(name, version), self.codebooks(name, version), self.read_cells(name, version)
        metric = DISTANCE_MEASURES[settings["metric"]]
        if centroids is None or not approximate:
            return dense_topk(rows, queries, k, metric)
        if codebooks is None:
            return ann.ann_topk(rows, centroids, queries, k, metric, settings["probe_pct"])
        return quantise.quantised_topk(
            rows, centroids, codebooks, queries, k, metric, settings["probe_pct"], settings["approximate_neighbors"]
        )

    def write_postings(self, name: str) -> PostingStore:
        """Build the inverted index of the newest version, for searches by terms until the next update."""
        version = self.table(name).manifest(self.spark)
        token = uuid.uuid4().hex
        store = PostingStore(f"{self.root}/postings/{name}/{version.version}/{token}")
        store.write(self.read_cells(name, version).select("id", "sparse_embedding"))
        # Named once it is whole; of two builds of one version the first counts.
        put_if_absent(self.spark, f"{self.root}/postings/{name}/{version.version}.txt", token)
        return self.postings(name) or store

    def postings(self, name: str) -> PostingStore | None:
        """The inverted index of the newest version; None if there is none."""
        version = self.table(name).manifest(self.spark).version
        if f"{version}.txt" not in names(self.spark, f"{self.root}/postings/{name}"):
            return None
        token = read_text(self.spark, f"{self.root}/postings/{name}/{version}.txt")
        return PostingStore(f"{self.root}/postings/{name}/{version}/{token}")

    def _prepared(self, settings: Row, datapoints: DataFrame) -> DataFrame:
        """Datapoints with checked dimensions and the index's norm, the last one of every id."""
        vector, size = F.col("embedding"), F.size("embedding")
        fits = vector.isNull() | (size == 0) | (size == settings["dims"])
        wrong = F.concat(F.lit(f"index has {settings['dims']} dimensions, vector has "), size.cast("string"))
        # A vector that is not finite counts as one that failed: the datapoint stays, without it.
        finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        sound = F.when(vector.isNull() | finite, vector).otherwise(F.array().cast(datapoints.schema["embedding"].dataType))
        checked = F.when(fits, sound).otherwise(F.raise_error(wrong))
        ready = datapoints.withColumn("embedding", checked)
        if settings["norm"] == "UNIT_L2_NORM":
            ready = ready.withColumn("__len", norm(F.col("embedding")))
            scaled = unit(F.col("embedding"), F.col("__len")).cast("array<float>")
            ready = ready.withColumn("embedding", scaled).drop("__len")
        else:
            ready = ready.withColumn("embedding", F.col("embedding").cast("array<float>"))
        metadata = datapoints.schema["embedding_metadata"].dataType.fieldNames()
        pointer = "chunk_line_offset"
        order = F.col(f"embedding_metadata.{pointer}") if pointer in metadata else F.lit(0)
        return last_per_key(ready.withColumn("__seq", order), "id", "__seq").drop("__seq")

    def applied(self, name: str, batch: tuple[str, int] | None) -> bool:
        """Whether a stream's batch, as ``(stream, number)``, is in the index."""
        return self.table(name).applied(self.spark, batch)

    def update(
        self, name: str, datapoints: DataFrame, overwrite: bool = False, replace_files: bool = False,
        batch: tuple[str, int] | None = None,
    ) -> int:
        """Full overwrite or partial upsert; returns the new version of the index.

        ``replace_files`` also removes old chunks of the files in this batch that it no longer has. Of a ``batch`` that
        the index has already nothing changes. Buckets with many deltas are compacted.
        """
        table = self.table(name)
        before = table.manifest(self.spark)
        ready = self._placed(name, self._prepared(self.find(name), datapoints), before)
        if overwrite:
            return table.overwrite(ready, before=before)
        version = table.upsert(ready, "embedding_metadata.source_file" if replace_files else None, batch, before)
        try:
            return max(version, table.compact(self.spark, MOST_LAYERS))
        except Conflict:  # another update has come in between; a later one compacts
            return version
