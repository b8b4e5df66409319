"""Approximate dense search: vectors in cells around centroids, a share of the cells searched.

Cells are trained on every vector. While all centroids may be sent to the tasks there is one level of them; beyond
that, vectors are first split among parents, and the cells of all parents are trained together: a round of training is
one job over slices of bounded size, however many parents there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from skeindex.operators.search import (
    NEIGHBOR_COUNT,
    SCORE_ENTRIES,
    DenseTop,
    best_per_id,
    dense_topk,
    found_schema,
    query_block,
    query_blocks,
    query_width,
    top_k,
    union_all,
    value_bytes,
    vector_rows,
)
from skeindex.session import BROADCAST_BYTES, fits_broadcast, stage

# Vectors per cell and percent of cells searched.
LEAF_SIZE = 1000
PROBE_PCT = 10
# Vectors of one parent that meet its cells in one task; more are split.
PARENT_SLICE = 50_000
# Pairs of vector and query that a task scores, about half a minute's work; more are dealt to more tasks.
TASK_PAIRS = 500_000_000
# Partial sums of one cell that are added up in one step.
SALT = 64
CELLS = "parent int, parent_centroid array<double>, cell int, centroid array<double>"


def _sliced(vectors: DataFrame, counts: DataFrame) -> DataFrame:
    """Deal the vectors of each node into slices of bounded size."""
    slices = counts.select("node", F.ceil(F.col("n") / F.lit(PARENT_SLICE)).alias("__n"))  # one row per node
    return vectors.join(F.broadcast(slices), "node").withColumn("slice", (F.rand(5) * F.col("__n")).cast("int")).drop("__n")


def _first_centroids(vectors: DataFrame, wanted: DataFrame, seed: int) -> DataFrame:
    """``(node, cell, centroid)``: of each node ``k`` different vectors, chosen by a hash; fewer if it has fewer."""
    hashed = F.xxhash64("embedding", F.lit(seed))
    share = F.least(F.lit(1.0), (2 * F.col("k") + 32) / F.col("n"))
    chosen = vectors.join(F.broadcast(wanted), "node").withColumn("h", hashed)
    chosen = chosen.where((F.col("h") / float(1 << 64) + 0.5) <= share)
    # Copies of one vector are one candidate: gathered where they are read, before they meet.
    single = chosen.groupBy("node", "h").agg(F.first("embedding").alias("embedding"), F.first("k").alias("k"))
    place = F.row_number().over(W.partitionBy("node").orderBy("h"))  # about twice as many as there will be cells
    kept = single.withColumn("cell", place - 1).where(F.col("cell") < F.col("k"))
    return kept.select("node", "cell", F.col("embedding").cast("array<double>").alias("centroid"))


def _sum_vectors(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Add up ``n`` and the vectors ``total`` of equal keys, in two steps, so that no list gets long."""
    add = lambda a, b: F.when(F.size(a) == 0, b).otherwise(F.zip_with(a, b, lambda x, y: x + y))
    for salted in ([*keys, "__salt"], keys):
        grouped = parts.groupBy(*salted).agg(F.sum("n").alias("n"), F.collect_list("total").alias("x"))
        parts = grouped.withColumn("total", F.aggregate("x", F.array().cast("array<double>"), add)).drop("x")
    return parts


def grouped_centroids(vectors: DataFrame, wanted: DataFrame, seed: int, iterations: int) -> DataFrame:
    """``(node, cell, centroid)`` of ``vectors(node, embedding)``: ``k`` means of each node in ``wanted(node, k, n)``.

    Lloyd's rounds for all nodes at once. A cell that no vector is nearest to stays where it was.
    """
    wanted = stage(wanted, "wanted")
    rows = stage(_sliced(vectors, wanted), "slices")
    slices = stage(rows.select("node", "slice").distinct(), "pairs")
    centroids = stage(_first_centroids(vectors, wanted, seed), "centroids")

    def meet(rows: pa.Table, cells: pa.Table) -> pa.Table:
        width = pc.list_value_length(cells["centroid"])[0].as_py() if cells.num_rows else 0
        _, centers = vector_rows(cells["centroid"], width)
        keep, points = vector_rows(rows["embedding"], width)
        place = _nearest(points, centers) if len(centers) else np.zeros(0, dtype=int)
        order = np.argsort(place, kind="stable")
        of = place[order]
        starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, dtype=int)
        sums = np.add.reduceat(points[order], starts, axis=0) if len(of) else np.zeros((0, max(1, width)))
        n = np.diff(np.r_[starts, len(of)]) if len(of) else starts
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(starts) + 1, dtype=np.int32) * width), pa.array(sums.ravel()))
        node = rows["node"].take(pa.array(np.zeros(len(starts), dtype=np.int64)))
        salt = pa.array(np.full(len(starts), (rows["slice"][0].as_py() if rows.num_rows else 0) % SALT, dtype=np.int32))
        return pa.table({"node": node, "cell": cells["cell"].take(pa.array(of[starts])), "__salt": salt, "n": pa.array(n, pa.int64()), "total": lists})

    schema = "node int, cell int, __salt int, n long, total array<double>"
    keys = ["node", "slice"]
    for _ in range(iterations):
        right = centroids.join(slices, "node")
        parts = rows.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, schema)
        means = _sum_vectors(parts, ["node", "cell"]).select("node", "cell", F.transform("total", lambda x: x / F.col("n")).alias("mean"))
        moved = centroids.join(means, ["node", "cell"], "left")
        centroids = stage(moved.select("node", "cell", F.coalesce("mean", "centroid").alias("centroid")), "centroids")
    return centroids


def train_cells(
    vectors: DataFrame,
    leaf_size: int = LEAF_SIZE,
    seed: int = 7,
    iterations: int = 10,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(parent, parent_centroid, cell, centroid)``: one cell per ``leaf_size`` vectors of ``(id, embedding)``.

    Vectors that are missing, empty or not finite are left out; the others have one length. With one level all cells
    have parent 0. With two, a parent's cells are trained on its own vectors; they have to fit a task, so one that is
    more crowded than that gets larger cells. The number of jobs does not depend on the number of parents.
    """
    spark = vectors.sparkSession
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.where((F.size("embedding") > 0) & finite).select(F.lit(0).alias("node"), "embedding")
    # Every round reads its input.
    usable = stage(usable, "training")
    facts = usable.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("d")).first()
    if not facts["n"]:
        raise ValueError("no vectors to train cells on")
    cells, most = -(-facts["n"] // leaf_size), max(1, limit // (8 * facts["d"]))
    # With two levels: about the square root of the cells, and so many that a parent has an eighth of what fits a task.
    parents = cells if cells <= most else min(most, max(math.isqrt(cells - 1) + 1, -(-8 * cells // most)))
    first = spark.createDataFrame([(0, parents, facts["n"])], "node int, k int, n long")
    top = grouped_centroids(usable, first, seed, iterations)
    if cells <= most:
        none = F.array_repeat(F.lit(0.0), facts["d"])
        return stage(top.select(F.lit(0).alias("parent"), none.alias("parent_centroid"), "cell", "centroid"), "cells")
    nodes = top.select(F.lit(0).alias("parent"), F.array().cast("array<double>").alias("parent_centroid"), "cell", "centroid")
    split = stage(assign_cells(usable.drop("node"), nodes, limit).withColumnRenamed("cell", "node"), "split")
    sizes = split.groupBy("node").agg(F.count("*").alias("n"))
    wanted = sizes.select("node", F.least(F.ceil(F.col("n") / leaf_size), F.lit(most)).cast("int").alias("k"), "n")
    below = grouped_centroids(split, wanted, seed, iterations)
    # Cells of all parents are numbered in the order of the parents.
    start = F.coalesce(F.sum("k").over(W.orderBy("node").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # one row per parent
    starts = below.groupBy("node").agg(F.count("*").alias("k")).select("node", start.cast("int").alias("start"))
    centers = top.select(F.col("cell").alias("node"), F.col("centroid").alias("parent_centroid"))
    found = below.join(F.broadcast(starts), "node").join(F.broadcast(centers), "node")
    return stage(found.select(F.col("node").alias("parent"), "parent_centroid", (F.col("start") + F.col("cell")).alias("cell"), "centroid"), "cells")


def _nearest(vectors: np.ndarray, centers: np.ndarray) -> np.ndarray:
    half = (centers**2).sum(1) / 2
    rows = max(1, SCORE_ENTRIES // len(centers))
    parts = [vectors[i : i + rows] for i in range(0, len(vectors), rows)]
    return np.concatenate([(p @ centers.T - half).argmax(1) for p in parts]) if parts else np.zeros(0, dtype=int)


def _with_nearest(vectors: DataFrame, table: DataFrame, key: str, centroid: str) -> DataFrame:
    """Add the key of the nearest centroid of a table that may be sent to the tasks; null without a usable vector."""
    found = table.select(key, centroid).distinct().orderBy(key).collect()
    keys = np.array([r[key] for r in found], dtype="int32")
    centers = np.array([r[centroid] for r in found], dtype="float64")
    shared = vectors.sparkSession.sparkContext.broadcast((keys, centers))
    schema = T.StructType([*vectors.schema.fields, T.StructField(key, T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, centers = shared.value
        for batch in batches:
            keep, points = vector_rows(batch.column("embedding"), centers.shape[1])
            good = np.isfinite(points).all(axis=1)
            place = np.flatnonzero(keep)[good]
            out = np.zeros(batch.num_rows, dtype="int32")
            missing = np.ones(batch.num_rows, dtype=bool)
            out[place], missing[place] = keys[_nearest(points[good], centers)], False
            column = pa.array(out, pa.int32(), mask=missing)
            yield pa.record_batch([*batch.columns, column], names=[*batch.schema.names, key])

    return vectors.mapInArrow(run, schema)


def assign_cells(vectors: DataFrame, centroids: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Add the ``cell`` of the nearest centroid to every row; rows without a usable vector get null.

    With more centroids than may be sent to the tasks, rows go to the nearest parent first and meet the cells of that
    parent only; crowded parents are split.
    """
    if fits_broadcast(centroids, F.size("centroid") * 8, limit):
        return _with_nearest(vectors, centroids, "cell", "centroid")
    routed = stage(_with_nearest(vectors, centroids, "parent", "parent_centroid"), "routed")
    slices = routed.groupBy("parent").agg(F.ceil(F.count("*") / F.lit(PARENT_SLICE)).alias("__n"))
    slices = F.broadcast(stage(slices, "slices"))  # one row per parent
    left = routed.join(slices, "parent").withColumn("__part", F.pmod(F.xxhash64("embedding"), "__n")).drop("__n")
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1))
    right = centroids.join(slices, "parent").select("parent", parts.alias("__part"), "cell", "centroid")
    schema = T.StructType([*vectors.schema.fields, T.StructField("cell", T.IntegerType())])
    names = vectors.columns

    def meet(rows: pa.Table, cells: pa.Table) -> pa.Table:
        width = pc.list_value_length(cells["centroid"])[0].as_py() if cells.num_rows else 0
        _, centers = vector_rows(cells["centroid"], width)
        keep, points = vector_rows(rows["embedding"], width)
        rows = rows.select(names).filter(pa.array(keep))
        nearest = pa.array(_nearest(points, centers)) if len(centers) else pa.array([], pa.int64())
        return rows.append_column("cell", cells["cell"].take(nearest))

    keys = ["parent", "__part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, schema)
    rest = routed.where(F.col("parent").isNull()).select(*names, F.lit(None).cast("int").alias("cell"))
    return found.unionByName(rest)


def write_cells(assigned: DataFrame, path: str) -> None:
    """Store vectors partitioned by cell; a crowded cell gets several files."""
    stored = assigned.where(F.col("cell").isNotNull()).hint("rebalance", "cell")
    stored.write.mode("overwrite").partitionBy("cell").parquet(path)


def choose_cells(
    centroids: DataFrame, queries: DataFrame, metric: str = "dot", probe_pct: int = PROBE_PCT,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(qid, cell)``: the closest ``probe_pct`` percent of the cells of each query, one at least."""
    probes = max(1, -(-centroids.count() * probe_pct // 100))
    cells = centroids.select(F.col("cell").alias("id"), F.col("centroid").alias("embedding"))
    return dense_topk(cells, queries, probes, metric, limit).select("qid", F.col("id").alias("cell"))


def ann_topk(
    assigned: DataFrame,
    centroids: DataFrame,
    queries: DataFrame,
    k: int = NEIGHBOR_COUNT,
    metric: str = "dot",
    probe_pct: int = PROBE_PCT,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(qid, rank, id, score)`` over the closest ``probe_pct`` percent of the cells of each query.

    With ``assigned`` read from a table partitioned by cell, other cells are not read. Queries are sent to the tasks
    block by block, each query vector once, with the pairs of query and cell.
    """
    queries = queries.select("qid", "dense").where(F.size("dense") > 0)
    width, schema = query_width(queries), found_schema(queries, assigned)
    pairs = stage(choose_cells(centroids, queries, metric, probe_pct, limit), "probes")
    per_query = pairs.groupBy("qid").agg(F.count("*").alias("n"))
    sized = queries.join(per_query, "qid").withColumn("bytes", F.size("dense") * 8 + value_bytes(queries, "qid") + 12 * F.col("n"))
    vectors = assigned.select("id", "embedding", "cell")
    found = []
    for part in query_blocks(sized, F.col("bytes"), limit):
        part = stage(part.select("qid", "dense"), "block")
        own = pairs.join(F.broadcast(part.select("qid")), "qid", "left_semi")
        found.append(_search_cells(vectors, part, own, k, metric, width, schema))
    best = best_per_id(union_all(found), metric != "l2")
    ranked = top_k(best, k, F.col("score"), ascending=metric == "l2")
    return ranked.select("qid", "rank", "id", "score")


def _search_cells(vectors: DataFrame, queries: DataFrame, pairs: DataFrame, k: int, metric: str, width: int, schema) -> DataFrame:
    """One block of queries against the cells that they chose."""
    spark = vectors.sparkSession
    asked, listed = queries.toArrow(), pairs.toArrow()
    if not asked.num_rows:
        return spark.createDataFrame([], schema)
    qids, matrix = query_block(asked, width)
    row = {q: i for i, q in enumerate(qids.to_pylist())}
    rows = np.array([row[q] for q in listed["qid"].to_pylist()], dtype="int64")
    cells = listed["cell"].to_numpy()
    order = np.argsort(cells, kind="stable")
    names, starts = np.unique(cells[order], return_index=True)
    chosen = dict(zip(names.tolist(), np.split(rows[order], starts[1:])))
    shared = spark.sparkContext.broadcast((qids, matrix, chosen))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, matrix, chosen = shared.value
        for batch in batches:
            id_type = batch.schema.field("id").type
            for cell in pc.unique(batch.column("cell")).to_pylist():
                if cell in chosen:
                    top = DenseTop(matrix[chosen[cell]], k, metric)
                    top.add(batch.filter(pc.equal(batch.column("cell"), cell)))
                    yield from top.result(qids.take(pa.array(chosen[cell])), id_type).to_batches()

    near = F.broadcast(pairs.select("cell").distinct())  # within the block's measured size
    searched = vectors.join(near, "cell", "left_semi").select("id", "embedding", "cell")
    most = max(len(rows) for rows in chosen.values())  # queries of a cell
    tasks = -(-searched.count() * most // TASK_PAIRS)
    if tasks > max(1, len(vectors.inputFiles())):  # the rows of a cell stay together as far as they fit a task
        searched = searched.repartitionByRange(tasks, "cell", F.xxhash64("id", "embedding"))
    return searched.mapInArrow(scan, schema)
