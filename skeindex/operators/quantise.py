"""Product quantisation: short codes of vectors, scored by tables, and an exact ranking of the best ones.

A vector is cut into parts of a few dimensions, and each part is replaced by the nearest of up to 256 entries of the
part's codebook. A query makes a table of its products with all entries; the sum of the entries that a code names
approximates the product with the vector, which is not read. The best codes of the searched cells make a shortlist, of
which the vectors are read and scored exactly.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeindex.functions.vectors import dot, norm
from skeindex.operators.ann import PROBE_PCT, _nearest, choose_cells
from skeindex.operators.search import (
    NEIGHBOR_COUNT,
    SCORE_PLACES,
    RunningTop,
    best_per_id,
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

# Fixed value: candidates of each query that are scored exactly.
SHORTLIST = 150
# Dimensions of a part, entries of its codebook, vectors that codebooks are fitted to, and rounds of fitting.
PART_DIMS, ENTRIES, SAMPLE, ROUNDS = 4, 256, 50_000, 12
CODEBOOKS = "part int, entries array<array<double>>"
# Bytes of query tables that a task keeps.
TABLE_BYTES = 32 << 20


def _means(points: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """``k`` means of points, at most as many as there are different ones."""
    different = np.unique(points, axis=0)
    rng = np.random.default_rng(seed)
    centers = different[rng.permutation(len(different))[:k]]
    for _ in range(rounds if len(different) > k else 0):
        place = _nearest(points, centers)
        n = np.bincount(place, minlength=len(centers))
        sums = np.column_stack([np.bincount(place, points[:, j], len(centers)) for j in range(points.shape[1])])
        centers = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centers)
    return centers


def train_codebooks(vectors: DataFrame, part_dims: int = PART_DIMS, sample: int = SAMPLE, seed: int = 7) -> DataFrame:
    """``(part, entries)`` from about ``sample`` vectors, chosen by a hash; one job for all parts, a group for each.

    Vectors that are missing, empty or not finite are left out; the others have one length.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.where((F.size("embedding") > 0) & finite).select(F.col("embedding").cast("array<double>").alias("v"))
    n = usable.count()
    if not n:
        raise ValueError("no vectors to train codebooks on")
    # By a random number, not by the vector: copies are chosen like others.
    chosen = usable.where(F.rand(seed) < sample / n) if n > sample else usable
    parts = F.transform(F.sequence(F.lit(0), F.ceil(F.size("v") / F.lit(part_dims)).cast("int") - 1), lambda i: F.slice("v", i * part_dims + 1, part_dims))
    rows = chosen.select(F.posexplode(parts).alias("part", "x"))

    def fit(group: pa.Table) -> pa.Table:
        _, points = vector_rows(group["x"], pc.list_value_length(group["x"])[0].as_py())
        found = _means(points, ENTRIES, ROUNDS, seed)
        return pa.table({"part": group["part"].slice(0, 1).cast(pa.int32()), "entries": pa.array([found.tolist()], pa.list_(pa.list_(pa.float64())))})

    return stage(rows.groupBy("part").applyInArrow(fit, CODEBOOKS), "codebooks")


def load_codebooks(codebooks: DataFrame) -> list[np.ndarray]:
    """The entries of each part, in order; their size depends on the dimensions only."""
    return [np.array(r["entries"], dtype=np.float64) for r in codebooks.orderBy("part").collect()]


def with_codes(vectors: DataFrame, codebooks: DataFrame) -> DataFrame:
    """Add ``codes`` (a byte for each part) and the ``length`` of every vector; null without a usable vector."""
    shared = vectors.sparkSession.sparkContext.broadcast(load_codebooks(codebooks))
    schema = T.StructType([*vectors.schema.fields, T.StructField("codes", T.BinaryType()), T.StructField("length", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        width = sum(b.shape[1] for b in books)
        for batch in batches:
            keep, points = vector_rows(batch.column("embedding"), width)
            good = np.isfinite(points).all(axis=1)
            place, points = np.flatnonzero(keep)[good], points[good]
            codes = np.zeros((len(points), len(books)), dtype=np.uint8)
            at = 0
            for j, book in enumerate(books):
                codes[:, j] = _nearest(points[:, at : at + book.shape[1]], book)
                at += book.shape[1]
            column, lengths = [None] * batch.num_rows, [None] * batch.num_rows
            for i, code, size in zip(place.tolist(), codes, np.linalg.norm(points, axis=1).tolist()):
                column[i], lengths[i] = code.tobytes(), size
            yield pa.record_batch([*batch.columns, pa.array(column, pa.binary()), pa.array(lengths, pa.float64())], names=schema.names)

    return vectors.mapInArrow(run, schema)


class CodeTop(RunningTop):
    """Top lists of one cell's queries by their tables."""

    def __init__(self, tables: list[np.ndarray], sizes: np.ndarray, k: int, metric: str) -> None:
        super().__init__(len(tables), k)
        self.tables, self.sizes, self.metric = tables, sizes, metric

    def add(self, codes: np.ndarray, lengths: np.ndarray, ids) -> None:
        parts = np.arange(codes.shape[1])
        for q, table in enumerate(self.tables):
            products = table[parts, codes].sum(axis=1)
            if self.metric == "cosine":
                sizes = self.sizes[q] * lengths
                products = np.divide(products, sizes, out=np.zeros_like(products), where=sizes > 0)
            elif self.metric == "l2":
                products = 2 * products - lengths**2  # larger is nearer
            self.offer_one(q, products, ids)


class QueryTables:
    """Tables of queries, made when they are needed; the ones used last are kept."""

    def __init__(self, matrix: np.ndarray, books: list[np.ndarray]) -> None:
        self.matrix, self.books = matrix, books
        self.kept: OrderedDict[int, np.ndarray] = OrderedDict()
        self.most = max(1, TABLE_BYTES // (len(books) * ENTRIES * 8))

    def __getitem__(self, q: int) -> np.ndarray:
        if q in self.kept:
            self.kept.move_to_end(q)
            return self.kept[q]
        table, at = np.zeros((len(self.books), ENTRIES)), 0
        for j, book in enumerate(self.books):
            table[j, : len(book)] = book @ self.matrix[q, at : at + book.shape[1]]
            at += book.shape[1]
        self.kept[q] = table
        if len(self.kept) > self.most:
            self.kept.popitem(last=False)
        return table


def shortlists(
    coded: DataFrame, centroids: DataFrame, codebooks: DataFrame, queries: DataFrame, size: int = SHORTLIST,
    metric: str = "dot", probe_pct: int = PROBE_PCT, limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(qid, id, cell)``: by their codes the best ``size`` ids of the closest ``probe_pct`` percent of the cells.

    ``coded(id, cell, codes, length)``; vectors are not read. Queries are sent to the tasks block by block.
    """
    queries = queries.select("qid", "dense").where(F.size("dense") > 0)
    query_width(queries)
    books = load_codebooks(codebooks)
    pairs = stage(choose_cells(centroids, queries, metric, probe_pct, limit), "probes")
    per_query = pairs.groupBy("qid").agg(F.count("*").alias("n"))
    sized = queries.join(per_query, "qid").withColumn("bytes", F.size("dense") * 8 + value_bytes(queries, "qid") + 12 * F.col("n"))
    schema = T.StructType([*found_schema(queries, coded).fields, T.StructField("cell", T.IntegerType())])
    found = []
    for part in query_blocks(sized, F.col("bytes"), limit):
        part = stage(part.select("qid", "dense"), "block")
        own = pairs.join(F.broadcast(part.select("qid")), "qid", "left_semi")
        found.append(_scan_codes(coded, part, own, books, size, metric, schema))
    best = union_all(found).groupBy("qid", "id").agg(F.max(F.struct("score", "cell")).alias("x")).select("qid", "id", "x.score", "x.cell")
    return top_k(best, size, F.col("score")).select("qid", "id", "cell")


def _scan_codes(coded: DataFrame, queries: DataFrame, pairs: DataFrame, books: list[np.ndarray], size: int, metric: str, schema) -> DataFrame:
    """One block of queries against the codes of the cells that they chose."""
    spark = coded.sparkSession
    asked, listed = queries.toArrow(), pairs.toArrow()
    if not asked.num_rows:
        return spark.createDataFrame([], schema)
    qids, matrix = query_block(asked, sum(b.shape[1] for b in books))
    row = {q: i for i, q in enumerate(qids.to_pylist())}
    chosen: dict[int, list[int]] = {}
    for qid, cell in zip(listed["qid"].to_pylist(), listed["cell"].to_pylist()):
        if qid in row:
            chosen.setdefault(cell, []).append(row[qid])
    shared = spark.sparkContext.broadcast((qids, matrix, books, chosen))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, matrix, books, chosen = shared.value
        tables, sizes = QueryTables(matrix, books), np.linalg.norm(matrix, axis=1)
        for batch in batches:
            for cell in pc.unique(batch.column("cell")).to_pylist():
                if cell not in chosen:
                    continue
                own = batch.filter(pc.equal(batch.column("cell"), cell))
                own = own.filter(pc.is_valid(own.column("codes")))
                if not own.num_rows:
                    continue
                codes = np.frombuffer(b"".join(own.column("codes").to_pylist()), dtype=np.uint8).reshape(own.num_rows, len(books))
                lengths, ids = own.column("length").to_numpy(zero_copy_only=False), own.column("id")
                for i in range(0, len(chosen[cell]), tables.most):
                    part = chosen[cell][i : i + tables.most]
                    top = CodeTop([tables[q] for q in part], sizes[part], size, metric)
                    top.add(codes, lengths, ids)
                    found = top.result(qids.take(pa.array(part)), ids.type)
                    yield from found.append_column("cell", pa.array(np.full(found.num_rows, cell, dtype=np.int32))).to_batches()

    near = F.broadcast(pairs.select("cell").distinct())  # within the block's measured size
    return coded.join(near, "cell", "left_semi").select("id", "cell", "codes", "length").mapInArrow(scan, schema)


def quantised_topk(
    coded: DataFrame, centroids: DataFrame, codebooks: DataFrame, queries: DataFrame, k: int = NEIGHBOR_COUNT,
    metric: str = "dot", probe_pct: int = PROBE_PCT, shortlist: int = SHORTLIST, limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(qid, rank, id, score)``: the shortlist of each query, scored exactly. Of rows that repeat an id the best counts.

    ``coded(id, embedding, cell, codes, length)``, read from a table partitioned or sorted by cell; vectors are read for
    shortlisted ids only.
    """
    wanted = stage(shortlists(coded, centroids, codebooks, queries, max(k, shortlist), metric, probe_pct, limit), "shortlist")
    rows = wanted.join(queries.select("qid", "dense"), "qid")
    small = fits_broadcast(wanted, value_bytes(wanted, "qid") + value_bytes(wanted, "id") + 8)
    pointers = wanted.select("id", "cell").distinct()
    near = coded.select("id", "cell", "embedding").join(F.broadcast(pointers) if small else pointers, ["id", "cell"], "left_semi")
    met = rows.join(near, ["id", "cell"])
    product = dot(F.col("embedding"), F.col("dense"))
    if metric == "cosine":
        sizes = norm(F.col("embedding")) * norm(F.col("dense"))
        product = F.when(sizes > 0, product / sizes).otherwise(0.0)
    elif metric == "l2":
        gaps = F.zip_with("embedding", "dense", lambda x, y: x.cast("double") - y.cast("double"))
        product = norm(gaps)
    scored = met.select("qid", "id", F.round(product, SCORE_PLACES).alias("score"))
    best = best_per_id(scored, metric != "l2")
    ranked = top_k(best, k, F.col("score"), ascending=metric == "l2")
    return ranked.select("qid", "rank", "id", "score")
