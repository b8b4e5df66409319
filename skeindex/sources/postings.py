"""An inverted index of sparse vectors: postings clustered by term, in blocks with their greatest weight.

Documents are dealt into slices of a fixed number. A block holds what one term has in one slice: the places of its
documents, their weights, and the greatest and smallest weight. Blocks lie in folders by a hash of their term and sorted
by it, so a search opens the folders of its terms only.

A search bounds each slice for each query from the blocks' heads, without reading a posting. It scores the most
promising slices first; their kth score is a floor, and of the other slices only those are read whose bound reaches it.
The result is that of scoring every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from skeindex.operators.search import (
    NEIGHBOR_COUNT,
    SCORE_ENTRIES,
    SCORE_PLACES,
    best_per_id,
    found_schema,
    query_blocks,
    top_k,
    union_all,
    value_bytes,
)
from skeindex.session import BROADCAST_BYTES, fits_broadcast, stage

# Documents in a slice, folders of terms, and slices that are scored before there is a floor.
SLICE_DOCS = 512
BUCKETS = 64
SEEDS = 4
# Scores are rounded, so a bound may be this much below the floor.
SLACK = 10.0**-SCORE_PLACES


def slice_blocks(index: DataFrame, slice_docs: int = SLICE_DOCS) -> DataFrame:
    """``slice, term_id, n, top, low, at, weights, ids`` of ``index(id, sparse_embedding)``.

    A row without term holds the ids of its slice in the order of their places. Rows without a vector are left out;
    weights that are not finite do not count. Slices are made where rows are read, without a shuffle.
    """
    names = index.schema["sparse_embedding"].dataType.fieldNames()
    terms = "sparse_embedding." + ("dimensions" if "dimensions" in names else "indices")
    rows = index.select("id", F.col(terms).alias("terms"), F.col("sparse_embedding.values").alias("weights"))
    of_id = index.schema["id"].dataType
    fields = [("slice", T.LongType()), ("term_id", T.LongType()), ("n", T.IntegerType()), ("top", T.DoubleType()), ("low", T.DoubleType())]
    fields += [("at", T.ArrayType(T.IntegerType())), ("weights", T.ArrayType(T.DoubleType())), ("ids", T.ArrayType(of_id))]
    schema = T.StructType([T.StructField(*f) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: list[pa.Table] = []

        def made(docs: pa.Table) -> pa.RecordBatch:
            nonlocal number
            of = docs.combine_chunks()
            terms, weights = (of[c].combine_chunks() if of[c].num_chunks != 1 else of[c].chunk(0) for c in ("terms", "weights"))
            sizes = np.diff(terms.offsets.to_numpy())
            ids, values = terms.flatten().to_numpy(zero_copy_only=False), weights.flatten().to_numpy(zero_copy_only=False)
            at = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            good = np.isfinite(values)
            ids, values, at = ids[good], values[good], at[good]
            order = np.argsort(ids, kind="stable")
            ids, values, at = ids[order], values[order], at[order]
            starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, dtype=np.int64)
            ends = np.r_[starts[1:], len(ids)] if len(starts) else starts
            low, top = ((f.reduceat(values, starts) if len(starts) else values) for f in (np.minimum, np.maximum))
            offsets = pa.array(np.r_[starts, len(ids), len(ids)].astype(np.int32) if len(starts) else np.zeros(2, dtype=np.int32))
            blocks = len(starts)
            own_ids = of["id"].combine_chunks() if of["id"].num_chunks != 1 else of["id"].chunk(0)
            listed = pa.ListArray.from_arrays(pa.array([0] * (blocks + 1) + [len(own_ids)], pa.int32()), own_ids)
            columns = [
                pa.array(np.full(blocks + 1, number, dtype=np.int64)), pa.array([*ids[starts].tolist(), None], pa.int64()), pa.array(np.r_[ends - starts, 0].astype(np.int32)),
                pa.array(np.r_[top, 0.0]), pa.array(np.r_[low, 0.0]), pa.ListArray.from_arrays(offsets, pa.array(at)), pa.ListArray.from_arrays(offsets, pa.array(values)), listed,
            ]
            number += 1
            return pa.record_batch(columns, names=schema.names)

        for batch in batches:
            # Spark would compute the weights twice to tell which are missing.
            batch = batch.filter(pc.and_(batch.column("terms").is_valid(), batch.column("weights").is_valid()))
            waiting.append(pa.table(batch.columns, names=batch.schema.names))
            while sum(t.num_rows for t in waiting) >= slice_docs:
                docs = pa.concat_tables(waiting)
                yield made(docs.slice(0, slice_docs))
                waiting = [docs.slice(slice_docs)]
        if sum(t.num_rows for t in waiting):
            yield made(pa.concat_tables(waiting))

    return rows.mapInArrow(run, schema)


@dataclass(frozen=True)
class PostingStore:
    """The blocks and ids of one index under ``root``."""

    root: str
    buckets: int = BUCKETS

    def write(self, index: DataFrame, slice_docs: int = SLICE_DOCS) -> None:
        """Build the index of ``index(id, sparse_embedding)``; ``root`` must be new."""
        made = stage(slice_blocks(index, slice_docs), "slices")
        made.where("term_id is null").select("slice", "ids").write.parquet(f"{self.root}/ids")
        bucket = F.pmod(F.xxhash64("term_id"), F.lit(self.buckets)).cast("int")
        blocks = made.where("term_id is not null").drop("ids").withColumn("bucket", bucket)
        dealt = blocks.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term_id", "slice")
        dealt.write.partitionBy("bucket").parquet(f"{self.root}/blocks")

    def ids(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/ids")

    def blocks(self, spark: SparkSession, terms: DataFrame | None = None) -> DataFrame:
        """The blocks of the ``term_id`` of ``terms``, or all: other folders are not opened."""
        schema = "slice long, term_id long, n int, top double, low double, at array<int>, weights array<double>, bucket int"
        found = spark.read.option("basePath", f"{self.root}/blocks").schema(schema).parquet(f"{self.root}/blocks")
        if terms is None:
            return found
        wanted = terms.select("term_id").distinct().withColumn("bucket", F.pmod(F.xxhash64("term_id"), F.lit(self.buckets)).cast("int"))
        own = [r["bucket"] for r in wanted.select("bucket").distinct().collect()]  # as many as there are folders at most
        wanted = F.broadcast(wanted) if fits_broadcast(wanted, 16) else wanted
        return found.where(F.col("bucket").isin(own)).join(wanted, ["bucket", "term_id"], "left_semi")

    def search(self, terms: DataFrame, k: int = NEIGHBOR_COUNT, limit: int = BROADCAST_BYTES, seeds: int = SEEDS) -> DataFrame:
        """``(qid, rank, id, score)`` of ``terms(qid, term_id, weight)`` by dot product; of an id that repeats the best row counts."""
        found = [rows for part in self._parts(terms, limit) for rows, _ in self._phases(part, k, seeds)]
        ranked = top_k(best_per_id(union_all(found)), k, F.col("score"))
        return ranked.select("qid", "rank", "id", "score")

    def reads(self, terms: DataFrame, k: int = NEIGHBOR_COUNT, limit: int = BROADCAST_BYTES, seeds: int = SEEDS) -> DataFrame:
        """One row: postings of the index, postings of the terms asked for, and postings that the search reads."""
        spark = terms.sparkSession
        chosen = union_all([c.select("n") for part in self._parts(terms, limit) for _, c in self._phases(part, k, seeds)])
        sums = [d.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(c)) for d, c in ((self.blocks(spark), "postings"), (self.blocks(spark, terms), "asked"), (chosen, "read"))]
        return sums[0].crossJoin(sums[1]).crossJoin(sums[2])  # one row each

    def _parts(self, terms: DataFrame, limit: int) -> list[DataFrame]:
        terms = stage(terms.select("qid", "term_id", "weight").where("qid is not null and term_id is not null"), "asked")
        return query_blocks(terms, value_bytes(terms, "qid") + 24, limit)

    def _phases(self, terms: DataFrame, k: int, seeds: int) -> list[tuple[DataFrame, DataFrame]]:
        """Scores and blocks of the most promising slices, then of those that can still matter."""
        blocks = self.blocks(terms.sparkSession, terms)
        most = F.greatest(F.col("weight") * F.col("top"), F.col("weight") * F.col("low"), F.lit(0.0))
        heads = blocks.select("term_id", "slice", "top", "low").join(F.broadcast(terms), "term_id")
        bounds = stage(heads.groupBy("qid", "slice").agg(F.sum(most).alias("bound")), "bounds")
        order = W.partitionBy("qid").orderBy(F.desc("bound"), "slice")
        bounds = stage(bounds.withColumn("place", F.row_number().over(order)), "bounds")
        first, read = self._scored(blocks, terms, bounds.where(F.col("place") <= seeds), k)
        first = stage(first, "seeds")
        floors = top_k(best_per_id(first), k, F.col("score")).where(F.col("rank") == k).select("qid", F.col("score").alias("floor"))
        rest = bounds.where(F.col("place") > seeds).join(F.broadcast(floors), "qid", "left")
        rest = stage(rest.where(F.col("floor").isNull() | (F.col("bound") + SLACK >= F.col("floor"))).select("qid", "slice"), "rest")
        return [(first, read), self._scored(blocks, terms, rest, k)]

    def _scored(self, blocks: DataFrame, terms: DataFrame, pairs: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
        """The k best rows of each pair of query and slice, and the blocks that are read for them."""
        spark = terms.sparkSession
        wanted = pairs.join(F.broadcast(terms.select("qid", "term_id")), "qid").select("term_id", "slice").distinct()
        wanted = F.broadcast(wanted) if fits_broadcast(wanted, 24) else wanted
        chosen = blocks.join(wanted, ["term_id", "slice"], "left_semi")
        asked = pairs.groupBy("slice").agg(F.collect_set("qid").alias("qids")).join(self.ids(spark), "slice")
        shared = spark.sparkContext.broadcast(_by_query(terms.toArrow()))  # within the limit of a part
        schema = found_schema(terms, asked.select(F.element_at("ids", 1).alias("id")))

        def meet(postings: pa.Table, asked: pa.Table) -> pa.Table:
            ids, qids = (asked[c].combine_chunks().flatten() for c in ("ids", "qids"))
            return _slice_top(postings, ids, qids, shared.value, k)

        keyed = chosen.select("slice", "term_id", "at", "weights")
        return keyed.groupBy("slice").cogroup(asked.groupBy("slice")).applyInArrow(meet, schema), chosen


def _by_query(terms: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Queries, where the terms of each start, terms and weights; a term that a query repeats counts as often."""
    coded = terms["qid"].combine_chunks().dictionary_encode()
    owner = coded.indices.to_numpy(zero_copy_only=False).astype("int64")
    order = np.argsort(owner, kind="stable")
    starts = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(coded.dictionary)))].astype("int64")
    return coded.dictionary, starts, terms["term_id"].to_numpy()[order], terms["weight"].to_numpy()[order]


def _spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers ``start, start + 1, …`` of each span, one span after the other."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def _slice_top(postings: pa.Table, ids: pa.Array, qids: pa.Array, asked: tuple, k: int) -> pa.Table:
    """The k best ids of each query in one slice; each posting of a term meets the queries that ask for it."""
    known, starts, terms, factors = asked
    blocks = postings["term_id"].to_numpy()
    order = np.argsort(blocks, kind="stable")
    at, weights = (postings[c].combine_chunks() for c in ("at", "weights"))
    firsts = at.offsets.to_numpy().astype("int64") - at.offsets[0].as_py()
    at, weights = (x.flatten().to_numpy(zero_copy_only=False) for x in (at, weights))
    query = pc.index_in(qids, value_set=known).to_numpy(zero_copy_only=False).astype("int64")
    entry = _spans(starts[query], starts[query + 1] - starts[query])
    owner = np.repeat(np.arange(len(query)), starts[query + 1] - starts[query])
    block = np.searchsorted(blocks, terms[entry], sorter=order)
    there = block < len(blocks)
    there[there] = blocks[order[block[there]]] == terms[entry[there]]
    owner, factor, block = owner[there], factors[entry[there]], order[block[there]]
    sizes = firsts[block + 1] - firsts[block]
    # Queries in runs with a bounded number of (posting, query) pairs and of scores.
    width = max(1, len(ids))
    cost = np.maximum(np.bincount(owner, sizes, len(query)), width)
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(cost) // SCORE_ENTRIES)) + 1).tolist(), len(query)]
    places = pc.rank(ids, "ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype("int64")
    found = []
    for start, end in zip(cuts, cuts[1:]):
        own = slice(*np.searchsorted(owner, [start, end]))
        posting = _spans(firsts[block[own]], sizes[own])
        cell = np.repeat(owner[own] - start, sizes[own]) * width + at[posting]
        sums = np.bincount(cell, np.repeat(factor[own], sizes[own]) * weights[posting], (end - start) * width)
        hit = np.flatnonzero(np.bincount(cell, minlength=len(sums)))
        hit = hit[np.isfinite(sums[hit])]
        scores, asks, row = np.round(sums[hit], SCORE_PLACES), hit // width, hit % width
        best = np.lexsort((places[row], -scores, asks))
        # Of rows that repeat an id the best one counts.
        best = best[np.sort(np.unique(asks[best] * (width + 1) + places[row[best]], return_index=True)[1])]
        of = asks[best]
        best = best[np.arange(len(of)) - np.searchsorted(of, of) < k]
        found.append((asks[best] + start, row[best], scores[best]))
    asks, row, scores = (np.concatenate(x) for x in zip(*found))
    columns = {"qid": qids.take(pa.array(asks, pa.int64())), "id": ids.take(pa.array(row, pa.int64()))}
    return pa.table(columns | {"score": pa.array(scores + 0.0, pa.float64())})
