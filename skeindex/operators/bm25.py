"""Corpus statistics and sparse vectors (BM25) as aggregations and row-local projections."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skeindex.functions.arrays import with_counts
from skeindex.functions.stem import stems
from skeindex.functions.text import (
    ENGLISH_STOP_WORDS,
    document_text,
    term_id,
    without_stop_words,
    words,
)
from skeindex.session import fits_broadcast

# BM25 saturation and length weight.
K1 = 1.2
B = 0.75


@dataclass(frozen=True)
class Analyzer:
    """How text becomes terms. The same analyzer must serve fit, documents and queries."""

    stem: bool = True
    stop_words: tuple = field(default=tuple(ENGLISH_STOP_WORDS))

    def tokens(self, text):
        kept = without_stop_words(words(text), self.stop_words)
        return stems(kept) if self.stem else kept


@dataclass(frozen=True)
class Model:
    """A fitted model: ``df(term_id, df)`` and the one-row ``stats(n_docs, avgdl, k1, b)``."""

    df: DataFrame
    stats: DataFrame


def coalesce_text(records: DataFrame) -> DataFrame:
    """One text column ``chunk`` from either spelling; records without text are dropped."""
    text = document_text(records.columns)
    return records.withColumn("chunk", text).where(F.col("chunk").isNotNull()).drop("text")


def doc_ids(records: DataFrame) -> DataFrame:
    """Ids of the records that have text, even when that text yields no token."""
    return coalesce_text(records).select("id")


def with_terms(df: DataFrame, text: str = "chunk", analyzer: Analyzer = Analyzer()) -> DataFrame:
    """Add ``terms array<struct<term_id, tf>>`` (sorted by id) and ``doc_len``, row by row.

    One row is one document, so counting inside the row needs no shuffle and keeps documents that
    share an id apart.
    """
    tokens = df.withColumn("__tokens", analyzer.tokens(F.col(text)))
    ids = F.sort_array(F.transform("__tokens", term_id))
    keyed = tokens.withColumn("__ids", ids).drop("__tokens")
    return with_counts(keyed, "__ids", "terms", "doc_len")


def term_frequency(df: DataFrame, text: str = "chunk", analyzer: Analyzer = Analyzer()) -> DataFrame:
    """``(id, term_id, tf)`` rows."""
    termed = with_terms(df.select("id", text), text, analyzer)
    return termed.select("id", F.inline_outer("terms")).where(F.col("term_id").isNotNull())


def document_frequency(termed: DataFrame) -> DataFrame:
    """``(term_id, df)``: each document lists a term once, so a count with map-side combine does."""
    # The outer form keeps the optimizer from adding a size check that repeats the counting.
    exploded = termed.select(F.explode_outer("terms.term_id").alias("term_id"))
    return exploded.where(F.col("term_id").isNotNull()).groupBy("term_id").agg(F.count("*").alias("df"))


def corpus_stats(termed: DataFrame, k1: float = K1, b: float = B) -> DataFrame:
    """One row: documents with at least one token, and their mean length."""
    has_tokens = F.col("doc_len") > 0
    return termed.agg(
        F.count_if(has_tokens).alias("n_docs"),
        F.coalesce(F.avg(F.when(has_tokens, F.col("doc_len"))), F.lit(0.0)).alias("avgdl"),
    ).select("n_docs", "avgdl", F.lit(k1).alias("k1"), F.lit(b).alias("b"))


def fit(records: DataFrame, analyzer: Analyzer = Analyzer(), k1: float = K1, b: float = B) -> Model:
    """Document frequencies and corpus statistics over all records that have text."""
    termed = with_terms(coalesce_text(records).select("id", "chunk"), "chunk", analyzer)
    return Model(document_frequency(termed), corpus_stats(termed, k1, b))


def encode_documents(termed: DataFrame, model: Model | None, drop_terms: bool = True) -> DataFrame:
    """Add ``sparse_embedding struct<indices, values>``; null when there is no model."""
    vector = "struct<indices array<bigint>, values array<double>>"
    if model is None:
        encoded = termed.withColumn("sparse_embedding", F.lit(None).cast(vector))
        return encoded.drop("terms", "doc_len") if drop_terms else encoded
    # One-row scalar subqueries: computed once, no join.
    stats = model.stats
    k1, b, avgdl = (stats.select(c).scalar() for c in ("k1", "b", "avgdl"))
    sized = termed.withColumn(
        "__damp", k1 * (1 - b + b * F.col("doc_len") / F.when(avgdl > 0, avgdl).otherwise(1.0))
    )
    values = F.transform("terms", lambda t: t["tf"] / (F.col("__damp") + t["tf"]))
    encoded = sized.withColumn(
        "sparse_embedding",
        F.struct(F.col("terms.term_id").alias("indices"), values.alias("values")),
    ).drop("__damp")
    return encoded.drop("terms", "doc_len") if drop_terms else encoded


def queries_are_small(queries: DataFrame, text: str = "text") -> bool:
    """May the terms of these queries be broadcast? Their text bounds their number."""
    return fits_broadcast(queries, F.length(text) * 16)


def query_terms(
    queries: DataFrame, model: Model, text: str = "text", analyzer: Analyzer = Analyzer(),
    small: bool | None = None,
) -> DataFrame:
    """``(qid, term_id, weight)``: inverse document frequency, normalised within each query."""
    listed = with_terms(queries.select("qid", text), text, analyzer).select(
        "qid", F.explode_outer("terms.term_id").alias("term_id")
    )
    listed = listed.where(F.col("term_id").isNotNull())
    wanted = listed.select("term_id").distinct()
    if queries_are_small(queries, text) if small is None else small:
        wanted = F.broadcast(wanted)
    known = model.df.join(wanted, "term_id", "left_semi")
    n_docs = model.stats.select("n_docs").scalar()
    idf = F.ln((n_docs + 1) / (F.coalesce(F.col("df"), F.lit(1)) + 0.5))
    scored = listed.join(known, "term_id", "left").select("qid", "term_id", idf.alias("idf"))
    total = F.sum("idf").over(W.partitionBy("qid"))
    return scored.select("qid", "term_id", (F.col("idf") / total).alias("weight"))


def encode_queries(
    queries: DataFrame, model: Model, text: str = "text", analyzer: Analyzer = Analyzer()
) -> DataFrame:
    """``(qid, sparse struct<values, dimensions>)``, terms ordered by id."""
    pairs = F.array_sort(F.collect_list(F.struct("term_id", "weight")))
    packed = query_terms(queries, model, text, analyzer).groupBy("qid").agg(pairs.alias("p"))
    return packed.select(
        "qid",
        F.struct(F.col("p.weight").alias("values"), F.col("p.term_id").alias("dimensions")).alias(
            "sparse"
        ),
    )


def postings(encoded: DataFrame) -> DataFrame:
    """``(id, term_id, weight)`` rows of encoded documents."""
    pairs = F.arrays_zip("sparse_embedding.indices", "sparse_embedding.values")
    rows = encoded.select("id", F.explode_outer(pairs).alias("p")).where(F.col("p").isNotNull())
    return rows.select("id", F.col("p.indices").alias("term_id"), F.col("p.values").alias("weight"))
