"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeindex.llm import align, fingerprint, lines, lm, merkle, mixing, packing, quality, simhash, topk, toxicity, warc
from skeindex.llm.common import session_of


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return session_of(spark).read.parquet(f"{sf}/{name}.parquet")


def op1_warc_derivatives(spark, sf):
    return warc.derive(warc.responses(table(spark, sf, "pages")))


def op2_toxicity_lexicon(spark, sf):
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op3_line_windows(spark, sf):
    """Of each document: its lines, how many go, which (comma-joined), and the MD5 of what stays."""
    cut = lines.without_windows(table(spark, sf, "documents"))
    gone = F.coalesce(F.col("gone"), F.array().cast("array<int>"))
    return cut.select(
        "doc.doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_removed"),
        F.array_join(gone.cast("array<string>"), ",").alias("removed_lines"),
        F.md5(F.col("text").cast("binary")).alias("text_md5"),
    )


def op4_repeated_lines(spark, sf):
    """Every unit of a repeated passage to remove, with its original offsets and the place of the unit that stays."""
    later = lines.repeated_passages(table(spark, sf, "documents"))
    return later.select(
        "doc_id", F.col("unit").cast("long").alias("unit"), "start", "end", F.lower(F.hex("digest")).alias("digest"),
        "kept_doc_id", F.col("kept_unit").cast("long").alias("kept_unit"),
    )


def op5_topk_threshold(spark, sf):
    vectors = topk.scaled(table(spark, sf, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("id % 50 = 0"), 5)


def op6_pack_powers(spark, sf):
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_paragraph_iblt(spark, sf):
    return fingerprint.fingerprints(table(spark, sf, "documents"))


def op8_mix_sources(spark, sf):
    mixed = mixing.mix(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op9_quality_attention(spark, sf):
    return quality.quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op10_simhash_trie(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op11_hashed_maxent(spark, sf):
    return lm.scores(table(spark, sf, "documents"))


def op12_merkle_manifest(spark, sf):
    return merkle.verified(table(spark, sf, "documents"))


def op13_token_alignment(spark, sf):
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align.align(table(spark, sf, "documents"), *paths)


QUERIES = {
    "op1_warc_derivatives": op1_warc_derivatives,
    "op2_toxicity_lexicon": op2_toxicity_lexicon,
    "op3_line_windows": op3_line_windows,
    "op4_repeated_lines": op4_repeated_lines,
    "op5_topk_threshold": op5_topk_threshold,
    "op6_pack_powers": op6_pack_powers,
    "op7_paragraph_iblt": op7_paragraph_iblt,
    "op8_mix_sources": op8_mix_sources,
    "op9_quality_attention": op9_quality_attention,
    "op10_simhash_trie": op10_simhash_trie,
    "op11_hashed_maxent": op11_hashed_maxent,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_token_alignment": op13_token_alignment,
}
