"""Mixing sources to target weights by hash-threshold histograms.

Every source has a budget of words. Sizes are summed by source and hash bucket; the cumulated histogram shows the
bucket in which the budget ends, and only that bucket is cut into finer buckets, until it holds one hash value. The
result is one hash threshold per source, so documents are taken by a filter; nothing is sorted. Thresholds of growing
budgets are nested: a document taken for one budget is taken for every larger one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeindex.llm.common import numbered, small, staged, word_count

HASH_BITS = 60
LEVEL_BITS = 12
KEYS = ["has_source", "source"]


def hash60(doc_id: Column, text: Column) -> Column:
    """A 60-bit hash of id and text, from MD5 so that SQL engines can compute it too."""
    digest = F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, h``: what mixing needs of each document (null text: size 0)."""
    return docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), hash60(F.col("doc_id"), F.col("text")).alias("h")
    )


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """``source, has_source, source_size, target``: weights go round the sources by code point, null last.

    A target stops at ``most`` times the source's size; the excess is shared among the others by weight, until none is
    above. Each round is one aggregate of two numbers over the table of sources.
    """
    key = F.coalesce(F.col("source"), F.lit(""))
    sums = sizes.groupBy(F.col("source").isNotNull().alias("has_source"), key.alias("source")).agg(F.sum("size").alias("source_size"))
    sums = numbered(sums, F.col("has_source").desc(), F.col("source"), name="position")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    sums = staged(sums.select("has_source", "source", "source_size", turn.alias("weight")), "sources")
    cap = F.lit(float(most)) * F.col("source_size")
    total = sums.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"]
    level, capped_before = None, -1
    while True:
        above = F.lit(False) if level is None else F.lit(level) * F.col("weight") > cap
        row = sums.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)).alias("capped"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("weight"),
            F.coalesce(F.sum(above.cast("int")), F.lit(0)).alias("n"),
        ).first()
        if row["n"] == capped_before or row["weight"] == 0:
            break
        level, capped_before = (total - row["capped"]) / row["weight"], row["n"]
    target = F.least(cap, F.lit(level or 0.0) * F.col("weight"))
    return sums.select("has_source", "source", "source_size", target.alias("target"))


def thresholds(sizes: DataFrame, budgets: DataFrame, level_bits: int = LEVEL_BITS) -> DataFrame:
    """``has_source, source, threshold``: documents with ``h <= threshold`` come nearest to ``budget``; no document: -1.

    A hash value is taken if its middle word is within the budget, so a source misses its budget by at most half of
    the documents of one hash value.
    """
    open_ = budgets.select(*KEYS, F.col("budget").cast("double").alias("left"), F.lit(0).cast("long").alias("prefix"))
    done, shift = None, HASH_BITS
    while True:
        shift = max(0, shift - level_bits)
        fan = F.lit(1 << level_bits).cast("long")
        bucket = F.shiftright("h", shift)
        inside = F.lit(True) if done is None else (F.floor(bucket / fan) == F.col("prefix"))
        rows = sizes.join(small(open_, 64 + F.length(F.col("source"))), KEYS).where(inside).groupBy(*KEYS, "left", bucket.alias("bucket"))
        hist = rows.agg(F.sum("size").alias("words"), F.min("h").alias("lo"), F.max("h").alias("hi"))
        before = F.coalesce(F.sum("words").over(Window.partitionBy(*KEYS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        hist = hist.withColumn("before", before)
        whole = F.col("before") + F.col("words") <= F.col("left")  # the bucket fits entirely
        half = (F.col("lo") == F.col("hi")) & (F.col("before") + F.col("words") / 2 <= F.col("left"))
        cut = (F.col("before") <= F.col("left")) & ~whole & (F.col("lo") != F.col("hi"))
        found = staged(
            hist.groupBy(*KEYS).agg(
                F.max(F.when(whole | half, F.col("hi"))).alias("taken_to"),
                F.max(F.when(cut, F.struct("bucket", (F.col("left") - F.col("before")).alias("left")))).alias("cut"),
            ),
            "thresholds",
        )
        step = found.select(*KEYS, "taken_to")
        done = step if done is None else done.unionByName(step)
        open_ = found.where(F.col("cut").isNotNull()).select(*KEYS, F.col("cut.left").alias("left"), F.col("cut.bucket").alias("prefix"))
        if shift == 0 or open_.isEmpty():
            break
    return done.groupBy(*KEYS).agg(F.coalesce(F.max("taken_to"), F.lit(-1)).alias("threshold"))


def limits(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """One row per source: ``has_source, source, source_size, target, rounds, threshold``.

    ``rounds`` copies of every document are taken, and one more of those with ``h <= threshold``.
    """
    targets = staged(source_targets(sizes, weights, most), "targets")
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("rounds", F.least(rounds, F.lit(int(most))).cast("int"))
    left = F.col("target") - F.col("rounds") * F.col("source_size")
    budgets = targets.select(*KEYS, left.alias("budget")).where("budget > 0")
    found = targets.join(thresholds(keyed(sizes), budgets), KEYS, "left")
    return staged(found.withColumn("threshold", F.coalesce("threshold", F.lit(-1))), "limits")


def keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with the source as two columns without nulls, so that it can be joined."""
    source = F.col("source").cast("string")
    return rows.withColumns({"has_source": source.isNotNull(), "source": F.coalesce(source, F.lit(""))})


def with_copies(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Add ``source_size, target, copies`` to rows with ``has_source, source, h``; the rows are not moved if the sources are few."""
    copies = F.col("rounds") + (F.col("h") <= F.col("threshold")).cast("int")
    rows = rows.join(small(found, 64 + F.length(F.col("source"))), KEYS)
    return rows.withColumn("copies", copies).drop("rounds", "threshold")


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` of every document.

    Null sources form one source of their own; a source of size 0 gets target 0; null text has size 0. Rows equal in id
    and text have one hash, so they are taken alike. An empty table gives an empty result. Other columns are ignored.
    """
    sizes = staged(sized(docs), "sizes")
    mixed = with_copies(keyed(sizes), limits(sizes, weights, most))
    source = F.when(F.col("has_source"), F.col("source")).alias("source")
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", source, "size", "source_size", "target", "copies", taken)


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``."""
    found = limits(staged(sized(docs), "sizes"), weights, most)
    rows = docs.select(
        F.struct(*docs.columns).alias("doc"), F.col("source"), hash60(F.col("doc_id"), F.col("text")).alias("h")
    )
    rows = with_copies(keyed(rows), found).where("copies > 0")
    return rows.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("doc.*")
