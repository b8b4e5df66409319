"""Duplicate passages across documents, made of sentence-sized units, and overlapping windows of three lines.

Both hash units of a document inside the Arrow batches in which it is read, keep only digests and positions, find the
digests that occur more than once by an aggregate that combines before the shuffle, and join the digests back to their
places. One digest can hold any number of places: the aggregate keeps one row of it per task, and the join is one that
adaptive execution splits.

Rows equal in ``doc_id`` and text are one document delivered more than once: they count as one occurrence and are
treated alike. Ids of null rank last. Null and empty texts have no units.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from skeindex.llm.common import let, staged

Unit = tuple[int, int, int, bytes] | tuple[int, int, int, bytes, int]  # number, first and last line or start and end, digest, words
# Pieces of a text, none left out: what ends in sentence marks or at a line break, and line breaks.
PIECE = r"[^.!?\n]+[.!?]*|[.!?]+|\n"
# Words that a run of repeated units has at least, to count as a repeated passage; shorter ones are stock phrases.
PASSAGE_WORDS = 20


def normal(line: str) -> str:
    """Lower case, runs of white space as one space, none at the ends."""
    return " ".join(line.lower().split())


def digest(text: str) -> bytes:
    return hashlib.md5(text.encode("utf-8", "replace"), usedforsecurity=False).digest()


def sentence_units(text: str) -> Iterator[Unit]:
    """Sentences and lines that are not blank: number, start and end in code points, digest of the normalised unit, words."""
    number = 0
    for piece in re.finditer(PIECE, text):
        plain = normal(piece.group())
        if plain:
            yield number, piece.start(), piece.end(), digest(plain), plain.count(" ") + 1
            number += 1


def line_windows(text: str, size: int = 3) -> Iterator[Unit]:
    """Windows of consecutive lines, blank lines passed over: number, first and last line, digest."""
    lines = [(i, plain) for i, line in enumerate(text.split("\n")) if (plain := normal(line))]
    for k in range(len(lines) - size + 1):
        yield k, lines[k][0], lines[k + size - 1][0], digest("\n".join(plain for _, plain in lines[k : k + size]))


def units(docs: DataFrame, cut: Callable[[str], Iterator[Unit]], words: bool = False) -> DataFrame:
    """``doc_id, text_hash, unit, first, last, digest`` (and ``words``) of all units of all rows."""
    rows = docs.select("text", "doc_id", F.xxhash64("text").alias("text_hash"))
    fields = {"text_hash": LongType(), "unit": IntegerType(), "first": LongType(), "last": LongType(), "digest": BinaryType()}
    fields |= {"words": IntegerType()} if words else {}
    schema = StructType([rows.schema["doc_id"], *(StructField(name, kind) for name, kind in fields.items())])
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32())[: 5 if words else 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(batch, of, found):
            keys = pa.array(of, pa.int64())
            columns = [pa.array(c, k) for c, k in zip(zip(*found) if found else [()] * len(kinds), kinds)]
            return pa.record_batch([batch.column(1).take(keys), batch.column(2).take(keys), *columns], schema=None, names=schema.names)

        for batch in batches:
            of, found = [], []
            for i, text in enumerate(batch.column(0)):
                for unit in cut(text.as_py() or ""):
                    of.append(i)
                    found.append(unit)
                    if len(found) >= 100_000:
                        yield made(batch, of, found)
                        of, found = [], []
            yield made(batch, of, found)

    return rows.mapInArrow(run, schema)


def repeated(found: DataFrame) -> DataFrame:
    """The units of ``found`` that are not the earliest of their digest, with the place of the earliest as ``kept``.

    Earliest: smallest doc_id (null last), then smallest unit.
    """
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "unit")
    first = found.groupBy("digest").agg(F.min(place).alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Written, so that the join has two plain shuffles, of which a large partition can be split.
    later = found.join(staged(first, "repeated"), "digest").where(~place.eqNullSafe(F.col("kept")))
    return later.select(*found.columns, F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.unit").alias("kept_unit"))


def repeated_passages(docs: DataFrame, at_least: int = PASSAGE_WORDS) -> DataFrame:
    """``doc_id, text_hash, unit, start, end, digest, words, kept_doc_id, kept_unit`` of every unit to remove.

    A unit is a sentence, cut at line breaks as well. Units that are not the earliest of their digest repeat; a run of
    consecutive ones, blank lines passed over, is a repeated passage if it has ``at_least`` words. ``start`` and ``end``
    (exclusive) are offsets in code points of the original text; ``unit`` numbers the units of a text.
    """
    later = repeated(staged(units(docs, sentence_units, words=True), "sentences"))
    own = ["doc_id", "text_hash"]
    later = later.dropDuplicates([*own, "unit"])  # a document delivered more than once: now at most the units of one text
    run = F.col("unit") - F.row_number().over(Window.partitionBy(*own).orderBy("unit"))
    of_run = Window.partitionBy(*own, "run")
    found = later.withColumn("run", run).withColumn("run_words", F.sum("words").over(of_run)).where(F.col("run_words") >= at_least)
    return found.drop("run", "run_words").withColumnsRenamed({"first": "start", "last": "end"})


def without_passages(docs: DataFrame, later: DataFrame) -> DataFrame:
    """``docs`` without the units that ``later`` (from :func:`repeated_passages`) names; no row goes.

    ``n_chars``, if there, follows the text.
    """
    spans = F.sort_array(F.collect_set(F.struct(F.col("start").alias("from"), F.col("end").alias("to"))))
    rows = _joined(docs, later.groupBy("doc_id", "text_hash").agg(spans.alias("gone")))
    schema = StructType([StructField("text", rows.schema["text"].dataType), StructField("doc", rows.schema["doc"].dataType), StructField("gone", ArrayType(LongType()))])
    flat = rows.select("text", "doc", F.flatten(F.transform("gone", lambda x: F.array(x["from"], x["to"]))).alias("gone"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, gone in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if gone:  # what lies between the spans
                    edges = [0, *gone, len(text)]
                    text = "".join(text[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
                texts.append(text)
            yield pa.record_batch([pa.array(texts, pa.string()), batch.column(1), batch.column(2)], names=["text", "doc", "gone"])

    return _restored(docs, flat.mapInArrow(cut, schema))


def covered_lines(docs: DataFrame, size: int = 3) -> DataFrame:
    """``doc_id, text_hash, gone``: of each document that has any, the lines that repeated windows cover.

    A window of ``size`` consecutive lines (blank ones passed over) is repeated if it occurred before, in an earlier
    document or further up in the same one; the covered positions of all repeated windows of a document are merged.
    """
    later = repeated(staged(units(docs, lambda text: line_windows(text, size)), "windows"))
    lines = F.array_distinct(F.flatten(F.collect_list(F.sequence(F.col("first").cast("int"), F.col("last").cast("int")))))
    return later.groupBy("doc_id", "text_hash").agg(F.array_sort(lines).alias("gone"))


def without_windows(docs: DataFrame, size: int = 3) -> DataFrame:
    """``doc, text, n_lines, gone``: the row as it was, the text that stays, its lines before, and which went (or null)."""
    return _cut(docs, covered_lines(docs, size))


def deduplicated(docs: DataFrame, size: int = 3) -> DataFrame:
    """``docs`` without lines covered by repeated windows; ``n_chars``, if there, follows the text. No row goes."""
    return _restored(docs, without_windows(docs, size))


def _joined(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``doc, text, gone`` of every row: ``gone`` by id and text of the row, null where there is none."""
    key = {"hash": F.xxhash64("text"), "no_id": F.col("doc_id").isNull(), "id": F.coalesce("doc_id", F.lit(0))}
    of = {"hash": F.col("text_hash"), "no_id": F.col("doc_id").isNull(), "id": F.coalesce("doc_id", F.lit(0))}
    gone = gone.select(*[c.alias(name) for name, c in of.items()], "gone")
    rows = docs.select(F.struct(*docs.columns).alias("doc"), "text", *[c.alias(name) for name, c in key.items()])
    return rows.join(gone, list(key), "left")


def _cut(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Cut the lines ``gone`` (ascending) from the texts; a text of which nothing goes stays as it is, byte for byte."""
    rows, lines = _joined(docs, gone), F.split("text", "\n")
    first = F.filter("gone", lambda x, i: (i == 0) | (F.get("gone", i - 1) != x - 1))
    last = F.filter("gone", lambda x, i: (i == F.size("gone") - 1) | (F.get("gone", i + 1) != x + 1))

    def between(s):  # the lines before, between and after the runs of lines that go, as slices
        def piece(i):
            start = F.when(i == 0, 0).otherwise(F.get(s["last"], i - 1) + 1)
            end = F.when(i == F.size(s["first"]), F.size(s["lines"])).otherwise(F.get(s["first"], i))
            return F.slice(s["lines"], start + 1, end - start)

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(s["first"])), piece)), "\n")

    kept = let(F.struct(lines.alias("lines"), first.alias("first"), last.alias("last")), between)
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))
    return rows.select("doc", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"), n_lines.alias("n_lines"), "gone")


def _restored(docs: DataFrame, cut: DataFrame) -> DataFrame:
    """The columns of ``docs`` with the texts of ``cut``."""
    now = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        n_chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        now["n_chars"] = F.when(F.col("gone").isNull(), F.col("doc.n_chars")).otherwise(n_chars)
    return cut.select(*[now.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])
