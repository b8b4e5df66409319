"""Alignment of two tokenizers over the same bytes, by lockstep merging.

A document is tokenised by A and by B, whose tokens cut the same bytes in different places. Every document of a block is
a lane of one NumPy state vector: a step links each lane's present A token to its present B token, marks a cut where
both end at the same byte, and moves on the pointer whose token ends first, or both. Finished lanes are compacted away. A long
document is several lanes, each from the end of one A token to the end of a later one, so that no lane holds up the
others.

How many documents hold a pair of ids linked is counted over the distinct pairs of each block; counts are joined back to
the blocks by pair, and a block then sums them for its documents. Neither pairs nor counts are ever sent to one task or to
the driver; what is broadcast has at most one row for each id of A.

Null and empty texts, and texts whose bytes a tokenizer does not give back (such as those holding U+2581), have no
tokens: their numbers are 0 and ``groups_sha256`` is ''. Repeated rows are documents of their own; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeindex.llm.bytelevel import MARKS, parts_of, token_bytes, words_of
from skeindex.llm.common import staged
from skeindex.llm.packing import TextTokenizer
from skeindex.llm.remember import Remembered

# Characters of text in a block, A tokens in a lane, lanes in the state vector, tokens written out at a time.
BLOCK_CHARS, LANE_TOKENS, LANES, WRITTEN = 750_000, 256, 8192, 1 << 19
# Segments of text whose ids a worker remembers, in each of two generations.
REMEMBERED = 100_000


# --- tokenizers ---------------------------------------------------------------------------------


class ByteLevel(TextTokenizer):
    """Tokenizer A: a byte-level BPE file; special tokens in a text are plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.bytes_of = token_bytes(self.tokenizer)

    def ids(self, text: str) -> bytes | None:
        """Ids of a text; None if their bytes are other ones, which ranks cannot give."""
        if self.by_ranks(text):
            return array("i", self.ranks.encode_ordinary(text)).tobytes()
        return _checked(self.tokenizer.encode(text, add_special_tokens=False).ids, self.bytes_of, text.encode())


class Pieces:
    """Tokenizer B: a BPE model of ``sentencepiece`` that writes a space as U+2581 and puts one before a text.

    ``cut``: no piece has a space after another character, nor a line break beside one, so that no token reaches over the
    edge of a word as ``words_of`` cuts it. ``joined`` are letters and digits that some piece has before a mark at which
    words are cut; texts that hold one are not cut.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        plain = [i for i in ids if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        pieces = [self.model.id_to_piece(i) for i in ids]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        whole = any("▁" in pieces[i].lstrip("▁") or ("\n" in pieces[i] and pieces[i] != "\n") for i in plain)
        self.line = self.model.encode("\n", num_threads=1)
        self.cut = not whole and [self.bytes_of[i] for i in self.line] == [b" ", b"\n"]
        joined = {x for i in plain for x, y in zip(pieces[i], pieces[i][1:]) if x.isalnum() and y in MARKS}
        self.joined = re.compile("[" + re.escape("".join(sorted(joined))) + "]") if joined else None

    def cuts(self, text: str) -> bool:
        return self.cut and not (self.joined and self.joined.search(text))

    def ids_of(self, segments: list[str]) -> list[list[int]]:
        """Ids of segments of a text that has a space before it."""
        # The model puts a space before each: a segment gives up one, or follows a line break that is taken off again.
        given = [s[1:] if s[0] == " " else "\n" + s for s in segments]
        found = self.model.encode(given, num_threads=1)
        plain = [ids if s[0] == " " else ids[len(self.line) :] for s, ids in zip(segments, found)]
        return [self.line[:1] if s == " " else ids for s, ids in zip(segments, plain)]  # nothing gets no space


class Tokenizers:
    """Ids by both tokenizers of a text with a space before it; those of B by words, which are remembered."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.known = Remembered(self._pieces, REMEMBERED, parts_of)

    def _pieces(self, segments: list[str]) -> Iterator[tuple[bytes | None]]:
        for segment, ids in zip(segments, self.b.ids_of(segments)):
            yield (_checked(ids, self.b.bytes_of, segment.encode()),)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and of B; none of either for texts whose bytes one of them does not give back, nor for empty ones."""
        numbers = self.known.numbers_of([_segments(text) if text and self.b.cuts(text) else [] for text in texts])
        known, out = self.known.found[0].__getitem__, []
        for text, of in zip(texts, numbers):
            a, b = self.a.ids(" " + text) if text else None, list(map(known, of))
            if text and not of:
                b = [_checked(self.b.model.encode(text, num_threads=1), self.b.bytes_of, b" " + text.encode())]
            out.append((_NONE, _NONE) if a is None or None in b else (np.frombuffer(a, dtype="<i4"), np.frombuffer(b"".join(b), dtype="<i4")))
        return out


_NONE = np.zeros(0, dtype="<i4")


def _checked(ids: list[int], bytes_of: list[bytes], raw: bytes) -> bytes | None:
    """Ids as bytes; None where their tokens' bytes are other ones."""
    return array("i", ids).tobytes() if b"".join(map(bytes_of.__getitem__, ids)) == raw else None


def _segments(text: str) -> list[str]:
    if not text[:1].isalnum():
        return words_of(" " + text)
    words = words_of(text)
    words[0] = " " + words[0]
    return words


_loaded: dict[tuple[str, str], Tokenizers] = {}


def loaded(a_path: str, b_path: str) -> Tokenizers:
    """One pair of tokenizers per worker and files."""
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Tokenizers(a_path, b_path)
    return _loaded[a_path, b_path]


# --- lockstep -----------------------------------------------------------------------------------


def lanes_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last A token (exclusive) of every lane: a document, or part of a long one."""
    ends = np.cumsum(sizes)
    n = -(-sizes // LANE_TOKENS)
    number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    first = np.repeat(ends - sizes, n) + number * LANE_TOKENS
    return first, np.minimum(first + LANE_TOKENS, np.repeat(ends, n))


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (position in A, position in B) of the lanes, and whether both tokens end there.

    ``a_ends`` and ``b_ends``: the byte at which each token ends, over all documents one after the other.
    """
    a, stop = first.copy(), last
    start = np.where(first > 0, a_ends[first - 1], 0)
    b = np.searchsorted(b_ends, start, side="right")
    links: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(a):
        a_end, b_end = a_ends.take(a), b_ends.take(b)
        both = a_end == b_end
        links.append((a, b, both))
        move_a = a_end <= b_end
        a, b = a + move_a, b + (both | ~move_a)
        on = a < stop
        if not on.all():
            a, b, stop = a[on], b[on], stop[on]
    if not links:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    return tuple(np.concatenate(x) for x in zip(*links))


class Aligned:
    """The alignment of a block: ``a`` and ``b`` hold the ids of each document, none for those without tokens."""

    def __init__(self, a: Sequence[np.ndarray], b: Sequence[np.ndarray], a_bytes: np.ndarray, b_bytes: np.ndarray):
        self.n_a, self.n_b = (np.array([len(x) for x in of], dtype=np.int64) for of in (a, b))
        self.a, self.b = (np.concatenate([np.zeros(0, dtype=np.int32), *of]) for of in (a, b))
        a_ends, b_ends = np.cumsum(a_bytes[self.a]), np.cumsum(b_bytes[self.b])
        doc_of = np.repeat(np.arange(len(a)), self.n_a)
        self.a_cut, self.b_cut = np.zeros(len(self.a), dtype=bool), np.zeros(len(self.b), dtype=bool)
        self.n_links = np.zeros(len(a), dtype=np.int64)
        first, last = lanes_of(self.n_a)
        wide, found = len(b_bytes), []
        for i in range(0, len(first), LANES):
            at_a, at_b, both = lockstep(a_ends, b_ends, first[i : i + LANES], last[i : i + LANES])
            self.a_cut[at_a[both]] = True
            self.b_cut[at_b[both]] = True
            doc = doc_of[at_a]
            self.n_links += np.bincount(doc, minlength=len(a))
            pairs, place = np.unique(self.a[at_a].astype(np.int64) * wide + self.b[at_b], return_inverse=True)
            keys, n = np.unique(doc * len(pairs) + place, return_counts=True)
            found.append((keys // max(1, len(pairs)), pairs[keys % max(1, len(pairs))], n))
        self.n_groups = np.bincount(doc_of[self.a_cut], minlength=len(a))
        self._count(found)

    def _count(self, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """The distinct pairs of the block with their documents; per document its pairs and how often it links them."""
        doc, pair, n = (np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in (zip(*found) if found else [()] * 3))
        self.pairs, place = np.unique(pair, return_inverse=True)
        keys, place = np.unique(doc * max(1, len(self.pairs)) + place, return_inverse=True)
        self.times = np.bincount(place, n, len(keys)).astype(np.int64)
        self.pair_at = keys % max(1, len(self.pairs))
        self.docs = np.bincount(self.pair_at, minlength=len(self.pairs))
        self.n_pairs = np.bincount(keys // max(1, len(self.pairs)), minlength=len(self.n_a))

    def digests(self) -> list[str]:
        """sha256 of the groups of each document as text; '' without tokens."""
        a_end, b_end = np.flatnonzero(self.a_cut) + 1, np.flatnonzero(self.b_cut) + 1
        a_group = np.cumsum(self.a_cut) - self.a_cut
        b_group = np.cumsum(self.b_cut) - self.b_cut
        b_start = np.r_[0, b_end[:-1]] if len(b_end) else b_end
        ids = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        mark = np.empty(len(ids), dtype=np.uint8)
        at_a, at_b = np.arange(len(self.a)) + b_start[a_group], np.arange(len(self.b)) + a_end[b_group]
        ids[at_a], ids[at_b] = self.a, self.b
        last = np.zeros(len(self.a), dtype=bool)
        last[a_end - 1] = True
        mark[at_a] = np.where(last, ord("|"), ord(","))
        mark[at_b] = np.where(self.b_cut, ord(";"), ord(","))
        ends = np.cumsum(self.n_a + self.n_b)
        out = []
        for start, end in zip(ends - self.n_a - self.n_b, ends):
            digest = hashlib.sha256()
            for i in range(start, end, WRITTEN):
                written = _written(ids[i : min(end, i + WRITTEN)], mark[i : min(end, i + WRITTEN)])
                digest.update(written if end > i + WRITTEN else written[:-1])
            out.append(digest.hexdigest() if end > start else "")
        return out


def _digits(ids: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits in ``wide`` columns, and which of them are written."""
    tens = 10 ** np.arange(wide - 1, -1, -1)
    return (ids[:, None] // tens % 10 + ord("0")).astype(np.uint8), (ids[:, None] >= tens) | (tens == 1)


_SMALL = _digits(np.arange(1 << 16), 5)


def _written(ids: np.ndarray, mark: np.ndarray) -> bytes:
    """Decimal ids, each with its mark behind it."""
    most = int(ids.max(initial=0))
    digits, written = (x.take(ids, axis=0) for x in _SMALL) if most < 1 << 16 else _digits(ids, len(str(most)))
    text = np.column_stack([digits, mark])
    return text[np.column_stack([written, np.ones(len(ids), dtype=bool)])].tobytes()


# --- the Spark job ------------------------------------------------------------------------------


def _schema(of_id: T.DataType) -> T.StructType:
    lists = {"doc_ids": of_id, **{c: T.LongType() for c in ("n_a", "n_b", "n_groups", "n_links")}, "digests": T.StringType()}
    lists |= {"n_pairs": T.IntegerType(), "pair_at": T.IntegerType(), "times": T.IntegerType(), "pairs": T.LongType(), "docs": T.IntegerType()}
    return T.StructType([T.StructField("block", T.LongType()), *(T.StructField(name, T.ArrayType(kind)) for name, kind in lists.items())])


def _listed(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Blocks of documents with their alignments; the pairs of ids, as ``a * (ids of B) + b``, once for a block."""
    rows = docs.select("doc_id", "text")
    schema = _schema(rows.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, number = loaded(a_path, b_path), TaskContext.get().partitionId() << 32
        a_bytes, b_bytes = (np.array([len(x) for x in t.bytes_of], dtype=np.int64) for t in (both.a, both.b))

        def made(ids: list[pa.Array], texts: list[str]) -> pa.RecordBatch:
            nonlocal number
            a_ids, b_ids = zip(*both.encode(texts))
            found = Aligned(a_ids, b_ids, a_bytes, b_bytes)
            arrays = [pa.concat_arrays(ids), *(pa.array(x) for x in (found.n_a, found.n_b, found.n_groups, found.n_links)), pa.array(found.digests(), pa.string())]
            arrays += [pa.array(x.astype(np.int32)) for x in (found.n_pairs, found.pair_at, found.times)] + [pa.array(found.pairs), pa.array(found.docs.astype(np.int32))]
            number += 1
            return pa.record_batch([pa.array([number], pa.int64()), *map(_listed, arrays)], names=schema.names)

        ids, texts, size = [], [], 0
        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                if texts and size + len(text) > BLOCK_CHARS:
                    yield made(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(batch.column(0).slice(i, 1))
                texts.append(text)
                size += len(text)
        if texts:
            yield made(ids, texts)

    return rows.mapInArrow(run, schema)


def pair_counts(blocks: DataFrame, b_size: int) -> DataFrame:
    """``pair, n, best``: documents that hold a pair of ids linked, and whether that is the most of its A id."""
    found = blocks.select(F.explode(F.arrays_zip("pairs", "docs")).alias("x"))
    counts = staged(found.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.docs").alias("n")), "pair-counts")
    a = F.floor(F.col("pair") / F.lit(b_size)).alias("a")
    most = counts.groupBy(a).agg(F.max("n").alias("most"))  # a row for each id of A at most
    return counts.withColumn("a", a).join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row of ``docs(doc_id, text)``.

    A reads a space and the text; B reads the text and puts the space before it. Two tokens are linked if their bytes
    overlap; the bytes where both an A and a B token end part the tokens into groups. A link's count is the number of
    documents that hold its pair of ids linked. ``n_best`` counts the links whose count is the highest of their A id,
    ``count_sum`` adds up the counts of all links. The files of the tokenizers are at the same paths on every node.
    """
    b_size = len(loaded(a_path, b_path).b.bytes_of)
    blocks = staged(aligned_blocks(docs, a_path, b_path), "aligned")
    pairs = blocks.select("block", F.posexplode("pairs").alias("at", "pair")).join(pair_counts(blocks, b_size), "pair")
    known = pairs.groupBy("block").agg(F.collect_list(F.struct("at", "n", "best")).alias("known"))
    rows = blocks.drop("pairs", "docs").join(known, "block", "left").drop("block")
    longs = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    of_id = blocks.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField("doc_id", of_id), *(T.StructField(c, T.LongType()) for c in longs), T.StructField("groups_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part = {name: batch.column(name).slice(i, 1).flatten() for name in batch.schema.names}
                pair_at, times, n_pairs = (part[c].to_numpy(zero_copy_only=False) for c in ("pair_at", "times", "n_pairs"))
                counts, best = np.zeros(len(part["known"]), dtype=np.int64), np.zeros(len(part["known"]), dtype=bool)
                at, n, most = (part["known"].field(j).to_numpy(zero_copy_only=False) for j in range(3))
                counts[at], best[at] = n, most
                times = times.astype(np.int64)
                ends = np.r_[0, np.cumsum(n_pairs)]
                sums = [np.r_[0, np.cumsum(x)] for x in (times * best[pair_at], times * counts[pair_at])]
                n_best, count_sum = (pa.array(s[ends[1:]] - s[ends[:-1]]) for s in sums)
                columns = [part[c] for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")]
                yield pa.record_batch([*columns, n_best, count_sum, part["digests"]], names=schema.names)

    return rows.mapInArrow(run, schema)
