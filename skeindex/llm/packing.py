"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are powers of two: as many of the greatest length as fit, then
one for each bit of the rest. Pieces of one length form a bucket, and each piece is a sequence of its own, so no
sequence crosses documents and none is padded. A batch is read from one bucket.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from skeindex.llm.bytelevel import BYTE_LEVEL_PATTERN, byte_alphabet
from skeindex.llm.common import offset_by, staged

# Characters of text that a worker takes at a time.
BLOCK_CHARS = 1_000_000


# Characters that every version of Unicode classes alike, and runs too long for a search of pairs without a heap.
_COMMON = re.compile(r"[\x00-\u024f\u2010-\u2027\u20ac]*")
LONG_RUN = 400
_LONG_SPACE = re.compile(rf"\s{{{LONG_RUN}}}")


def ranked(path: str):
    """The tokenizer of a file as merge ranks for ``tiktoken``; None if the file says more than ranks can.

    They give the same ids if the file's merges are numbered in their order after the 256 bytes and it cuts texts by the
    usual pattern of byte-level tokenizers.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    cut, model = found.get("pre_tokenizer") or {}, found["model"]
    plain = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True) and found.get("normalizer") is None
    options = [model.get(o) for o in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")]
    if not plain or model.get("type") != "BPE" or any(options):
        return None
    letters, vocabulary = byte_alphabet(), model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    added = {t["content"] for t in found.get("added_tokens", [])}
    ranks = {bytes(letters[c] for c in entry): i for entry, i in vocabulary.items() if entry not in added}
    if sorted(i for x, i in ranks.items() if len(x) == 1) != list(range(256)) or any(vocabulary.get("".join(m)) != 256 + i for i, m in enumerate(merges)):
        return None
    if len(ranks) != 256 + len(merges):
        return None
    return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})


class TextTokenizer:
    """Token ids of texts as little-endian unsigned 32-bit bytes, as the tokenizer's file has them.

    Texts of common characters without added tokens go through the file's ranks, which is faster; all others through
    the tokenizer itself. A property test holds both to the same ids.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.ranks = Tokenizer.from_file(path), ranked(path)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added)) if added else None

    def by_ranks(self, text: str) -> bool:
        """Whether the ranks give the ids of this text."""
        if self.ranks is None or not (text.isascii() or _COMMON.fullmatch(text)) or (self.added and self.added.search(text)):
            return False
        return max(map(len, text.split()), default=0) < LONG_RUN and not _LONG_SPACE.search(text)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            ids = self.ranks.encode_ordinary(text) if self.by_ranks(text) else self.tokenizer.encode(text, add_special_tokens=False).ids
            yield array("I", ids).tobytes()


_tokenizers: dict[str, TextTokenizer] = {}


def tokenizer(path: str) -> TextTokenizer:
    """One tokenizer per worker and file."""
    if path not in _tokenizers:
        _tokenizers[path] = TextTokenizer(path)
    return _tokenizers[path]


def binary_lengths(n: int, longest: int) -> list[int]:
    """Lengths of the pieces of ``n`` tokens: powers of two up to ``longest``, falling."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in reversed(range(longest.bit_length())) if rest >> b & 1]


def pieces(docs: DataFrame, path: str, longest: int = 1024, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces with their length bucket and their number within task and bucket; ``ids`` only if asked for."""
    if longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    rows = docs.select("text", "doc_id")
    fields = [StructField(c, LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens")]
    fields += [StructField("bucket", IntegerType()), StructField("part", IntegerType()), StructField("number", LongType())]
    schema = StructType([rows.schema["doc_id"], *fields, *([StructField("ids", BinaryType())] * with_ids)])
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, counts = tokenizer(path), TaskContext.get().partitionId(), {}

        def packed(ids: pa.Array, texts: list[str], first: int) -> pa.RecordBatch:
            of, out = [], []
            for i, tokens in enumerate(encoder.encode(texts), start=first):
                view = memoryview(tokens + end)
                n, at = len(view) // 4, 0
                for length in binary_lengths(n, longest):
                    own, bucket = view[4 * at : 4 * (at + length)], length.bit_length() - 1
                    number = counts.get(bucket, 0)
                    counts[bucket] = number + 1
                    of.append(i)
                    out.append((at, length, zlib.crc32(own), n, bucket, part, number, *([bytes(own)] * with_ids)))
                    at += length
            kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.int64()] + [pa.binary()] * with_ids
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            return pa.record_batch([ids.take(pa.array(of, pa.int64())), *columns], names=schema.names)

        for batch in batches:
            texts, size, first = [], 0, 0
            for i, text in enumerate(batch.column(0)):
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= BLOCK_CHARS:
                    yield packed(batch.column(1), texts, first)
                    texts, size, first = [], 0, i + 1
            if texts:
                yield packed(batch.column(1), texts, first)

    return rows.mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, longest: int = 1024, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket`` (and ``ids``) of every piece.

    ``path``: the tokenizer's file, the same on every node. A document's ids end with ``end_id``, so null and empty
    texts are one piece of one id. Every sequence is one piece, at offset 0, of a power-of-two length; the sequences of
    a length are numbered without gaps, short lengths first. Repeated rows are packed as often as they occur; an empty
    table gives an empty result; columns other than ``doc_id`` and ``text`` are ignored.
    """
    found = staged(pieces(docs, path, longest, end_id, with_ids), "pieces")
    found = offset_by(found, [F.col("bucket"), F.col("part")], "number", "sequence_id")
    return found.withColumn("offset", F.lit(0).cast("long")).drop("part", "number")
