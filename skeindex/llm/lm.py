"""A hashed maximum-entropy language model with a class-factored softmax.

A word falls by its hash into a class and a group within it. What came before a word (the word before, which makes a
bigram, and the word two before as a skip feature) is hashed to rows of two weight tables: one gives a softmax over
classes, the other, its rows hashed with the class, a softmax over the groups of that class. Within a group words have
their smoothed share of the training tokens, so the model starts as the smoothed unigram model, sums to one over any
vocabulary, and its size does not grow with the corpus:

    P(word | before) = P(class | before) * P(group | class, before) * (count + 1) / (sum of count + 1 in the group, + 1)

The last ``1`` is the share of words that training has not seen. Documents are read once, into blocks of whole texts
with a dictionary each. One shuffle brings the entries of all dictionaries together by word, and their counts go back to
the blocks. Training passes once over all training tokens, in rounds: every task takes gradient steps from the present
weights over its blocks of the round, and what the tasks changed is averaged row by row, by how often each met the row.
Scoring reads a block at a time, in slices of sparse rows.

Null texts are empty: a text always ends with one end token. Repeated rows are documents of their own. An id of null
has the crc32 of the empty text, 0, so it is trained on. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeindex.llm.common import crc32_fold, staged
from skeindex.session import shared_dir

# Size of the factored softmax and rows of each weight table: the model's size, whatever the corpus.
CLASSES, GROUPS, ROWS = 32, 32, 1 << 15
# Rounds of training, tokens of one gradient step, first step size, parts in which weights travel, bound on a sum of weights.
ROUNDS, STEP_TOKENS, RATE, PARTS, MOST = 4, 8192, 0.35, 32, 40.0
# Bytes of text in a block; a longer text is a block of its own. Dictionary entries that meet in one partition.
BLOCK_BYTES, PART_ENTRIES = 8_000_000, 500_000
# The end of a text; no word is empty.
END = b""
SEED = 42
_START = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.array([0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], dtype=np.uint64)
_CLASS, _SPREAD = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
_SHIFT = np.uint64(64 - (ROWS.bit_length() - 1))


# --- words, classes and features ----------------------------------------------------------------


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(SEED)), dtype=np.uint64, count=len(words))


def class_and_group(hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (hashed & np.uint64(CLASSES - 1)).astype(np.int64), (hashed >> np.uint64(32) & np.uint64(GROUPS - 1)).astype(np.int64)


def before(hashed: np.ndarray, place: np.ndarray, first: int = 0, last: int | None = None) -> list[np.ndarray]:
    """Hashes of what precedes the tokens from ``first`` to ``last``: the word before, and the word two before.

    ``place``: the token's position in its text; beyond the start of a text stands one start word.
    """
    at = np.arange(first, len(hashed) if last is None else min(last, len(hashed)))
    own = place[at]
    return [np.where(own < k, _START, hashed.take(at - k, mode="clip")) * odd for k, odd in zip((1, 2), _ODD)]


def class_rows(found: list[np.ndarray]) -> list[np.ndarray]:
    return [((x ^ x >> np.uint64(29)) * _SPREAD >> _SHIFT).astype(np.uint16) for x in found]


def group_rows(found: list[np.ndarray], classes: np.ndarray) -> list[np.ndarray]:
    """Rows of what precedes a token, with its class."""
    own = (classes.astype(np.uint64) + np.uint64(1)) * _CLASS
    return class_rows([x + own for x in found])


@dataclass
class Model:
    """Logarithms of the classes' and groups' shares, and the two weight tables."""

    class_bias: np.ndarray
    group_bias: np.ndarray
    classes: np.ndarray
    groups: np.ndarray
    class_hits: np.ndarray
    group_hits: np.ndarray

    @classmethod
    def of_shares(cls, shares: np.ndarray) -> Model:
        """A model without weights; ``shares``: the mass of each class and group, the unseen words included."""
        empty = lambda width: np.zeros((ROWS, width), dtype=np.float32)
        hits = lambda: np.zeros(ROWS, dtype=np.float32)
        rows = shares.sum(axis=1)
        return cls(np.log(rows / rows.sum()).astype(np.float32), np.log(shares / rows[:, None]).astype(np.float32), empty(CLASSES), empty(GROUPS), hits(), hits())

    def sums(self, table: np.ndarray, rows: list[np.ndarray], bias: np.ndarray) -> np.ndarray:
        """The bias and rows of ``table`` of every token added up, within bounds that no exponential overflows."""
        x = table.take(rows[0], axis=0)
        for r in rows[1:]:
            x += table.take(r, axis=0)
        x += bias
        return np.clip(x, -MOST, MOST, out=x)

    def log_shares(self, table: np.ndarray, rows: list[np.ndarray], bias: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Natural logarithm of each token's own share in the softmax of its sums."""
        x = self.sums(table, rows, bias)
        own = x[np.arange(len(right)), right]
        return own - np.log(np.exp(x, out=x) @ np.ones(x.shape[1], dtype=np.float32))

    def score(self, hashed: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Natural logarithm of P(class, group | before) of every token."""
        out = np.empty(len(hashed))
        for i in range(0, len(hashed), STEP_TOKENS):
            found = before(hashed, place, i, i + STEP_TOKENS)
            classes, groups = class_and_group(hashed[i : i + STEP_TOKENS])
            first = self.log_shares(self.classes, class_rows(found), self.class_bias, classes)
            second = self.log_shares(self.groups, group_rows(found, classes), self.group_bias[classes], groups)
            out[i : i + STEP_TOKENS] = first.astype(np.float64) + second
        return out

    def learn(self, hashed: np.ndarray, place: np.ndarray) -> None:
        """Gradient steps over the tokens, in order."""
        for i in range(0, len(hashed), STEP_TOKENS):
            found = before(hashed, place, i, i + STEP_TOKENS)
            classes, groups = class_and_group(hashed[i : i + STEP_TOKENS])
            self._step(self.classes, self.class_hits, class_rows(found), self.class_bias, classes)
            self._step(self.groups, self.group_hits, group_rows(found, classes), self.group_bias[classes], groups)

    def _step(self, table: np.ndarray, hits: np.ndarray, rows: list[np.ndarray], bias: np.ndarray, right: np.ndarray) -> None:
        """One step: a row moves by its gradient over the root of how often it was met."""
        slope = self.sums(table, rows, bias)
        np.exp(slope, out=slope)
        slope /= (slope @ np.ones(slope.shape[1], dtype=np.float32))[:, None]
        slope[np.arange(len(right)), right] -= 1
        for r in rows:
            order = np.argsort(r, kind="stable")
            of = r.take(order)
            starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            met, n = of[starts].astype(np.intp), np.diff(np.r_[starts, len(of)])
            seen = hits.take(met) + n
            hits[met] = seen
            move = slope.take(order.take(starts), axis=0)
            often = n > 1
            if often.any():
                ends = np.cumsum(n[often])
                move[often] = np.add.reduceat(slope.take(order[np.repeat(often, n)], axis=0), ends - n[often], axis=0)
            move *= (RATE / np.sqrt(1 + seen))[:, None]
            table[met] = table.take(met, axis=0) - move


# --- blocks of texts ----------------------------------------------------------------------------


def text_blocks(docs: DataFrame, folds: int = 7, held: int = 2, rounds: int = ROUNDS) -> DataFrame:
    """Blocks of whole texts: ids, held-out marks, token counts, tokens as numbers of words, words, training counts."""
    held_out = crc32_fold(F.col("doc_id"), folds) == held
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"), held_out.alias("held_out"))
    of_id = rows.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()), T.StructField("round", T.IntegerType()), T.StructField("doc_ids", T.ArrayType(of_id)),
            T.StructField("held_out", T.ArrayType(T.BooleanType())), T.StructField("sizes", T.ArrayType(T.IntegerType())),
            T.StructField("tokens", T.ArrayType(T.IntegerType())), T.StructField("words", T.ArrayType(T.BinaryType())), T.StructField("trained", T.ArrayType(T.IntegerType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, number = TaskContext.get().partitionId(), 0

        def made(ids: list[pa.Array], marks: list[bool], texts: list[bytes]) -> pa.RecordBatch:
            nonlocal number
            numbers: dict[bytes, int] = defaultdict()
            numbers.default_factory = numbers.__len__
            parts, sizes = [], []
            for text in texts:
                own = text.lower().split()  # bytes: only A-Z change, and the six ASCII white-space characters part words
                own.append(END)
                parts.append(np.fromiter(map(numbers.__getitem__, own), dtype=np.int32, count=len(own)))
                sizes.append(len(own))
            tokens = np.concatenate(parts)
            learned = np.repeat(~np.array(marks, dtype=bool), sizes)
            trained = np.bincount(tokens[learned], minlength=len(numbers)).astype(np.int32)
            block, number = first << 32 | number, number + 1
            arrays = [
                pa.array([block], pa.int64()), pa.array([(first + number) % rounds], pa.int32()), _listed(pa.concat_arrays(ids)), _listed(pa.array(marks, pa.bool_())),
                _listed(pa.array(sizes, pa.int32())), _listed(pa.array(tokens)), _listed(pa.array(list(numbers), pa.binary())), _listed(pa.array(trained)),
            ]
            return pa.record_batch(arrays, names=schema.names)

        ids, marks, texts, size = [], [], [], 0
        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                text = text.as_py()
                if texts and size + len(text) > BLOCK_BYTES:
                    yield made(ids, marks, texts)
                    ids, marks, texts, size = [], [], [], 0
                ids.append(batch.column(0).slice(i, 1))
                marks.append(batch.column(2)[i].as_py())
                texts.append(text)
                size += len(text)
        if texts:
            yield made(ids, marks, texts)

    return rows.mapInArrow(run, schema)


def _listed(values: pa.Array) -> pa.ListArray:
    """The values as one list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _values(column: pa.ListArray, i: int) -> np.ndarray:
    return column.slice(i, 1).flatten().to_numpy(zero_copy_only=False)


def _places(sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


# --- training -----------------------------------------------------------------------------------


def _tables(model: Model) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(model.classes, model.class_hits), (model.groups, model.group_hits)]


def changes(blocks: DataFrame, model: Model) -> DataFrame:
    """``part, moved, hits``: what gradient steps over ``blocks`` change in each part of the weights, averaged over tasks.

    A row's change is the mean of the tasks' changes, weighted by how often each met the row.
    """
    shape = {part: model_part.shape for part, model_part in enumerate(_split(model))}

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(model.class_bias, model.group_bias, *(x.copy() for x in (model.classes, model.groups, model.class_hits, model.group_hits)))
        for batch in batches:
            for i in range(batch.num_rows):
                sizes, marks = _values(batch.column(2), i), _values(batch.column(1), i)
                hashed = hashes(batch.column(4).slice(i, 1).flatten().to_pylist())[_values(batch.column(3), i)]
                learned = np.repeat(~marks.astype(bool), sizes)
                own.learn(hashed[learned], _places(sizes)[learned])
        for part, (now, was, hits, hits_were) in enumerate(zip(_split(own), _split(model), _split_hits(own), _split_hits(model))):
            met = hits - hits_were
            if met.any():
                moved = (now - was).astype(np.float16)
                yield pa.record_batch([pa.array([part], pa.int32()), pa.array([moved.tobytes()], pa.binary()), pa.array([met.tobytes()], pa.binary())], names=["part", "moved", "hits"])

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for part, moved, hits in zip(*(c.to_pylist() for c in batch.columns)):
                met = np.frombuffer(hits, dtype=np.float32)
                change = np.frombuffer(moved, dtype=np.float16).reshape(shape[part]) * met[:, None]
                if part in sums:
                    sums[part][0] += change
                    sums[part][1] += met
                else:
                    sums[part] = [change.astype(np.float32), met.copy()]
        for part, (change, met) in sums.items():
            change /= np.maximum(met, 1)[:, None]
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([change.tobytes()], pa.binary()), pa.array([met.tobytes()], pa.binary())], names=["part", "moved", "hits"])

    schema = "part int, moved binary, hits binary"
    rows = blocks.select("block", "held_out", "sizes", "tokens", "words")
    rows = rows.coalesce(blocks.sparkSession.sparkContext.defaultParallelism)  # weights travel once for each core
    found = rows.mapInArrow(learn, schema)
    return found.repartition(PARTS, "part").mapInArrow(mean, schema)


def _split(model: Model) -> list[np.ndarray]:
    return [x for table, _ in _tables(model) for x in np.array_split(table, PARTS)]


def _split_hits(model: Model) -> list[np.ndarray]:
    return [x for _, hits in _tables(model) for x in np.array_split(hits, PARTS)]


def train(blocks: DataFrame, model: Model, rounds: int = ROUNDS) -> Model:
    """One pass over all training tokens of ``blocks``, a round at a time; the driver holds the weights only."""
    for number in range(rounds):
        weights, hits = _split(model), _split_hits(model)  # views into the model
        for part, moved, met in changes(blocks.where(F.col("round") == number), model).collect():
            weights[part] += np.frombuffer(moved, dtype=np.float32).reshape(weights[part].shape)
            hits[part] += np.frombuffer(met, dtype=np.float32)
    return model


# --- scores -------------------------------------------------------------------------------------


def word_counts(blocks: DataFrame) -> DataFrame:
    """``block, counts``: of every word of a block's dictionary, in its order, the training tokens of all blocks.

    Each is coded as ``(count * CLASSES * GROUPS + cell) * 2 + first``; ``first`` marks one entry of each word. A word
    has at most one entry in a block, so no word has more entries than there are blocks. Entries meet by word and go back
    by block, in partitions of a bounded number of entries.
    """
    entries = blocks.agg(F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-entries // PART_ENTRIES))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, block in enumerate(batch.column(0).to_pylist()):
                words, trained = (batch.column(c).slice(i, 1).flatten() for c in (1, 2))
                for at in range(0, len(words), 50_000):
                    own = words.slice(at, 50_000)
                    places = np.arange(at, at + len(own), dtype=np.int32)
                    yield pa.record_batch([own, pa.array(np.full(len(own), block)), pa.array(places), trained.slice(at, 50_000)], names=["word", "block", "at", "trained"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        rows = pa.Table.from_batches(found).combine_chunks()
        words = rows["word"].combine_chunks().dictionary_encode()
        if isinstance(words, pa.ChunkedArray):
            words = words.combine_chunks()
        number = words.indices.to_numpy(zero_copy_only=False)
        total = np.bincount(number, rows["trained"].to_numpy(), len(words.dictionary)).astype(np.int64)
        classes, groups = class_and_group(hashes(words.dictionary.to_pylist()))
        coded = ((total * (CLASSES * GROUPS) + classes * GROUPS + groups) * 2)[number]
        # Of the entries of a word the one in the smallest block is its first.
        order = np.lexsort((rows["block"].to_numpy(), number))
        first = np.r_[True, number[order][1:] != number[order][:-1]]
        coded[order[first]] += 1
        yield from pa.table({"block": rows["block"], "at": rows["at"], "coded": pa.array(coded)}).to_batches(100_000)

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        block, at, coded = (pa.Table.from_batches(found)[c].to_numpy() for c in ("block", "at", "coded"))
        order = np.lexsort((at, block))
        ends = np.flatnonzero(np.r_[block[order][1:] != block[order][:-1], True]) + 1
        for start, end in zip(np.r_[0, ends[:-1]], ends):
            own = order[start:end]
            yield pa.record_batch([pa.array([block[own[0]]], pa.int64()), _listed(pa.array(coded[own]))], names=["block", "counts"])

    rows = blocks.select("block", "words", "trained").mapInArrow(listed, "word binary, block long, at int, trained int")
    rows = rows.repartition(parts, "word").mapInArrow(counted, "block long, at int, coded long")
    return rows.repartition(parts, "block").mapInArrow(gathered, "block long, counts array<long>")


def corpus_counts(counts: DataFrame) -> tuple[np.ndarray, int, int]:
    """The mass of each class and group (count + 1 of its words, and 1 for unseen ones), training tokens, distinct words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, words = np.zeros(CLASSES * GROUPS, dtype=np.int64), np.zeros(CLASSES * GROUPS, dtype=np.int64)
        for batch in batches:
            coded = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            n, cell = _decoded(coded)
            once = (coded & 1 == 1) & (n > 0)
            np.add.at(tokens, cell[once], n[once])
            np.add.at(words, cell[once], 1)
        met = np.flatnonzero(words)
        yield pa.record_batch([pa.array(met), pa.array(tokens[met]), pa.array(words[met])], names=["cell", "tokens", "words"])

    sums = counts.select("counts").mapInArrow(run, "cell long, tokens long, words long").groupBy("cell").agg(F.sum("tokens"), F.sum("words"))
    shares, n, v = np.ones(CLASSES * GROUPS), 0, 0
    for cell, tokens, words in sums.collect():  # a row for each cell at most
        shares[cell] += tokens + words
        n, v = n + tokens, v + words
    return shares.reshape(CLASSES, GROUPS), n, v


def _decoded(coded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts and cells of coded entries."""
    return (coded >> 1) // (CLASSES * GROUPS), (coded >> 1) % (CLASSES * GROUPS)


def scores(docs: DataFrame, folds: int = 7, held: int = 2, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs(doc_id, text)``.

    Training rows are those whose crc32 of the id as text, modulo ``folds``, is not ``held``. ``base_score`` is the
    add-one unigram model of the training tokens, ``score`` the model's log10 probability of the text.
    """
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/llm/texts-{uuid.uuid4().hex}"
    made = text_blocks(docs, folds, held, rounds)
    made.write.partitionBy("round").option("compression", "zstd").parquet(path)
    blocks = spark.read.schema(made.schema).parquet(path)
    counts = staged(word_counts(blocks), "counts")
    shares, n, v = corpus_counts(counts)
    model = train(blocks, Model.of_shares(shares), rounds)
    rows = blocks.join(counts, "block").select("doc_ids", "held_out", "sizes", "tokens", "words", "counts")
    return _scored(rows, model, shares, n, v)


def _scored(rows: DataFrame, model: Model, shares: np.ndarray, n: int, v: int) -> DataFrame:
    schema = T.StructType(
        [T.StructField("doc_id", rows.schema["doc_ids"].dataType.elementType), T.StructField("held_out", T.BooleanType())]
        + [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")]
        + [T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                sizes, tokens = _values(batch.column(2), i), _values(batch.column(3), i)
                hashed = hashes(batch.column(4).slice(i, 1).flatten().to_pylist())
                counts, cells = _decoded(_values(batch.column(5), i))
                starts = np.cumsum(sizes) - sizes
                within = np.log((counts + 1) / shares.ravel()[cells])
                base = np.add.reduceat(np.log10((counts + 1) / (n + 1 * (v + 1)))[tokens], starts)
                score = np.add.reduceat((model.score(hashed[tokens], _places(sizes)) + within[tokens]) / np.log(10), starts)
                n_known = np.add.reduceat((counts > 0)[tokens].astype(np.int64), starts)
                ids = batch.column(0).slice(i, 1).flatten()
                columns = [ids, batch.column(1).slice(i, 1).flatten(), pa.array(sizes.astype(np.int64)), pa.array(n_known), pa.array(np.full(len(sizes), n, dtype=np.int64))]
                yield pa.record_batch([*columns, pa.array(base), pa.array(score)], names=schema.names)

    return rows.mapInArrow(run, schema)
