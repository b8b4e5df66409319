"""Toxicity: a weighted lexicon, matched by Aho-Corasick after folding look-alikes, normalised by length.

Texts are folded first: letters of other scripts and shapes that look like Latin ones and digits or signs that stand for
letters become those letters; invisible characters go, and marks that make no letter of a language with what they stand
on. The lexicon holds beginnings of words with weights; it is learned from labelled rows as the log-odds of a beginning
in toxic and other documents, counted by a Spark aggregate. A hit inside an exception phrase does not count. The summed
weight for a fixed number of words goes through a logistic curve.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeindex.llm import simhash
from skeindex.llm.common import staged
from skeindex.llm.components import components
from skeindex.llm.learn import labelled, logistic, scored, sigmoid

# Letters that look alike, digits and signs that stand for letters, characters without width, marks on letters.
LOOK_ALIKE = (
    "аa вb еe ёe іi їi јj кk мm нh оo рp сc тt уy хx ѕs ԁd ԛq ԝw һh "  # Cyrillic
    "αa βb εe ηn ιi κk νv οo ρp τt υu χx "  # Greek
    "ϲc ϳj ωw "
    "ոn օo սu հh ցg "  # Armenian
    "ᴀa ʙb ᴄc ᴅd ᴇe ɢg ʜh ɪi ᴊj ᴋk ʟl ᴍm ɴn ᴏo ᴘp ʀr ᴛt ᴜu ᴠv ᴡw ʏy ᴢz "  # small capitals
    "ɑa ɡg ıi øo đd łl ħh ŧt ƒf"
)
DIGITS = "0o 1i 3e 4a 5s 7t 8b 9g @a $s"
NO_WIDTH = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
MARKS = ((0x300, 0x36F), (0x483, 0x489), (0x1AB0, 0x1AFF), (0x1DC0, 0x1DFF), (0x20D0, 0x20FF), (0xFE00, 0xFE0F), (0xFE20, 0xFE2F))
_FOLD = {c: None for first, last in MARKS for c in range(first, last + 1)}
_FOLD |= {ord(pair[0]): pair[1] for pair in (LOOK_ALIKE + " " + DIGITS).split()} | {ord(c): None for c in NO_WIDTH}

# Phrases whose words are meant otherwise.
EXCEPTIONS = ("trash can", "trash cans", "trash bin", "clown fish", "pond scum", "pathetic fallacy")

SHORTEST, LONGEST = 4, 12
# Standard errors below the log-odds: 95 % on one side.
CONFIDENCE = 1.645


def fold(text: str) -> str:
    """Lower case, compatibility forms and look-alikes replaced, characters without width and marks that do not compose removed.

    Accented letters stay: in languages that have them they tell words apart.
    """
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return text.lower().translate(_FOLD)


def words_of(folded: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in folded).split()


def beginnings(text: str) -> set[str]:
    """The beginnings of the words of a text, ``SHORTEST`` to ``LONGEST`` letters."""
    words = {w[:LONGEST] for w in words_of(fold(text))}
    return {w[:n] for w in words for n in range(SHORTEST, len(w) + 1)}


class Matcher:
    """Scores texts with a lexicon ``beginning -> weight``."""

    def __init__(self, lexicon: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS):
        self.automaton = ahocorasick.Automaton()
        for term, weight in lexicon.items():
            self.automaton.add_word(term, (len(term), float(weight)))
        for phrase in map(fold, exceptions):
            if phrase not in lexicon:
                self.automaton.add_word(phrase, (len(phrase), None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def density(self, text: str) -> float:
        """log(1 + weight for 100 words): a text counts as at least 100 words more than it has."""
        if not len(self.automaton):
            return 0.0
        folded = fold(text)
        hits, spared = [], []
        for end, (length, weight) in self.automaton.iter(folded):
            start = end - length + 1
            if start and folded[start - 1].isalnum():
                continue  # not the beginning of a word
            if weight is None:
                if end + 1 == len(folded) or not folded[end + 1].isalnum():
                    spared.append((start, end))
            else:
                hits.append((start, end, weight))
        if spared:  # a hit is spared if the phrases that start no later than it reach its end
            spared.sort()
            starts, reach = [a for a, _ in spared], list(accumulate((b for _, b in spared), max))
            hits = [h for h in hits if not (k := bisect_right(starts, h[0])) or reach[k - 1] < h[1]]
        if not hits:
            return 0.0
        return float(np.log1p(100.0 * sum(w for _, _, w in hits) / (len(folded.split()) + 100.0)))


def count_beginnings(rows: DataFrame) -> DataFrame:
    """``term, toxic, clean``: in how many documents of ``rows(text, label)`` a beginning occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            keys = list(counts)
            made = pa.record_batch(
                [pa.array([t for t, _ in keys], pa.string()), pa.array([y for _, y in keys], pa.int32()), pa.array([counts[x] for x in keys], pa.int64())],
                names=["term", "label", "n"],
            )
            counts.clear()
            return made

        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.update((term, int(label > 0)) for term in beginnings(text or ""))
                if len(counts) > 500_000:
                    yield flush()
        yield flush()

    found = rows.select("text", "label").mapInArrow(run, "term string, label int, n long")
    return found.groupBy("term").agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"), F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("clean"))


def choose(terms: list[tuple[str, int, float]]) -> dict[str, float]:
    """Of terms (beginning, toxic documents, weight) that imply each other one each.

    A beginning gives way to a longer one that nearly all its documents have, then longer ones to it.
    """
    count = {t: n for t, n, _ in terms}
    longer = {t[:-1] for t, n, _ in terms if n >= 0.95 * count.get(t[:-1], np.inf)}
    kept = {t: w for t, _, w in terms if t not in longer}
    return {t: w for t, w in kept.items() if not any(t[:n] in kept for n in range(SHORTEST, len(t)))}


def one_of_near_copies(rows: DataFrame) -> DataFrame:
    """``text, label``: of texts of one label whose fingerprints are linked by at most four differing bits, one."""
    prints = staged(simhash.fingerprints(rows, keep=("text", "label")), "prints")
    least = prints.groupBy("fp").agg(F.lit(None).cast("long").alias("doc_id"))
    root = staged(components(simhash.near_links(least)), "components").withColumnRenamed("node", "fp")
    found = prints.join(root, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root"), "label")
    return found.agg(F.min("text").alias("text")).select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS, max_rows: int = 20_000, max_terms: int = 20_000, least_odds: float = 3.0, least_bound: float = 1.5) -> tuple[dict[str, float], float, float]:
    """Lexicon, slope and intercept, learned from at most about ``max_rows`` labelled rows.

    A term is in at least three toxic texts, its log-odds are at least ``least_odds`` and with 95 % confidence at least
    ``least_bound``, however few of the toxic texts have it. Near copies (SimHash) of one label are counted once, so that
    a group of them does not make its own words terms. Texts are measured with the ``exceptions`` that they will be scored
    with. ``max_terms`` bounds the model: the beginnings with the greatest evidence (log-odds times documents) are kept.
    """
    rows = labelled(docs, labels, "toxic", max_rows)
    rows = rows.withColumn("h", F.xxhash64("text")).dropDuplicates(["h", "label"]).select("text", "label")
    rows = one_of_near_copies(rows).persist()
    try:
        totals = {r["label"] > 0: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
        toxic, clean = totals.get(True, 0), totals.get(False, 0)
        odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
        error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5) - 1 / (toxic + 1.0) - 1 / (clean + 1.0))
        terms = count_beginnings(rows).where(F.col("toxic") >= 3).withColumn("weight", odds)
        terms = terms.where((F.col("weight") >= least_odds) & (F.col("weight") - CONFIDENCE * error >= least_bound))
        terms = terms.orderBy(F.desc(F.col("weight") * F.col("toxic")), "term").limit(max_terms).collect()
        lexicon = choose([(r["term"], r["toxic"], r["weight"]) for r in terms])

        def densities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(lexicon, exceptions)
            for batch in batches:
                x = [matcher.density(t or "") for t in batch.column(0).to_pylist()]
                yield pa.record_batch([pa.array(x, pa.float64()), batch.column(1).cast(pa.int32())], names=["x", "label"])

        points = rows.mapInArrow(densities, "x double, label int").collect()
    finally:
        rows.unpersist()
    points.sort()  # the same model whatever order the tasks end in
    x, y = np.array([p["x"] for p in points]), np.array([float(p["label"] > 0) for p in points])
    return lexicon, *logistic(x, y, penalty=1e-4)


def toxicity(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``; labels are learned outside the held-out fold.

    Null and empty texts get the score of a text without hits. Without labels, or with one class only, all scores are
    the share of that class. Repeated rows are scored alike; an empty table gives an empty result.
    """
    lexicon, slope, intercept = fit(docs, labels, exceptions, **options)
    matcher: list[Matcher] = []

    def score(texts: list[str]) -> np.ndarray:
        if not matcher:
            matcher.append(Matcher(lexicon, exceptions))
        return sigmoid(slope * np.array([matcher[0].density(t) for t in texts]) + intercept)

    return scored(docs, score, 0.5)
