"""Document fingerprints as invertible Bloom lookup tables, with DataFrame functions only.

A text is a set of paragraph digests. Each digest goes into one cell of three parts of a table; a cell holds how many
digests it got and the exclusive-or of the digests and of their checks. Tables of two texts are subtracted cell by
cell, so common paragraphs cancel, and peeling recovers the rest: a cell with one digest names it, and taking it out of
its other cells frees further ones. Where peeling fails, the digests are dealt into stripes by their value and every
stripe is tried with larger and larger tables. All of this happens within the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeindex.llm.common import let, staged

PARTS = 3
# Cells in a part of the fingerprint; cells in a part of the tables tried on a stripe; digests meant for a stripe.
WIDTH, RETRIES, STRIPE = 8, (16, 32, 64, 128), 16
# Rows in a block of consecutive documents, and most blocks.
BLOCK_ROWS, BLOCKS = 512, 20_000


def long(value: int) -> Column:
    return F.lit(value).cast("long")


def digests(text: Column) -> Column:
    """The distinct 64-bit digests of a text's paragraphs: lines, cut further at the ends of sentences."""
    pieces = F.filter(F.split(text, r"(?<=[.!?])\s+|\n"), lambda p: p != "")
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(-1))


def entry(digest: Column, width: int, seed: int, count: Column) -> Column:
    """A digest with its check, its cell in each part and the count it stands for."""
    cells = [F.pmod(F.xxhash64(digest, F.lit(PARTS * seed + j)), long(width)).cast("int").alias(f"c{j}") for j in range(PARTS)]
    return F.struct(digest.alias("d"), check(digest).alias("x"), count.alias("n"), *cells)


def cell(n: Column, k: Column, x: Column) -> Column:
    return F.struct(n.alias("n"), k.alias("k"), x.alias("x"))


def table(found: Column, width: int, seed: int = 0) -> Column:
    """The cells of a set of digests: ``array<struct<n, k, x>>`` of three parts of ``width`` cells."""
    empty = cell(long(0), long(0), long(0))

    def part(entries: Column, j: int) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(width - 1)),
            lambda c: F.aggregate(
                F.filter(entries, lambda e: e[f"c{j}"] == c), empty, lambda s, e: cell(s["n"] + 1, s["k"].bitwiseXOR(e["d"]), s["x"].bitwiseXOR(e["x"]))
            ),
        )

    entries = F.transform(found, lambda d: entry(d, width, seed, long(1)))
    return let(entries, lambda e: F.concat(*[part(e, j) for j in range(PARTS)]))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: cell(x["n"] - y["n"], x["k"].bitwiseXOR(y["k"]), x["x"].bitwiseXOR(y["x"])))


def peel(cells: Column, width: int, seed: int = 0, rounds: int = 16) -> Column:
    """The digests in which two subtracted tables differ, ``array<struct<d, n>>`` with n 1 (first) or -1; null on failure."""

    def pure(table: Column) -> Column:
        single = F.filter(table, lambda c: (F.abs(c["n"]) == 1) & (check(c["k"]) == c["x"]))
        return F.array_distinct(F.transform(single, lambda c: F.struct(c["k"].alias("d"), c["n"].alias("n"))))

    def without(table: Column, keys: Column) -> Column:
        def part(entries: Column, j: int) -> Column:
            return F.transform(
                F.slice(table, j * width + 1, width),
                lambda c, i: F.aggregate(
                    F.filter(entries, lambda e: e[f"c{j}"] == i), c, lambda s, e: cell(s["n"] - e["n"], s["k"].bitwiseXOR(e["d"]), s["x"].bitwiseXOR(e["x"]))
                ),
            )

        entries = F.transform(keys, lambda p: entry(p["d"], width, seed, p["n"]))
        return let(entries, lambda e: F.concat(*[part(e, j) for j in range(PARTS)]))

    def step(state: Column, _: Column) -> Column:
        def go(keys: Column) -> Column:
            after = F.struct(without(state["cells"], keys).alias("cells"), F.concat(state["got"], keys).alias("got"), F.lit(True).alias("open"))
            ended = F.struct(state["cells"].alias("cells"), state["got"].alias("got"), F.lit(False).alias("open"))
            return F.when(F.size(keys) == 0, ended).otherwise(after)

        return F.when(~state["open"], state).otherwise(let(pure(state["cells"]), go))

    none = F.array().cast("array<struct<d:bigint,n:bigint>>")
    start = F.struct(cells.alias("cells"), none.alias("got"), F.lit(True).alias("open"))
    done = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)
    clear = lambda s: F.forall(s["cells"], lambda c: (c["n"] == 0) & (c["k"] == 0) & (c["x"] == 0))
    return let(done, lambda s: F.when(clear(s), s["got"]))


def differing(a: Column, b: Column) -> Column:
    """The digests in which two sets differ, by tables that grow until peeling succeeds.

    After the last size the stripe is compared directly, so the result is always whole.
    """

    def stripe(own: Column) -> Column:
        tries = [peel(subtract(table(own["a"], w, s), table(own["b"], w, s)), w, s) for s, w in enumerate(RETRIES, start=1)]
        only = [F.transform(F.array_except(own[x], own[y]), lambda d: F.struct(d.alias("d"), long(n).alias("n"))) for x, y, n in (("a", "b", 1), ("b", "a", -1))]
        return F.coalesce(*tries, F.concat(*only))

    count = F.greatest(F.lit(1), F.ceil((F.size(a) + F.size(b)) / STRIPE).cast("int"))
    own = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.struct(F.filter(a, lambda d: F.pmod(d, count) == i).alias("a"), F.filter(b, lambda d: F.pmod(d, count) == i).alias("b")),
    )
    return F.flatten(F.transform(own, stripe))


def likeness(n_a: Column, n_b: Column, n_differ: Column) -> Column:
    """Digests in common, twice, as a share of all of both; 1 for two empty sets."""
    both = n_a + n_b
    return F.when(both == 0, F.lit(1.0)).otherwise((both - n_differ) / both)


def encoded(cells: Column) -> Column:
    """A table as text: base64 of count (4 bytes), digests and checks (8 bytes each) of its cells."""
    hexed = lambda c: F.concat(F.lpad(F.hex(c["n"]), 8, "0"), F.lpad(F.hex(c["k"]), 16, "0"), F.lpad(F.hex(c["x"]), 16, "0"))
    return F.base64(F.unhex(F.array_join(F.transform(cells, hexed), "")))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, next_text``: with the text of the next document by id, after the last that of the first.

    Documents are dealt into blocks of consecutive ids, by quantiles of the ids; texts move once, to their block. Each
    block also gets the first document of the block after it. Equal ids are ordered by a hash of the text; ids of null
    come last. Null texts become empty.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = rows.count()
    blocks = max(1, min(BLOCKS, n // BLOCK_ROWS))
    bounds = None
    if blocks > 1:
        shares = [i / blocks for i in range(1, blocks)]
        bounds = rows.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * blocks)).alias("b")).first()["b"]
    bounds = sorted(set(bounds or []))
    # Binary search for the number of bounds that are not greater than the id.
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    block = F.lit(0)
    if bounds:
        b = F.lit(bounds)
        fits = lambda p, s: (p + s <= len(bounds)) & (F.get(b, p + s - 1) <= F.col("doc_id"))
        block = F.aggregate(F.lit(steps), F.lit(0), lambda p, s: F.when(fits(p, s), p + s).otherwise(p))
    rows = rows.withColumn("block", F.when(F.col("doc_id").isNull(), len(bounds)).otherwise(block).cast("int"))
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", long(0)).alias("id"), F.xxhash64("text").alias("h"))
    firsts = staged(rows.groupBy("block").agg(F.min(key).alias("key")), "firsts")
    order = Window.orderBy("block")
    before = F.coalesce(F.lag("block").over(order), F.max("block").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    firsts = firsts.select("key", before.alias("before"))
    # At most one row for each block, and blocks are bounded in number.
    heads = rows.withColumn("key", key).join(F.broadcast(firsts), "key").select("before", "text").distinct()
    heads = heads.select(F.lit(None).cast(rows.schema["doc_id"].dataType).alias("doc_id"), "text", F.col("before").alias("block"), F.lit(True).alias("head"))
    rows = rows.withColumn("head", F.lit(False)).unionByName(heads)
    in_block = Window.partitionBy("block").orderBy("head", F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
    return rows.withColumn("next_text", F.lead("text").over(in_block)).where(~F.col("head")).select("doc_id", "text", "next_text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every row.

    The edited text ends in the beginning of the next document's text. Likeness is found by peeling the subtracted
    fingerprints, and by larger tables where that fails. Null texts are empty; an empty table gives an empty result;
    repeated rows each get a row; a single document is followed by itself.
    """
    rows = with_next(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", edited)
    rows = rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("ed"), digests(F.col("next_text")).alias("nx")
    )
    rows = rows.withColumns({f"{c}_cells": table(F.col(c), WIDTH) for c in ("own", "ed", "nx")})

    def near(other: str) -> Column:
        first = peel(subtract(F.col("own_cells"), F.col(f"{other}_cells")), WIDTH)
        n_differ = F.coalesce(_size(first), _size(differing(F.col("own"), F.col(other))))
        return likeness(F.size("own"), F.size(other), n_differ)

    return rows.select(
        "doc_id", "n_chars", "edited_sha256", encoded(F.col("own_cells")).alias("fingerprint"), encoded(F.col("ed_cells")).alias("edited_fingerprint"),
        near("ed").alias("near_edited"), near("nx").alias("near_next"),
    )


def _size(array: Column) -> Column:
    """Size of an array; null for null."""
    return let(array, lambda a: F.when(a.isNotNull(), F.size(a)))
