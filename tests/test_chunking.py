"""Sections, windows, records and offsets."""

import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from skeindex.functions.splitting import _windows, header_sections, split_text
from skeindex.operators import chunking


def one_by_one(pieces, size, overlap):
    """Windows made by adding one piece at a time."""
    out, held = [], []
    for piece in pieces:
        if held and sum(map(len, held)) + len(piece) > size:
            out.append("".join(held))
            while held and (sum(map(len, held)) > overlap or sum(map(len, held)) + len(piece) > size):
                held.pop(0)
        held.append(piece)
    return out + ["".join(held)]


def test_windows_agree_with_adding_one_piece_at_a_time():
    rng = random.Random(1)
    for _ in range(3000):
        size = rng.randint(5, 60)
        overlap = rng.randint(0, size - 1)
        pieces = ["x" * rng.randint(1, size - 1) for _ in range(rng.randint(1, 40))]
        assert _windows(pieces, size, overlap) == one_by_one(pieces, size, overlap)


@pytest.mark.parametrize(
    "length, sizes",
    [(499, [499]), (500, [500]), (501, [500, 101]), (900, [500, 500]), (1300, [500, 500, 500])],
)
def test_text_without_separators(length, sizes):
    assert [len(c) for c in split_text("a" * length)] == sizes


def test_long_word_between_short_ones():
    chunks = split_text("one two " + "w" * 600 + " three")
    assert chunks == ["one two", "w" * 499, "w" * 201, "three"]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n", max_size=3000))
def test_chunks_fit_and_cover(text):
    chunks = split_text(text)
    assert all(0 < len(c) <= 500 and c == c.strip() for c in chunks)
    assert {w for c in chunks for w in c.split()} <= set(text.split()) or "".join(text.split())


def test_header_sections():
    markdown = "pre\n\n# A\ntext\n\nmore\n### C\nc\n## B\nb\n#### no\n```\n# code\n```\n# Z\n# A\n#x"
    assert header_sections(markdown) == [
        ([None, None, None], "pre"),
        (["A", None, None], "text  \nmore"),
        (["A", None, "C"], "c"),
        (["A", "B", None], "b\n#### no\n```\n# code\n```"),
        (["A", None, None], "#x"),
    ]


def pages(spark):
    rows = [
        ("p/b.html", "u2", "t", "# H\n" + "word " * 300),
        ("p/a.html", "u1", "t", "x\n# One\n### Three\n" + "y" * 700),
        ("p/c.html", "u3", "t", None),
    ]
    return spark.createDataFrame(
        rows, "source_file string, original_url string, scrape_time string, markdown string"
    )


def test_records_and_offsets(spark):
    records = chunking.with_line_offsets(chunking.chunk_records(pages(spark), "v7"), "where")
    rows = records.orderBy("chunk_line_offset").collect()
    assert [r["chunk_line_offset"] for r in rows] == list(range(len(rows)))
    assert [r["id"] for r in rows] == [
        "p/a.html_chunk_0", "p/a.html_chunk_1", "p/a.html_chunk_2",
        "p/b.html_chunk_0", "p/b.html_chunk_1", "p/b.html_chunk_2", "p/b.html_chunk_3",
    ]
    assert rows[0]["headers"] == [] and rows[1]["headers"] == ["One", "Three"]
    assert {(r["chunk_gcs_uri"], r["chunking_strategy_version"]) for r in rows} == {("where", "v7")}


def test_running_offsets_over_many_partitions(spark):
    weights = [(i, (i * 7919) % 13) for i in range(5000)]
    df = spark.createDataFrame(weights, "k int, w int").repartition(7)
    spread_out = chunking.running_offsets(df, ["k"], F.col("w"))
    found = {r["k"]: r["base"] for r in spread_out.collect()}
    total = 0
    for key, weight in weights:
        assert found[key] == total
        total += weight


def test_reuse_renumbers_in_file_and_old_order(spark):
    rows = [("b.jsonl", 0, "b0"), ("a.jsonl", 5, "a5"), ("a.jsonl", 2, "a2")]
    old = spark.createDataFrame(rows, "file_path string, chunk_line_offset long, id string")
    again = chunking.reuse_chunks(old.withColumn("chunk_gcs_uri", F.lit("old")), "new")
    assert sorted((r["chunk_line_offset"], r["id"], r["chunk_gcs_uri"]) for r in again.collect()) == [
        (0, "a2", "new"), (1, "a5", "new"), (2, "b0", "new"),
    ]


def test_row_counter(spark):
    df, seen = chunking.counted(spark.range(17), "rows")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 17
