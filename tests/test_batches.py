"""Arrow batches are worked on in pieces of bounded size."""

import pyarrow as pa

from skeindex.functions.batches import by_pieces, pieces
from skeindex.functions.stem import stems_of_lists


def test_pieces_of_text_are_bounded():
    texts = ["x" * 1000] * 5000 + [None, "", "y" * 3_000_000, "z"]
    found = list(pieces(pa.array(texts), 100_000))
    assert [t for piece in found for t in piece.to_pylist()] == texts
    sizes = [sum(len(t or "") for t in piece.to_pylist()) for piece in found]
    assert max(s for s in sizes if s < 3_000_000) <= 101_000 and len(found) > 50


def test_no_row_is_one_piece():
    assert [len(p) for p in pieces(pa.array([], pa.string()))] == [0]
    assert [len(p) for p in pieces(pa.array([None, None], pa.list_(pa.string())))] == [2]


def test_many_empty_rows_are_cut_too():
    assert max(len(p) for p in pieces(pa.array([None] * 5000, pa.string()), 6400)) <= 101


def test_a_batch_is_one_array_whatever_its_pieces():
    seen = []

    def some(lists):
        seen.append(len(lists.flatten()))
        return stems_of_lists(lists)

    rows = [["running", "cats"], None, [], ["flies"] * 1000] * 50
    (out,) = by_pieces(some, 2000)(iter([pa.array(rows, pa.list_(pa.string()))]))
    assert out.to_pylist() == stems_of_lists(pa.array(rows, pa.list_(pa.string()))).to_pylist()
    assert max(seen) <= 3000
