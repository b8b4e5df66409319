"""Arrow arrays taken in pieces, so that the Python objects of a task do not grow with the batches that it is sent."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text, or values of lists, in a piece.
PIECE_BYTES, PIECE_VALUES = 1 << 20, 1 << 18


def pieces(values: pa.Array, limit: int | None = None) -> Iterator[pa.Array]:
    """Consecutive slices of strings or lists that hold about ``limit`` bytes or values, one row at least; an empty array is one."""
    text = pa.types.is_string(values.type) or pa.types.is_large_string(values.type)
    sizes = pc.binary_length(values) if text else pc.list_value_length(values)
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    # Missing and empty rows count as well: they become Python objects too.
    group = (ends + 64 * np.arange(len(ends))) // (limit or (PIECE_BYTES if text else PIECE_VALUES))
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(values)]
    for start, end in zip(cuts, cuts[1:]):
        yield values.slice(start, end - start)


def by_pieces(make: Callable[[pa.Array], pa.Array], limit: int | None = None) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    """An Arrow function over batches that works on one piece of a batch at a time."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.concat_arrays([make(piece) for piece in pieces(batch, limit)])

    return run
