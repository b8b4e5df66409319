"""Per-text helpers of the chunking job: header sections and overlapping windows."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

# Header levels, window size, overlap, and separators from coarse to fine.
HEADER_LEVELS = 3
CHUNK_SIZE = 500
CHUNK_OVERLAP = 100
SEPARATORS = ("\n\n", "\n", " ", "")

_HEADER = re.compile(r"(#{1,%d})(?: (.*))?$" % HEADER_LEVELS, re.S)
_UNPRINTABLE = re.compile(r"[^\S ]|[\x00-\x1f\x7f-\x9f​-‏ -‮﻿]")


def _visible(line: str) -> str:
    line = line.strip()
    return line if line.isprintable() else "".join(c for c in line if c.isprintable())


def header_sections(markdown: str) -> list[tuple[list, str]]:
    """``([h1, h2, h3], text)`` per section; absent levels are None, header lines are dropped.

    Adjacent lines join with a newline, paragraphs of one section with a Markdown line break.
    A higher header clears the lower ones. Lines inside a code fence are never headers.
    """
    sections: list[tuple[list, list]] = []
    path: list = [None] * HEADER_LEVELS
    paragraph: list[str] = []
    fence = ""

    def flush():
        if paragraph:
            if not sections or sections[-1][0] != path:
                sections.append((list(path), []))
            sections[-1][1].append("\n".join(paragraph))
            paragraph.clear()

    for raw in markdown.split("\n"):
        line = _visible(raw)
        if fence:
            if line.startswith(fence):
                fence = ""
            paragraph.append(line)
            continue
        if line.startswith("```") and line.count("```") == 1 or line.startswith("~~~"):
            fence = line[:3]
            paragraph.append(line)
            continue
        header = _HEADER.match(line) if line.startswith("#") else None
        if header:
            flush()
            level = len(header.group(1))
            path[level - 1 :] = [(header.group(2) or "").strip()] + [None] * (HEADER_LEVELS - level)
        elif line:
            paragraph.append(line)
        else:
            flush()
    flush()
    return [(headers, "  \n".join(parts)) for headers, parts in sections]


def _pieces(text: str, separator: str) -> list[str]:
    """Split before every separator, which stays at the start of its piece."""
    if separator == "":
        return list(text)
    head, *rest = text.split(separator)
    return ([head] if head else []) + [separator + r for r in rest]


def _windows(pieces: list[str], size: int, overlap: int) -> list[str]:
    """Greedy windows over whole pieces, found by bisection on the prefix sums of their lengths.

    A window is the longest run within ``size``. The next one starts at the first piece from which
    at most ``overlap`` characters repeat and the next piece still fits.
    """
    ends = [0, *accumulate(map(len, pieces))]
    out, start, n = [], 0, len(pieces)
    while True:
        stop = bisect_right(ends, ends[start] + size, lo=start) - 1
        stop = max(stop, start + 1)
        out.append("".join(pieces[start:stop]))
        if stop >= n:
            return out
        low = max(ends[stop] - overlap, ends[stop + 1] - size)
        start = min(bisect_left(ends, low, lo=start), stop)


def split_text(
    text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, separators=SEPARATORS
) -> list[str]:
    """Overlapping chunks of at most ``size`` characters; stripped, empty ones left out."""
    at = next(i for i, s in enumerate(separators) if s in text)
    finer = separators[at + 1 :]
    chunks: list[str] = []
    run: list[str] = []
    for piece in _pieces(text, separators[at]):
        if len(piece) < size:
            run.append(piece)
            continue
        if run:
            chunks += _windows(run, size, overlap)
            run = []
        chunks += split_text(piece, size, overlap, finer) if finer else [piece]
    if run:
        chunks += _windows(run, size, overlap)
    return [c for c in (chunk.strip() for chunk in chunks) if c]
