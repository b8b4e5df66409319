"""Byte-level tokenizers: their alphabet and pattern, and texts cut into words at whose edges a token always starts."""

from __future__ import annotations

import re

# Fixed value: how byte-level tokenizers cut a text before they merge bytes.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_OTHER_SPACE = re.compile(r"[^\S \n]|\0")
# Marks at which words are cut further, at their ends.
MARKS = ".,!?#$%&*|"


def words_of(text: str) -> list[str]:
    """Cut a text where a byte-level tokenizer always starts a new token, so ids of the parts join to ids of the text.

    That is before a single space and around a single line break between other characters. Texts with other white space
    are cut at single spaces only.
    """
    edges = text[:1] + text[-1:]
    if " " in edges or "\n" in edges or "  " in text or "\n " in text or " \n" in text or "\n\n" in text or _OTHER_SPACE.search(text):
        return _spaced(text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")


def parts_of(word: str) -> tuple[str, str] | None:
    """A word and the marks at its end, between which a new token always starts too; None for others."""
    core = word.rstrip(MARKS)
    return (core, word[len(core) :]) if len(core) < len(word) and core[-1:].isalnum() else None


_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def _spaced(text: str) -> list[str]:
    """Cut before every single space between two characters that are not white space."""
    cuts = [0, *(m.start() for m in _SINGLE_SPACE.finditer(text)), len(text)]
    return [text[i:j] for i, j in zip(cuts, cuts[1:])]


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def token_bytes(tokenizer) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary; none for ids without an entry."""
    letters = byte_alphabet()
    entries = {i: entry for entry, i in tokenizer.get_vocab(with_added_tokens=False).items()}
    return [bytes(letters.get(c, 0) for c in entries.get(i, "")) for i in range(max(entries) + 1)]
