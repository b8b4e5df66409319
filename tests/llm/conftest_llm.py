"""Messy documents for the tests of this folder."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, doc string, size int, gone string, fp string, block int"


def words(start, n):
    return " ".join(f"w{i}" for i in range(start, start + n))


LINES = [f"line number {i} of a text" for i in range(30)]
LONG = "\n".join(words(7 * i, 9) for i in range(6000))


def doc(doc_id, text, source="s"):
    return (doc_id, text, None, source, None if text is None else len(text), "h", "d", 7, "g", "f", 3)


ROWS = [
    doc(1, "\n".join(LINES[:6])),
    doc(2, "head\n" + "\n".join(LINES[1:5]) + "\n\ntail", "t"),
    doc(3, None),
    doc(4, ""),
    doc(5, " \n \n"),
    doc(6, LONG, None),
    doc(7, words(0, 60), "t"),
    doc(8, words(0, 60).upper(), "t"),
    doc(9, words(0, 60) + " more", None),
    doc(None, "\n".join(LINES[:6])),
    doc(None, None, None),
    doc(10, "\n".join(LINES[10:20])),
    doc(10, "\n".join(LINES[10:20])),
    doc(10, "another text under the same id\n" + "\n".join(LINES[12:16])),
    doc(11, "ünï ß 日本語 😀 x\ty  z.\r\nnext"),
]
