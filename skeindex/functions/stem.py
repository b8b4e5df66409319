"""English word stems (the published Porter2 rules), cached per Python worker."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeindex.functions.batches import by_pieces

# Fixed values of the published algorithm: irregular words, suffix tables, letter classes.
IRREGULAR = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
KEPT_AFTER_PLURAL = set("inning outing canning herring earring proceed exceed succeed".split())
SECOND = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent",
    "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate",
    "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous",
    "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble",
    "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
THIRD = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic",
    "ical": "ic", "ful": "", "ness": "", "ative": "",
}
FOURTH = "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion".split()
V, C = "[aeiouy]", "[^aeiouy]"

_REGION = re.compile(f"^.*?{V}{C}")
_LONG_PREFIX = re.compile("^(gener|commun|arsen)")
_SHORT_END = re.compile(f"({C}{V}[^aeiouywxY]|^{V}{C})$")
_DOUBLE = re.compile("(bb|dd|ff|gg|mm|nn|pp|rr|tt)$")


def _longest(word: str, suffixes):
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _after_region(text: str) -> int:
    found = _REGION.match(text)
    return found.end() if found else len(text)


def stem(word: str) -> str:
    if len(word) <= 2:
        return word
    if word in IRREGULAR:
        return IRREGULAR[word]
    word = re.sub(f"(^|(?<={V}))y", "Y", word)
    prefix = _LONG_PREFIX.match(word)
    r1 = prefix.end() if prefix else _after_region(word)
    r2 = r1 + _after_region(word[r1:])

    def has(suffix: str, region: int) -> bool:
        return len(word) - len(suffix) >= region

    # plurals
    if word.endswith("sses"):
        word = word[:-2]
    elif word.endswith(("ied", "ies")):
        word = word[:-2] if len(word) > 4 else word[:-1]
    elif word.endswith("s") and not word.endswith(("us", "ss")) and re.search(V, word[:-2]):
        word = word[:-1]
    if word in KEPT_AFTER_PLURAL:
        return word

    # past and progressive forms
    suffix = _longest(word, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if suffix in ("eed", "eedly"):
        if has(suffix, r1):
            word = word[: -len(suffix)] + "ee"
    elif suffix and re.search(V, word[: -len(suffix)]):
        word = word[: -len(suffix)]
        if word.endswith(("at", "bl", "iz")):
            word += "e"
        elif _DOUBLE.search(word):
            word = word[:-1]
        elif len(word) <= r1 and _SHORT_END.search(word):
            word += "e"
    word = re.sub(f"(?<=.)(?<={C})[yY]$", "i", word) if len(word) > 2 else word

    suffix = _longest(word, SECOND)
    if suffix and has(suffix, r1):
        before = word[-len(suffix) - 1 : -len(suffix)]
        if not (suffix == "ogi" and before != "l") and not (
            suffix == "li" and before not in set("cdeghkmnrt")
        ):
            word = word[: -len(suffix)] + SECOND[suffix]
    suffix = _longest(word, THIRD)
    if suffix and has(suffix, r2 if suffix == "ative" else r1):
        word = word[: -len(suffix)] + THIRD[suffix]
    suffix = _longest(word, FOURTH)
    if suffix and has(suffix, r2) and not (suffix == "ion" and word[-4:-3] not in ("s", "t")):
        word = word[: -len(suffix)]
    if word.endswith("e"):
        if has("e", r2) or (has("e", r1) and not _SHORT_END.search(word[:-1])):
            word = word[:-1]
    elif word.endswith("ll") and has("l", r2):
        word = word[:-1]
    return word.lower()


# Words whose stems a worker remembers, in each of two generations.
REMEMBERED = 100_000


class Stems:
    """Stems of words, each computed once while it is remembered; words that come again are kept longest."""

    def __init__(self, most: int = REMEMBERED) -> None:
        self.most = most
        self.younger: dict[str, str] = {}
        self.older: dict[str, str] = {}

    def __call__(self, words: list[str | None]) -> list[str | None]:
        if len(self.younger) > self.most:
            self.older, self.younger = self.younger, {}
        out = []
        for word in words:
            found = self.younger.get(word)
            if found is None and word is not None:
                found = self.older.get(word)
                self.younger[word] = found = stem(word) if found is None else found
            out.append(found)
        return out


_stems = Stems()


def stems_of_lists(tokens: pa.ListArray) -> pa.ListArray:
    """Lists with each word replaced by its stem: only the different words are looked at in Python."""
    tokens = tokens.cast(pa.list_(pa.string()))
    coded = tokens.flatten().dictionary_encode()
    words = pa.array(_stems(coded.dictionary.to_pylist()), pa.string())
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype("int32"))
    lists = pa.ListArray.from_arrays(offsets, words.take(coded.indices))
    return pc.if_else(pc.is_valid(tokens), lists, pa.scalar(None, lists.type)) if tokens.null_count else lists


_stem_all = F.arrow_udf(by_pieces(stems_of_lists), T.ArrayType(T.StringType()))


def stems(tokens: Column) -> Column:
    return _stem_all(tokens)
