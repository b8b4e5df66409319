"""Tokens, stop words and term ids as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word pattern and English stop words.
WORD_PATTERN = r"[\p{L}\p{N}]+"
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom this "
    "that these those am is are was were be been being have has had having do does did doing a an "
    "the and but if or because as until while of at by for with about against between into through "
    "during before after above below to from up down in out on off over under again further then "
    "once here there when where why how all any both each few more most other some such no nor not "
    "only own same so than too very s t can will just don should now d ll m o re ve y ain aren "
    "couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan shouldn wasn weren won wouldn"
).split()


def words(text: Column) -> Column:
    """Lower-cased words of ``text``, in order."""
    # A capital dotted I lower-cases to two code points here and to one elsewhere.
    lowered = F.lower(F.replace(text, F.lit("İ"), F.lit("i")))
    return F.regexp_extract_all(lowered, F.lit(WORD_PATTERN), F.lit(0))


def without_stop_words(tokens: Column, stop_words) -> Column:
    listed = list(stop_words)
    if not listed:
        return tokens
    return F.filter(tokens, lambda w: ~w.isin(listed))


def term_id(term: Column) -> Column:
    """Unsigned 32-bit id of a term, held in a long."""
    return F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("long")


def document_text(df_columns, chunk: str = "chunk", text: str = "text") -> Column:
    """The text of a record under either spelling; empty strings count as missing."""
    present = [F.nullif(F.col(c), F.lit("")) for c in (chunk, text) if c in df_columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")
