"""Dense vectors: model hook, built-in hashed embedder, unit norm."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeindex.functions.vectors import norm, unit
from skeindex.operators.bm25 import Analyzer, with_terms

# Output size, markers of hosted model names, and the name of the default local model.
DEFAULT_DIMENSIONS = 768
HOSTED_MARKERS = ("gemini", "text-embedding", "text-multilingual-embedding")
LOCAL_NAME = "local"

# What a text is embedded as.
DOCUMENT, QUERY = "document", "query"

# A loader is called once per Python task with the role of the texts and returns
# ``texts -> sequence of vectors``.
Loader = Callable[[str], Callable[[list[str]], list]]


class ModelRegistry:
    """Names to model loaders. Hosted names share the ``hosted`` loader; others go by name."""

    def __init__(self) -> None:
        self._loaders: dict[str, Loader] = {}

    def register(self, name: str, loader: Loader) -> "ModelRegistry":
        self._loaders[name] = loader
        return self

    def knows(self, name: str) -> bool:
        return name in self._loaders

    def resolve(self, model: str) -> Loader:
        key = "hosted" if any(m in model for m in HOSTED_MARKERS) else model
        if model in self._loaders:
            return self._loaders[model]
        if key in self._loaders:
            return self._loaders[key]
        raise KeyError(f"no loader registered for model {model!r} (looked up {key!r})")


def embed(
    df: DataFrame, loader: Loader, text: str = "chunk", role: str = DOCUMENT
) -> DataFrame:
    """Add ``embedding array<float>`` and ``embedding_error``; a failing text gets an empty vector.

    Texts go to the model in Arrow batches. Only when a batch fails are its texts tried one by one.
    """
    result = T.StructType(
        [
            T.StructField("embedding", T.ArrayType(T.FloatType())),
            T.StructField("error", T.StringType()),
        ]
    )

    def one(model, value):
        try:
            return np.asarray(model([value])[0], dtype="float32"), None
        except Exception as error:  # the row stays, its vector is empty
            return np.empty(0, dtype="float32"), str(error)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = loader(role)
        for texts in batches:
            listed = texts.tolist()
            try:
                rows = [(np.asarray(v, dtype="float32"), None) for v in model(listed)]
            except Exception:
                rows = [one(model, value) for value in listed]
            yield pd.DataFrame(rows, columns=["embedding", "error"])

    vectorise = F.pandas_udf(run, result).asNondeterministic()
    kept = df.columns
    return df.withColumn("__e", vectorise(F.col(text))).select(
        *kept, F.col("__e.embedding").alias("embedding"), F.col("__e.error").alias("embedding_error")
    )


def hashed_features(termed: DataFrame, dimensions: int = DEFAULT_DIMENSIONS) -> DataFrame:
    """``(…, dims array<struct<dim, value>>)``: signed term counts summed per hashed dimension."""
    sign = lambda t: F.when(F.shiftright(t["term_id"], 31) == 1, -t["tf"]).otherwise(t["tf"])
    slot = lambda t: F.pmod(t["term_id"], F.lit(dimensions)).cast("int")
    kept = [F.col(c) for c in termed.columns if c not in ("terms", "doc_len")]
    signed = termed.select(
        *kept,
        F.sort_array(
            F.transform("terms", lambda t: F.struct(slot(t).alias("dim"), sign(t).alias("v")))
        ).alias("__signed"),
    )
    starts = signed.select(
        *kept,
        "__signed",
        F.filter(
            F.transform("__signed", lambda e, i: F.struct(i.alias("at"), e["dim"].alias("dim"))),
            lambda s: (s["at"] == 0) | (F.get("__signed", s["at"] - 1)["dim"] != s["dim"]),
        ).alias("__starts"),
    )

    def total(s, i):
        end = F.coalesce(F.get("__starts", i + 1)["at"], F.size("__signed"))
        run = F.slice(F.col("__signed"), s["at"] + 1, end - s["at"])
        value = F.aggregate(run, F.lit(0).cast("long"), lambda acc, e: acc + e["v"])
        return F.struct(s["dim"].alias("dim"), value.alias("value"))

    summed = starts.select(*kept, F.transform("__starts", total).alias("__d"))
    nonzero = F.filter("__d", lambda d: d["value"] != 0)
    return summed.select(*kept, F.inline(F.array(F.struct(nonzero.alias("dims")))))


def densify(featured: DataFrame, dimensions: int = DEFAULT_DIMENSIONS) -> DataFrame:
    """Replace ``dims`` by a unit-length ``embedding array<float>`` (all zeros when empty)."""
    kept = [F.col(c) for c in featured.columns if c != "dims"]
    zeros = lambda n: F.array_repeat(F.lit(0.0).cast("float"), n)
    squares = F.aggregate(
        "dims", F.lit(0).cast("long"), lambda acc, d: acc + d["value"] * d["value"]
    )
    # A generated column, so that the length is computed once per row and not once per element.
    sized = featured.select(
        *kept, "dims", F.inline(F.array(F.struct(F.sqrt(squares.cast("double")).alias("__len"))))
    )

    def piece(d, i):
        gap = d["dim"] - F.coalesce(F.get("dims", i - 1)["dim"], F.lit(-1)) - 1
        return F.concat(zeros(gap), F.array((d["value"] / F.col("__len")).cast("float")))

    body = F.flatten(F.transform("dims", piece))
    last = F.coalesce(F.get("dims", F.size("dims") - 1)["dim"], F.lit(-1))
    vector = F.concat(body, zeros(F.lit(dimensions - 1) - last))
    return sized.select(*kept, vector.alias("embedding"))


def hash_embed(
    df: DataFrame,
    text: str = "chunk",
    dimensions: int = DEFAULT_DIMENSIONS,
    analyzer: Analyzer = Analyzer(),
) -> DataFrame:
    """The default embedder: signed feature hashing of term counts, unit length, row by row."""
    return densify(hashed_features(with_terms(df, text, analyzer), dimensions), dimensions)


def l2_normalize(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Scale vectors to unit length; zero vectors are unchanged."""
    sized = df.withColumn("__len", norm(F.col(column)))
    return sized.withColumn(column, unit(F.col(column), F.col("__len"))).drop("__len")

