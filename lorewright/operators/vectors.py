"""Text vectors and vector arithmetic."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType
from pyspark.sql.window import Window

from lorewright.functions.text import let

DIMENSIONS = 384

#: text column -> array<float> column of unit length
Encoder = Callable[[Column], Column]


def l2_normalize(vec: Column) -> Column:
    """Unit length; an all-zero vector stays as it is."""
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return let(norm, lambda n: F.transform(vec, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(x.cast("double"))))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def mean_pool(vectors: Column, mask: Column, dimensions: int) -> Column:
    """Mean of the unmasked token vectors, element by element; all masked gives zeros."""
    total = F.greatest(F.aggregate(mask, F.lit(0.0), lambda s, x: s + x), F.lit(1e-9))  # as the all-masked case must not divide by zero
    weighted = F.zip_with(vectors, mask, lambda v, m: F.transform(v, lambda x: x * m))
    zero = F.array_repeat(F.lit(0.0), dimensions)
    return F.transform(F.aggregate(weighted, zero, lambda s, v: F.zip_with(s, v, lambda x, y: x + y)), lambda x: x / total)


def hashed_bag_of_words(dimensions: int = DIMENSIONS) -> Encoder:
    """The default encoder: words hash to a signed bucket; no weights are needed.

    It is shape-compatible with a sentence encoder, not equivalent in meaning.
    A text without words gives the zero vector.
    """

    def encode(text: Column) -> Column:
        words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
        hashed = F.transform(words, lambda w: F.xxhash64(w))
        slots = F.transform(hashed, lambda h: F.struct(F.pmod(h, F.lit(dimensions)).cast("int").alias("b"), F.when(F.pmod(F.shiftright(h, 32), F.lit(2)) == 0, 1.0).otherwise(-1.0).alias("s")))

        def bucket(of: Column, b: Column) -> Column:
            return F.aggregate(of, F.lit(0.0), lambda total, x: total + F.when(x["b"] == b, x["s"]).otherwise(0.0))

        raw = let(slots, lambda of: F.transform(F.sequence(F.lit(0), F.lit(dimensions - 1)), lambda b: bucket(of, b)))
        return let(raw, lambda r: F.transform(l2_normalize(r), lambda x: x.cast("float")))

    return encode


@dataclass(frozen=True)
class ModelEncoder:
    """An encoder that runs a model on the executors, as a step of its own.

    ``load(device)`` gives a function from texts to rows of numbers; it is
    called once per task, for the first of ``devices`` that works.  Texts go in
    batches; when a batch fails its texts are tried one by one, and only those
    that fail alone get NULL.  NULL texts count as empty.
    """

    load: Callable[[str], Callable[[list[str]], np.ndarray]]
    batch: int = 64
    dimensions: int = DIMENSIONS
    devices: Sequence[str] = ("cpu",)

    def _ready(self) -> Callable[[list[str]], np.ndarray]:
        error: Exception = ValueError("no device")
        for device in self.devices:
            try:
                return self.load(device)
            except Exception as e:  # noqa: BLE001
                error = e
        raise error

    def _encode(self, model: Callable[[list[str]], np.ndarray], texts: list[str]) -> list[np.ndarray | None]:
        try:
            rows = np.asarray(model(texts), dtype=np.float32)
            if rows.shape != (len(texts), self.dimensions):
                raise ValueError(f"{rows.shape} is not {(len(texts), self.dimensions)}")
            return list(rows)
        except Exception:  # noqa: BLE001
            return [None] if len(texts) == 1 else [v for t in texts for v in self._encode(model, [t])]

    def append(self, df: DataFrame, text: Column) -> DataFrame:
        """``df`` with ``vec``."""

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = self._ready()
            for f in frames:
                texts = ["" if t is None else t for t in f["_text"]]
                f["vec"] = [v for i in range(0, len(texts), self.batch) for v in self._encode(model, texts[i : i + self.batch])]
                yield f.drop(columns="_text")

        schema = StructType([*df.schema.fields, StructField("vec", ArrayType(FloatType()))])
        return df.withColumn("_text", text).mapInPandas(run, schema)


def encode_text(df: DataFrame, text: Column, encoder: Encoder | ModelEncoder | None = None) -> DataFrame:
    """Append ``vec``; any encoder of the same shape can be plugged in."""
    if isinstance(encoder, ModelEncoder):
        return encoder.append(df, text)
    return df.withColumn("vec", (encoder or hashed_bag_of_words())(text))


def cosine_topk(queries: DataFrame, corpus: DataFrame, k: int, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Exact top-k by cosine of a stated set of queries against all rows.

    The query set must be small and is the broadcast side; candidates are cut
    to k per query and partition by the window's group limit before the shuffle.
    """
    q = queries.select(F.col(id_column).alias("query_id"), l2_normalize(F.col(column)).alias("_q"))
    c = corpus.select(F.col(id_column).alias("match_id"), l2_normalize(F.col(column)).alias("_c"))
    scored = c.join(q, F.col("query_id") != F.col("match_id")).select("query_id", "match_id", F.round(dot(F.col("_q"), F.col("_c")), 6).alias("cosine"))
    w = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "match_id")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
