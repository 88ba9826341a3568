"""Quality classifier: hashed word n-grams, logistic regression, follow the regularised leader.

A text is a sparse vector of hashed words and word pairs, scaled to length one. The updates
go row by row, hence one task makes them, over a bounded sample of the labelled rows. The
model has ``1 << BITS`` weights at most, which bounds what goes through the driver. A score
is the logistic function of a sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lullcast.llm.common import sampled, text_or_empty
from lullcast.llm.sharding import shuffle_order
from lullcast.workspace import materialize

BITS = 18
#: The classifier is fitted on so many labelled rows at most, those first in hash order.
SAMPLE_ROWS = 12_000
PASSES = 4
_MIX = np.uint64(0x9E3779B97F4A7C15)


def features(text: str, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets (sorted, distinct) and values of a text: logs of how often words and pairs
    of words occur, scaled to length one; none for a text without words."""
    words = text.encode("utf-8", "surrogatepass").split()
    single = np.fromiter(map(crc32, words), np.uint64, len(words)) * _MIX
    pairs = (single[:-1] * _MIX) ^ (single[1:] >> np.uint64(7))
    buckets = np.concatenate((single, pairs * _MIX)) >> np.uint64(64 - bits)
    found, counts = np.unique(buckets, return_counts=True)
    values = np.log1p(counts)
    return found.astype(np.int64), values / np.sqrt((values * values).sum() or 1.0)


class Ftrl:
    """FTRL-proximal for logistic loss; the last weight is the bias."""

    def __init__(self, size: int, alpha: float = 4.0, beta: float = 1.0, l1: float = 0.01, l2: float = 0.01):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        pulled = np.sign(z) * self.l1 - z
        pulled[np.abs(z) <= self.l1] = 0.0
        return pulled / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def update(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (logistic(w @ values) - label) * values
        squared = g * g
        before = self.n[at]
        sigma = (np.sqrt(before + squared) - np.sqrt(before)) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] = before + squared


def logistic(x: float | np.ndarray) -> float | np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    label: str = "label",
    doc_id: str = "doc_id",
    text: str = "text",
    bits: int = BITS,
    rows: int = SAMPLE_ROWS,
    passes: int = PASSES,
) -> np.ndarray:
    """Weights (the last is the bias) from the documents of at most ``rows`` labels.

    Labels other than 0 and 1, null ids and ids without a document are not used; of several
    labels for one id the largest counts; null texts are empty, and documents that repeat
    an id are one. Texts of any length are read whole. Without any labelled document all weights are 0, so every score is one
    half. The sample of labels is bounded by ``rows``, hence broadcast.
    """
    wanted = labels.select(
        F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{label}`").alias("label")
    ).where("label in (0, 1) and _id is not null").withColumn("label", F.col("label").cast("int"))
    wanted = wanted.groupBy("_id").agg(F.max("label").alias("label"))
    wanted = wanted.withColumn("_order", shuffle_order("quality", F.col("_id")))
    chosen = materialize(sampled(wanted, "_order", rows).drop("_place"), "label-sample")
    texts = documents.select(F.col(f"`{doc_id}`").alias("_id"), text_or_empty(text).alias("text"))
    found = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "label", "_order")
    sample = found.agg(F.min("text").alias("text"))
    size = 1 << bits

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_order", "label"], kind="stable")
        model = Ftrl(size)
        for _ in range(passes):
            for text, y in zip(rows["text"], rows["label"]):
                at, values = features(text, bits)
                model.update(np.append(at, size), np.append(values, 1.0), y)
        w = model.weights(slice(None))
        used = np.flatnonzero(w)
        return pd.DataFrame({"bucket": used, "weight": w[used]})

    learnt = sample.groupBy().applyInPandas(learn, "bucket bigint, weight double").toPandas()
    weights = np.zeros(size + 1)
    weights[learnt["bucket"].to_numpy(np.int64)] = learnt["weight"].to_numpy()
    return weights


def score(documents: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """``documents`` without ``text`` and with ``score``, the chance of label 1.

    Null texts are empty; an empty text scores by the bias alone. An empty table gives no
    rows, rows that repeat get equal scores. A given column ``score`` is replaced.
    """
    bits = int(len(weights) - 1).bit_length() - 1
    shared = documents.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    kept = [F.col(f"`{c}`") for c in documents.columns if c not in (text, "score")]
    rows = documents.select(*kept, text_or_empty(text))
    schema = documents.select(*kept).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            made = np.empty(batch.num_rows)
            for k, value in enumerate(batch.column(batch.num_columns - 1)):
                at, values = features(value.as_py(), bits)
                made[k] = logistic(float(w[at] @ values) + float(w[-1]))
            columns = [*batch.columns[:-1], pa.array(made)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "score"])

    return rows.mapInArrow(run, schema)
