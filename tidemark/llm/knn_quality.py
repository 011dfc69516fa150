"""Quality by nearest-neighbour voting in a latent-semantic space.

Texts become hashed byte-trigram counts. A bounded, labelled sample gives document frequencies and a latent space (the
leading eigenvectors of its term covariance); its vectors and labels are broadcast. Every document is compared with
all of them by blocked cosine products, and its nearest neighbours vote with their similarity.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import doc_columns, map_rows, utf8

#: Parameters: hashed terms, latent dimensions, neighbours that vote, the most labelled rows to learn from.
TERMS, LATENT, NEIGHBOURS, SAMPLE = 2048, 64, 15, 5000
POWER, REJECT_BELOW = 4, 0.3
BLOCK_BYTES, BLOCK_ROWS = 1 << 20, 256


def term_counts(text: str | None) -> np.ndarray:
    """log(1 + count) of the hashed byte trigrams of the whole text."""
    data = np.frombuffer(utf8(text or ""), np.uint8)
    total = np.zeros(TERMS, np.int64)
    for at in range(0, max(len(data) - 2, 0), BLOCK_BYTES):
        part = data[at : at + BLOCK_BYTES + 2].astype(np.uint32)
        term = part[:-2] * np.uint32(2654435761) + part[1:-1] * np.uint32(2246822519) + part[2:] * np.uint32(3266489917)
        total += np.bincount((term ^ term >> 15) >> np.uint32(4) & np.uint32(TERMS - 1), minlength=TERMS)
    return np.log1p(total).astype(np.float32)


@dataclass
class Model:
    """What scoring needs: weights of terms, the latent axes, and the labelled vectors with their labels."""

    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        latent = _unit(counts * self.weights) @ self.axes
        return _unit(latent)

    def score(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        near = self.project(counts) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        votes = np.maximum(np.take_along_axis(near, best, 1), 0).astype(np.float64) ** POWER
        total = votes.sum(axis=1)
        said = (votes * self.labels[best]).sum(axis=1) / np.maximum(total, 1e-12)
        return np.clip(np.where(total > 1e-12, said, self.prior), 0, 1)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def held_out(id_col: str = "doc_id"):
    """Rows that no model may learn from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Model from at most ``sample`` labelled documents, those of smallest hash among the rows that may be learnt from.

    Null labels are left out; several labels of one id are averaged. Without any labelled row every score is 0.5.
    """
    usable = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.avg("quality").alias("label")
    )
    chosen = usable.where(~held_out("id")).orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = doc_columns(docs, "doc_id", "text").join(F.broadcast(chosen), "id")  # at most ``sample`` ids and numbers
    schema = "id long, label double, counts binary"

    def work(batch: pa.RecordBatch):
        counts = [term_counts(t.as_py()).astype(np.float16).tobytes() for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(counts, pa.binary())], names=["id", "label", "counts"]
        )

    # one row of each id, so that repeated rows cannot raise the number
    found = map_rows(rows.select("id", "text", "label"), work, schema).groupBy("id").agg(
        F.min(F.struct("counts", "label")).alias("x")
    ).select("id", "x.*").collect()
    found.sort(key=lambda r: r["id"])
    if not found:
        empty = np.zeros((0, 1), np.float32)
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), empty, np.zeros(0), 0.5)
    counts = np.stack([np.frombuffer(r["counts"], np.float16) for r in found]).astype(np.float32)
    truth = np.array([r["label"] for r in found])
    weights = (np.log((1 + len(found)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    terms = _unit(counts * weights)
    _, axes = np.linalg.eigh((terms.T @ terms).astype(np.float64))
    axes = axes[:, ::-1][:, :LATENT].astype(np.float32)
    return Model(weights, axes, _unit(terms @ axes), truth, float(truth.mean()))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row from its whole text; a text of fewer than three bytes gets the prior.

    Repeated rows are scored alike, null ids stay, further columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch):
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            counts = np.stack([term_counts(t.as_py()) for t in part.column(1)])
            scores = shared.value.score(counts).astype(np.float64)
            empty = ~counts.any(axis=1)
            scores[empty] = shared.value.prior
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores)], names=["doc_id", "score"])

    return map_rows(doc_columns(docs, "doc_id", "text"), work, "doc_id long, score double")
