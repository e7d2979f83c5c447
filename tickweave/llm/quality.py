"""Quality classifier: nearest-neighbour voting in a latent semantic space."""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.llm.common import annotate, cells, free_name
from tickweave.plans.session import ship, table

#: Labelled rows that the space is fitted on and that vote, at most: 8,192 vectors of 64 floats are 2 MB of broadcast.
MAX_LABELLED = 8192
DIMS = 64
NEIGHBOURS = 25
THRESHOLD = 0.3
BUCKETS = 2048
#: Edges of the style measures' buckets; each bucket is a term of its own.
STYLE_EDGES = {
    "distinct words": np.array([0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]), "capitals": np.array([0.01, 0.03, 0.06, 0.1, 0.2, 0.4, 0.7]),
    "marks": np.array([0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.4]), "digits": np.array([0.005, 0.02, 0.05, 0.1, 0.3]), "word length": np.array([2.0, 3, 4, 5, 6, 7, 9, 12, 20]), "words": np.array([1.0, 3, 10, 30, 100, 300, 1000, 3000, 10000]),
}
TERMS = BUCKETS + sum(len(e) + 1 for e in STYLE_EDGES.values())
_CAPITAL, _MARK, _DIGIT = (np.array([bool(f(b)) for b in range(256)]) for f in (lambda b: 65 <= b <= 90, lambda b: 33 <= b <= 47 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 126, lambda b: 48 <= b <= 57))


def terms(text: bytes | None) -> np.ndarray:
    """Term weights of a whole text: hashed byte trigrams by the logarithm of their counts, at length 1, and style buckets."""
    out = np.zeros(TERMS, np.float32)
    text = text or b""
    raw = np.frombuffer(text, np.uint8)
    if len(raw) >= 3:
        wide = raw.astype(np.uint32)
        grams = (wide[:-2] * np.uint32(0x9E3779B1) + wide[1:-1] * np.uint32(0x85EBCA77) + wide[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(21)
        out[:BUCKETS] = np.log1p(np.bincount(grams, minlength=BUCKETS))
        out[:BUCKETS] /= np.linalg.norm(out[:BUCKETS])
    words = text.split()
    n, counts = max(len(raw), 1), np.bincount(raw, minlength=256)
    style = {"distinct words": len(set(words)) / max(len(words), 1), "capitals": counts[_CAPITAL].sum() / n, "marks": counts[_MARK].sum() / n, "digits": counts[_DIGIT].sum() / n, "word length": (n - len(words)) / max(len(words), 1), "words": len(words)}
    at = BUCKETS
    for name, edges in STYLE_EDGES.items():
        out[at + int(np.searchsorted(edges, style[name], "right"))] = 0.5
        at += len(edges) + 1
    return out


@dataclass
class Model:
    mean: np.ndarray
    weight: np.ndarray
    axes: np.ndarray  # terms x dims
    vectors: np.ndarray  # labelled x dims, of length 1
    labels: np.ndarray
    prior: float

    def place(self, x: np.ndarray) -> np.ndarray:
        v = ((x - self.mean) * self.weight) @ self.axes
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def score(self, x: np.ndarray, k: int, block: int = 512) -> np.ndarray:
        """Similarity-weighted votes of the k nearest labelled vectors, by the cosines with all of them."""
        if not len(self.labels):
            return np.full(len(x), self.prior)
        v, out = self.place(x), np.empty(len(x))
        k = min(k, len(self.labels))
        for a in range(0, len(v), block):
            cos = v[a : a + block] @ self.vectors.T
            near = np.argpartition(cos, -k, axis=1)[:, -k:] if k < cos.shape[1] else np.broadcast_to(np.arange(k), cos.shape)
            w = np.maximum(np.take_along_axis(cos, near, 1).astype(np.float64), 0) ** 4
            out[a : a + block] = ((w * self.labels[near]).sum(1) + 0.01 * self.prior) / (w.sum(1) + 0.01)
        return np.clip(out, 0, 1)


def fit(x: np.ndarray, y: np.ndarray, dims: int = DIMS) -> Model:
    """Axes by the eigenvectors of the weighted terms' covariance (a truncated singular value decomposition).

    x may be of 16-bit floats: it is widened a block of rows at a time, so there is no second copy.
    """
    width = x.shape[1] if len(x) else TERMS
    if not len(x):
        return Model(np.zeros(width, np.float32), np.ones(width, np.float32), np.zeros((width, dims), np.float32), np.zeros((0, dims), np.float32), y, 0.5)
    blocks = [slice(a, a + 512) for a in range(0, len(x), 512)]
    df = sum((x[b] > 0).sum(0) for b in blocks)
    weight = np.log((1 + len(x)) / (1 + df)).astype(np.float32) + 0.3
    mean = (sum(x[b].sum(0, dtype=np.float64) for b in blocks) / len(x)).astype(np.float32)
    spread = np.zeros((width, width), np.float32)
    for b in blocks:
        z = (x[b].astype(np.float32) - mean) * weight
        spread += z.T @ z
    axes = np.linalg.eigh(spread)[1]
    axes = np.ascontiguousarray(axes[:, ::-1][:, :dims]).astype(np.float32)
    model = Model(mean, weight, axes, np.zeros((0, dims), np.float32), y.astype(np.float64), float(y.mean()))
    model.vectors = np.concatenate([model.place(x[b].astype(np.float32)) for b in blocks])
    return model


def fitted(docs: DataFrame, labels: DataFrame, most: int) -> Model:
    """The model of at most `most` labelled documents, those whose hashed doc_id is least.

    Their terms (4 KB a document, so at most 34 MB) meet in one task, which fits the model; only that, some 3 MB, comes to the driver.
    """
    picked = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.avg("quality").alias("q"))
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.join(F.broadcast(picked), "doc_id").select("text", "q", "doc_id")

    def weigh(batches):
        for b in batches:
            x = [terms(t).astype(np.float16).tobytes() for t in b.column(0).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), b.column(1), b.column(2).cast(pa.string())], names=["x", "q", "doc"])

    def one(batches):
        x, y = np.empty((most, TERMS), np.float16), np.empty(most)
        n = 0
        for b in batches:
            for t, q in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                x[n], y[n] = np.frombuffer(t.as_buffer(), np.float16), float(q >= 0.5)
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(x[:n], y[:n]))], pa.binary())], names=["model"])

    # repeated documents could make more rows than labels; the bound holds for rows
    held = rows.mapInArrow(weigh, "x binary, q double, doc string").orderBy("doc", "x").limit(most)
    got = held.select("x", "q").coalesce(1).mapInArrow(one, "model binary").collect()
    return pickle.loads(got[0][0]) if got else fit(np.zeros((0, TERMS), np.float16), np.zeros(0))


def classify(docs: DataFrame, labelled: DataFrame, labels: DataFrame, text: str = "text", into: str = "quality", most: int = MAX_LABELLED, k: int = NEIGHBOURS) -> DataFrame:
    """docs with a struct: score (0 to 1), predicted (1 from THRESHOLD on).

    labelled: doc_id, text of the documents that labels (doc_id, quality) speak of. The space is fitted on a
    sample of at most `most` of them, whose vectors are broadcast (2 MB at the default) and vote; every document's cosines
    with all of them are computed, in blocks. A map over rows: no document moves.

    Null and empty texts have the style terms of an empty text and are scored by them; labels that differ
    for a doc_id are averaged, null ones ignored; without any label the score is 0.5; repeated rows score alike.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(fitted(labelled, labels, most))

    def make():
        def run(texts):
            scores: list[float] = []
            for a in range(0, len(texts), 2048):
                scores += shared.value.score(np.stack([terms(t) for t in texts[a : a + 2048]]), k).tolist()
            return scores, [int(s >= THRESHOLD) for s in scores]

        return run

    return annotate(docs, free_name(docs, into), T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]), make, text)


def fold(doc_id: Column) -> Column:
    """Whether a document is held out: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op4_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs, labels = cells(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels")
    out = classify(docs, docs, labels.filter(~fold(F.col("doc_id"))))
    return out.select("doc_id", fold(F.col("doc_id")).alias("held_out"), F.col("quality.score").alias("score"), F.col("quality.predicted").alias("predicted"))
