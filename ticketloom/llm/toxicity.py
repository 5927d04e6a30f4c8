"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A feature is a hashed run of 3 to 6 characters of the lower-cased text; its value grows with the run's density in the
text and stays below 1, so one chance hit in a long text counts little. Log-count ratios of the two classes scale the
values, the features that part the classes best are kept, and a penalised logistic regression weighs them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.common import map_texts, read, remainder
from ticketloom.session import settle_table

ORDERS = (3, 4, 5, 6)
BITS = 19
FEATURES = 1024
#: At most so many labelled rows of each class (clean, toxic) fit the classifier: those with the lowest keyed hash.
FIT_ROWS = (8_000, 4_000)
DENSITY = 400.0
PENALTY = 1.0
CHUNK_CHARS = 1 << 20
THRESHOLD = 0.7
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def gram_codes(text: str, bits: int = BITS) -> Iterator[np.ndarray]:
    """Buckets of all character n-grams of a text, order by order and in parts of bounded size."""
    longest = max(ORDERS)
    text = " " + text.lower() + " "
    for at in range(0, len(text), CHUNK_CHARS):
        part = text[at:at + CHUNK_CHARS + longest - 1]
        chars = np.frombuffer(part.encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
        code, room = chars.copy(), len(text) - at
        for n in range(2, longest + 1):
            if n > room:
                break
            code = code[:-1] * MULTIPLIER + chars[n - 1:] if n > 1 else code
            if n in ORDERS:
                mixed = (code ^ (code >> np.uint64(29))) * MULTIPLIER
                yield (mixed[:CHUNK_CHARS] >> np.uint64(64 - bits)).astype(np.int64)


def density(counts: np.ndarray, n_chars: int) -> np.ndarray:
    """Values from 0 to below 1: half at one occurrence in ``DENSITY`` characters."""
    return counts / (counts + max(n_chars, 1) / DENSITY)


@dataclass
class ToxicityModel:
    """``place``: feature of each bucket, or the number of features; ``weights``: ratios times regression weights."""

    place: np.ndarray
    weights: np.ndarray
    intercept: float

    def counts(self, text: str) -> np.ndarray:
        n = len(self.weights)
        out = np.zeros(n + 1, np.int64)
        for codes in gram_codes(text):
            out += np.bincount(self.place[codes], minlength=n + 1)
        return out[:n]

    def score(self, text: str | None) -> float:
        text = text or ""
        z = self.intercept + float(density(self.counts(text), len(text)) @ self.weights) if text else self.intercept
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def _fit_rows(labels: DataFrame, label: str, doc_id: str, fit_rows: tuple[int, int]) -> DataFrame:
    """The labelled ids that fit the classifier: a documented bound for each class, lowest hash first."""
    ids = labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("__y")).where("__id is not null and __y in (0, 1)").groupBy("__id").agg(F.max("__y").alias("__y"))
    order = F.xxhash64(F.col("__id"), F.lit("toxicity"))
    both = [ids.where(F.col("__y") == y).orderBy(order, "__id").limit(n) for y, n in enumerate(fit_rows)]
    return both[0].union(both[1])


def logistic(x: np.ndarray, y: np.ndarray, row_weight: np.ndarray, penalty: float = PENALTY, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Weights and intercept of a penalised logistic regression, by Newton's method."""
    a = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w, ridge = np.zeros(a.shape[1]), np.full(a.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (row_weight * (p - y)) + ridge * w
        curve = (a * (row_weight * np.maximum(p * (1 - p), 1e-4)).astype(a.dtype)[:, None]).T @ a + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", fit_rows: tuple[int, int] = FIT_ROWS, features: int = FEATURES) -> ToxicityModel:
    """Fit on at most ``fit_rows`` labelled rows of each class; ``labels`` must hold training rows only.

    Labels that are null or neither 0 nor 1, null ids and ids without a document are left out; of a doc_id labelled
    twice the toxic label counts, of a doc_id with several texts the greatest text. With only one class the model
    scores that class's share for every text, with none 0.5.
    """
    ids = F.broadcast(settle_table(_fit_rows(labels, label, doc_id, fit_rows), "toxicity-ids"))  # bounded by fit_rows
    rows = docs.select(F.col(doc_id).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__text")).join(ids, "__id")
    rows = settle_table(rows.groupBy("__id", "__y").agg(F.max("__text").alias("text")).select(F.col("__y").alias("y"), "text").coalesce(8), "toxicity-rows")
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    seen = {r["y"]: r["n"] for r in labels.groupBy(F.col(label).cast("int").alias("y")).agg(F.count(F.lit(1)).alias("n")).where("y in (0, 1)").collect()}
    if len(n) < 2:
        share = (1 + seen.get(1, 0)) / (2 + sum(seen.values()))
        return ToxicityModel(np.zeros(1 << BITS, np.int16), np.zeros(0), float(np.log(share / (1 - share))))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((2, 1 << BITS), np.float32)
        for batch in batches:
            for y, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = x.as_py()
                codes, counts = np.unique(np.concatenate([*gram_codes(own), np.zeros(0, np.int64)]), return_counts=True)
                both[y, codes] += density(counts, len(own))
        yield pa.RecordBatch.from_arrays([pa.array([both.tobytes()], pa.binary())], names=["sums"])

    total = np.zeros((2, 1 << BITS))
    for row in rows.mapInArrow(sums, "sums binary").toLocalIterator():  # one row of fixed size for each of 8 tasks
        total += np.frombuffer(row["sums"], np.float32).reshape(2, -1)
    mean = (total + 1e-3) / np.array([[n[0]], [n[1]]])
    ratio = np.clip(np.log(mean[1] / mean[0]), -6, 6)
    parting = np.abs(mean[1] - mean[0]) / np.sqrt(mean[1] + mean[0])
    best = np.sort(np.argsort(-parting, kind="stable")[:features])
    place = np.full(1 << BITS, len(best), np.int16)
    place[best] = np.arange(len(best))
    scale = ratio[best]
    draft = ToxicityModel(place, scale, 0.0)

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [(density(draft.counts(t.as_py()), len(t.as_py())) * scale).astype(np.float16).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary())], names=["y", "x"])

    table = rows.mapInArrow(values, "y int, x binary").toArrow()  # at most sum(fit_rows) rows of two bytes a feature
    x = np.frombuffer(b"".join(table.column("x").to_pylist()), np.float16).reshape(-1, len(best)).astype(np.float32)
    y = table.column("y").to_numpy().astype(np.float64)
    share = seen[1] / (seen[0] + seen[1])
    row_weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    weights, intercept = logistic(x, y, row_weight)
    return ToxicityModel(place, scale * weights, intercept)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """The ``keep`` columns, then score (0 to 1) and predicted (1 from ``threshold`` on) of every whole text.

    Null and empty texts get the score of a text without features. Repeated rows score alike; other columns are left
    out, so their names cannot clash (``names`` are those of the new ones); an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size

    def start():
        model = shared.value

        def make(texts: pa.Array) -> list[pa.Array]:
            scores = np.array([model.score(x.as_py()) for x in texts], np.float64)
            return [pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]

        return make

    return map_texts(docs, text, keep, start, dict(zip(names, ("double", "int"))))


def without_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that a model fitted on all ``labels`` does not reject, all columns kept."""
    scored = score_toxicity(docs, fit_toxicity(docs, labels, doc_id, text), text, tuple(docs.columns), names=("__score", "__predicted"))
    return scored.where("__predicted = 0").drop("__score", "__predicted")


def training_labels(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return labels.where(remainder(doc_id, 3) != 1)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit_toxicity(docs, training_labels(read(spark, sf_dir, "labels")))
    out = score_toxicity(docs, model)
    return out.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted")
