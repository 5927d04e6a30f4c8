"""Kernel machine: Nyström features of landmark rows, squared-hinge Newton steps, probabilities calibrated on held-out folds.

The Gaussian kernel of a row with some landmark rows, whitened by the landmarks' own kernel, stands in for the full kernel.
Landmarks are rows of the table and stay sparse. One pass over the rows serves every class and every fold: it adds up, per
problem, gradient and Hessian over the rows inside the margin, a few hundred numbers squared whatever the table holds.
Rows of a fold are scored by weights that have not seen them, and those scores fit each class's probability curve.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.functions.hashing import keyed_hash
from ticketloom.functions.sparse import Rows, vector_parts
from ticketloom.functions.vectors import width_of

LANDMARKS, FOLDS = 256, 3
SUM_BYTES = 256 << 20
BATCH_ROWS = 1024
LANDMARK_SEED = "landmark"


def scale_gamma(df: DataFrame, features: str = "features") -> float:
    """1 / (d * variance of all entries), the usual kernel width; zeros that are not stored count."""
    d = width_of(df, features)
    values = vector_parts(df, features)["values"]
    row = df.select(F.aggregate(values, F.lit(0.0), lambda s, v: s + v).alias("s"), F.aggregate(values, F.lit(0.0), lambda s, v: s + v * v).alias("q")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).first()
    mean = row["s"] / (row["n"] * d)
    return 1.0 / (d * max(row["q"] / (row["n"] * d) - mean * mean, 1e-12))


@dataclass
class Nystrom:
    landmarks: Rows
    whiten: np.ndarray
    gamma: float

    @classmethod
    def fit(cls, df: DataFrame, gamma: float, size: int = LANDMARKS, features: str = "features") -> "Nystrom":
        """The rows with the lowest keyed hashes are the landmarks, so they follow ids alone."""
        picked = df.select(vector_parts(df, features).alias("x"), keyed_hash(LANDMARK_SEED, F.col("id")).alias("h"), "id").orderBy("h", "id").limit(size)
        rows = Rows.of(picked.select("x").toArrow().column("x"))
        values, vectors = np.linalg.eigh(np.exp(-gamma * rows.rough(rows) ** 2))
        kept = values > 1e-9 * values.max()
        return cls(rows, vectors[:, kept] / np.sqrt(values[kept]), gamma)

    def lift(self, x: Rows) -> np.ndarray:
        """Features of some rows and a one for the intercept."""
        return np.concatenate([np.exp(-self.gamma * x.rough(self.landmarks) ** 2) @ self.whiten, np.ones((len(x), 1))], axis=1)


def _sums(data: DataFrame, work, groups: int, size: int) -> np.ndarray:
    """(groups, size): what ``work(x, label, fold)`` adds up over batches of rows; tasks add up their own first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((groups, size))
        for batch in batches:
            for low in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(low, BATCH_ROWS)
                held += work(Rows.of(part.column(0)), part.column(1).to_numpy(), part.column(2).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(groups)), pa.array(list(held), pa.list_(pa.float64()))], names=["at", "v"])

    rows = data.select("x", "label", "fold").mapInArrow(run, "at long, v array<double>")
    rows = rows.groupBy("at").agg(Summarizer.sum(array_to_vector("v")).alias("v")).select("at", vector_to_array("v").alias("v")).collect()
    out = np.zeros((groups, size))
    for r in rows:
        out[r["at"]] = r["v"]
    return out


@dataclass
class KernelMachine:
    """An estimator for ``(id, features, label)`` tables: one class against the rest, two classes by one boundary."""

    C: float = 1.0
    landmarks: int = LANDMARKS
    folds: int = FOLDS
    max_iter: int = 30
    gamma: float | None = None

    def fit(self, df: DataFrame) -> "KernelModel":
        base = Nystrom.fit(df, self.gamma or scale_gamma(df), self.landmarks)
        classes = max(2, int(df.agg(F.max("label").alias("k")).first()["k"]) + 1)
        free, folds = classes if classes > 2 else 1, self.folds
        width = base.whiten.shape[1] + 1
        if 8 * width * width * free * (folds + 1) > SUM_BYTES:
            raise ValueError(f"{free} classes with {width} features need sums above {SUM_BYTES} bytes; ask for fewer landmarks")
        fold = F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(folds))
        data = df.select(vector_parts(df, "features").alias("x"), F.col("label").cast("int").alias("label"), fold.cast("int").alias("fold"))
        weights = self._weights(data, base, free, classes, width)
        slopes = _calibrate(data, base, weights, free, classes, folds)
        return KernelModel(base, weights[folds], slopes, classes)

    def _weights(self, data: DataFrame, base: Nystrom, free: int, classes: int, width: int) -> np.ndarray:
        """(folds + 1, classes, width): the last weights have seen all rows, the others all but one fold."""
        folds, cost = self.folds, self.C
        problems = (folds + 1) * free
        shared = data.sparkSession.sparkContext.broadcast(base)
        ridge = np.eye(width)
        ridge[-1, -1] = 1e-9  # the intercept is free

        def passed(w: np.ndarray) -> np.ndarray:
            def work(x, label, fold):
                z, out = shared.value.lift(x), np.zeros((problems, 1 + width + width * width))
                for f in range(folds + 1):
                    rows = z[fold != f]
                    for c in range(free):
                        y = np.where(label[fold != f] == classes - free + c, 1.0, -1.0)
                        lack = 1 - y * (rows @ w[f, c])
                        inside = rows[lack > 0]
                        out[f * free + c] = np.concatenate([[(lack[lack > 0] ** 2).sum()], y[lack > 0] @ inside, (inside.T @ inside).ravel()])
                return out

            return _sums(data, work, problems, 1 + width + width * width).reshape(folds + 1, free, -1)

        w, last, step = np.zeros((folds + 1, free, width)), None, None
        for _ in range(self.max_iter):
            sums = passed(w)
            value = 0.5 * np.einsum("fcw,wv,fcv->fc", w, ridge, w) + cost * sums[:, :, 0]
            if last is not None:
                worse = value > last[1] + 1e-12 * np.abs(last[1])  # there half the step is tried
                if worse.any():
                    w = np.where(worse[:, :, None], (w + last[0]) / 2, w)
                    if np.abs(w - last[0])[worse].max() > 1e-9:
                        continue
                if (last[1] - value).max() <= 1e-6 * max(value.max(), 1e-12):
                    break
            last = w, value
            step = np.empty_like(w)
            for f in range(folds + 1):
                for c in range(free):
                    gram = sums[f, c, 1 + width:].reshape(width, width)
                    step[f, c] = np.linalg.solve(ridge + 2 * cost * gram, 2 * cost * sums[f, c, 1:1 + width])
            w = step
        return last[0]


def _calibrate(data: DataFrame, base: Nystrom, weights: np.ndarray, free: int, classes: int, folds: int, rounds: int = 20) -> np.ndarray:
    """(classes, 2): slope and shift of each class's logistic curve over held-out scores, by Newton steps on sums.

    Targets are smoothed by the class counts, so a class that the scores separate keeps a finite slope.
    """
    shared = data.sparkSession.sparkContext.broadcast((base, weights))
    counts = {r["label"]: r["n"] for r in data.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total, curves = sum(counts.values()), np.tile([1.0, 0.0], (free, 1))
    goal = np.array([[1 / (total - counts.get(classes - free + c, 0) + 2), (counts.get(classes - free + c, 0) + 1) / (counts.get(classes - free + c, 0) + 2)] for c in range(free)])
    for _ in range(rounds):
        at = curves.copy()

        def work(x, label, fold):
            base, w = shared.value
            z, out = base.lift(x), np.zeros((free, 5))
            for c in range(free):
                s = np.einsum("rw,rw->r", z, w[fold, c])
                t = np.where(label == classes - free + c, goal[c, 1], goal[c, 0])
                p = 1 / (1 + np.exp(-np.clip(at[c, 0] * s + at[c, 1], -500, 500)))  # noqa: B023
                d, v = p - t, np.maximum(p * (1 - p), 1e-12)
                out[c] = [d @ s, d.sum(), v @ (s * s), v @ s, v.sum()]
            return out

        sums = _sums(data, work, free, 5)
        for c in range(free):
            hessian = np.array([[sums[c, 2] + 1e-6, sums[c, 3]], [sums[c, 3], sums[c, 4] + 1e-6]])
            move = np.linalg.solve(hessian, sums[c, :2])
            curves[c] -= move * min(1.0, 5.0 / max(np.abs(move).max(), 1e-12))
        if np.abs(curves - at).max() <= 1e-4:
            break
    return curves


@dataclass
class KernelModel:
    base: Nystrom
    weights: np.ndarray
    curves: np.ndarray
    classes: int

    def scores(self, x: Rows) -> tuple[np.ndarray, np.ndarray]:
        """(margins, probabilities); two classes have one margin."""
        s = self.base.lift(x) @ self.weights.T
        p = 1 / (1 + np.exp(-np.clip(s * self.curves[:, 0] + self.curves[:, 1], -500, 500)))
        p = np.concatenate([1 - p, p], axis=1) if len(self.weights) < self.classes else p
        return s, p / np.maximum(p.sum(axis=1, keepdims=True), 1e-300)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``rawPrediction``, ``probability`` (arrays) and ``prediction``, the class of the largest margin."""
        shared, free, classes = df.sparkSession.sparkContext.broadcast(self), len(self.weights), self.classes
        width = free + classes

        @F.arrow_udf("array<double>")
        def score(column: pa.Array) -> pa.Array:
            parts = [np.zeros((0, width))]
            for low in range(0, len(column), BATCH_ROWS):
                parts.append(np.concatenate(shared.value.scores(Rows.of(column.slice(low, BATCH_ROWS))), axis=1))
            out = np.concatenate(parts)
            return pa.FixedSizeListArray.from_arrays(pa.array(out.ravel(), pa.float64()), width).cast(pa.list_(pa.float64()))

        out = df.withColumn("_both", score(vector_parts(df, "features")))
        out = out.withColumn("rawPrediction", F.slice("_both", 1, free)).withColumn("probability", F.slice("_both", free + 1, classes)).drop("_both")
        best = (F.col("rawPrediction")[0] > 0).cast("double") if free == 1 else (F.array_position("rawPrediction", F.array_max("rawPrediction")) - 1).cast("double")
        return out.withColumn("prediction", best)

    def save(self, spark: SparkSession, path: str) -> None:
        x = self.base.landmarks.as_sparse()
        numbers = {"begin": x.begin, "index": x.index, "value": x.value, "whiten": self.base.whiten.ravel(), "weights": self.weights.ravel(), "curves": self.curves.ravel()}
        rows = [(name, [float(v) for v in values]) for name, values in numbers.items()] + [("facts", [float(x.width), self.base.gamma, float(self.classes)])]
        spark.createDataFrame(rows, "name string, numbers array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "KernelModel":
        held = {r["name"]: np.array(r["numbers"]) for r in spark.read.parquet(path).collect()}
        width, gamma, classes = held["facts"]
        rows = Rows(int(width), None, held["begin"].astype(np.int64), held["index"].astype(np.int64), held["value"]).narrow()
        free = int(classes) if classes > 2 else 1
        return cls(Nystrom(rows, held["whiten"].reshape(len(rows), -1), float(gamma)), held["weights"].reshape(free, -1), held["curves"].reshape(free, 2), int(classes))
