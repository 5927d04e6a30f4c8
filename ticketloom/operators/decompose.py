"""Truncated decompositions by a randomised range finder with orthonormalised block power steps.

A pass multiplies every row's vector with a basis of ``k`` and some columns and adds up the outer products by feature, so
tasks and driver hold d x k numbers and never a d x d matrix. Each step orthonormalises the sums; the last one's small
Gram matrix gives singular values and right vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.sparse import Rows, vector_parts
from ticketloom.functions.vectors import width_of

OVERSAMPLE, POWER_STEPS = 10, 6
BASIS_BYTES = 512 << 20
SEED = 42


def _times(x: Rows, right: np.ndarray) -> np.ndarray:
    if x.matrix is not None:
        return x.matrix @ right
    out = np.zeros((len(x), right.shape[1]))
    np.add.at(out, np.repeat(np.arange(len(x)), np.diff(x.begin)), x.value[:, None] * right[x.index])
    return out


def _pulled(df: DataFrame, column: str, basis: np.ndarray) -> np.ndarray:
    """Sum over rows of x (x · basis), d x r: tasks add up the features they meet, then sums are shuffled by feature."""
    shared = df.sparkSession.sparkContext.broadcast(basis)  # at most BASIS_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right = shared.value
        held, met = np.zeros_like(right), np.zeros(len(right), bool)
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                x = Rows.of(batch.column(0).slice(low, 1024))
                y = _times(x, right)
                if x.matrix is not None:
                    held += x.matrix.T @ y
                    met[:] = True
                else:
                    np.add.at(held, x.index, x.value[:, None] * y[np.repeat(np.arange(len(x)), np.diff(x.begin))])
                    met[x.index] = True
        full = np.flatnonzero(met)
        for low in range(0, len(full), 1024):
            some = full[low:low + 1024]
            values = pa.FixedSizeListArray.from_arrays(pa.array(held[some].ravel()), right.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), values.cast(pa.list_(pa.float64()))], names=["at", "v"])

    parts = df.select(vector_parts(df, column).alias("x")).mapInArrow(run, "at long, v array<double>")
    sums = parts.groupBy("at").agg(Summarizer.sum(array_to_vector("v")).alias("v")).select("at", vector_to_array("v").alias("v")).toArrow()
    out = np.zeros_like(basis)
    if sums.num_rows:
        out[sums.column("at").to_numpy()] = sums.column("v").combine_chunks().flatten().to_numpy().reshape(-1, basis.shape[1])
    return out


@dataclass
class Factors:
    """``values`` fall; column i of ``right`` belongs to value i."""

    values: np.ndarray
    right: np.ndarray

    def project(self, df: DataFrame, column: str) -> Column:
        """The rows in the space of the right vectors, U times sigma where nothing was centred."""
        right = self.right
        shared = df.sparkSession.sparkContext.broadcast(right)

        @F.arrow_udf("array<double>")
        def turn(x: pa.Array) -> pa.Array:
            out = _times(Rows.of(x), shared.value) if len(x) else np.zeros((0, right.shape[1]))
            return pa.FixedSizeListArray.from_arrays(pa.array(out.ravel(), pa.float64()), right.shape[1]).cast(pa.list_(pa.float64()))

        return array_to_vector(turn(vector_parts(df, column)))


def truncated_svd(df: DataFrame, column: str, k: int, centre: bool = False, power_steps: int = POWER_STEPS, oversample: int = OVERSAMPLE, seed: int = SEED) -> Factors:
    """The ``k`` largest singular values and right vectors of the rows, or of the rows less their mean.

    Stops early once a step leaves the values as they are. Fewer than ``k`` come back if there are fewer features.
    """
    d = width_of(df, column)
    r = min(d, k + oversample)
    if 8 * d * r > BASIS_BYTES:
        raise ValueError(f"a basis of {d} x {r} numbers is above {BASIS_BYTES} bytes; ask for fewer components")
    mean, n = np.zeros(d), 0
    if centre:
        whole = df.agg(F.count(F.lit(1)).alias("n")).first()
        n = whole["n"]
        mean = _pulled_sum(df, column, d) / max(n, 1)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, r)))[0] if r < d else np.eye(d)
    last = None
    for _ in range(power_steps + 1):
        z = _pulled(df, column, basis)
        if centre:
            z -= n * np.outer(mean, mean @ basis)
        gram = basis.T @ z
        energy, turn = np.linalg.eigh((gram + gram.T) / 2)
        order = np.argsort(-energy)[:k]
        found = Factors(np.sqrt(np.maximum(energy[order], 0.0)), basis @ turn[:, order])
        if r == d or (last is not None and np.abs(found.values - last).max() <= 1e-9 * max(found.values.max(), 1e-300)):
            break
        last, basis = found.values, np.linalg.qr(z)[0]
    return found


def _pulled_sum(df: DataFrame, column: str, d: int) -> np.ndarray:
    """Sum of all rows: d numbers."""
    row = df.select(Summarizer.sum(array_to_vector(F.col(column)) if dict(df.dtypes)[column].startswith("array") else F.col(column)).alias("s")).first()
    return row["s"].toArray() if row["s"] is not None else np.zeros(d)
