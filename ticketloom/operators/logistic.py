"""Multinomial (or binomial) logistic regression over blocks of rows.

Rows lie in blocks of bounded size. A table of one block is solved in its task, by coordinate steps on one dual distribution
over the classes per row. For weights that belong to the duals, the duality gap is the mean divergence of a row's dual from
its predicted distribution, so it comes with every round at no cost and ends the search. Intercepts are not penalised: they
take a Newton step an epoch.

Wide models over several blocks take limited-memory steps: a pass adds up the gradient, blocks are written once and only read,
and the number of passes does not follow the number of blocks. Narrow models take Newton steps in all weights: a pass adds up
gradient and Hessian over the blocks. In both the predictions are the duals of the gap.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.sparse import spread
from ticketloom.functions.vectors import as_vector, width_of
from ticketloom.session import settle_table

#: A table of more than BLOCK_ENTRIES lies in blocks of PART_ENTRIES: many tasks then share a pass.
BLOCK_ENTRIES, PART_ENTRIES = 2_000_000, 500_000
MODEL_BYTES = 256 << 20
SUMS_BYTES = 64 << 20  # sums of all blocks that the driver adds up itself
SMOOTH = 0.5  # share of the uniform distribution in the first duals
LEAST = 1e-12
NEWTON_WIDTH = 512  # weights of models that are solved by Newton steps; their Hessian takes 2 MB
SLICE_ROWS = 2048
MEMORY = 10  # steps that shape the next one, where weights lie in several blocks
SHARED_EPOCHS = 4  # local passes of a round where other blocks move the weights too
STATIC = ("block", "begin", "index", "value", "label")
BLOCK_SCHEMA = "block long, begin binary, index binary, value binary, label binary, dual binary, sums binary"


@dataclass
class Block:
    """Rows of one block in compressed sparse form, with their duals."""

    begin: np.ndarray
    index: np.ndarray
    value: np.ndarray
    label: np.ndarray
    dual: np.ndarray

    @classmethod
    def of(cls, row: dict, classes: int) -> "Block":
        label = np.frombuffer(row["label"], np.int32)
        if row["dual"] is None:
            dual = np.full((len(label), classes), SMOOTH / classes)
            dual[np.arange(len(label)), label] += 1 - SMOOTH
        else:
            dual = np.frombuffer(row["dual"]).reshape(-1, classes).copy()
        return cls(np.frombuffer(row["begin"], np.int64), np.frombuffer(row["index"], np.int32), np.frombuffer(row["value"]), label, dual)

    def margins(self, weights: np.ndarray) -> np.ndarray:
        """Scores of all rows, without intercepts."""
        out = np.zeros((len(self.label), weights.shape[1]))
        row = np.repeat(np.arange(len(self.label)), np.diff(self.begin))
        for c in range(weights.shape[1]):
            out[:, c] = np.bincount(row, weights[self.index, c] * self.value, minlength=len(self.label))
        return out

    def pull(self, change: np.ndarray, features: int) -> np.ndarray:
        """Sum over rows of their features times their ``change``."""
        row = np.repeat(np.arange(len(self.label)), np.diff(self.begin))
        return np.stack([np.bincount(self.index, change[row, c] * self.value, minlength=features) for c in range(change.shape[1])], axis=1)


def _all_scores(z: np.ndarray, classes: int) -> np.ndarray:
    """With two classes only the second has a score; the first's is zero."""
    return np.concatenate([np.zeros((len(z), 1)), z], axis=1) if z.shape[1] < classes else z


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _facts(block: Block, predicted: np.ndarray, free: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Sum of divergences, gradient and Hessian of the loss by the intercepts."""
    p, q = np.maximum(block.dual, LEAST), np.maximum(predicted, LEAST)
    gap = float((p * (np.log(p) - np.log(q))).sum())
    gradient = predicted.sum(axis=0) - np.bincount(block.label, minlength=predicted.shape[1])
    hessian = np.diag(predicted.sum(axis=0)) - predicted.T @ predicted
    return gap, gradient[-free:], hessian[-free:, -free:]


def _newton(gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    step = -np.linalg.lstsq(hessian + 1e-9 * np.trace(hessian) / len(hessian) * np.eye(len(hessian)), gradient, rcond=None)[0]
    return step * min(1.0, 2.0 / max(np.abs(step).max(), LEAST))


def improve(block: Block, weights: np.ndarray, intercepts: np.ndarray, first: bool, scale: float, blocks: int, caution: float, epochs: int, tol: float, seed: int):
    """Coordinate steps on the duals of a block: (change of weights, change of intercepts, what held before).

    ``scale`` is the penalty times the number of all rows; ``caution`` scales what a block assumes all blocks to move. A step moves a row's dual towards its prediction, as far as the
    dual objective along that line rises. A block ends early once it meets the tolerance by itself.
    """
    classes, free, n = block.dual.shape[1], weights.shape[1], len(block.label)
    before = block.dual.copy()
    if first:  # the weights are still zero and belong to duals that sit on the labels
        before = np.zeros_like(block.dual)
        before[np.arange(n), block.label] = 1
    held = _facts(Block(block.begin, block.index, block.value, block.label, before), _softmax(_all_scores(block.margins(weights) + intercepts, classes)), free)
    own, b = weights.copy(), intercepts.copy()
    if first:
        own += caution / scale * block.pull((before - block.dual)[:, -free:], len(weights))
    norm = np.add.reduceat(np.append(block.value ** 2, 0.0), block.begin[:-1]) * (np.diff(block.begin) > 0)
    curve, push = caution / scale * norm, caution / scale
    rng = np.random.default_rng(seed)
    begin, index, value, dual = block.begin, block.index, block.value, block.dual
    z = np.zeros(classes)
    for _ in range(epochs if blocks == 1 else min(epochs, SHARED_EPOCHS)):
        predicted = _softmax(_all_scores(block.margins(own) + b, classes))
        gap, gradient, hessian = _facts(block, predicted, free)
        if gap <= 0.3 * tol * n and (blocks > 1 or np.abs(gradient).max() <= 0.3 * tol * n):
            break
        if blocks == 1:
            b = b + _newton(gradient, hessian)
        for i in rng.permutation(n).tolist():
            at, x, p = index[begin[i]:begin[i + 1]], value[begin[i]:begin[i + 1]], dual[i]
            near = own[at]
            z[classes - free:] = x @ near + b
            e = np.exp(z - z.max())
            way = e / e.sum() - p
            slope = way @ (z - np.log(p))
            part = way[classes - free:]
            bend = curve[i] * (part @ part)
            s = min(1.0, slope / (np.abs(way).sum() ** 2 + bend + LEAST))
            for _ in range(2):  # Newton along the line, from the safe step
                there = np.maximum(p + s * way, LEAST)
                s += (way @ (z - np.log(there)) - s * bend) / ((way * way / there).sum() + bend + LEAST)
                s = min(1.0, max(0.0, s))
            dual[i] = np.maximum(p + s * way, LEAST)
            own[at] = near - (push * s) * np.outer(x, part)
    change = 1.0 / scale * block.pull((before - dual)[:, -free:], len(weights))
    return change, b - intercepts, held


def _pack_blocks(rows: pa.Table) -> pa.Table:
    """One block's rows, in the order of their ids, as one row."""
    rows = rows.sort_by([("id", "ascending")])
    kind, indices, values = (pa.concat_arrays(rows.column(c).chunks) for c in ("type", "indices", "values"))
    if values.null_count:
        raise ValueError("rows without features")
    size, dense = values.value_lengths().to_numpy().astype(np.int64), kind.to_numpy() == 1
    row, index = spread(size)
    index[~dense[row]] = indices.filter(pa.array(~dense)).flatten().to_numpy()
    parts = {"begin": np.append(0, np.cumsum(size)), "index": index.astype(np.int32), "value": values.flatten().to_numpy().astype(np.float64),
             "label": rows.column("label").to_numpy().astype(np.int32)}
    return pa.table({"block": pa.array([rows.column("block")[0].as_py()], pa.int64()), **{k: pa.array([v.tobytes()], pa.binary()) for k, v in parts.items()}})


def make_blocks(df: DataFrame, id_col: str, features: str, label: str, block_entries: int) -> tuple[DataFrame, int, int, int, int]:
    """(blocks, their number, rows, features, classes). Blocks follow the ids and the entries alone, not the cluster."""
    data = as_vector(df, features).select(F.col(id_col).alias("id"), F.col(label).cast("long").alias("label"), F.unwrap_udt(F.col(features)).alias("v"))
    facts = data.agg(F.count(F.lit(1)).alias("n"), F.max("label").alias("k"), F.sum(F.size("v.values")).alias("entries"), F.sum((F.col("label").isNull() | (F.col("label") < 0)).cast("int")).alias("bad")).first()
    if not facts["n"]:
        raise ValueError("no rows to fit")
    if facts["bad"]:
        raise ValueError("labels are whole numbers from 0")
    blocks = 1 if facts["entries"] <= block_entries else math.ceil(facts["entries"] / min(block_entries, PART_ENTRIES))
    flat = data.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), "id", "label", F.col("v.type").alias("type"), F.col("v.indices").alias("indices"), F.col("v.values").alias("values"))
    packed = flat.groupBy("block").applyInArrow(_pack_blocks, "block long, begin binary, index binary, value binary, label binary")
    empty = [F.lit(None).cast("binary").alias(c) for c in ("dual", "sums")]
    return settle_table(packed.select("*", *empty), "logistic-blocks", maxRecordsPerFile=1), blocks, facts["n"], width_of(df, features), max(2, facts["k"] + 1)


def _round(table: DataFrame, weights: np.ndarray, intercepts: np.ndarray, number: int, scale: float, blocks: int, caution: float, classes: int, epochs: int, tol: float) -> DataFrame:
    shared = table.sparkSession.sparkContext.broadcast((weights, intercepts))  # at most MODEL_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercepts = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in (*STATIC, "dual")}
                block = Block.of(row, classes)
                change, shift, (gap, gradient, hessian) = improve(block, weights, intercepts, number == 0, scale, blocks, caution, epochs, tol, 1000 * number + row["block"] % 1000)
                made = {"dual": block.dual, "sums": np.concatenate([[gap], gradient, hessian.ravel(), shift, change.ravel()])}
                columns = [pa.array([row["block"]], pa.int64()), *(pa.array([row[c]], pa.binary()) for c in STATIC[1:]), *(pa.array([v.tobytes()], pa.binary()) for v in made.values())]
                yield pa.RecordBatch.from_arrays(columns, names=[*STATIC, *made])

    return settle_table(table.mapInArrow(run, BLOCK_SCHEMA), "logistic-blocks")


def _curvature(block: Block, weights: np.ndarray) -> np.ndarray:
    """Packed sums over a block's rows: loss, entropy of the predictions, gradient and Hessian; the last row of ``weights`` are intercepts."""
    (features, free), classes = weights.shape, block.dual.shape[1]
    loss, entropy, gradient, hessian = 0.0, 0.0, np.zeros((free, features)), np.zeros((free, features, free, features))
    for low in range(0, len(block.label), SLICE_ROWS):
        label = block.label[low:low + SLICE_ROWS]
        begin = block.begin[low:low + len(label) + 1]
        x, at = np.zeros((len(label), features)), slice(begin[0], begin[-1])
        np.add.at(x, (np.repeat(np.arange(len(label)), np.diff(begin)), block.index[at]), block.value[at])
        x[:, -1] = 1.0
        z = _all_scores(x @ weights, classes)
        z -= z.max(axis=1, keepdims=True)
        rest = np.log(np.exp(z).sum(axis=1, keepdims=True))
        p = np.exp(z - rest)
        loss -= float((z - rest)[np.arange(len(label)), label].sum())
        entropy -= float((p * (z - rest)).sum())
        change = p.copy()
        change[np.arange(len(label)), label] -= 1
        p = p[:, classes - free:]
        gradient += change[:, classes - free:].T @ x
        for a in range(free):
            for b in range(a + 1):
                part = x.T @ (x * (p[:, a] * ((a == b) - p[:, b]))[:, None])
                hessian[a, :, b] += part
                if a != b:
                    hessian[b, :, a] += part
    return np.concatenate([[loss, entropy], gradient.ravel(), hessian.ravel()])


def _curvatures(table: DataFrame, weights: np.ndarray, classes: int) -> DataFrame:
    shared = table.sparkSession.sparkContext.broadcast(weights)
    size = weights.size
    return _block_sums(table, STATIC, 2 + size + size * size, lambda row: _curvature(Block.of({**row, "dual": None}, classes), shared.value))


def _slopes(table: DataFrame, weights: np.ndarray, intercepts: np.ndarray, classes: int) -> DataFrame:
    """Packed sums over blocks: loss, entropy of the predictions, and the gradients of intercepts and weights."""
    shared = table.sparkSession.sparkContext.broadcast((weights, intercepts))  # at most MODEL_BYTES
    features, free = weights.shape

    def work(row: dict) -> np.ndarray:
        weights, intercepts = shared.value
        block = Block.of({**row, "dual": None}, classes)
        z = _all_scores(block.margins(weights) + intercepts, classes)
        z -= z.max(axis=1, keepdims=True)
        z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
        p = np.exp(z)
        loss, entropy = -z[np.arange(len(z)), block.label].sum(), -(p * z).sum()
        p[np.arange(len(z)), block.label] -= 1
        change = p[:, classes - free:]
        return np.concatenate([[loss, entropy], change.sum(axis=0), block.pull(change, features).ravel()])

    return _block_sums(table, STATIC, 2 + free + features * free, work)


def _squares(table: DataFrame, features: int) -> DataFrame:
    """Sums of squared values over blocks, per feature."""
    return _block_sums(table, ("index", "value"), features, lambda row: np.bincount(
        np.frombuffer(row["index"], np.int32), np.frombuffer(row["value"]) ** 2, minlength=features))


def _block_sums(table: DataFrame, columns: tuple[str, ...], size: int, work) -> DataFrame:
    """What ``work`` makes of blocks, packed: each task adds up its own and returns one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for i in range(batch.num_rows):
                made = work({c: batch.column(c)[i].as_py() for c in columns})
                held = made if held is None else held + made
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held.astype(float).tobytes()], pa.binary())], names=["sums"])

    return table.select(*columns).mapInArrow(run, "sums binary")


def _added(table: DataFrame, column: str, size: int, rows: int) -> np.ndarray:
    """The sum over at most ``rows`` rows of a column of packed numbers; the driver adds up a few, else numbers meet by a shuffle."""
    if 8 * size * rows <= SUMS_BYTES:
        out = np.zeros(size)
        for x in sorted(table.select(column).toArrow().column(0).to_pylist()):
            out += np.frombuffer(x)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size)
        for batch in batches:
            for x in batch.column(0):
                held += np.frombuffer(x.as_py())
        full = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(held[full])], names=["at", "v"])

    rows = table.select(column).mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size)
    out[rows.column("at").to_numpy()] = rows.column("v").to_numpy()
    return out


@dataclass
class DualLogistic:
    """An estimator for ``(id, features, label)`` tables; ``fit`` returns Spark's logistic regression model.

    The objective is the sum of log losses times ``C`` plus half the squared weights: over all classes, or over the one
    weight vector that two classes need. ``gap`` is the mean duality gap at which the search ended; ``tol`` bounds it and the
    mean intercept gradient; ``max_iter`` bounds the rounds, ``epochs`` the steps per row and round. Models of at most
    ``newton_width`` weights take Newton steps. Models above ``MODEL_BYTES`` are left to Spark's own solver.
    """

    C: float = 1.0
    tol: float = 1e-4
    max_iter: int = 1000
    epochs: int = 50
    block_entries: int = BLOCK_ENTRIES
    id_col: str = "id"
    newton_width: int = NEWTON_WIDTH
    gap: float | None = None
    rounds: int = 0
    blocks: int = 0

    def fit(self, df: DataFrame) -> LogisticRegressionModel:
        table, self.blocks, n, features, classes = make_blocks(df, self.id_col, "features", "label", self.block_entries)
        free = classes if classes > 2 else 1
        if 8 * features * free > MODEL_BYTES:
            return LogisticRegression(family="multinomial" if classes > 2 else "binomial", maxIter=self.max_iter, tol=self.tol, regParam=1.0 / (self.C * n), standardization=False).fit(df)
        scale = 1.0 / self.C  # the penalty times the number of rows
        if (features + 1) * free <= self.newton_width:
            weights = self._newton_fit(table, n, features, classes, free, scale)
            return logistic_model(df, weights[:-1], weights[-1], classes)
        if self.blocks > 1:
            return logistic_model(df, *self._quasi_newton_fit(table, n, features, classes, free, scale), classes)
        weights, intercepts = np.zeros((features, free)), np.zeros(free)
        for number in range(max(2, self.max_iter)):
            table = _round(table, weights, intercepts, number, scale, 1, 1.0, classes, self.epochs, self.tol)
            cuts = np.cumsum([1, free, free * free, free])
            gap, gradient, hessian, shift, delta = np.split(_added(table, "sums", cuts[-1] + features * free, self.blocks), cuts)
            self.gap, self.rounds = float(gap[0]) / n, number
            if number and self.gap <= self.tol and np.abs(gradient).max() <= self.tol * n:
                break
            weights = weights + delta.reshape(features, free)
            intercepts = intercepts + shift
        return logistic_model(df, weights, intercepts, classes)

    def _newton_fit(self, table: DataFrame, n: int, features: int, classes: int, free: int, scale: float) -> np.ndarray:
        """Weights with the intercepts as the last row; a step that raises the objective is halved."""
        size, last, before, step = (features + 1) * free, math.inf, np.zeros((features + 1, free)), None
        penalty = np.tile(np.append(np.full(features, scale), 0.0), free)
        weights = before
        for number in range(max(2, self.max_iter)):
            sums = _added(_curvatures(table, weights, classes), "sums", 2 + size + size * size, self.blocks)
            loss, entropy, gradient, hessian = sums[0], sums[1], sums[2:2 + size], sums[2 + size:].reshape(size, size)
            flat = weights.T.ravel()
            value = loss + 0.5 * float(penalty @ flat ** 2)
            if value > last + 1e-12 * abs(last) and np.abs(step).max() > 1e-9:
                step = step / 2
                weights = before + step
                continue
            pulled = gradient.reshape(free, -1)
            self.gap, self.rounds = max(0.0, value - entropy + float((pulled[:, :-1] ** 2).sum()) / (2 * scale)) / n, number
            if self.gap <= self.tol and np.abs(pulled[:, -1]).max() <= self.tol * n:
                break
            curve = hessian + np.diag(penalty) + 1e-9 * max(np.trace(hessian) / size, LEAST) * np.eye(size)
            step = -np.linalg.solve(curve, gradient + penalty * flat).reshape(free, -1).T
            before, last, weights = weights, value, weights + step
        return weights

    def _quasi_newton_fit(self, table: DataFrame, n: int, features: int, classes: int, free: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
        """Limited-memory steps over several blocks: a pass adds up gradients, blocks stay as they are. The steps start from the
        bound on the Hessian's diagonal; the gap is that of the predictions taken as duals."""
        size, pairs = features * free, []
        bound = np.append(np.repeat(scale + 0.25 * _added(_squares(table, features), "sums", features, self.blocks), free), np.full(free, 0.25 * n))

        def held(x: np.ndarray) -> tuple[float, np.ndarray, float]:
            sums = _added(_slopes(table, x[:size].reshape(features, free), x[size:], classes), "sums", 2 + free + size, self.blocks)
            value, pulled = sums[0] + 0.5 * scale * float(x[:size] @ x[:size]), sums[2 + free:]
            return value, np.append(pulled + scale * x[:size], sums[2:2 + free]), max(0.0, value - sums[1] + float(pulled @ pulled) / (2 * scale)) / n

        x = np.zeros(size + free)
        value, slope, self.gap = held(x)
        for self.rounds in range(max(2, self.max_iter)):
            if self.gap <= self.tol and np.abs(slope[size:]).max() <= self.tol * n:
                break
            step, used = -slope, []
            for moved, turned in reversed(pairs):
                used.append(float(moved @ step) / float(moved @ turned))
                step = step - used[-1] * turned
            step = step / bound
            if pairs:
                moved, turned = pairs[-1]
                step *= float(moved @ turned) / float(turned @ (turned / bound))
            for (moved, turned), a in zip(pairs, reversed(used)):
                step = step + (a - float(turned @ step) / float(moved @ turned)) * moved
            while True:
                there, after, gap = held(x + step)
                if there <= value + 1e-4 * float(slope @ step) or np.abs(step).max() < 1e-12:
                    break
                step = step / 2
            if float(step @ (after - slope)) > 0:
                pairs = [*pairs, (step, after - slope)][-MEMORY:]
            x, value, slope, self.gap = x + step, there, after, gap
        return x[:size].reshape(features, free), x[size:]


def logistic_model(df: DataFrame, weights: np.ndarray, intercepts: np.ndarray, classes: int) -> LogisticRegressionModel:
    """Weights as a model of Spark ML, to be applied, saved and loaded like a fitted one."""
    from pyspark.ml.common import _py2java

    sc, free = df.sparkSession.sparkContext, weights.shape[1]
    matrix = DenseMatrix(free, len(weights), weights.T.ravel().tolist(), isTransposed=True)
    java = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        f"DualLogistic_{uuid.uuid4().hex[:12]}", _py2java(sc, matrix), _py2java(sc, DenseVector(intercepts)), classes, classes > 2)
    return LogisticRegressionModel(java)
