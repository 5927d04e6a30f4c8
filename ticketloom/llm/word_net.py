"""A log-bilinear model over words, trained by noise-contrastive estimation in Spark tasks.

Every word seen ``LEAST`` times has representations of its own, as context and as target; rarer words share those of
their ending. The words are dealt into groups: the most frequent are alone in theirs, the others lie in parts of about
the root of their number, ordered by their endings. The two words before give a prediction; its products with the
groups' representations choose the group, those with the words' representations the word inside it. Both steps are
normalised exactly when a text is scored, so the probabilities of a context sum to one. Inside an ending, rare words
keep their smoothed share.

All training positions are trained on, in ``ROUNDS`` parts. In a round each task steps through its own positions from
the same parameters; what the tasks reach is averaged by an aggregate, each row by how often a task has met it.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import word_parts
from ticketloom.session import drop_scratch, scratch_path

LEAST = 32
ENDINGS = 32
SINGLES = 94
WIDTH = 24
NOISE = 32
NEAR_NOISE = 3  # in a word's own group
ROUNDS = 4
BATCH = 1024
RATE = 0.1
#: A smaller corpus is gone through repeatedly, until so many positions have been trained on.
LEAST_POSITIONS = 2_000_000
BUFFER = 1 << 18
BLOCK_ROWS = 8_192
#: Positions scored, and products held, at a time.
SCORED, CACHED = 4_096, 1 << 16
END = b""  # no word is empty
ALONE = 2 + ENDINGS + SINGLES  # rows below are groups of their own: before the text, its end, endings, frequent words


@dataclass
class Rows:
    """The rows of the model: ``words`` from row ``2 + ENDINGS`` on; ``counts``: of all rows; ``size``: of a group of several."""

    words: list[bytes]
    counts: np.ndarray
    size: int

    @property
    def groups(self) -> int:
        return ALONE + -(-max(0, len(self.counts) - ALONE) // self.size)

    def group(self, row: np.ndarray) -> np.ndarray:
        return np.where(row < ALONE, row, ALONE + (row - ALONE) // self.size)

    def places(self) -> "Places":
        return Places({END: 1} | {w: i for i, w in enumerate(self.words, 2 + ENDINGS)})


class Places(dict):
    """The row of each word; words without one of their own go by their ending."""

    def __missing__(self, word: bytes) -> int:
        return 2 + zlib.crc32(word[-2:]) % ENDINGS


def model_rows(head: dict[bytes, int], rare: dict[int, int]) -> Rows:
    """Rows from the counts of frequent words and of ``END``, and of each ending's other words."""
    ranked = sorted((w for w in head if w != END), key=lambda w: (-head[w], w))
    words = ranked[:SINGLES] + sorted(ranked[SINGLES:], key=lambda w: w[::-1])
    counts = [0, head.get(END, 0), *(rare.get(i, 0) for i in range(ENDINGS)), *(head[w] for w in words)]
    counts += [0] * (ALONE - len(counts))  # a small vocabulary leaves groups empty
    return Rows(words, np.array(counts, np.int64), max(1, math.ceil(math.sqrt(len(counts) - ALONE))))


@dataclass
class Net:
    """``table``: of each row its context's and target's representation, bias and three sums of squared gradients."""

    rows: Rows
    table: np.ndarray
    dense: dict[str, np.ndarray]
    squares: dict[str, np.ndarray] = field(default_factory=dict)
    less: np.ndarray | None = None  # log10 of each row's smoothed share among the known words

    def gains(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        """By how much a row's words are more probable here than by their share."""
        return self.log_p(a, b, c) - self.less[c]

    def log_p(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        """log10 P(row c | rows a and b before it), normalised over all rows; an ending's row stands for all its words.

        The sum over the groups is formed once for each pair of rows that occurs before some position.
        """
        out = np.empty(len(c))
        if not len(c):
            return out
        open_ = np.bincount(self.rows.group(np.arange(len(self.rows.counts))), self.rows.counts, minlength=self.rows.groups) > 0
        bias = np.where(open_, self.dense["bias"], -np.inf).astype(np.float32)
        pairs, of = np.unique(a * len(self.table) + b, return_inverse=True)
        before = [self.table[:, :WIDTH].take(x, axis=0) for x in np.divmod(pairs, len(self.table))]
        q = before[0] @ self.dense["far"] + before[1] @ self.dense["near"]
        total, group = _log_sums(q, self.dense["group"], bias), self.rows.group(c)
        for at in range(0, len(c), SCORED):
            s = slice(at, at + SCORED)
            own = np.einsum("ij,ij->i", q.take(of[s], axis=0), self.dense["group"].take(group[s], axis=0))
            out[s] = own.astype(np.float64) + bias[group[s]] - total[of[s]]
        inner = np.flatnonzero(c >= ALONE)
        inner = inner[np.argsort(_narrow(group[inner], self.rows.groups), kind="stable")]
        if len(inner):
            edges = np.flatnonzero(np.concatenate([[True], np.diff(group[inner]) != 0, [True]]))
            for i, j in zip(edges[:-1], edges[1:]):
                low = ALONE + (int(group[inner[i]]) - ALONE) * self.rows.size
                held = self.table[low:low + self.rows.size]
                targets, weights = np.ascontiguousarray(held[:, WIDTH:2 * WIDTH]), held[:, 2 * WIDTH]
                mine, place = q.take(of[inner[i:j]], axis=0), c[inner[i:j]] - low
                own = np.einsum("ij,ij->i", mine, targets.take(place, axis=0)).astype(np.float64) + weights[place]
                out[inner[i:j]] += own - _log_sums(mine, targets, weights)
        return out / math.log(10)


def _narrow(at: np.ndarray, most: int) -> np.ndarray:
    """Numbers below ``most`` in the fewest bytes, where they are sorted fastest."""
    return at.astype(np.min_scalar_type(max(most, 1)))


def _log_sums(q: np.ndarray, targets: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """log of the sum over all targets of exp(q . target + bias), a few rows at a time, so that a part stays in the cache."""
    out, columns = np.empty(len(q)), np.ascontiguousarray(targets.T)
    part = max(16, CACHED // max(1, len(targets)))
    room = np.empty((min(part, len(q)), len(targets)), np.float32)
    far = float(np.sqrt((targets * targets).sum(axis=1).max(initial=0.0)))
    for at in range(0, len(q), part):
        mine = q[at:at + part]
        z = np.matmul(mine, columns, out=room[:len(mine)])
        z += bias
        if far * float(np.sqrt((mine * mine).sum(axis=1).max())) + float(bias.max()) > 60:  # else 32-bit floats hold every exponential
            most = z.max(axis=1)
            out[at:at + part] = most + np.log(np.exp(z - most[:, None]).sum(axis=1, dtype=np.float64))
        else:
            out[at:at + part] = np.log(np.exp(z, out=z).sum(axis=1))
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In 32-bit floats, in place."""
    np.clip(x, -30, 30, out=x)
    np.exp(np.negative(x, out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _summed(of: np.ndarray, grad: np.ndarray, rows: int) -> np.ndarray:
    """``rows`` sums of the rows of ``grad``, row ``i`` in sum ``of[i]``."""
    width = grad.shape[1]
    at = (of[:, None] * width + np.arange(width)).ravel()
    return np.bincount(at, grad.ravel(), minlength=rows * width).reshape(rows, width).astype(np.float32)


def start(rows: Rows, seed: int = 11) -> Net:
    rng, n, k = np.random.default_rng(seed), len(rows.counts), rows.groups
    table = np.zeros((n, 2 * WIDTH + 4), np.float32)
    table[:, :WIDTH] = rng.normal(0, 0.3, (n, WIDTH))
    of = rows.group(np.arange(n))
    total = np.bincount(of, rows.counts, minlength=k).astype(np.float64)
    table[:, 2 * WIDTH] = np.log(np.maximum(rows.counts, 0.5) / np.maximum(total[of], 0.5))
    dense = {"far": np.eye(WIDTH) * 0.5, "near": np.eye(WIDTH), "group": np.zeros((k, WIDTH)), "bias": np.log(np.maximum(total, 0.5) / max(1.0, total.sum()))}
    dense = {name: x.astype(np.float32) for name, x in dense.items()}
    return Net(rows, table, dense, {name: np.zeros_like(x) for name, x in dense.items()})


class Trainer:
    """Steps of noise-contrastive estimation from a model's parameters; ``met`` counts how often a row was trained.

    Contexts, targets with their bias, and sums of squares lie in tables of their own, whose rows are read and written whole.
    """

    def __init__(self, net: Net, seed: int):
        self.rows = net.rows
        self.context, self.target = net.table[:, :WIDTH].copy(), net.table[:, WIDTH:2 * WIDTH + 1].copy()
        self.sums = [net.table[:, 2 * WIDTH + i].copy() for i in (1, 2, 3)]
        self.dense, self.squares = ({n: x.copy() for n, x in own.items()} for own in (net.dense, net.squares))
        self.rng, self.met, self.positions = np.random.default_rng(seed), np.zeros(len(net.table), np.float32), 0
        self.spot = np.zeros(len(net.table), np.int64)
        share = np.bincount(self.rows.group(np.arange(len(net.table))), self.rows.counts, minlength=self.rows.groups)
        self.upto = np.cumsum(share) / share.sum()
        self.log_noise = np.log(NOISE * np.maximum(share / share.sum(), 1e-12)).astype(np.float32)
        # Inside the groups: rows by their counts, drawn by one look-up in the running sum.
        counts = np.maximum(self.rows.counts[ALONE:], 0).astype(np.float64)
        self.inner = np.concatenate([[0.0], np.cumsum(counts)])
        of = np.arange(len(counts)) // self.rows.size
        total = np.bincount(of, counts) if len(counts) else np.zeros(0)
        self.log_inner = np.log(NEAR_NOISE * np.maximum(counts, 0.5) / np.maximum(total[of], 0.5)).astype(np.float32)

    def reached(self, low: int, high: int) -> np.ndarray:
        """Some rows of the model's table as they stand now."""
        return np.column_stack([self.context[low:high], self.target[low:high], *(x[low:high] for x in self.sums)])

    def _add(self, at: np.ndarray, grad: np.ndarray, table: np.ndarray, square: np.ndarray) -> None:
        """One sparse step: gradients of equal rows are added up, and scaled by the row's squares so far."""
        self.spot[at] = np.arange(len(at))
        lead = self.spot[at]  # one of the places that hold the same row
        first = lead == np.arange(len(at))
        at, grad = at[first], _summed((np.cumsum(first) - 1)[lead], grad, int(first.sum()))
        total = square[at] + np.einsum("ij,ij->i", grad, grad) / grad.shape[1]
        square[at] = total
        grad *= (RATE / np.sqrt(total + 1e-6))[:, None]
        table[at] = table.take(at, axis=0) - grad

    def step(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> None:
        w, dense, group = WIDTH, self.dense, self.rows.group(c)
        at = np.concatenate([a, b])
        before = self.context.take(at, axis=0)
        ra, rb = before[:len(a)], before[len(a):]
        q = ra @ dense["far"] + rb @ dense["near"]
        noise = np.minimum(np.searchsorted(self.upto, self.rng.random(NOISE), side="right"), len(self.upto) - 1)
        tc, tn = dense["group"].take(group, axis=0), dense["group"].take(noise, axis=0)
        up = _sigmoid(np.einsum("ij,ij->i", q, tc) + (dense["bias"] - self.log_noise)[group]) - np.float32(1)
        down = _sigmoid(q @ tn.T + (dense["bias"] - self.log_noise)[noise])
        dq = up[:, None] * tc
        dq += down @ tn
        inner = np.flatnonzero(c >= ALONE)
        if len(inner):
            own, qi = c[inner], np.ones((len(inner), w + 1), np.float32)
            qi[:, :w] = q.take(inner, axis=0)
            low = (group[inner] - ALONE) * self.rows.size
            high = np.minimum(low + self.rows.size, len(self.inner) - 1)
            ends = self.inner[low], self.inner[high]
            draw = ends[0][:, None] + self.rng.random((len(own), NEAR_NOISE)) * (ends[1] - ends[0])[:, None]
            drawn = np.clip(np.searchsorted(self.inner, draw, side="right") - 1, low[:, None], high[:, None] - 1)
            rows = np.concatenate([own[:, None], drawn + ALONE], axis=1)
            t = self.target.take(rows.ravel(), axis=0).reshape(*rows.shape, w + 1)
            g = _sigmoid(np.einsum("ijk,ik->ij", t, qi) - self.log_inner[rows - ALONE])
            g[:, 0] -= 1
            dq[inner] += np.einsum("ij,ijk->ik", g, t)[:, :w]
            self._add(rows.ravel(), (g[:, :, None] * qi[:, None, :]).reshape(-1, w + 1), self.target, self.sums[0])
        grad = {"group": _summed(group, up[:, None] * q, len(dense["group"])), "bias": np.bincount(group, up, minlength=len(dense["bias"])).astype(np.float32)}
        np.add.at(grad["group"], noise, down.T @ q)
        np.add.at(grad["bias"], noise, down.sum(axis=0))
        grad["far"], grad["near"] = ra.T @ dq, rb.T @ dq
        back = np.concatenate([dq @ dense["far"].T, dq @ dense["near"].T])
        for name, x in grad.items():
            self.squares[name] += x * x
            dense[name] -= RATE * x / np.sqrt(self.squares[name] + 1e-6)
        self._add(at, back, self.context, self.sums[1])
        self.positions += len(c)

    def train(self, texts: list[np.ndarray], passes: int) -> None:
        """All positions of the texts, each ``passes`` times, in random order."""
        a, b, c = (np.concatenate([x[i:len(x) - 2 + i] for x in texts]) for i in range(3))
        self.met += passes * np.bincount(np.concatenate([a, b, c[c >= ALONE]]), minlength=len(self.met)).astype(np.float32)
        for _ in range(passes):
            order = self.rng.permutation(len(c))
            for at in range(0, len(c), BATCH):
                s = order[at:at + BATCH]
                self.step(a[s], b[s], c[s])


def encode(docs: DataFrame, rows: Rows, text: str = "text") -> DataFrame:
    """(turn, ids): the rows of each part of a text after the two before it, dealt into the rounds."""
    places = docs.sparkSession.sparkContext.broadcast(rows.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Rows(places.value, np.zeros(0), 1).places().__getitem__
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                out = []
                for x in whole.column(0).slice(at, 128):
                    last = [0, 0]
                    for part in [*word_parts(x.as_py()), [END]]:
                        ids = np.array([*last, *map(of, part)], np.int32)
                        last = ids[-2:].tolist()
                        out.append(ids.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([zlib.crc32(x) % ROUNDS for x in out], pa.int32()), pa.array(out, pa.binary())], names=["turn", "ids"])

    return docs.select(text).mapInArrow(run, "turn int, ids binary")


def fit(docs: DataFrame, rows: Rows, text: str = "text") -> Net:
    """A model trained on all positions of ``docs``; the number of steps follows the number of tokens."""
    spark, net, total = docs.sparkSession, start(rows), int(rows.counts.sum())
    if not total:
        return net
    path = scratch_path(spark, "lm-ids")
    encode(docs, rows, text).write.parquet(path)
    ids = spark.read.schema("turn int, ids binary").parquet(path)
    passes, slots = max(1, math.ceil(LEAST_POSITIONS / total)), spark.sparkContext.defaultParallelism
    names = sorted(net.dense)
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast(net)

        def run(batches: Iterator[pa.RecordBatch], turn=turn, shared=shared) -> Iterator[pa.RecordBatch]:
            own, held, waiting, seed = None, [], 0, 0
            for batch in batches:
                for x in batch.column(0):
                    held.append(np.frombuffer(x.as_py(), np.int32).astype(np.int64))
                    waiting += len(held[-1]) - 2
                    own = own or Trainer(shared.value, zlib.crc32(x.as_py()) + turn)
                    if waiting > BUFFER:
                        own.train(held, passes)
                        held, waiting = [], 0
            if held:
                own.train(held, passes)
            if own is None:
                return
            for low in range(0, len(own.met), BLOCK_ROWS):
                met = own.met[low:low + BLOCK_ROWS, None]
                out = np.concatenate([own.reached(low, low + BLOCK_ROWS) * met, met], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([low // BLOCK_ROWS], pa.int32()), pa.array([out.tobytes()], pa.binary())], names=["block", "sums"])
            n = np.float32(own.positions)
            flat = np.concatenate([*(own.dense[x].ravel() for x in names), *(own.squares[x].ravel() for x in names)]) * n
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([np.append(flat, n).astype(np.float32).tobytes()], pa.binary())], names=["block", "sums"])

        def add(group: pd.DataFrame) -> pd.DataFrame:
            out = 0
            for x in group["sums"]:
                out = out + np.frombuffer(x, np.float32).astype(np.float64)
            return pd.DataFrame({"block": [group["block"].iloc[0]], "sums": [out.astype(np.float32).tobytes()]})

        reached = ids.where(F.col("turn") == turn).select("ids").coalesce(slots).mapInArrow(run, "block int, sums binary")
        for r in reached.groupBy("block").applyInPandas(add, "block int, sums binary").toLocalIterator():  # as large as the model
            sums = np.frombuffer(r["sums"], np.float32)
            if r["block"] < 0:
                flat, at = sums[:-1] / sums[-1], 0
                for part in (net.dense, net.squares):
                    for name in names:
                        size = part[name].size
                        part[name] = flat[at:at + size].reshape(part[name].shape).astype(np.float32)
                        at += size
                continue
            sums = sums.reshape(-1, net.table.shape[1] + 1)
            met, low = sums[:, -1] > 0, r["block"] * BLOCK_ROWS
            net.table[low:low + len(sums)][met] = sums[met, :-1] / sums[met, -1:]
        shared.unpersist()
        reached = r = None
        spark.sparkContext._jvm.System.gc()  # the files of a shuffle are deleted when the driver has collected it
    drop_scratch(spark, path)
    return net
