"""Second-order histogram boosting with a softmax objective, level by level or leaf by leaf.

Values become bins by quantile cuts per feature; zeros of sparse rows are never stored, their sums are what a node's total
leaves over. A round grows one tree per class from gradients and Hessians of all classes at once, so there is no
one-against-rest. Rows lie in blocks of bounded size that follow ids and entries alone; their entries are sorted by feature
and bin once, when the blocks are made. A table of one block grows its trees in its task. Otherwise every pass adds up the
histograms of all open nodes of all classes in the blocks, tasks of some features each sum them over the blocks, and only the
best split of a node comes back. Blocks are written with new margins every ``KEPT_ROUNDS`` rounds; the trees in between are
applied where a block is read. Both ways run the same code on the same sums.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.functions.sparse import Rows, vector_parts
from ticketloom.functions.vectors import as_vector, width_of
from ticketloom.session import settle_table

#: A larger table than BLOCK_ENTRIES is cut into at most PARTS blocks, more only where these would hold over MOST_ENTRIES.
BLOCK_ENTRIES, PARTS, MOST_ENTRIES = 4_000_000, 8, 32_000_000
KEPT_ROUNDS = 8
CUT_BYTES = 128 << 20
#: Values of a feature that a block hands on for the quantiles, all of them if it has no more.
CUT_VALUES = 8192
GRADIENT_BINS = 2048
FEATURE_PARTS, NARROW, NARROW_PARTS = 64, 4096, 8
STATIC = ("block", "owner", "cell", "key", "label", "draw")
BLOCK_SCHEMA = "block long, owner binary, cell binary, key binary, label binary, draw binary, margin binary"
SUM_KINDS = {"slot": np.int32, "feature": np.int32, "bin": np.uint16, "g": np.int64, "h": np.int64, "n": np.int32}
NODE_SCHEMA = "round int, class int, node long, feature int, cut double, value double, gain double"


@dataclass(frozen=True)
class BoostRule:
    """How trees grow. ``leaves`` asks for growth by the best leaf; ``top`` and ``other`` for one-side sampling."""

    rounds: int = 100
    rate: float = 0.3
    depth: int = 6
    leaves: int | None = None
    l2: float = 1.0
    min_hessian: float = 1.0
    min_rows: int = 1
    min_gain: float = 0.0
    bins: int = 256
    top: float | None = None
    other: float | None = None
    seed: int = 42


@dataclass
class Split:
    gain: float
    feature: int
    bin: int
    left: tuple[float, float, int]


class Block:
    """Binned rows of one block; entries are sorted by feature, with a cell for each feature and bin they hold."""

    def __init__(self, row: dict, zero_bins: np.ndarray, free: int):
        self.owner, self.cell = np.frombuffer(row["owner"], np.int32), np.frombuffer(row["cell"], np.int32)
        key, self.label = np.frombuffer(row["key"], np.int64), np.frombuffer(row["label"], np.int32)
        self.draw, self.zero_bins = np.frombuffer(row["draw"], np.float64), zero_bins
        self.n, self.free = len(self.label), free
        self.margin = np.zeros((self.n, free)) if row["margin"] is None else np.frombuffer(row["margin"]).reshape(-1, free).copy()
        self.cell_feature, self.cell_bin = key // 65536, key % 65536
        self.begin = np.searchsorted(self.cell, np.arange(len(key) + 1))  # the entries of cell c are begin[c] to begin[c + 1]

    def derivatives(self, classes: int) -> tuple[np.ndarray, np.ndarray, float]:
        z = self.margin if self.free == classes else np.concatenate([np.zeros((self.n, 1)), self.margin], axis=1)
        e = np.exp(z - z.max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        loss = -np.log(np.maximum(p[np.arange(self.n), self.label], 1e-300)).sum()
        y = np.zeros_like(p)
        y[np.arange(self.n), self.label] = 1
        part = slice(classes - self.free, classes)
        return (p - y)[:, part], np.maximum((2.0 if classes > 2 else 1.0) * p * (1 - p), 1e-16)[:, part], float(loss)

    def move(self, node: np.ndarray, at: int, split: Split) -> None:
        """Send the rows of a node to its children."""
        mine = node == at
        left = np.full(self.n, self.zero_bins[split.feature] <= split.bin)
        low, high = np.searchsorted(self.cell_feature, [split.feature, split.feature + 1])
        middle = low + np.searchsorted(self.cell_bin[low:high], split.bin, side="right")
        left[self.owner[self.begin[low]:self.begin[middle]]] = True
        left[self.owner[self.begin[middle]:self.begin[high]]] = False
        node[mine] = np.where(left[mine], 2 * at + 1, 2 * at + 2)

    def advance(self, steps: list[tuple[int, list[tuple[int, Split]], dict[int, float]]]) -> None:
        """Add what finished trees, as ``(class, splits, leaves)``, give to the margins."""
        for c, splits, leaves in steps:
            node, ends = np.zeros(self.n, np.int64), np.array(sorted(leaves))
            for at, s in splits:
                self.move(node, at, s)
            self.margin[:, c] += np.array([leaves[at] for at in ends.tolist()])[np.searchsorted(ends, node)]

    def histograms(self, node: np.ndarray, nodes: list[int], g: np.ndarray, h: np.ndarray, held: np.ndarray) -> np.ndarray:
        """(3, nodes, cells): sums of g, h and rows of what the entries hold."""
        slot = np.full(self.n, -1)
        if len(nodes) == 1:
            slot[(node == nodes[0]) & held] = 0
        else:
            order = np.argsort(nodes)
            at = np.array(nodes)[order]
            spot = np.minimum(np.searchsorted(at, node), len(at) - 1)
            slot = np.where((at[spot] == node) & held, order[spot], -1)
        owner, cell = self.owner, self.cell
        if not (slot >= 0).all():
            mine = np.flatnonzero(slot[owner] >= 0)
            owner, cell = owner[mine], cell[mine]
        size = len(nodes) * len(self.cell_bin)
        key = slot[owner] * len(self.cell_bin) + cell
        return np.stack([np.bincount(key, g[owner], minlength=size), np.bincount(key, h[owner], minlength=size), np.bincount(key, minlength=size)]).reshape(3, len(nodes), -1)


def best_split(feature: np.ndarray, bins: np.ndarray, sums: np.ndarray, total: tuple[float, float, int], zero_bins: np.ndarray, rule: BoostRule) -> Split | None:
    """The best split of a node from its cells, sorted by feature and bin; what they lack of ``total`` are zeros.

    Equal gains go to the smaller feature, then to the smaller bin.
    """
    if not len(feature):
        return None
    first = np.flatnonzero(np.append(True, feature[1:] != feature[:-1]))
    names = feature[first]
    rest = np.array(total)[:, None] - np.add.reduceat(sums, first, axis=1)
    feature, bins = np.append(feature, names), np.append(bins, zero_bins[names])
    sums = np.concatenate([sums, rest], axis=1)
    order = np.lexsort((bins, feature))
    feature, bins, sums = feature[order], bins[order], sums[:, order]
    run = np.cumsum(sums, axis=1)
    first = np.flatnonzero(np.append(True, feature[1:] != feature[:-1]))
    base = np.concatenate([np.zeros((3, 1)), run], axis=1)[:, first]
    left = run - np.repeat(base, np.diff(np.append(first, len(feature))), axis=1)
    right = np.array(total)[:, None] - left
    ends = np.append((feature[1:] != feature[:-1]) | (bins[1:] != bins[:-1]), True)
    enough = ends & (left[1] >= rule.min_hessian) & (right[1] >= rule.min_hessian)
    enough &= (np.rint(left[2]) >= max(rule.min_rows, 1)) & (np.rint(right[2]) >= max(rule.min_rows, 1))
    score = lambda s: s[0] ** 2 / np.maximum(s[1] + rule.l2, 1e-300)
    gain = np.where(enough, 0.5 * (score(left) + score(right) - score(total)), -np.inf)
    at = int(np.argmax(np.round(gain, 10)))
    if not gain[at] > rule.min_gain + 1e-10:
        return None
    return Split(float(gain[at]), int(feature[at]), int(bins[at]), (float(left[0, at]), float(left[1, at]), int(round(left[2, at]))))


class Trees:
    """The trees of one round while they grow, a tree per class; nodes are numbered like a heap."""

    def __init__(self, totals: list[tuple[float, float, int]], rule: BoostRule):
        self.rule = rule
        self.totals = [{0: t} for t in totals]
        self.found: list[dict[int, Split | None]] = [{} for _ in totals]
        self.used: list[set[int]] = [set() for _ in totals]

    def _children(self, c: int, at: int) -> None:
        g, h, n = self.totals[c][at]
        left = self.found[c][at].left
        self.totals[c][2 * at + 1], self.totals[c][2 * at + 2] = left, (g - left[0], h - left[1], n - left[2])

    def _wanted(self, c: int) -> list[int]:
        """Nodes whose split has to be looked for now; sets ``used`` to the splits of the tree as known."""
        rule, found, used = self.rule, self.found[c], set()
        leaves, open_nodes, unknown = 1, [0], []
        while open_nodes:
            known = [at for at in open_nodes if at in found]
            unknown += [at for at in open_nodes if at not in found]
            ready = [at for at in known if found[at] is not None]
            if rule.leaves is not None:
                ready = sorted(ready, key=lambda at: (-round(found[at].gain, 10), at))[:1] if leaves < rule.leaves else []
            if not ready:
                break
            open_nodes = [at for at in open_nodes if at in found and at not in ready] if rule.leaves is not None else []
            for at in ready:
                used.add(at)
                leaves += 1
                self._children(c, at)
                below = [2 * at + 1, 2 * at + 2]
                open_nodes += [b for b in below if (b + 1).bit_length() <= rule.depth]
        self.used[c] = used
        return unknown

    def grow(self, find: Callable[[list[tuple[int, int]]], dict[tuple[int, int], Split | None]]) -> None:
        """Passes of looking for splits, until the trees hold no node whose split is unknown."""
        while wanted := [(c, at) for c in range(len(self.totals)) for at in self._wanted(c)]:
            splits = find(wanted)
            for c, at in wanted:
                self.found[c][at] = splits.get((c, at))

    def splits(self, c: int) -> list[tuple[int, Split]]:
        return [(at, self.found[c][at]) for at in sorted(self.used[c])]

    def leaves(self, c: int) -> dict[int, float]:
        ends = {b for at in self.used[c] for b in (2 * at + 1, 2 * at + 2)} - self.used[c] or {0}
        return {at: -self.rule.rate * self.totals[c][at][0] / (self.totals[c][at][1] + self.rule.l2) for at in ends}

    def rows(self, number: int, cuts: list[np.ndarray]) -> list[tuple]:
        out = []
        for c in range(len(self.totals)):
            out += [(number, c, at, s.feature, float(cuts[s.feature][s.bin]), None, s.gain) for at, s in self.splits(c)]
            out += [(number, c, at, -1, None, float(v), None) for at, v in self.leaves(c).items()]
        return out


def _placed(block: Block, splits: list[tuple[int, Split]]) -> np.ndarray:
    """The node of every row by the splits known so far."""
    node = np.zeros(block.n, np.int64)
    for at, s in splits:
        block.move(node, at, s)
    return node


def _weights(block: Block, g: np.ndarray, number: int, least: float, share: float, rule: BoostRule) -> np.ndarray:
    """One-side sampling: rows with large gradients stay, of the others a keyed sample stands for all of them."""
    if rule.top is None:
        return np.ones(block.n)
    size = np.abs(g).sum(axis=1)
    drawn = np.modf(block.draw + (number + 1) * 0.6180339887498949)[0] * (1 - share) < rule.other
    return np.where(size >= least, 1.0, np.where(drawn, (1 - share) / rule.other, 0.0))


def _threshold(counts: np.ndarray, rule: BoostRule) -> tuple[float, float]:
    """Least size of a large gradient, by a histogram over [0, 2], and the share of rows that reach it."""
    if rule.top is None:
        return 0.0, 1.0
    above = np.cumsum(counts[::-1])[::-1]
    at = int(np.flatnonzero(above >= rule.top * counts.sum())[-1])
    return at * 2.0 / GRADIENT_BINS, min(float(above[at] / counts.sum()), 1 - 1e-9)


def _gradient_sizes(g: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum((np.abs(g).sum(axis=1) * GRADIENT_BINS / 2).astype(int), GRADIENT_BINS - 1), minlength=GRADIENT_BINS)


def _grow_block(block: Block, classes: int, cuts: list[np.ndarray], rule: BoostRule) -> tuple[list[tuple], list[float]]:
    """All rounds on a table that is one block."""
    rows, losses = [], []
    for number in range(rule.rounds):
        g, h, loss = block.derivatives(classes)
        losses.append(loss / block.n)
        w = _weights(block, g, number, *_threshold(_gradient_sizes(g), rule), rule)
        held, g, h = w > 0, g * w[:, None], h * w[:, None]
        trees = Trees([(float(g[held, c].sum()), float(h[held, c].sum()), int(held.sum())) for c in range(block.free)], rule)
        node = [np.zeros(block.n, np.int64) for _ in range(block.free)]
        moved = [set() for _ in range(block.free)]

        def find(wanted):
            out = {}
            for c in range(block.free):
                nodes = [at for k, at in wanted if k == c]
                for at in sorted({(b - 1) // 2 for b in nodes if b} - moved[c]):
                    block.move(node[c], at, trees.found[c][at])
                    moved[c].add(at)
                if nodes:
                    sums = block.histograms(node[c], nodes, g[:, c], h[:, c], held)
                    for i, at in enumerate(nodes):
                        full = np.flatnonzero(sums[2, i])
                        out[c, at] = best_split(block.cell_feature[full], block.cell_bin[full], sums[:, i, full], trees.totals[c][at], block.zero_bins, rule)
            return out

        trees.grow(find)
        rows += trees.rows(number, cuts)
        for c in range(block.free):
            block.advance([(c, trees.splits(c), trees.leaves(c))])
    losses.append(block.derivatives(classes)[2] / block.n)
    return rows, losses


def _thinned(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, rows up to each since the last) of sorted values: all of them, or ``CUT_VALUES`` at even ranks."""
    value, n = np.unique(value, return_counts=True)
    ends = np.cumsum(n)
    at = np.arange(len(value))
    if len(value) > CUT_VALUES:
        at = np.unique(np.searchsorted(ends, np.arange(1, CUT_VALUES + 1) * (ends[-1] / CUT_VALUES) - 1e-9))
    return value[at], np.diff(ends[at], prepend=0)


def _cuts(data: DataFrame, features: int, rule: BoostRule, blocks: int) -> list[np.ndarray]:
    """Upper ends of all bins but the last, per feature: quantiles of the values that are not zero, and zero.

    Blocks follow ids alone and sums are whole numbers, so the cuts do not depend on the partitioning.
    """
    shares = np.arange(1, rule.bins) / rule.bins

    def values(rows: pa.Table) -> pa.Table:
        x = Rows.of(rows.column("x")).as_sparse()
        held = np.flatnonzero(x.value != 0)
        held = held[np.lexsort((x.value[held], x.index[held]))]
        names, first = np.unique(x.index[held], return_index=True)
        parts = [_thinned(v) for v in np.split(x.value[held], first[1:])] if len(names) else []
        join = lambda arrays, kind: np.concatenate([np.zeros(0, kind), *arrays])
        return pa.table({"idx": pa.array(np.repeat(names, [len(v) for v, _ in parts]).astype(np.int32)), "v": join([v for v, _ in parts], float),
                         "n": pa.array(join([n for _, n in parts], np.int64).astype(np.int64))})

    def quantiles(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("idx", "ascending"), ("v", "ascending")])
        names, first = np.unique(rows.column("idx").to_numpy(), return_index=True)
        out, most = [], []
        for v, n in zip(np.split(rows.column("v").to_numpy(), first[1:]), np.split(rows.column("n").to_numpy(), first[1:])):
            ends = np.cumsum(n)
            out.append(np.unique(v[np.searchsorted(ends, np.ceil(shares * ends[-1] - 1e-9))]).tolist())
            most.append(float(v[-1]))
        return pa.table({"idx": pa.array(names, pa.int32()), "cuts": pa.array(out, pa.list_(pa.float64())), "most": pa.array(most, pa.float64())})

    flat = data.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), vector_parts(data, "features").alias("x"))
    found = flat.groupBy("block").applyInArrow(values, "idx int, v double, n long")
    found = found.groupBy(F.pmod("idx", F.lit(FEATURE_PARTS))).applyInArrow(quantiles, "idx int, cuts array<double>, most double")
    rows = found.toArrow()
    if rows.nbytes > CUT_BYTES:
        raise ValueError(f"cuts of {features} features take {rows.nbytes} bytes; use fewer bins")
    out = [np.zeros(1)] * features
    for j, cuts, most in zip(rows.column("idx").to_pylist(), rows.column("cuts").to_pylist(), rows.column("most").to_pylist()):
        held = np.unique(np.append(np.array(cuts), 0.0))
        held = held[held < max(most, 0.0)]
        out[j] = held if len(held) else np.zeros(1)
    return out


def _make_blocks(data: DataFrame, cuts: list[np.ndarray], blocks: int) -> DataFrame:
    """One row per block: entries by feature and bin, with a cell for each pair, rows in the order of their ids."""
    shared = data.sparkSession.sparkContext.broadcast(cuts)  # at most CUT_BYTES

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        x = Rows.of(rows.column("x")).as_sparse()
        bins = np.zeros(len(x.index), np.uint16)
        order = np.argsort(x.index, kind="stable")
        names, first = np.unique(x.index[order], return_index=True)
        for j, at in zip(names, np.split(order, first[1:])):
            bins[at] = np.searchsorted(shared.value[j], x.value[at], side="left")
        owner = np.repeat(np.arange(len(x), dtype=np.int32), np.diff(x.begin))
        order = np.lexsort((bins, x.index))
        entry = x.index[order].astype(np.int64) * 65536 + bins[order]
        fresh = np.append(True, entry[1:] != entry[:-1])[:len(entry)]
        parts = {"owner": owner[order], "cell": (np.cumsum(fresh) - 1).astype(np.int32), "key": entry[fresh], "label": rows.column("label").to_numpy().astype(np.int32),
                 "draw": rows.column("draw").to_numpy()}
        return pa.table({"block": pa.array([rows.column("block")[0].as_py()], pa.int64()), **{k: pa.array([v.tobytes()], pa.binary()) for k, v in parts.items()}})

    draw = F.pmod(F.xxhash64("id", F.lit("boost")), F.lit(1 << 30)).cast("double") / F.lit(float(1 << 30))
    flat = data.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), "id", "label", draw.alias("draw"), vector_parts(data, "features").alias("x"))
    packed = flat.repartition(blocks, "block").groupBy("block").applyInArrow(pack, "block long, owner binary, cell binary, key binary, label binary, draw binary")
    return settle_table(packed.select("*", F.lit(None).cast("binary").alias("margin")), "boost-blocks", maxRecordsPerFile=1)


@dataclass
class Booster:
    """An estimator for ``(id, features, label)`` tables with labels 0, 1, 2 ..."""

    rule: BoostRule = field(default_factory=BoostRule)
    block_entries: int = BLOCK_ENTRIES

    def fit(self, df: DataFrame) -> "BoostedModel":
        data = as_vector(df, "features").select("id", "features", F.col("label").cast("int").alias("label"))
        facts = data.agg(F.count(F.lit(1)).alias("n"), F.max("label").alias("k"), F.sum(F.size(F.unwrap_udt("features")["values"])).alias("entries")).first()
        if not facts["n"]:
            raise ValueError("no rows to fit")
        features, classes = width_of(data, "features"), max(2, facts["k"] + 1)
        blocks = 1
        if facts["entries"] > self.block_entries:
            blocks = max(min(PARTS, math.ceil(4 * facts["entries"] / self.block_entries)), math.ceil(facts["entries"] / MOST_ENTRIES))
        cuts = _cuts(data, features, self.rule, blocks)
        table = _make_blocks(data, cuts, blocks)
        free = classes if classes > 2 else 1
        zero_bins = np.array([np.searchsorted(c, 0.0, side="left") for c in cuts], np.int64)
        grow = self._one_block if blocks == 1 else self._many_blocks
        rows, losses = grow(table, cuts, zero_bins, classes, free, facts["n"])
        return BoostedModel(rows, classes, features, losses)

    def _one_block(self, table, cuts, zero_bins, classes, free, n):
        rule, shared = self.rule, table.sparkSession.sparkContext.broadcast((cuts, zero_bins))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cuts, zero_bins = shared.value
            for batch in batches:
                for i in range(batch.num_rows):
                    block = Block({c: batch.column(c)[i].as_py() for c in (*STATIC, "margin")}, zero_bins, free)
                    rows, losses = _grow_block(block, classes, cuts, rule)
                    rows += [(j, -1, 0, -1, None, v, None) for j, v in enumerate(losses)]
                    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
                    names = [c.split()[0] for c in NODE_SCHEMA.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=names)

        rows = [tuple(r) for r in table.mapInArrow(run, NODE_SCHEMA).collect()]  # the model itself
        return [r for r in rows if r[1] >= 0], [r[5] for r in sorted(r for r in rows if r[1] < 0)]

    def _many_blocks(self, table, cuts, zero_bins, classes, free, n):
        rule, rows, losses, kept = self.rule, [], [], []
        unit = _unit(n, rule)
        for number in range(rule.rounds + 1):
            if len(kept) == KEPT_ROUNDS:
                table, kept = _settled(table, zero_bins, free, kept), []
            state = _State(table, zero_bins, classes, free, kept, number, rule, unit)
            least = None if rule.top is not None else _threshold(np.zeros(0), rule)
            loss, sizes, totals = _opening(state, least)
            losses.append(loss / n)
            if number == rule.rounds:
                break
            if least is None:
                least = _threshold(sizes, rule)
                totals = _opening(state, least)[2]
            trees = Trees(totals, rule)
            trees.grow(lambda wanted: _find(state, least, trees, wanted))  # noqa: B023
            rows += trees.rows(number, cuts)
            kept = [*kept, trees]
        return rows, losses


@dataclass
class _State:
    """The blocks before a round: stored ones and the trees that their margins lack."""

    table: DataFrame
    zero_bins: np.ndarray
    classes: int
    free: int
    kept: list[Trees]
    number: int
    rule: BoostRule
    unit: float

    def over_blocks(self, work, schema: str) -> DataFrame:
        return _over_blocks(self.table, self.zero_bins, self.free, self.kept, work, schema)


def _over_blocks(table: DataFrame, zero_bins: np.ndarray, free: int, kept: list[Trees], work, schema: str) -> DataFrame:
    shared = table.sparkSession.sparkContext.broadcast(zero_bins)
    steps = [(c, trees.splits(c), trees.leaves(c)) for trees in kept for c in range(free)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in (*STATIC, "margin")}
                block = Block(row, shared.value, free)
                block.advance(steps)
                yield from work(row, block)

    return table.mapInArrow(run, schema)


def _settled(table: DataFrame, zero_bins, free: int, kept: list[Trees]) -> DataFrame:
    """The blocks with the margins that finished trees give them."""
    def work(row, block):
        parts = [row[c] for c in STATIC[1:]] + [block.margin.tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([row["block"]], pa.int64()), *(pa.array([p], pa.binary()) for p in parts)], names=[*STATIC, "margin"])

    return settle_table(_over_blocks(table, zero_bins, free, kept, work, BLOCK_SCHEMA), "boost-blocks", maxRecordsPerFile=1)


def _opening(state: _State, least: tuple[float, float] | None) -> tuple[float, np.ndarray, list[tuple[float, float, int]]]:
    """Loss, sizes of gradients, and (once the least large gradient is known) sums of gradients per class; a row a block comes back."""
    classes, free, number, rule, unit = state.classes, state.free, state.number, state.rule, state.unit

    def work(row, block):
        g, h, loss = block.derivatives(classes)
        sizes, sums = _gradient_sizes(g) if least is None else np.zeros(0), np.zeros(0, np.int64)
        if least is not None:
            w = _weights(block, g, number, *least, rule)
            sums = np.array([[round(float(x[:, c] @ w) * unit) for x in (g, h)] + [int((w > 0).sum())] for c in range(free)], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([row["block"]], pa.int64()), pa.array([loss], pa.float64()), pa.array([sizes.astype(np.int64).tobytes()], pa.binary()), pa.array([sums.tobytes()], pa.binary())],
                                         names=["block", "loss", "sizes", "sums"])

    rows = sorted(state.over_blocks(work, "block long, loss double, sizes binary, sums binary").collect())
    sizes = sum(np.frombuffer(r["sizes"], np.int64) for r in rows)
    sums = sum(np.frombuffer(r["sums"], np.int64) for r in rows).reshape(-1, 3)
    return sum(r["loss"] for r in rows), sizes, [(g / unit, h / unit, k) for g, h, k in sums.tolist()]


def _unit(n: int, rule: BoostRule) -> float:
    """Parts of one that sums of ``n`` gradients over blocks are counted in: whole numbers add up alike in any order."""
    return 2.0 ** math.floor(61 - math.log2(max(1, n) * max(1.0, 1.0 / (rule.other or 1.0))))


def _find(state: _State, least: tuple[float, float], trees: Trees, wanted: list[tuple[int, int]]) -> dict[tuple[int, int], Split | None]:
    """The best split of every wanted node: sums by node, feature and bin of every block, added up and searched in parts of the features."""
    classes, number, rule, unit, zero_bins = state.classes, state.number, state.rule, state.unit, state.zero_bins
    known = {c: sorted((at, s) for at, s in trees.found[c].items() if s is not None) for c, _ in wanted}
    parts = NARROW_PARTS if len(zero_bins) <= NARROW else FEATURE_PARTS

    def work(row, block):
        g, h, _ = block.derivatives(classes)
        w, held = _weights(block, g, number, *least, rule), {k: [] for k in SUM_KINDS}
        for c in known:
            slots = [i for i, (k, _) in enumerate(wanted) if k == c]
            sums = block.histograms(_placed(block, known[c]), [wanted[i][1] for i in slots], g[:, c] * w, h[:, c] * w, w > 0)
            slot, cell = np.nonzero(sums[2])
            found = [np.array(slots)[slot], block.cell_feature[cell], block.cell_bin[cell], *(np.rint(s[slot, cell] * scale) for s, scale in zip(sums, (unit, unit, 1.0)))]
            for (name, kind), x in zip(SUM_KINDS.items(), found):
                held[name].append(x.astype(kind))
        held = {k: np.concatenate(v) for k, v in held.items()}
        part = held["feature"] % parts
        places = [np.flatnonzero(part == p) for p in range(parts)]
        columns = [pa.array([x[at].tobytes() for at in places], pa.binary()) for x in held.values()]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(parts), pa.int32()), *columns], names=["part", *SUM_KINDS])

    totals = [trees.totals[c][at] for c, at in wanted]

    def best(rows: pa.Table) -> pa.Table:
        x = {k: np.concatenate([np.frombuffer(b, kind) for b in rows.column(k).to_pylist()]) for k, kind in SUM_KINDS.items()}
        code = (x["slot"].astype(np.int64) * len(zero_bins) + x["feature"]) * 65536 + x["bin"]
        order = np.argsort(code, kind="stable")
        code, found = code[order], []
        first = np.flatnonzero(np.append(True, code[1:] != code[:-1])[:len(code)])
        sums = np.stack([np.add.reduceat(x[k][order].astype(np.int64), first) / scale for k, scale in (("g", unit), ("h", unit), ("n", 1.0))]) if len(first) else np.zeros((3, 0))
        slot, feature, bins = code[first] // (65536 * len(zero_bins)), code[first] // 65536 % len(zero_bins), code[first] % 65536
        ends = np.searchsorted(slot, np.arange(len(wanted) + 1))
        for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
            s = best_split(feature[a:b], bins[a:b], sums[:, a:b], totals[i], zero_bins, rule)
            if s is not None:
                found.append((i, s.gain, s.feature, s.bin, *s.left))
        kinds = [pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]
        columns = list(zip(*found)) if found else [()] * len(kinds)
        return pa.table([pa.array(x, t) for x, t in zip(columns, kinds)], names=["slot", "gain", "feature", "bin", "g", "h", "n"])

    sums = state.over_blocks(work, ", ".join(["part int", *(f"{k} binary" for k in SUM_KINDS)]))
    splits = sums.repartition(parts, "part").groupBy("part").applyInArrow(best, "slot long, gain double, feature long, bin long, g double, h double, n long")
    out: dict = {}
    for r in sorted(splits.collect(), key=lambda r: (r["feature"], r["bin"])):
        key = wanted[r["slot"]]
        if key not in out or round(r["gain"], 10) > round(out[key].gain, 10):
            out[key] = Split(r["gain"], r["feature"], r["bin"], (r["g"], r["h"], r["n"]))
    return out


@dataclass
class BoostedModel:
    """Fitted trees; ``losses`` holds the mean training loss before the first round and after every round."""

    nodes: list[tuple]
    classes: int
    features: int
    losses: list[float]

    def compiled(self) -> tuple[np.ndarray, list]:
        """(features in use, trees) with children as places in a tree's arrays."""
        used = np.array(sorted({r[3] for r in self.nodes if r[3] >= 0}), np.int64)
        spot = {f: i for i, f in enumerate(used.tolist())}
        trees: dict = {}
        for r in self.nodes:
            trees.setdefault((r[0], r[1]), []).append(r)
        out = []
        for (_, c), rows in sorted(trees.items()):
            rows = sorted(rows, key=lambda r: r[2])
            at = {r[2]: i for i, r in enumerate(rows)}
            out.append((c, np.array([spot.get(r[3], -1) for r in rows]), np.array([r[4] if r[4] is not None else 0.0 for r in rows]),
                        np.array([[at.get(2 * r[2] + 1, -1), at.get(2 * r[2] + 2, -1)] for r in rows]), np.array([r[5] if r[5] is not None else 0.0 for r in rows])))
        return used, out

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` (an array) and ``prediction``; row by row, so it serves tables and streams."""
        classes, free = self.classes, self.classes if self.classes > 2 else 1
        shared = df.sparkSession.sparkContext.broadcast(self.compiled())  # the model

        @F.arrow_udf("array<double>")
        def score(column: pa.Array) -> pa.Array:
            used, trees = shared.value
            parts = [np.zeros((0, classes))]
            for low in range(0, len(column), 1024):
                x = Rows.of(column.slice(low, 1024)).as_sparse()
                table, z = np.zeros((len(x), max(1, len(used)))), np.zeros((len(x), free))
                at = np.minimum(np.searchsorted(used, x.index), max(0, len(used) - 1)) if len(used) else np.zeros(0, int)
                hit = np.flatnonzero(used[at] == x.index) if len(used) else np.zeros(0, int)
                table[np.repeat(np.arange(len(x)), np.diff(x.begin))[hit], at[hit]] = x.value[hit]
                for c, feature, cut, below, value in trees:
                    place = np.zeros(len(x), np.int64)
                    while (inner := feature[place] >= 0).any():
                        rows = np.flatnonzero(inner)
                        p = place[rows]
                        place[rows] = below[p, (table[rows, feature[p]] > cut[p]).astype(int)]
                    z[:, c] += value[place]
                full = z if free == classes else np.concatenate([np.zeros((len(z), 1)), z], axis=1)
                e = np.exp(full - full.max(axis=1, keepdims=True)) if len(full) else full
                parts.append(e / e.sum(axis=1, keepdims=True) if len(full) else full)
            out = np.concatenate(parts)
            return pa.FixedSizeListArray.from_arrays(pa.array(out.ravel(), pa.float64()), classes).cast(pa.list_(pa.float64()))

        scored = df.withColumn("probability", score(vector_parts(df, "features")))
        return scored.withColumn("prediction", (F.array_position("probability", F.array_max("probability")) - 1).cast("double"))

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 - the name Spark's tree models use
        out = np.zeros(self.features)
        for r in self.nodes:
            if r[3] >= 0:
                out[r[3]] += r[6]
        return DenseVector(out / out.sum() if out.sum() else out)

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(self.classes, self.features, self.losses)], "classes int, features int, losses array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BoostedModel":
        facts = spark.read.parquet(f"{path}/facts").first()
        return cls([tuple(r) for r in spark.read.parquet(f"{path}/nodes").collect()], facts["classes"], facts["features"], list(facts["losses"]))
