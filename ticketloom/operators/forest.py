"""Random forest on binned sparse rows: trees are dealt out to tasks, each grown level by level from the cells its rows hold.

Spark's own forest keeps a row as one whole number per feature and a histogram of every bin for every open node, so wide
texts and deep trees cost memory and time that the rows do not ask for. Here rows keep their non-zero bins by feature, and a
level reads the features drawn for its nodes; narrow rows lie in a matrix of bytes. Every part of the forest reads all blocks
of binned rows, so the table is bounded by ``MOST_ENTRIES``; a larger one is left to Spark's own forest. Draws follow seed,
tree and ids alone, so neither the number of parts nor the cluster changes a tree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.functions.sparse import DENSE_WIDTH, Rows, spread, vector_parts
from ticketloom.functions.vectors import as_vector, width_of
from ticketloom.operators.boosting import BoostRule, _cuts
from ticketloom.session import settle_table

#: Every part holds three bytes an entry, or one a cell of a narrow table; parts and blocks are the same for every cluster.
MOST_ENTRIES, PARTS, BLOCKS = 128_000_000, 32, 16
#: Rows of a block, counted by two bytes, and the rows that make more blocks.
PIECE_ROWS, ROWS_PER_BLOCK = 65_535, 50_000
BLOCK_SCHEMA = "block long, piece int, begin binary, row binary, bin binary, label binary"
#: Nodes of a level are split together while their rows hold so many entries, and nodes times features stay below PLACES.
SLICE_ENTRIES, PLACES = 2_000_000, 1 << 24
TABLE_CELLS = 1 << 22
LEAST_GAIN = 1e-12
TREE_SCHEMA = "tree int, feature binary, cut binary, below binary, share binary, gained binary"


@dataclass(frozen=True)
class ForestRule:
    trees: int = 100
    depth: int = 15
    bins: int = 32
    seed: int = 42


@dataclass
class Binned:
    """Rows of a table in the order of blocks and ids; zeros are not stored, but narrow rows also lie in a matrix."""

    begin: np.ndarray
    index: np.ndarray
    bin: np.ndarray
    label: np.ndarray
    matrix: np.ndarray | None = None
    #: Instead of rows: (number of the first row, begin of each feature, rows, bins) of every block, by feature.
    columns: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] | None = None

    @classmethod
    def of(cls, blocks: list[dict], features: int) -> "Binned":
        """From rows of ``BLOCK_SCHEMA``."""
        blocks = sorted(blocks, key=lambda b: (b["block"], b["piece"]))
        label = [np.frombuffer(b["label"], np.int32) for b in blocks]
        starts = np.cumsum([0, *map(len, label)])[:-1].tolist()
        out = cls(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint8), np.concatenate(label))
        if features <= DENSE_WIDTH:
            out.matrix = np.concatenate([np.frombuffer(b["bin"], np.uint8).reshape(-1, features) for b in blocks])
        else:
            out.columns = [(at, np.frombuffer(b["begin"], np.int64), np.frombuffer(b["row"], np.uint16), np.frombuffer(b["bin"], np.uint8)) for at, b in zip(starts, blocks)]
        return out

    def sizes(self) -> np.ndarray:
        """Entries of every row."""
        if self.columns is not None:
            ends = [at for at, *_ in self.columns[1:]] + [len(self.label)]
            return np.concatenate([np.bincount(row, minlength=end - at) for (at, _, row, _), end in zip(self.columns, ends)])
        return np.diff(self.begin) if len(self.begin) else np.full(len(self.label), self.matrix.shape[1])

    def only(self, rows: np.ndarray) -> "Binned":
        """Without the entries of other rows; rows keep their numbers."""
        kept, columns = np.zeros(len(self.label), bool), []
        kept[rows] = True
        for at, begin, row, bins in self.columns:
            mine = kept[at + row.astype(np.int64)]
            columns.append((at, np.append(0, np.cumsum(mine))[begin], row[mine], bins[mine]))
        return Binned(self.begin, self.index, self.bin, self.label, None, columns)

    def held(self, features: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, features, bins) of what these features hold, some entries at a time."""
        for at, begin, row, bins in self.columns:
            size = begin[features + 1] - begin[features]
            for some in np.split(np.arange(len(features)), np.flatnonzero(np.diff(np.cumsum(size) // SLICE_ENTRIES)) + 1):
                group, place = spread(size[some])
                place += begin[features[some]][group]
                yield at + row[place].astype(np.int64), features[some][group], bins[place]


def _drawn(rng: np.random.Generator, nodes: int, features: int, wanted: int) -> np.ndarray:
    """(nodes, wanted): different features for every node."""
    if wanted >= features:
        return np.tile(np.arange(features), (nodes, 1))
    if features <= 16 * wanted:
        return np.sort(np.argpartition(rng.random((nodes, features), np.float32), wanted, axis=1)[:, :wanted], axis=1)
    out = np.sort(rng.integers(0, features, (nodes, wanted)), axis=1)
    while (again := np.flatnonzero((out[:, 1:] == out[:, :-1]).any(axis=1))).size:
        part = out[again]
        twice = np.concatenate([np.zeros((len(part), 1), bool), part[:, 1:] == part[:, :-1]], axis=1)
        part[twice] = rng.integers(0, features, int(twice.sum()))
        out[again] = np.sort(part, axis=1)
    return out


def _split(data: Binned, rows: np.ndarray, slot: np.ndarray, weight: np.ndarray, totals: np.ndarray, drawn: np.ndarray,
           zero_bins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per node (gain, feature, last bin to the left) by Gini impurity, and per row whether it goes left."""
    (nodes, classes), wanted, stored = totals.shape, drawn.shape[1], data.matrix is None and data.columns is None
    zero = np.arange(nodes * wanted, dtype=np.int64) * 256 + zero_bins[drawn].ravel()
    if data.matrix is None:
        place = np.full((nodes, len(zero_bins)), -1, np.int16)
        place[np.arange(nodes)[:, None], drawn] = np.arange(wanted)
    if data.matrix is not None:
        mine = np.repeat(rows, wanted)
        key = (slot[:, None] * wanted + np.arange(wanted)) * 256
        key = (key + data.matrix[rows[:, None], drawn[slot]]).ravel()
    elif stored:
        owner, at = spread(data.begin[rows + 1] - data.begin[rows])
        at += data.begin[rows][owner]
        feature, node = data.index[at], slot[owner]
        found = place[node, feature]
        hit = np.flatnonzero(found >= 0)
        mine = rows[owner[hit]]
        key = (node[hit].astype(np.int64) * wanted + found[hit]) * 256 + data.bin[at[hit]]
    else:
        slots, mine, key = np.full(len(data.label), -1, np.int32), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        slots[rows] = slot
        for who, feature, bins in data.held(np.unique(drawn)):
            node = slots[who]
            found = np.where(node >= 0, place[node, feature], -1)
            hit = np.flatnonzero(found >= 0)
            mine.append(who[hit])
            key.append((node[hit].astype(np.int64) * wanted + found[hit]) * 256 + bins[hit])
        mine, key = np.concatenate(mine), np.concatenate(key)
    span = int(max((key % 256).max(initial=0), zero_bins.max(initial=0))) + 1
    if nodes * wanted * span * classes <= 4 * len(key) + TABLE_CELLS:  # a table of all cells, else sorted ones
        spot, at_zero = key // 256 * span + key % 256, zero // 256 * span + zero % 256
        counts = np.bincount(spot * classes + data.label[mine], weight[mine], minlength=nodes * wanted * span * classes).astype(float).reshape(-1, classes)
        full = counts.any(axis=1)
        full[at_zero] = True
        cells = np.flatnonzero(full)
        counts, at_zero = counts[cells], np.searchsorted(cells, at_zero)
        cells = cells // span * 256 + cells % span
    else:
        cells, spot = np.unique(np.concatenate([key, zero]), return_inverse=True)
        counts = np.bincount(spot[:len(key)] * classes + data.label[mine], weight[mine], minlength=len(cells) * classes).astype(float).reshape(-1, classes)  # whole numbers if no entry was drawn
        at_zero = spot[len(key):]
    pair = cells // 256
    first = np.searchsorted(pair, np.arange(nodes * wanted))
    counts[at_zero] += np.repeat(totals, wanted, axis=0) - np.add.reduceat(counts, first, axis=0)  # what is not stored is zero
    left = np.cumsum(counts, axis=0)
    left -= (left[first] - counts[first])[pair]
    whole = totals[pair // wanted]
    right = whole - left
    n, a, b = whole.sum(axis=1), left.sum(axis=1), right.sum(axis=1)
    gain = ((left ** 2).sum(axis=1) / np.maximum(a, 1) + (right ** 2).sum(axis=1) / np.maximum(b, 1) - (whole ** 2).sum(axis=1) / n) / n
    gain[(a <= 0) | (b <= 0)] = -1.0
    best = np.maximum.reduceat(gain, first[::wanted])
    ties = np.flatnonzero(gain == best[pair // wanted])
    pick = ties[np.unique(pair[ties] // wanted, return_index=True)[1]]
    by, last = drawn.ravel()[pair[pick]], cells[pick] % 256
    if data.matrix is not None:
        return best, by, last, data.matrix[rows, by[slot]] <= last[slot]
    goes = zero_bins[by][slot] <= last[slot]
    if stored:
        hit = np.flatnonzero(feature == by[node])
        goes[owner[hit]] = data.bin[at[hit]] <= last[node[hit]]
        return best, by, last, goes
    left = np.zeros(len(data.label), bool)
    left[rows] = goes
    for who, feature, bins in data.held(np.unique(by)):
        node = slots[who]
        hit = np.flatnonzero((node >= 0) & (by[node] == feature))
        left[who[hit]] = bins[hit] <= last[node[hit]]
    return best, by, last, left[rows]


def grow_tree(data: Binned, cuts: list[np.ndarray], zero_bins: np.ndarray, classes: int, rule: ForestRule, tree: int) -> dict[str, np.ndarray]:
    """A tree over a bootstrap sample; nodes in the order they were opened, a right child follows its left one."""
    rng, features = np.random.default_rng([rule.seed, tree]), len(zero_bins)
    wanted = features if rule.trees == 1 else math.ceil(math.sqrt(features))
    weight = np.ones(len(data.label)) if rule.trees == 1 else rng.poisson(1.0, len(data.label)).astype(float)
    if not weight.any():
        weight[:] = 1.0
    rows = np.flatnonzero(weight)
    node = np.zeros(len(rows), np.int64)
    held = np.bincount(data.label[rows], weight[rows], minlength=classes)[None]
    feature, cut, below, counts, gained = [np.array([-1], np.int32)], [np.zeros(1)], [np.zeros(1, np.int32)], [held], np.zeros(features)
    entries = data.sizes()
    held_entries = entries.sum()
    opened, size = 0, 1  # nodes from ``opened`` on are those of this level
    for _ in range(rule.depth):
        here = counts[-1]
        open_ = np.flatnonzero((here > 0).sum(axis=1) > 1)
        keep = np.isin(node - opened, open_)
        rows, node = rows[keep], node[keep]
        order = np.argsort(node, kind="stable")
        rows, node = rows[order], node[order]
        if not len(open_):
            break
        slot = np.searchsorted(open_, node - opened)
        ends = np.cumsum(np.bincount(slot, entries[rows], minlength=len(open_)))
        if data.columns is not None:
            if 2 * ends[-1] < held_entries:
                data, held_entries = data.only(rows), ends[-1]
            ends[:] = 0  # nodes share what is read of the features
        most, low, moved = max(1, PLACES // features), 0, np.zeros(len(rows), np.int64)
        made = []
        while low < len(open_):
            done = ends[low - 1] if low else 0
            high = min(max(low + 1, int(np.searchsorted(ends, done + SLICE_ENTRIES, side="right"))), low + most, len(open_))
            a, b = np.searchsorted(slot, [low, high])
            drawn = _drawn(rng, high - low, features, wanted)
            gain, by, last, left = _split(data, rows[a:b], slot[a:b] - low, weight, here[open_[low:high]], drawn, zero_bins)
            good = gain > LEAST_GAIN
            child = size + 2 * (np.cumsum(good) - 1)
            at = opened + open_[low:high]
            made.append((at[good], by[good], last[good], child[good]))
            np.add.at(gained, by[good], gain[good] * here[open_[low:high]][good].sum(axis=1))
            moved[a:b] = np.where(good[slot[a:b] - low], child[slot[a:b] - low] + ~left, -1)
            size, low = size + 2 * int(good.sum()), high
        at, by, last, child = (np.concatenate(v) for v in zip(*made))
        feature[-1][at - opened], below[-1][at - opened] = by, child
        cut[-1][at - opened] = [cuts[f][v] for f, v in zip(by.tolist(), last.tolist())]
        opened += len(here)
        rows, node = rows[moved >= 0], moved[moved >= 0]
        if size == opened:
            break
        counts.append(np.bincount((node - opened) * classes + data.label[rows], weight[rows], minlength=(size - opened) * classes).reshape(-1, classes))
        feature.append(np.full(size - opened, -1, np.int32))
        cut.append(np.zeros(size - opened))
        below.append(np.zeros(size - opened, np.int32))
    feature, counts = np.concatenate(feature), np.concatenate(counts)
    inner = feature >= 0
    share = counts[~inner]
    return {"feature": feature, "cut": np.concatenate(cut)[inner], "below": np.concatenate(below)[inner].astype(np.int32),
            "share": (share / share.sum(axis=1, keepdims=True)).astype(np.float32), "gained": gained / (gained.sum() or 1.0)}


@dataclass
class Forest:
    """An estimator for ``(id, features, label)`` tables with labels 0, 1, 2 ..."""

    rule: ForestRule
    most_entries: int = MOST_ENTRIES
    parts: int = PARTS

    def fit(self, df: DataFrame):
        data = as_vector(df, "features").select("id", "features", F.col("label").cast("int").alias("label"))
        facts = data.agg(F.count(F.lit(1)).alias("n"), F.max("label").alias("k"), F.sum(F.size(F.unwrap_udt("features")["values"])).alias("entries")).first()
        if not facts["n"]:
            raise ValueError("no rows to fit")
        rule, features, classes = self.rule, width_of(data, "features"), max(2, facts["k"] + 1)
        if (facts["n"] * features if features <= DENSE_WIDTH else facts["entries"]) > self.most_entries:
            return RandomForestClassifier(numTrees=rule.trees, maxDepth=rule.depth, maxBins=rule.bins, seed=rule.seed).fit(as_vector(df, "features"))
        count = max(BLOCKS, math.ceil(facts["n"] / ROWS_PER_BLOCK))
        cuts = _cuts(data, features, BoostRule(bins=rule.bins), count)
        zero_bins = np.array([np.searchsorted(c, 0.0, side="left") for c in cuts], np.int64)
        shared = df.sparkSession.sparkContext.broadcast((cuts, zero_bins))  # at most CUT_BYTES

        def pack(rows: pa.Table) -> pa.Table:
            rows, (cuts, zero_bins) = rows.sort_by("id"), shared.value
            out = {c.split()[0]: [] for c in BLOCK_SCHEMA.split(", ")}
            for low in range(0, len(rows), PIECE_ROWS):
                some = rows.slice(low, PIECE_ROWS)
                x, label = Rows.of(some.column("x")).as_sparse(), some.column("label").to_numpy().astype(np.int32)
                order = np.argsort(x.index, kind="stable")
                begin = np.append(0, np.cumsum(np.bincount(x.index, minlength=features)))
                row, bins = np.repeat(np.arange(len(x)), np.diff(x.begin))[order].astype(np.uint16), np.zeros(len(order), np.uint8)
                for j in np.flatnonzero(np.diff(begin)):
                    at = slice(begin[j], begin[j + 1])
                    bins[at] = np.searchsorted(cuts[j], x.value[order[at]], side="left")
                if features <= DENSE_WIDTH:
                    matrix = np.tile(zero_bins.astype(np.uint8), (len(x), 1))
                    matrix[row, x.index[order]] = bins
                    begin, row, bins = np.zeros(0, np.int64), row[:0], matrix
                for name, v in zip(out, (some.column("block")[0].as_py(), low // PIECE_ROWS, begin.tobytes(), row.tobytes(), bins.tobytes(), label.tobytes())):
                    out[name].append(v)
            return pa.table([pa.array(v, k) for v, k in zip(out.values(), (pa.int64(), pa.int32(), *[pa.binary()] * 4))], names=list(out))

        def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (cuts, zero_bins), blocks, mine = shared.value, [], []
            for batch in batches:
                for i, part in enumerate(batch.column("part").to_pylist()):
                    mine += [] if part in mine else [part]
                    if part == mine[0]:  # a task of several parts holds the blocks once
                        blocks += batch.slice(i, 1).to_pylist()
            if not blocks:
                return
            table, numbers = Binned.of(blocks, features), [n for part in mine for n in range(part, rule.trees, parts)]
            del blocks
            for number in numbers:
                tree = grow_tree(table, cuts, zero_bins, classes, rule, number)
                columns = [pa.array([tree[c].tobytes()], pa.binary()) for c in ("feature", "cut", "below", "share", "gained")]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), *columns], names=[c.split()[0] for c in TREE_SCHEMA.split(", ")])

        parts = min(self.parts, rule.trees)
        flat = data.select(F.pmod(F.xxhash64("id"), F.lit(count)).alias("block"), "id", "label", vector_parts(data, "features").alias("x"))
        blocks = settle_table(flat.groupBy("block").applyInArrow(pack, BLOCK_SCHEMA), "forest-blocks", maxRecordsPerFile=1)
        # Each part reads all blocks, without a shuffle. A union of single partitions alone would become one partition.
        dealt = [blocks.coalesce(1).withColumn("part", F.lit(p)) for p in range(parts)] + [blocks.where("block < 0").withColumn("part", F.lit(-1))]
        grown = reduce(DataFrame.unionAll, dealt).mapInArrow(grow, TREE_SCHEMA)
        trees = settle_table(grown, "forest-trees").toLocalIterator()  # the driver's JVM holds the trees of one part at a time
        return ForestModel(sorted((tuple(bytes(v) if i else v for i, v in enumerate(r)) for r in trees), key=lambda r: r[0]), classes, features)


@dataclass
class ForestModel:
    """Grown trees as packed arrays: a split goes left up to its cut, and a leaf holds its shares of the classes."""

    trees: list[tuple]
    classes: int
    features: int

    def compiled(self) -> tuple[np.ndarray, list]:
        """(features in use, trees) with places in a table of these features; a leaf leads to itself."""
        features = [np.frombuffer(t[1], np.int32) for t in self.trees]
        used = np.unique(np.concatenate(features))
        used, out = used[used >= 0], []
        for (_, _, cut, below, share, _), feature in zip(self.trees, features):
            inner, down, ends = feature >= 0, np.arange(len(feature), dtype=np.int32), np.full(len(feature), np.inf)
            down[inner], ends[inner] = np.frombuffer(below, np.int32), np.frombuffer(cut)
            out.append((np.where(inner, np.searchsorted(used, feature), 0).astype(np.int32), ends, down, (np.cumsum(~inner) - 1).astype(np.int32), np.frombuffer(share, np.float32).reshape(-1, self.classes)))
        return used, out

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` (an array) and ``prediction``; row by row, so it serves tables and streams."""
        shared, classes = df.sparkSession.sparkContext.broadcast(self), self.classes  # the packed trees

        @F.arrow_udf("array<double>")
        def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            used, trees = shared.value.compiled()
            step = min(max(64, TABLE_CELLS // max(1, len(used))), 8192)
            for column in batches:
                parts = [np.zeros((0, classes))]
                for low in range(0, len(column), step):
                    x = Rows.of(column.slice(low, step)).as_sparse()
                    table, votes = np.zeros((len(x), len(used) + 1)), np.zeros((len(x), classes))
                    at = np.searchsorted(used, x.index)
                    hit = np.flatnonzero(np.append(used, -1)[at] == x.index)
                    row = np.arange(len(x))
                    table[np.repeat(row, np.diff(x.begin))[hit], at[hit]] = x.value[hit]
                    for feature, cut, down, leaf, share in trees:
                        place, before = np.zeros(len(x), np.int64), None
                        while before is None or (place != before).any():
                            before, place = place, down[place] + (table[row, feature[place]] > cut[place])
                        votes += share[leaf[place]]
                    parts.append(votes / np.maximum(votes.sum(axis=1, keepdims=True), 1e-300))
                out = np.concatenate(parts)
                yield pa.FixedSizeListArray.from_arrays(pa.array(out.ravel(), pa.float64()), classes).cast(pa.list_(pa.float64()))

        scored = df.withColumn("probability", score(vector_parts(df, "features")))
        return scored.withColumn("prediction", (F.array_position("probability", F.array_max("probability")) - 1).cast("double"))

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 - the name Spark's tree models use
        out = np.sum([np.frombuffer(t[5]) for t in self.trees], axis=0)
        return DenseVector(out / out.sum() if out.sum() else out)

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.trees, TREE_SCHEMA).write.mode("overwrite").parquet(f"{path}/trees")
        spark.createDataFrame([(self.classes, self.features)], "classes int, features int").coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ForestModel":
        facts = spark.read.parquet(f"{path}/facts").first()
        trees = [tuple(bytes(v) if i else v for i, v in enumerate(r)) for r in spark.read.parquet(f"{path}/trees").orderBy("tree").collect()]
        return cls(trees, facts["classes"], facts["features"])
