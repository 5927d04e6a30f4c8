"""Approximate nearest neighbours: stable projections, kd-trees and a chi-square stopping test.

Vectors are projected to a few dimensions by independent normal weights; the squared projected distance of two vectors
over their squared distance is then chi-square distributed. A shallow kd-tree over the projections deals all vectors
into cells, each cell is searched by a kd-tree of its own: rows are verified in the order of their projected distance
until the next one's is so large, given the k-th best distance, that with probability ``SURE`` nothing closer is left.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketloom.llm.common import read
from ticketloom.session import settle_table

DIMENSIONS = 8  # even
SURE = 0.97
CELL_ROWS = 16_384
MAX_CELLS = 4_096
#: The cells' borders are medians of at most so many projected rows; every row is indexed.
SAMPLE_ROWS = 20_000
LEAF_ROWS = 64
QUERY_BLOCK = 8_192
FOUND = "query_id long, vec_id long, score double"


def chi_square_cdf(x: np.ndarray | float, m: int = DIMENSIONS):
    """Distribution function for an even number of degrees of freedom."""
    half = np.asarray(x, np.float64) / 2
    return 1 - np.exp(-half) * sum(half ** i / math.factorial(i) for i in range(m // 2))


def chi_square_quantile(p: float, m: int = DIMENSIONS) -> float:
    low, high = 0.0, 1e3
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, m) < p else (low, mid)
    return high


def kd_splits(points: np.ndarray, leaf_rows: int, max_leaves: int = 1 << 30) -> list[tuple[int, float]]:
    """A complete kd-tree's inner nodes, level by level: dimension and median; a row goes right if above it."""
    depth = max(0, math.ceil(math.log2(max(1, min(max_leaves, len(points) / leaf_rows)))))
    splits: list[tuple[int, float]] = []
    groups = [points]
    for _ in range(depth):
        below = []
        for g in groups:
            d = int(np.argmax(g.max(axis=0) - g.min(axis=0))) if len(g) else 0
            cut = float(np.median(g[:, d])) if len(g) else 0.0
            splits.append((d, cut))
            below += [g[g[:, d] <= cut], g[g[:, d] > cut]] if len(g) else [g, g]
        groups = below
    return splits


def kd_leaf(points: np.ndarray, splits: list[tuple[int, float]]) -> np.ndarray:
    """The leaf of each row."""
    dims, cuts = np.array([s[0] for s in splits], np.int64), np.array([s[1] for s in splits])
    node, rows = np.zeros(len(points), np.int64), np.arange(len(points))
    for _ in range((len(splits) + 1).bit_length() - 1):
        node = 2 * node + 1 + (points[rows, dims[node]] > cuts[node])
    return node - len(splits)


def box_distance(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of a point to each box."""
    return (np.maximum(np.maximum(low - q, q - high), 0) ** 2).sum(axis=1)


class LeafIndex:
    """A kd-tree over one cell: rows ordered by leaf, with the leaves' boxes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, points: np.ndarray):
        leaf = kd_leaf(points, kd_splits(points, LEAF_ROWS))
        order = np.lexsort((ids, leaf))
        self.ids, self.vectors, points, leaf = ids[order], vectors[order], points[order], leaf[order]
        self.begin = np.flatnonzero(np.concatenate([[True], leaf[1:] != leaf[:-1]]))
        self.end = np.append(self.begin[1:], len(leaf))
        self.low, self.high = np.minimum.reduceat(points, self.begin), np.maximum.reduceat(points, self.begin)

    def search(self, own: int, vector: np.ndarray, point: np.ndarray, k: int, bound: float, sure: float) -> list[tuple[float, int]]:
        """The k nearest found, closest first, equal distances by id; ``bound``: the k-th best distance so far."""
        near = box_distance(point, self.low, self.high)
        order = np.argsort(near, kind="stable")
        best: list[tuple[float, int]] = []
        at, step = 0, 2
        while at < len(order):
            if bound < math.inf and (bound == 0 or chi_square_cdf(near[order[at]] / bound ** 2) >= sure) and near[order[at]] > 0:
                break
            rows = np.concatenate([np.arange(self.begin[i], self.end[i]) for i in order[at:at + step]])
            at, step = at + step, min(2 * step, 64)
            rows = rows[self.ids[rows] != own]
            distance = np.sqrt(((self.vectors[rows] - vector) ** 2).sum(axis=1))
            close = np.flatnonzero(distance <= bound)
            if len(close) > k:
                close = close[distance[close] <= np.partition(distance[close], k - 1)[k - 1]]
            best = sorted([*best, *zip(distance[close].tolist(), self.ids[rows[close]].tolist())])[:k]
            if len(best) == k:
                bound = min(bound, best[-1][0])
        return best


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v): rows with an id and a finite vector other than zero, of any length."""
    v = F.col(embedding).cast("array<double>")
    rows = vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    return rows.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))


def _projected(rows: DataFrame, seed: int) -> DataFrame:
    """Vectors as bytes, and their projections; vectors of one width share their weights."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights: dict[int, np.ndarray] = {}
        for batch in batches:
            column = batch.column(1)
            flat, widths = column.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(column).to_numpy().astype(np.int64)
            begin = np.cumsum(widths) - widths
            p = np.empty((len(widths), DIMENSIONS))
            for width in np.unique(widths).tolist():
                if width not in weights:
                    weights[width] = np.random.default_rng(seed).normal(size=(width, DIMENSIONS))
                at = np.flatnonzero(widths == width)
                p[at] = flat[begin[at][:, None] + np.arange(width)] @ weights[width]
            v = [flat[i:i + n].tobytes() for i, n in zip(begin.tolist(), widths.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(v, pa.binary()), pa.array(list(p), pa.list_(pa.float64()))], names=["vec_id", "v", "p"])

    return rows.mapInArrow(run, "vec_id long, v binary, p array<double>")


def _with_cell(rows: DataFrame, splits: list[tuple[int, float]]) -> DataFrame:
    """``cell``: the leaf of the projection, among the leaves of the vector's width."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS)
            width = pc.binary_length(batch.column(1)).to_numpy().astype(np.int64) // 8
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(width * MAX_CELLS + kd_leaf(p, splits))], names=["vec_id", "v", "p", "cell"])

    return rows.mapInArrow(run, "vec_id long, v binary, p array<double>, cell long")


def _search(rows: DataFrame, asked: DataFrame, k: int, sure: float, blocks: int) -> DataFrame:
    """Answers of the cells' parts to what is asked of them: (cell, part, block) groups meet group by group.

    With several blocks of queries, a part of a cell is copied for those blocks only that ask for it.
    """
    if blocks > 1:
        wanted = asked.select("cell", "part", F.col("block").alias("asking")).distinct()
        rows = rows.join(wanted, ["cell", "part"]).withColumnRenamed("asking", "block")
    else:
        rows = rows.withColumn("block", F.lit(0))

    def answer(cell: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(cell) and len(queries):
            index = LeafIndex(cell["vec_id"].to_numpy(), np.stack([np.frombuffer(x) for x in cell["v"]]), np.stack(cell["p"].to_list()))
            for own, v, p, bound in zip(queries["vec_id"].tolist(), queries["v"], queries["p"], queries["bound"].tolist()):
                out += [(own, i, d) for d, i in index.search(own, np.frombuffer(v), np.asarray(p), k, bound, sure)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    keys = ["cell", "part", "block"]
    return rows.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(answer, FOUND)


def nearest(vectors: DataFrame, is_query, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding", sure: float = SURE, seed: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest other rows found, by Euclidean distance in double.

    ``is_query`` is a condition on ``vec_id``. Null ids and vectors that are null, zero, or hold null or
    non-finite components take no part. Vectors of other lengths have no distance: a query is answered by rows of its own
    length (few lengths are expected: each has up to ``MAX_CELLS`` cells). Equal distances go to the smaller id. Rows with the query's id
    count as its own; a query row that repeats is answered once, a candidate row that repeats is a candidate each time.
    With fewer than k candidates all come back. Other columns are ignored; an empty table gives an empty result.

    A first search in a part of each query's own cell bounds its k-th distance; only cells that the bound and the
    stopping test leave open are searched then. Cells hold any number of rows: they are searched in parts of bounded
    size, so many equal vectors are no hot group.
    """
    spark = vectors.sparkSession
    rows = settle_table(usable(vectors, vec_id, embedding), "ann-rows")
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = settle_table(_projected(rows, seed), "ann-projected")
    sample = rows.select("p", F.xxhash64("vec_id", F.lit(seed)).alias("h")).orderBy("h").limit(SAMPLE_ROWS).collect()
    leaf = max(1.0, CELL_ROWS * len(sample) / n)
    splits = kd_splits(np.array([r["p"] for r in sample]), leaf, MAX_CELLS)
    rows = settle_table(_with_cell(rows, splits), "ann-cells")
    boxes = [f(F.col("p")[i]).alias(f"{name}{i}") for i in range(DIMENSIONS) for name, f in (("low", F.min), ("high", F.max))]
    cells = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *boxes).orderBy("cell").collect()  # at most MAX_CELLS rows for each length
    low, high = (np.array([[c[f"{name}{i}"] for i in range(DIMENSIONS)] for c in cells]) for name in ("low", "high"))
    names, parts = [c["cell"] for c in cells], [math.ceil(c["n"] / CELL_ROWS) for c in cells]
    widths = np.array(names) // MAX_CELLS
    per_cell = F.broadcast(spark.createDataFrame(list(zip(names, parts)), "cell long, parts int"))
    rows = rows.join(per_cell, "cell").withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), F.col("parts")).cast("int"))
    queries = settle_table(rows.where(is_query(F.col("vec_id"))).select("vec_id", "v", "p", "cell").distinct(), "ann-queries")
    n_queries = queries.count()
    blocks = max(1, math.ceil(n_queries / QUERY_BLOCK))
    block = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).cast("int").alias("block")
    held = ["vec_id", "v", "p", "cell", "part", "parts"]
    first = settle_table(_search(rows.where("part = 0").select(*held), queries.select("vec_id", "v", "p", "cell", F.lit(0).alias("part"), block, F.lit(math.inf).alias("bound")), k, sure, blocks), "ann-first")
    bounds = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.max("score")).otherwise(F.lit(math.inf)).alias("bound"))
    limit = chi_square_quantile(sure)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for queries in batches:
            out = []
            for own, v, p, cell, bound in zip(queries["vec_id"], queries["v"], queries["p"], queries["cell"], queries["bound"]):
                for i in np.flatnonzero((widths == cell // MAX_CELLS) & (box_distance(np.asarray(p), low, high) <= bound * bound * limit)):
                    out += [(own, v, p, names[i], part, bound) for part in range(parts[i]) if (names[i], part) != (cell, 0)]
            yield pd.DataFrame(out, columns=["vec_id", "v", "p", "cell", "part", "bound"])

    asked = queries.join(bounds, queries["vec_id"] == bounds["query_id"], "left").select("vec_id", "v", "p", "cell", F.coalesce("bound", F.lit(math.inf)).alias("bound"))
    asked = asked.mapInPandas(route, "vec_id long, v binary, p array<double>, cell long, part int, bound double").select("vec_id", "v", "p", "cell", "part", block, "bound")
    rest = _search(rows.select(*held), settle_table(asked, "ann-asked") if blocks > 1 else asked, k, sure, blocks)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return first.union(rest).select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)
