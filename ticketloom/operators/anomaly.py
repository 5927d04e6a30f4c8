"""Anomaly counts: an isolation forest and a one-class boundary."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketloom.functions.hashing import hash_unit, keyed_hash
from ticketloom.functions.vectors import as_array
from ticketloom.session import settle_table

TREES = 100
SUBSAMPLE = 256
SIGNIFICANT_SHARE = 0.05
NODE_SCHEMA = "tree int, node int, feature int, threshold double, size int, depth int"


def _deal(df: DataFrame, trees: int, subsample: int, seed: int) -> DataFrame:
    """``(tree, _id, _x)``: per tree the ``subsample`` rows with the lowest keyed hashes of (seed, tree, id).

    One rule for every size. Only ids are hashed and ranked; a hash share that leaves each tree about four times the
    rows it needs thins them out before the ranking, and is dropped if a tree ever came out short. The drawn ids, at
    most ``trees * subsample``, are then broadcast to fetch their vectors.
    """
    ids = df.select("_id").distinct()
    n = ids.count()
    share = min(1.0, 4.0 * subsample / max(n, 1))
    every = ids.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    every = every.withColumn("_h", keyed_hash(seed, F.col("tree"), F.col("_id")))
    order = W.partitionBy("tree").orderBy("_h", "_id")

    def drawn(part: DataFrame) -> DataFrame:
        return settle_table(part.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= subsample).select("tree", "_id"), "drawn")

    got = drawn(every.filter(hash_unit(F.col("_h")) < share))
    if share < 1.0 and got.count() < trees * subsample:
        got = drawn(every)
    return df.join(F.broadcast(got), "_id").select("tree", "_id", "_x")


def _grow(seed: int):
    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        """One isolation tree over a bounded subsample; children of node i are 2i+1, 2i+2."""
        pdf = pdf.sort_values("_id")
        tree, x = int(pdf["tree"].iloc[0]), np.vstack(pdf["_x"].to_numpy())
        rng = np.random.default_rng([seed, tree])
        limit = max(1, int(np.ceil(np.log2(max(len(x), 2)))))
        nodes, todo = [], [(0, np.arange(len(x)), 0)]
        while todo:
            node, index, depth = todo.pop()
            part = x[index]
            low, high = part.min(0), part.max(0)
            usable = np.flatnonzero(high > low)
            if depth >= limit or len(index) <= 1 or not len(usable):
                nodes.append((tree, node, -1, 0.0, len(index), depth))
                continue
            f = int(rng.choice(usable))
            cut = float(rng.uniform(low[f], high[f]))
            left = part[:, f] < cut
            nodes.append((tree, node, f, cut, len(index), depth))
            todo += [(2 * node + 1, index[left], depth + 1), (2 * node + 2, index[~left], depth + 1)]
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "size", "depth"])

    return grow


def _mean_path(n):
    """Average path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype="float64")
    body = 2.0 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2.0 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, body, np.where(n == 2, 1.0, 0.0))


def isolation_scores(
    df: DataFrame, id_col: str, features: str = "features", trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 42
) -> DataFrame:
    """``(id, score)``, higher is more isolated, rounded to 6 digits.

    Trees are grown in parallel, one task group each; the forest is at most
    ``trees * 2 * subsample`` nodes and is sent to the scoring tasks.
    """
    rows = as_array(df.select(F.col(id_col).alias("_id"), F.col(features).alias("_x")), "_x")
    dealt = _deal(rows, trees, subsample, seed)
    forest = dealt.groupBy("tree").applyInPandas(_grow(seed), NODE_SCHEMA).toPandas()
    built = forest[forest["node"] == 0]["size"].max()
    tables = []
    for _, t in forest.groupby("tree"):
        width = int(t["node"].max()) + 1
        feature, threshold, path = np.full(width, -1), np.zeros(width), np.zeros(width)
        at = t["node"].to_numpy()
        feature[at], threshold[at] = t["feature"], t["threshold"]
        path[at] = t["depth"].to_numpy() + _mean_path(t["size"])
        tables.append((feature, threshold, path))
    norm = float(_mean_path(built)) or 1.0

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype="float64")
        m = np.vstack(x.to_numpy())
        total, every = np.zeros(len(m)), np.arange(len(m))
        for feature, threshold, path in tables:
            node = np.zeros(len(m), dtype="int64")
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = m[every, np.maximum(f, 0)] >= threshold[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += path[node]
        return pd.Series(2.0 ** (-total / len(tables) / norm))

    return rows.select(F.col("_id").alias(id_col), F.round(score("_x"), 6).alias("score"))


def flag_by_quantile(scores: DataFrame, share: float, highest: bool = True) -> DataFrame:
    """Add ``is_anomaly`` beyond the (interpolated) quantile of ``score``.

    Scores have 6 digits, so their frequency table is bounded and the quantile exact.
    """
    table = scores.groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    at = 1.0 - share if highest else share
    edge = table.agg(F.expr(f"percentile(score, {at}, n)").alias("e")).first()["e"]
    beyond = F.col("score") > F.lit(edge) if highest else F.col("score") < F.lit(edge)
    return scores.withColumn("is_anomaly", beyond)


def boundary_scores(
    df: DataFrame, id_col: str, features: str = "features", nu: float = 0.1, gamma: float | None = None, components: int = 128,
    rounds: int = 20, seed: int = 42,
) -> DataFrame:
    """``(id, score)``: margin to a one-class boundary in random Fourier features, 6 digits.

    The Gaussian kernel is replaced by an explicit cosine map and the boundary is fitted by
    gradient steps; a step sums one vector per partition.
    """
    rows = as_array(df.select(F.col(id_col).alias("_id"), F.col(features).alias("_x")), "_x")
    rows = settle_table(rows, "boundary")
    stats = rows.select(F.size("_x").alias("d"), F.aggregate("_x", F.lit(0.0), lambda s, v: s + v).alias("s"),
                        F.aggregate("_x", F.lit(0.0), lambda s, v: s + v * v).alias("q")).agg(
        F.max("d").alias("d"), F.count(F.lit(1)).alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).first()
    cells = stats["n"] * stats["d"]
    variance = max(stats["q"] / cells - (stats["s"] / cells) ** 2, 1e-12)
    gamma = gamma or 1.0 / (stats["d"] * variance)
    rng = np.random.default_rng(seed)
    w0 = rng.normal(0.0, np.sqrt(2 * gamma), (stats["d"], components))
    b0 = rng.uniform(0, 2 * np.pi, components)
    lift = lambda m: np.sqrt(2.0 / components) * np.cos(m @ w0 + b0)
    w, n = np.zeros(components), stats["n"]

    def step(w, rho):
        def partial(batches):
            grad, short = np.zeros(components), 0
            for pdf in batches:
                z = lift(np.vstack(pdf["_x"].to_numpy()))
                inside = z @ w < rho
                grad += z[inside].sum(0)
                short += int(inside.sum())
            yield pd.DataFrame({"g": [grad.tolist()], "c": [short]})

        parts = rows.select("_x").mapInPandas(partial, "g array<double>, c long")
        entries = parts.select(F.posexplode(F.concat("g", F.array(F.col("c").cast("double")))).alias("i", "v"))
        total = np.zeros(components + 1)
        for r in entries.groupBy("i").agg(F.sum("v").alias("v")).collect():
            total[r["i"]] = r["v"]
        return total[:-1], total[-1]

    rho = 1e-9
    for t in range(1, rounds + 1):
        grad, short = step(w, rho)
        rate = 1.0 / t
        w = w - rate * (w - grad / (nu * n))
        rho = max(rho - rate * (short / (nu * n) - 1.0) * 0.5, 1e-9)

    @F.pandas_udf("double")
    def margin(x: pd.Series) -> pd.Series:
        return pd.Series(lift(np.vstack(x.to_numpy())) @ w) if len(x) else pd.Series([], dtype="float64")

    return rows.select(F.col("_id").alias(id_col), F.round(margin("_x"), 6).alias("score"))


def detect_anomalies(df: DataFrame, id_col: str, features: str = "features", contamination: float = 0.1) -> DataFrame:
    """One row: anomalies of both methods, ratio, and whether they are significant."""
    forest = flag_by_quantile(isolation_scores(df, id_col, features), contamination)
    boundary = flag_by_quantile(boundary_scores(df, id_col, features, contamination), contamination, highest=False)
    a = forest.agg(F.sum(F.col("is_anomaly").cast("bigint")).alias("a"), F.count(F.lit(1)).alias("n")).first()
    b = boundary.agg(F.sum(F.col("is_anomaly").cast("bigint")).alias("b")).first()
    ratio = a["a"] / a["n"]
    return df.sparkSession.createDataFrame(
        [(a["a"], b["b"], ratio, a["a"] > a["n"] * SIGNIFICANT_SHARE)],
        "isolation_forest_anomalies bigint, one_class_anomalies bigint, anomaly_ratio double, has_significant_anomalies boolean")
