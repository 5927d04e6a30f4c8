"""Clustering analysis: K-means with silhouette, exact silhouette, DBSCAN."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ticketloom.functions.sparse import Rows, slack, vector_parts
from ticketloom.functions.vectors import as_vector, width_of
from ticketloom.operators.decompose import truncated_svd
from ticketloom.operators.neighbours import BLOCK_ROWS, POINT_ROWS, QUERY_ROWS, Distances, block_join, build_cells, route, tile_rows
from ticketloom.session import settle_table

COMPONENT_LIMIT = 50
FEASIBLE_SILHOUETTE = 0.3
DBSCAN_EPS = 0.5
DBSCAN_MIN_SAMPLES = 5
EDGE_DIGITS = 9


def reduce_for_clustering(df: DataFrame, id_col: str, features: str = "features") -> DataFrame:
    """``(id, features)`` as vectors, by PCA to 50 components where there are more."""
    source = as_vector(df.select(id_col, F.col(features).alias("features")), "features")
    if width_of(source, "features") <= COMPONENT_LIMIT:
        return source
    axes = truncated_svd(source, "features", COMPONENT_LIMIT, centre=True)
    return source.select(id_col, axes.project(source, "features").alias("features"))


def silhouette_by_row(df: DataFrame, id_col: str, cluster: str, features: str = "features", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(id, cluster, silhouette)`` with Euclidean distances.

    Needs every pair of distances by definition. Rows are cut into blocks and each pair of
    blocks is reduced in place to one distance sum per row and cluster; no pair leaves its
    task. For tables too large for that use the squared form in :func:`mean_silhouette`.
    """
    rows = df.select(F.col(id_col).alias("_id"), F.col(cluster).alias("_c"), vector_parts(df, features).alias("_x"))
    facts = {r["_c"]: r for r in rows.groupBy("_c").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("_x.values")).alias("w")).collect()}
    sizes = {name: r["n"] for name, r in facts.items()}
    n = sum(sizes.values())
    blocks = max(1, -(-n // tile_rows(n, sum(r["w"] for r in facts.values()) / max(n, 1), block_rows)))
    block = F.pmod(F.xxhash64("_id"), F.lit(blocks).cast("bigint")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = rows.withColumn("_qb", block).withColumn("_pb", every)
    right = rows.withColumn("_pb", block).withColumn("_qb", every)
    id_type, c_type = df.schema[id_col].dataType, df.schema[cluster].dataType
    schema = T.StructType([T.StructField("_id", id_type), T.StructField("_c", c_type), T.StructField("_o", c_type), T.StructField("_sum", T.DoubleType())])

    kinds = to_arrow_schema(schema)

    def sums(queries: pa.Table, points: pa.Table) -> pa.Table:
        if not queries.num_rows or not points.num_rows:
            return kinds.empty_table()
        q, p, out = Rows.of(queries.column("_x")), Rows.of(points.column("_x")), []
        names = points.column("_c").to_pylist()
        for other in sorted(set(names)):
            mine, total = np.flatnonzero([n == other for n in names]), np.zeros(len(q))
            near = Distances(q, p.take(mine))
            for j in range(0, len(mine), POINT_ROWS):
                for i in range(0, len(q), QUERY_ROWS):
                    square = near.squares(np.arange(i, min(i + QUERY_ROWS, len(q))), np.arange(j, min(j + POINT_ROWS, len(mine))))
                    total[i:i + QUERY_ROWS] += np.sqrt(np.maximum(square, 0.0, out=square), out=square).sum(1)
            out.append(pa.table({"_id": queries.column("_id"), "_c": queries.column("_c"), "_o": [other] * len(q), "_sum": total}).cast(kinds))
        return pa.concat_tables(out)

    parts = left.groupBy("_qb", "_pb").cogroup(right.groupBy("_qb", "_pb")).applyInArrow(sums, schema)
    count = F.lit(None).cast("double")
    for name, n in sizes.items():
        count = F.when(F.col("_o") == F.lit(name), F.lit(float(n))).otherwise(count)
    totals = parts.groupBy("_id", "_c", "_o").agg(F.sum("_sum").alias("_sum")).withColumn("_n", count)
    own = F.col("_c") == F.col("_o")
    scores = totals.groupBy("_id", "_c").agg(
        F.max(F.when(own, F.col("_sum") / F.nullif(F.col("_n") - 1, F.lit(0.0)))).alias("_a"),
        F.max(F.when(own, F.col("_n"))).alias("_own"),
        F.min(F.when(~own, F.col("_sum") / F.col("_n"))).alias("_b"))
    value = F.when(F.col("_own") == 1, 0.0).otherwise(
        F.coalesce((F.col("_b") - F.col("_a")) / F.nullif(F.greatest("_a", "_b"), F.lit(0.0)), F.lit(0.0)))
    return scores.select(F.col("_id").alias(id_col), F.col("_c").alias(cluster), value.alias("silhouette"))


def mean_silhouette(df: DataFrame, id_col: str, cluster: str, features: str = "features", kind: str = "euclidean") -> float:
    """``euclidean`` is exact and quadratic; ``squared_euclidean`` is linear, another number."""
    if kind == "euclidean":
        return silhouette_by_row(df, id_col, cluster, features).agg(F.avg("silhouette").alias("s")).first()["s"]
    return ClusteringEvaluator(featuresCol=features, predictionCol=cluster, distanceMeasure="squaredEuclidean").evaluate(as_vector(df, features))


def kmeans_scores(
    df: DataFrame, id_col: str, max_clusters: int = 10, n_init: int = 10, seed: int = 42, silhouette: str = "squared_euclidean", parallelism: int = 4
) -> DataFrame:
    """``(k, silhouette)`` for k = 2.. on ``(id, features)``; best of ``n_init`` starts per k.

    The reduced table is stored once and the independent fits run side by side.
    """
    n = df.count()

    def fit(task):
        k, start = task
        model = KMeans(k=k, seed=seed + start, maxIter=100, tol=1e-4).fit(df)
        return k, model.summary.trainingCost, start, model

    tasks = [(k, s) for k in range(2, min(max_clusters + 1, n)) for s in range(n_init)]
    with ThreadPoolExecutor(parallelism) as pool:
        fits = list(pool.map(fit, tasks))
    rows = []
    for k in sorted({f[0] for f in fits}):
        best = min((f for f in fits if f[0] == k), key=lambda f: (f[1], f[2]))[3]
        labelled = best.transform(df)
        kinds = labelled.select("prediction").distinct().count()
        rows.append((k, float(mean_silhouette(labelled, id_col, "prediction", kind=silhouette)) if kinds > 1 else 0.0))
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double")


def _close(near: Distances, mine: np.ndarray, theirs: np.ndarray, eps: float) -> np.ndarray:
    """Which pairs lie within eps, as a table of truth values; the band around eps is checked to 9 digits."""
    square = near.squares(mine, theirs)
    inside = square <= max(eps - near.off, 0.0) ** 2 if eps >= near.off else np.zeros(square.shape, bool)
    row, col = np.divmod(np.flatnonzero((square <= (eps + near.off) ** 2) & ~inside), len(theirs))
    inside[row, col] = near.q.fine(mine[row], near.p, theirs[col], EDGE_DIGITS) <= eps
    return inside


def _tied(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` after tying codes ``a`` and ``b`` pair by pair: the least code each code is tied to."""
    while (differ := root[a] != root[b]).any():
        a, b = a[differ], b[differ]
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        new = np.arange(len(root))
        np.minimum.at(new, high, low)
        while (new != new[new]).any():
            new = new[new]
        root = new[root]
    return root


def dbscan(
    df: DataFrame, id_col: str, features: str = "features", eps: float = DBSCAN_EPS, min_samples: int = DBSCAN_MIN_SAMPLES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(id, cluster, is_core)``; cluster is the smallest core id of the component, null for noise.

    Copies of a vector are counted, not compared. Rows are placed in cells once; a first join of blocks returns one count
    per row and block, a second one the links: a star per part of the core rows of a block, never its pairs, and the core
    rows near a border row, fewer than ``min_samples``. Stars are contracted to components. A border row joins the
    reachable cluster with the smallest id.
    """
    rows = df.select(F.col(id_col).alias("_id"), vector_parts(df, features).alias("_x"))
    rows = rows.withColumn("_v", F.md5(F.to_json("_x")))
    id_type = df.schema[id_col].dataType
    distinct = rows.groupBy("_v").agg(F.min("_id").alias("_id"), F.count(F.lit(1)).alias("_w"), F.first("_x").alias("_x"))
    cells, placed = build_cells(distinct.withColumn("_g", F.lit("")), 1)
    placed = placed.drop("_dist")

    def count_close(queries: pa.Table, points: pa.Table, pairs) -> dict:
        near, weight = Distances(Rows.of(queries.column("_x")), Rows.of(points.column("_x"))), points.column("_w").to_numpy().astype(np.int64)
        held = np.zeros(queries.num_rows, np.int64)
        for mine, theirs in pairs():
            row, col = np.divmod(np.flatnonzero(_close(near, mine, theirs, eps)), len(theirs))
            np.add.at(held, mine[row], weight[theirs[col]])
        return {"_id": queries.column("_id"), "_c": pa.array(held)}

    count_schema = T.StructType([T.StructField("_id", id_type), T.StructField("_c", T.LongType())])
    visits = route(placed.select("_g", "_id", "_x"), cells, radius=eps, block_rows=block_rows)
    near = block_join(visits, placed, cells, count_close, count_schema).groupBy("_id").agg(F.sum("_c").alias("_c"))
    graded = settle_table(placed.join(near, "_id").withColumn("_core", F.col("_c") >= min_samples).drop("_c"), "dbscan-grade")
    cores = graded.filter("_core")

    def link(queries: pa.Table, points: pa.Table, pairs) -> dict:
        """Core queries: each row of a part to the least of it. Border queries: every core row they reach."""
        core = queries.column("_core").to_numpy(zero_copy_only=False)
        near = Distances(Rows.of(queries.column("_x")), Rows.of(points.column("_x")))
        ids = pa.concat_arrays([c for t in (queries, points) for c in t.column("_id").chunks])
        _, first, code = np.unique(ids.to_numpy(zero_copy_only=False), return_index=True, return_inverse=True)
        q_code, p_code = code[:len(core)], code[len(core):]
        root, edge_a, edge_b = np.arange(len(first)), [], []
        for mine, theirs in pairs():
            row, col = np.divmod(np.flatnonzero(_close(near, mine, theirs, eps)), len(theirs))
            a, b, inner = q_code[mine[row]], p_code[theirs[col]], core[mine[row]]
            edge_a.append(a[~inner])
            edge_b.append(b[~inner])
            root = _tied(root, a[inner], b[inner])
        moved = np.flatnonzero(root != np.arange(len(first)))
        a, b = np.concatenate([moved, *edge_a]), np.concatenate([root[moved], *edge_b])
        return {"_a": ids.take(pa.array(first[a])), "_b": ids.take(pa.array(first[b])), "_core": pa.array(np.arange(len(a)) < len(moved))}

    link_schema = T.StructType([T.StructField("_a", id_type), T.StructField("_b", id_type), T.StructField("_core", T.BooleanType())])
    reached = route(graded.select("_g", "_id", "_x", "_core"), cells, radius=eps, block_rows=block_rows)
    links = settle_table(block_join(reached, cores.select("_g", "_id", "_x", "_cell"), cells, link, link_schema), "dbscan-links")
    roots = connected(links.filter("_core").select("_a", "_b"))
    least = cores.select(F.col("_id").alias("_b")).join(roots.select(F.col("_a").alias("_b"), F.col("_b").alias("_root")), "_b", "left")
    least = least.select("_b", F.coalesce("_root", "_b").alias("_least"))
    border = links.filter(~F.col("_core")).join(least, "_b").groupBy(F.col("_a").alias("_id")).agg(F.min("_least").alias("cluster"))
    named = least.select(F.col("_b").alias("_id"), F.col("_least").alias("cluster")).unionByName(border)
    labels = graded.select("_id", "_v", F.col("_core").alias("is_core")).join(named, "_id", "left").drop("_id")
    return rows.join(labels, "_v").select(F.col("_id").alias(id_col), "cluster", "is_core")


def connected(edges: DataFrame) -> DataFrame:
    """``(_a, _b)``: every node that is not the least of its component, and that least node.

    Alternating star contraction: a node ties its larger neighbours to its least one, then its smaller neighbours and
    itself. Nothing is lost, the number of edges does not grow, and the rounds follow the logarithm of the table. Every
    round is stored reliably, so its plan stays short and lost executors cost one round.
    """
    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("_a", "_b").cast("decimal(38,0)")).alias("s")).first()

    def least(df: DataFrame) -> DataFrame:
        return df.groupBy("_a").agg(F.least(F.min("_b"), F.first("_a")).alias("_m"))

    current = settle_table(edges.select(F.greatest("_a", "_b").alias("_a"), F.least("_a", "_b").alias("_b")).filter("_a <> _b").distinct(), "components")
    now = state(current)
    while now["n"]:
        both = current.unionByName(current.select(F.col("_b").alias("_a"), F.col("_a").alias("_b")))
        large = both.join(least(both), "_a").filter("_b > _a").select(F.col("_b").alias("_a"), F.col("_m").alias("_b")).distinct()
        large = settle_table(large, "components")
        ends = large.groupBy("_a").agg(F.min("_b").alias("_m"))
        small = large.join(ends, "_a").filter("_b > _m").select(F.col("_b").alias("_a"), F.col("_m").alias("_b"))
        new = settle_table(small.unionByName(ends.select("_a", F.col("_m").alias("_b"))).distinct(), "components")
        before, now, current = now, state(new), new
        if before == now:
            break
    return current


def dbscan_summary(labelled: DataFrame) -> DataFrame:
    return labelled.agg(
        F.countDistinct("cluster").alias("clusters"),
        F.sum(F.col("cluster").isNull().cast("bigint")).alias("noise_points"),
        F.sum(F.col("is_core").cast("bigint")).alias("core_points"))


def clustering_analysis(
    df: DataFrame, id_col: str, features: str = "features", max_clusters: int = 10, n_init: int = 10, silhouette: str = "squared_euclidean",
    eps: float = DBSCAN_EPS, min_samples: int = DBSCAN_MIN_SAMPLES,
) -> dict:
    """K-means over a range of k by silhouette, and a DBSCAN count."""
    reduced = settle_table(reduce_for_clustering(df, id_col, features), "clustering")
    scores = [(r["k"], r["silhouette"]) for r in kmeans_scores(reduced, id_col, max_clusters, n_init, silhouette=silhouette).orderBy("k").collect()]
    best_k, best = max(scores, key=lambda s: s[1]) if scores else (2, 0.0)
    density = dbscan_summary(dbscan(reduced, id_col, eps=eps, min_samples=min_samples)).first()
    return {
        "optimal_k": best_k,
        "silhouette_scores": dict(scores),
        "best_silhouette_score": best,
        "dbscan_clusters": density["clusters"],
        "dbscan_noise_points": density["noise_points"],
        "clustering_feasible": best > FEASIBLE_SILHOUETTE,
    }
