"""Exact nearest (or farthest) neighbours and range counts as blocked joins.

Rows are assigned to cells around pivots, some √n of them in a tree of two levels: a row goes to the nearest of the upper
pivots, then to the nearest pivot below it. From the summary of each cell (radius, smallest pivot distances) every query
gets a bound on its k-th distance, and by the triangle inequality it opens only the branches and cells that can hold a
closer row. Neighbouring cells are put together to parts, and a query travels to a part once, with one bit for each cell it
opens there, so a table is copied some ``PARTS`` times and not once for each cell. Parts and their visitors are cut at a
bounded size, so a cell holding a third of the rows is many tasks; each returns at most k rows per query, never its pairs.
Copies of one vector share one query. Sparse vectors stay sparse: distances come from norms and from the features that two
rows share.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.functions.hashing import keyed_hash
from ticketloom.functions.sparse import Rows, slack, vector_parts
from ticketloom.session import measured, settle_table

#: Pivots are broadcast: there are fewer than √n where that many would be larger than this.
PIVOT_BYTES = 64 << 20
SUMMARY_CELLS = 1_000_000
#: A table is cut into some PARTS parts, each of them a copy of the queries and, by blocks of queries, of the table; of no fewer than LEAST_ROWS rows and at most BLOCK_ROWS rows or BLOCK_BYTES bytes.
PARTS, LEAST_ROWS, BLOCK_ROWS, BLOCK_BYTES = 6, 4096, 131_072, 64 << 20
#: Distances at a time: those of so many queries to so many points.
QUERY_ROWS, POINT_ROWS = 256, 2048
DIGITS = 9
#: Branches whose cells bound a query's k-th distance, and cells an approximate search visits.
BOUND_BRANCHES, PROBES = 3, 8


def _planes(d: np.ndarray, own: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Least distance to the side of each pivot, for rows assigned to it before the query's own nearest pivot."""
    near = d[np.arange(len(d)), own]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(gap[own] > 0, (d * d - (near * near)[:, None]) / (2 * gap[own]), 0.0)


def tile_rows(n: int, width: float, most: int = BLOCK_ROWS) -> int:
    """Rows of a part of a table of ``n`` rows with ``width`` entries each: the number of parts grows only beyond their largest size."""
    return max(1, min(most, max(LEAST_ROWS, -(-n // PARTS)), int(BLOCK_BYTES // (12 * max(1.0, width)))))


@dataclass
class Cells:
    """Pivots in two levels and, per group, summaries of branches and cells."""

    tops: Rows
    leaves: Rows
    begin: np.ndarray  # the leaves of top t are begin[t] to begin[t + 1]
    depth: int
    groups: dict = field(default_factory=dict)
    width: float = 1.0  # entries of a row

    def __post_init__(self):
        self.tolerance = slack(self.leaves)
        self.top_gaps = self.tops.rough(self.tops)
        self.below = [np.arange(a, b) for a, b in zip(self.begin[:-1], self.begin[1:])]
        self.branch = [self.leaves.take(x) for x in self.below]
        self.gaps = [x.rough(x) for x in self.branch]

    @classmethod
    def around(cls, pivots: Rows, depth: int) -> "Cells":
        tops = pivots.take(np.arange(max(1, math.isqrt(len(pivots)))))
        parent = pivots.rough(tops).argmin(1)
        order = np.argsort(parent, kind="stable")
        return cls(tops, pivots.take(order), np.searchsorted(parent[order], np.arange(len(tops) + 1)), depth)

    def assign(self, x: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cell, distance to its pivot, distance to the upper pivot) of every row."""
        d = x.rough(self.tops)
        top = d.argmin(1)
        cell, dist = np.zeros(len(x), np.int64), np.zeros(len(x))
        for t in np.unique(top):
            mine = np.flatnonzero(top == t)
            below = x.take(mine).rough(self.branch[t])
            near = below.argmin(1)
            cell[mine], dist[mine] = self.begin[t] + near, below[np.arange(len(mine)), near]
        return cell, dist, d[np.arange(len(x)), top]

    def summarise(self, group: str, rows: list) -> None:
        """Take in the cell summaries ``(cell, n, near, far, top_near, top_far, small)`` of one group."""
        m, tops = len(self.leaves), len(self.tops)
        g = {"count": np.zeros(m, np.int64), "near": np.full(m, np.inf), "far": np.full(m, -np.inf), "small": np.full((m, self.depth), np.inf),
             "top_near": np.full(tops, np.inf), "top_far": np.full(tops, -np.inf)}
        for r in rows:
            c = r["_cell"]
            g["count"][c], g["near"][c], g["far"][c] = r["n"], r["near"], r["far"]
            g["small"][c, :len(r["small"])] = r["small"]
            t = int(np.searchsorted(self.begin, c, side="right")) - 1
            g["top_near"][t], g["top_far"][t] = min(g["top_near"][t], r["top_near"]), max(g["top_far"][t], r["top_far"])
        self.groups[group] = g

    def deal(self, most: int) -> None:
        """Put the cells of every group together to parts, in their order; a cell too large for one is cut into several."""
        for g in self.groups.values():
            rows, room, spans = tile_rows(int(g["count"].sum()), self.width, most), 0, []
            g["rows"], g["first"], g["cuts"] = rows, np.zeros(len(g["count"]), np.int64), np.ones(len(g["count"]), np.int64)
            for c in np.flatnonzero(g["count"]).tolist():
                n = int(g["count"][c])
                if n > rows:
                    g["first"][c], g["cuts"][c], room = len(spans), -(-n // rows), 0
                    spans += [[c, c + 1] for _ in range(g["cuts"][c])]
                    continue
                if n > room:
                    spans.append([c, c + 1])
                    room = rows
                g["first"][c], spans[-1][1], room = len(spans) - 1, c + 1, room - n
            g["spans"] = np.array(spans, np.int64).reshape(-1, 2)

    def plan(self) -> pa.Table:
        """Where every cell's rows go: ``(_g, _cell, _first, _cuts)``, at most SUMMARY_CELLS rows."""
        at = {name: np.flatnonzero(g["count"]) for name, g in self.groups.items()}
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return pa.table({
            "_g": pa.array([name for name, x in at.items() for _ in range(len(x))], pa.string()), "_cell": pa.array(join(list(at.values())), pa.int32()),
            "_first": pa.array(join([self.groups[n]["first"][x] for n, x in at.items()]), pa.int32()),
            "_cuts": pa.array(join([self.groups[n]["cuts"][x] for n, x in at.items()]), pa.int64())})

    def _bounds(self, x: Rows, group: dict, t: int, d: np.ndarray) -> np.ndarray:
        """Least possible distance from each query to a row of each cell below the upper pivot ``t``."""
        at = self.below[t]
        bound = np.maximum.reduce([d - group["far"][at], group["near"][at] - d, _planes(d, d.argmin(1), self.gaps[t]), np.zeros_like(d)])
        return np.where(group["count"][at] > 0, bound, np.inf)

    def visits(self, x: Rows, group: dict, wanted: int, farthest: bool, radius: float | None, probes: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(query, cell) of every cell a query has to visit."""
        n, tops = len(x), x.rough(self.tops)
        if farthest:
            d = x.rough(self.leaves)
            least = np.abs(d[:, :, None] - group["small"][None]).reshape(n, -1)
            least = np.where(np.isfinite(least), least, -np.inf)
            edge = -np.partition(-least, wanted - 1, axis=1)[:, wanted - 1] if least.shape[1] >= wanted else np.full(n, -np.inf)
            return np.nonzero((d + group["far"] >= edge[:, None] - self.tolerance) & (group["count"] > 0))
        held = np.isfinite(group["top_near"])
        if radius is not None:
            edge = np.full(n, float(radius))
        else:
            edge = np.full(n, np.inf)
            some = np.argsort(np.where(held, tops, np.inf), axis=1, kind="stable")[:, :BOUND_BRANCHES]
            most = [[] for _ in range(n)]
            for t in np.unique(some):
                mine = np.flatnonzero((some == t).any(axis=1))
                if held[t] and len(self.below[t]):
                    upper = (x.take(mine).rough(self.branch[t])[:, :, None] + group["small"][self.below[t]][None]).reshape(len(mine), -1)
                    keep = min(wanted, upper.shape[1])
                    for i, row in zip(mine, np.partition(upper, keep - 1, axis=1)[:, :keep]):
                        most[i].append(row)
            for i, parts in enumerate(most):
                flat = np.concatenate(parts) if parts else np.zeros(0)
                if len(flat) >= wanted:
                    edge[i] = np.partition(flat, wanted - 1)[wanted - 1]
        bound = np.maximum.reduce([tops - group["top_far"], group["top_near"] - tops, _planes(tops, tops.argmin(1), self.top_gaps), np.zeros_like(tops)])
        open_tops = (bound <= edge[:, None] + self.tolerance) & held
        queries, found, away = [], [], []
        for t in np.flatnonzero(open_tops.any(axis=0)):
            mine = np.flatnonzero(open_tops[:, t])
            part = x.take(mine)
            d = part.rough(self.branch[t])
            row, cell = np.nonzero(self._bounds(part, group, t, d) <= edge[mine][:, None] + self.tolerance)
            queries.append(mine[row])
            found.append(self.begin[t] + cell)
            away.append(d[row, cell])
        if not queries:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        query, cell, d = np.concatenate(queries), np.concatenate(found), np.concatenate(away)
        if probes is not None:  # the nearest cells, as many as hold enough rows and not fewer than asked
            order = np.lexsort((cell, d, query))
            query, cell = query[order], cell[order]
            before = np.cumsum(group["count"][cell]) - group["count"][cell]
            first = np.searchsorted(query, query)
            keep = (np.arange(len(query)) - first < probes) | (before - before[first] < wanted)
            query, cell = query[keep], cell[keep]
        return query, cell


def _pivots(points: DataFrame, wanted: int) -> Rows:
    """The first rows in hash order, each vector once; they only steer pruning."""
    rows = points.select("_x", keyed_hash("pivot", F.col("_id")).alias("_h"), "_id").orderBy("_h", "_id").limit(wanted).select("_x").toArrow()
    if not rows.num_rows:
        raise ValueError("no rows to search")
    x = Rows.of(rows.column("_x"))
    if x.matrix is not None:
        return Rows(x.width, np.unique(x.matrix, axis=0))
    seen = {(x.index[a:b].tobytes(), x.value[a:b].tobytes()): i for i, (a, b) in enumerate(zip(x.begin[:-1], x.begin[1:]))}
    return x.take(np.array(sorted(seen.values())))


def build_cells(points: DataFrame, depth: int) -> tuple[Cells, DataFrame]:
    """Choose pivots and summarise cells; ``points`` has ``_g, _id, _x``. Returns the cells and the points with ``_cell``."""
    size = points.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("_g").alias("g"), F.avg(F.size("_x.values")).alias("w")).first()
    room = int(PIVOT_BYTES // (12 * max(1.0, size["w"] or 1.0)))
    wanted = max(1, min(math.isqrt(size["n"]), room, SUMMARY_CELLS // max(1, size["g"])))
    cells = Cells.around(_pivots(points, wanted), depth)
    cells.width = float(size["w"] or 1.0)
    shared = points.sparkSession.sparkContext.broadcast(cells)  # at most some PIVOT_BYTES
    kept = [f for f in points.schema.fields]

    def assign(batches):
        for batch in batches:
            cell, dist, top = shared.value.assign(Rows.of(batch.column(batch.schema.get_field_index("_x")))) if batch.num_rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(dist, pa.float64()), pa.array(top, pa.float64())],
                                             names=[*batch.schema.names, "_cell", "_dist", "_top"])

    schema = T.StructType([*kept, T.StructField("_cell", T.IntegerType()), T.StructField("_dist", T.DoubleType()), T.StructField("_top", T.DoubleType())])
    placed = settle_table(points.mapInArrow(assign, schema), "cells")
    sizes = placed.groupBy("_g", "_cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("_dist").alias("far"), F.min("_dist").alias("near"), F.max("_top").alias("top_far"), F.min("_top").alias("top_near"))
    closest = placed.select("_g", "_cell", "_dist").withColumn(
        "_rn", F.row_number().over(W.partitionBy("_g", "_cell").orderBy("_dist"))
    ).filter(F.col("_rn") <= depth).groupBy("_g", "_cell").agg(F.sort_array(F.collect_list("_dist")).alias("small"))
    by_group: dict = {}
    for r in sizes.join(closest, ["_g", "_cell"]).collect():  # one row per group and cell, at most SUMMARY_CELLS
        by_group.setdefault(r["_g"], []).append(r)
    for name, rows in by_group.items():
        cells.summarise(name, rows)
    return cells, placed.drop("_top")


def route(
    queries: DataFrame, cells: Cells, wanted: int = 1, farthest: bool = False, radius: float | None = None, probes: int | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per query and part it visits: the columns of ``queries``, ``_part``, and ``_open`` with a bit for each cell of the part."""
    cells.deal(block_rows)
    shared = queries.sparkSession.sparkContext.broadcast(cells)

    def run(batches):
        cells = shared.value
        for whole in batches:
            for low in range(0, whole.num_rows, QUERY_ROWS):
                batch = whole.slice(low, QUERY_ROWS)
                x = Rows.of(batch.column(batch.schema.get_field_index("_x")))
                names = np.array(batch.column(batch.schema.get_field_index("_g")).to_pylist(), dtype=object)
                for name in sorted(set(names)):
                    if name in cells.groups:
                        mine, group = np.flatnonzero(names == name), cells.groups[name]
                        query, cell = cells.visits(x.take(mine), group, wanted, farthest, radius, probes)
                        opened = np.zeros((len(mine), len(group["count"])), bool)
                        opened[query, cell] = True
                        for part, (a, b) in enumerate(group["spans"].tolist()):
                            asking = np.flatnonzero(opened[:, a:b].any(axis=1))
                            if not len(asking):
                                continue
                            bits = np.packbits(opened[asking, a:b], axis=1)
                            ends = np.arange(len(asking) + 1, dtype=np.int32) * bits.shape[1]
                            bits = pa.Array.from_buffers(pa.binary(), len(asking), [None, pa.py_buffer(ends), pa.py_buffer(bits.tobytes())])
                            taken = batch.take(pa.array(mine[asking]))
                            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(np.full(len(asking), part), pa.int32()), bits], names=[*taken.schema.names, "_part", "_open"])

    return queries.mapInArrow(run, T.StructType([*queries.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_open", T.BinaryType())]))


def block_join(visits: DataFrame, placed: DataFrame, cells: Cells, work, schema: T.StructType) -> DataFrame:
    """Run ``work(queries, points, pairs)`` on Arrow tables of every part and a block of its visitors, as :func:`route` cut them.

    ``pairs()`` gives places in the two tables, ``QUERY_ROWS`` by ``POINT_ROWS`` at most, that hold all pairs of a query
    and a row of a cell it opens; all pairs of a query come before those of the next slice of queries. Where a side is empty ``work`` is not called.
    """
    spark = placed.sparkSession
    plan = measured(spark.createDataFrame(cells.plan()))
    shared = spark.sparkContext.broadcast({name: g["spans"] for name, g in cells.groups.items()})  # two numbers per part
    sizes = measured(spark.createDataFrame([(name, g["rows"]) for name, g in cells.groups.items()], "_g string, _rows int"))
    blocks = visits.groupBy("_g", "_part").agg(F.count(F.lit(1)).alias("_nq")).join(sizes, "_g")
    blocks = measured(blocks.select("_g", "_part", F.ceil(F.col("_nq") / F.col("_rows")).cast("int").alias("_qbs")))
    left = visits.join(blocks, ["_g", "_part"]).withColumn("_qb", F.pmod(F.xxhash64("_id"), F.col("_qbs").cast("bigint")).cast("int")).drop("_qbs")
    spot = F.col("_first") + F.pmod(F.xxhash64("_id"), F.col("_cuts")).cast("int")
    right = placed.join(plan, ["_g", "_cell"]).withColumn("_part", spot).drop("_first", "_cuts")
    right = right.join(blocks, ["_g", "_part"]).withColumn("_qb", F.explode(F.sequence(F.lit(0), F.col("_qbs") - 1))).drop("_qbs")
    keys = ["_g", "_part", "_qb"]
    left = left.select(*[F.col(c).alias(c) for c in left.columns])
    names = [f.name for f in schema.fields]
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(schema)

    def run(queries: pa.Table, points: pa.Table) -> pa.Table:
        if not queries.num_rows or not points.num_rows:
            return kinds.empty_table()
        points = points.sort_by([("_cell", "ascending"), ("_id", "ascending")])
        low, high = shared.value[points.column("_g")[0].as_py()][points.column("_part")[0].as_py()]
        bits = np.frombuffer(b"".join(queries.column("_open").to_pylist()), np.uint8).reshape(queries.num_rows, -1)
        opened = np.unpackbits(bits, axis=1, count=int(high - low)).astype(bool)
        held, begin = np.unique(points.column("_cell").to_numpy(), return_index=True)
        spans = list(zip((held - low).tolist(), begin.tolist(), [*begin[1:].tolist(), points.num_rows]))

        def pairs():
            for start in range(0, len(opened), QUERY_ROWS):
                part = opened[start:start + QUERY_ROWS]
                for cell, a, b in spans:
                    mine = start + np.flatnonzero(part[:, cell])
                    for at in range(a, b if len(mine) else a, POINT_ROWS):
                        yield mine, np.arange(at, min(at + POINT_ROWS, b))

        return pa.table(work(queries.drop_columns(["_open"]), points, pairs)).select(names).cast(kinds)

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


class Distances:
    """Which pairs of two tables of rows lie within a bound, by rough distances."""

    def __init__(self, q: Rows, p: Rows, farthest: bool = False):
        self.q, self.p, self.farthest, self.off = q, p, farthest, slack(q, p)
        self.dense = q.matrix is not None and p.matrix is not None and q.width == p.width
        if self.dense:  # the square of a distance is one product of longer rows
            self.left = np.column_stack([-2.0 * q.matrix, np.ones(len(q)), q.squares()])
            self.right = np.column_stack([p.matrix, p.squares(), np.ones(len(p))])

    def squares(self, mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
        """Squared distances, good to the slack; negative if the farthest are asked for."""
        if self.dense:
            out = self.left[mine] @ self.right[theirs[0]:theirs[-1] + 1].T
        else:
            out = self.q.take(mine).rough(self.p.take(theirs)) ** 2
        return np.negative(out, out=out) if self.farthest else out

    def edge(self, bound: np.ndarray | float) -> np.ndarray:
        """What :meth:`squares` reach at most where distances (negative ones if farthest) are at most ``bound``."""
        far = np.maximum(-np.minimum(bound, 0.0) - self.off, 0.0) if self.farthest else bound + self.off
        return -(far ** 2) if self.farthest else np.where(far >= 0, far ** 2, -np.inf)


def _top(k: int, farthest: bool):
    """Block work: at most ``k`` best points per query, ties by id."""

    def work(queries: pa.Table, points: pa.Table, pairs) -> dict:
        by_id = pc.sort_indices(points.column("_id")).to_numpy()
        place = np.zeros(len(by_id) + 1, np.int64)
        place[by_id], place[-1] = np.arange(len(by_id)), len(by_id)
        q, p = Rows.of(queries.column("_x")), Rows.of(points.column("_x"))
        near = Distances(q, p, farthest)
        best, found = np.full((len(q), k), np.inf), np.full((len(q), k), -1)  # distances, negative if farthest; points
        for mine, theirs in pairs():
            square, edge = near.squares(mine, theirs), best[mine, k - 1]
            fresh = np.flatnonzero(np.isinf(edge))
            if len(fresh) and len(theirs) > k:
                kth = np.partition(square[fresh], k - 1, axis=1)[:, k - 1]
                edge[fresh] = (-1 if farthest else 1) * np.sqrt(np.maximum(-kth if farthest else kth, 0.0)) + near.off
            with np.errstate(invalid="ignore"):
                limit = np.where(np.isinf(edge), np.inf, near.edge(np.where(np.isinf(edge), 0.0, edge)))
            row, col = np.divmod(np.flatnonzero(square <= limit[:, None]), len(theirs))
            if not len(row):
                continue
            d = q.fine(mine[row], p, theirs[col], DIGITS)
            touched, group = np.unique(row, return_inverse=True)
            at = mine[touched]
            group = np.append(group, np.repeat(np.arange(len(at)), k))
            d, other = np.append(-d if farthest else d, best[at]), np.append(theirs[col], found[at])
            order = np.lexsort((place[other], d, group))
            first = np.searchsorted(group[order], np.arange(len(at)))
            kept = order[first[:, None] + np.arange(k)]
            best[at], found[at] = d[kept], other[kept]
        row, col = np.nonzero(found >= 0)
        return {"_qid": queries.column("_id").take(pa.array(row)), "_id": points.column("_id").take(pa.array(found[row, col])), "_d": pa.array(np.abs(best[row, col]))}

    return work


def _shaped(df: DataFrame, id_col: str, vec_col: str, group_col: str | None) -> DataFrame:
    group = F.coalesce(F.col(group_col).cast("string"), F.lit("\0")) if group_col else F.lit("")
    out = df.select(F.col(id_col).alias("_id"), vector_parts(df, vec_col).alias("_x"), group.alias("_g"))
    if df.select(vec_col).schema[0].dataType == T.ArrayType(T.FloatType()):  # moved as they are; a task widens them
        out = out.withColumn("_x", F.col("_x").withField("values", F.col("_x.values").cast("array<float>")))
    return out.withColumn("_v", F.md5(F.to_json("_x")))


@dataclass
class NeighbourIndex:
    """Points in cells, stored once; any number of query tables, or batches of a stream, are searched in it."""

    cells: Cells
    placed: DataFrame
    depth: int

    @classmethod
    def build(cls, points: DataFrame, depth: int, id_col: str = "id", vec_col: str = "features", group_col: str | None = None) -> "NeighbourIndex":
        """``depth`` is the largest number of neighbours asked for. Of copies the first ``depth`` ids are enough."""
        place = F.row_number().over(W.partitionBy("_g", "_v").orderBy("_id"))
        first = _shaped(points, id_col, vec_col, group_col).withColumn("_rn", place).filter(F.col("_rn") <= depth).drop("_rn", "_v")
        cells, placed = build_cells(first, depth)
        return cls(cells, placed.drop("_dist"), depth)

    def search(self, queries: DataFrame, k: int, id_col: str = "id", vec_col: str = "features", group_col: str | None = None, farthest: bool = False,
               exclude_self: bool = True, block_rows: int = BLOCK_ROWS, search: str = "exact", probes: int = PROBES) -> DataFrame:
        """See :func:`neighbours`. Copies of a query vector are searched once."""
        wanted = k + 1 if exclude_self else k
        if wanted > self.depth:
            raise ValueError(f"the index serves {self.depth} neighbours, {wanted} are asked for")
        asked = _shaped(queries, id_col, vec_col, group_col)
        place = F.row_number().over(W.partitionBy("_g", "_v").orderBy("_id"))
        leads = asked.withColumn("_rn", place).filter(F.col("_rn") == 1).drop("_rn")
        visits = route(leads.select("_g", "_id", "_x"), self.cells, wanted, farthest, probes=probes if search == "approximate" else None, block_rows=block_rows)
        schema = T.StructType([T.StructField("_qid", queries.schema[id_col].dataType), T.StructField("_id", self.placed.schema["_id"].dataType), T.StructField("_d", T.DoubleType())])
        found = block_join(visits, self.placed, self.cells, _top(wanted, farthest), schema)
        by_distance = [F.desc("_d") if farthest else F.asc("_d"), F.asc("_id")]
        found = found.withColumn("_rn", F.row_number().over(W.partitionBy("_qid").orderBy(*by_distance))).filter(F.col("_rn") <= wanted)
        lists = found.groupBy("_qid").agg(F.sort_array(F.collect_list(F.struct("_rn", "_id", "_d"))).alias("_list"))
        shared = leads.select("_g", "_v", F.col("_id").alias("_qid")).join(lists, "_qid").drop("_qid")
        mine = asked.select("_g", "_v", F.col("_id").alias(id_col)).join(shared, ["_g", "_v"])
        others = F.filter("_list", lambda n: n["_id"] != F.col(id_col)) if exclude_self else F.col("_list")
        picked = mine.select(id_col, F.posexplode(F.slice(others, 1, k)).alias("_pos", "_n"))
        return picked.select(
            id_col, (F.col("_pos") + 1).alias("nn_rank"), F.col("_n._id").alias("nn_id"), F.col("_n._d").alias("distance"))


def neighbours(
    queries: DataFrame,
    points: DataFrame,
    k: int,
    id_col: str = "id",
    vec_col: str = "features",
    group_col: str | None = None,
    farthest: bool = False,
    exclude_self: bool = True,
    block_rows: int = BLOCK_ROWS,
    search: str = "exact",
    probes: int = PROBES,
) -> DataFrame:
    """``(id, nn_rank, nn_id, distance)``: the k nearest rows by Euclidean distance, ties by id.

    With ``group_col`` only rows of the query's own group count. Copies of one vector are
    searched once: the k+1 first ids per vector are enough as points, one row per vector
    as query, and a row drops itself from the shared list. ``search="approximate"`` visits only the
    ``probes`` cells whose pivots are nearest, and more where these hold too few rows; every row still gets
    k neighbours if there are that many, with their true distances.
    """
    if search not in ("exact", "approximate"):
        raise ValueError(f"unknown search: {search}")
    if search == "approximate" and farthest:
        raise ValueError("the farthest rows have no approximate search")
    index = NeighbourIndex.build(points, k + 1 if exclude_self else k, id_col, vec_col, group_col)
    return index.search(queries, k, id_col, vec_col, group_col, farthest, exclude_self, block_rows, search, probes)


def approximate_neighbours(df: DataFrame, k: int, id_col: str = "id", vec_col: str = "features", probes: int = PROBES) -> DataFrame:
    """Every row's k neighbours in the ``probes`` cells nearest to it (or all others, in a smaller table)."""
    return neighbours(df, df, k, id_col, vec_col, search="approximate", probes=probes)
