"""Vectors of an Arrow batch as matrices for numpy: dense rows, or compressed sparse rows that are never spread out."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import DenseVector, SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.vectors import is_vector

#: Narrower tables are dense matrices even if their vectors are stored sparse.
DENSE_WIDTH = 256
#: Products of sparse rows are added up in parts of so many terms.
PART_TERMS = 1 << 22
VECTOR_TYPE = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"


def vector_parts(df: DataFrame, column: str) -> Column:
    """A vector or array column as ``struct<type, size, indices, values>``; sparse vectors stay sparse."""
    if is_vector(df, column):
        return F.unwrap_udt(F.col(column)).cast(VECTOR_TYPE)
    values = F.col(column).cast("array<double>")
    return F.struct(F.lit(1).cast("tinyint").alias("type"), F.size(values).alias("size"), F.lit(None).cast("array<int>").alias("indices"), values.alias("values")).cast(VECTOR_TYPE)


def spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group, place in the group) of every member of groups of these sizes."""
    group = np.repeat(np.arange(len(sizes)), sizes)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


@dataclass
class Rows:
    """Some vectors: ``matrix`` if they are dense, else ``begin, index, value``."""

    width: int
    matrix: np.ndarray | None
    begin: np.ndarray | None = None
    index: np.ndarray | None = None
    value: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.matrix) if self.matrix is not None else len(self.begin) - 1

    @classmethod
    def of(cls, column: pa.Array | pa.ChunkedArray) -> "Rows":
        """From a column of :func:`vector_parts`."""
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
        kind, size, indices, values = column.flatten()
        value, held = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64), values.value_lengths().to_numpy(zero_copy_only=False)
        held = np.asarray(held, np.int64)
        dense = kind.to_numpy(zero_copy_only=False) == 1
        sizes = np.where(dense, held, np.nan_to_num(size.to_numpy(zero_copy_only=False).astype(float))).astype(np.int64)
        width = int(sizes.max()) if len(sizes) else 0
        if len(column) and dense.all() and (held == width).all():
            return cls(width, value.reshape(-1, width))
        row, place = spread(held)
        index = place.astype(np.int64)
        index[~dense[row]] = indices.filter(pa.array(~dense)).flatten().to_numpy(zero_copy_only=False)
        return cls(width, None, np.append(0, np.cumsum(held)), index, value).narrow()

    def narrow(self) -> "Rows":
        if self.matrix is not None or self.width > DENSE_WIDTH:
            return self
        matrix = np.zeros((len(self), self.width))
        matrix[np.repeat(np.arange(len(self)), np.diff(self.begin)), self.index] = self.value
        return Rows(self.width, matrix)

    def take(self, rows: np.ndarray) -> "Rows":
        if self.matrix is not None:
            return Rows(self.width, self.matrix[rows])
        size = np.diff(self.begin)[rows]
        group, place = spread(size)
        at = self.begin[rows][group] + place
        return Rows(self.width, None, np.append(0, np.cumsum(size)), self.index[at], self.value[at])

    def squares(self) -> np.ndarray:
        if self.matrix is not None:
            return (self.matrix * self.matrix).sum(1)
        row = np.repeat(np.arange(len(self)), np.diff(self.begin))
        return np.bincount(row, self.value * self.value, minlength=len(self))

    def dots(self, other: "Rows") -> np.ndarray:
        """All products of a row here and a row of ``other``; sparse ones meet in the features they share."""
        if self.matrix is not None and other.matrix is not None:
            return self.matrix @ other.matrix.T
        a, b = self.as_sparse(), other.as_sparse()
        order = np.argsort(b.index, kind="stable")
        held, first, count = np.unique(b.index[order], return_index=True, return_counts=True)
        out = np.zeros(len(a) * len(b))
        if not len(held) or not len(a.index):
            return out.reshape(len(a), len(b))
        owner = np.repeat(np.arange(len(b)), np.diff(b.begin))[order]
        row = np.repeat(np.arange(len(a)), np.diff(a.begin))
        at = np.minimum(np.searchsorted(held, a.index), len(held) - 1)
        hit = np.flatnonzero(held[at] == a.index)
        row, at, value, size = row[hit], at[hit], a.value[hit], count[at[hit]]
        cuts = np.searchsorted(np.cumsum(size), np.arange(0, size.sum(), PART_TERMS), side="left") if len(size) else []
        for low, high in zip(cuts, [*cuts[1:], len(size)]):
            group, place = spread(size[low:high])
            entry = first[at[low:high]][group] + place
            np.add.at(out, row[low:high][group] * len(b) + owner[entry], value[low:high][group] * b.value[order[entry]])
        return out.reshape(len(a), len(b))

    def as_sparse(self) -> "Rows":
        if self.matrix is None:
            return self
        row, index = np.nonzero(self.matrix)
        return Rows(self.width, None, np.append(0, np.cumsum(np.bincount(row, minlength=len(self.matrix)))), index, self.matrix[row, index])

    def rough(self, other: "Rows") -> np.ndarray:
        """All distances from norms and products: good to :func:`slack`."""
        square = self.squares()[:, None] + other.squares()[None, :] - 2.0 * self.dots(other)
        return np.sqrt(np.maximum(square, 0.0))

    def fine(self, rows: np.ndarray, other: "Rows", others: np.ndarray, digits: int) -> np.ndarray:
        """Distances of row pairs, feature by feature, rounded to the digits results are ranked by."""
        if not len(rows):
            return np.zeros(0)
        if self.matrix is not None and other.matrix is not None:
            return np.round(np.sqrt(((self.matrix[rows] - other.matrix[others]) ** 2).sum(1)), digits)
        a, b = self.as_sparse().take(rows), other.as_sparse().take(others)
        width = max(self.width, other.width, 1)
        key = np.concatenate([np.repeat(np.arange(len(x)), np.diff(x.begin)) * width + x.index for x in (a, b)])
        order = np.argsort(key, kind="stable")
        key, value = key[order], np.concatenate([a.value, -b.value])[order]
        if not len(key):
            return np.zeros(len(rows))
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        total = np.bincount(key[first] // width, np.add.reduceat(value, first) ** 2, minlength=len(rows))
        return np.round(np.sqrt(total), digits)


def slack(*parts: Rows) -> float:
    """How far rough distances may be off."""
    most = max((float(p.squares().max()) for p in parts if len(p)), default=0.0)
    return 1e-6 * (1.0 + most ** 0.5)


def _between(x, y, u: float):
    if x["type"] and y["type"]:
        a, b = np.array(x["values"]), np.array(y["values"])
        return DenseVector(a + u * (b - a))
    ix, iy = (np.arange(len(v["values"])) if v["type"] else np.asarray(v["indices"], np.int64) for v in (x, y))
    index = np.union1d(ix, iy)
    a, b = np.zeros(len(index)), np.zeros(len(index))
    a[np.searchsorted(index, ix)], b[np.searchsorted(index, iy)] = x["values"], y["values"]
    value = a + u * (b - a)
    return SparseVector(x["size"] or y["size"], index[value != 0], value[value != 0])


#: x + u (y - x) of columns of :func:`vector_parts`: index arrays are merged, so sparse vectors stay sparse. One call makes
#: one vector, and only new points are made; vectors have no Arrow form that a batch could return.
between = F.udf(_between, VectorUDT(), useArrow=False)
