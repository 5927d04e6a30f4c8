"""Dense arrays, ML vectors and their long form."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_vector(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, VectorUDT)


def as_array(df: DataFrame, column: str) -> DataFrame:
    """The column as ``array<double>`` whatever it was."""
    value = vector_to_array(F.col(column)) if is_vector(df, column) else F.col(column).cast(T.ArrayType(T.DoubleType()))
    return df.withColumn(column, value)


def as_vector(df: DataFrame, column: str) -> DataFrame:
    return df if is_vector(df, column) else df.withColumn(column, array_to_vector(F.col(column).cast("array<double>")))


def entries(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """Non-zero entries of a vector or array column as ``(*keep, idx, w)`` rows."""
    if is_vector(df, column):
        raw = df.select(*keep, F.unwrap_udt(F.col(column)).alias("_v"))
        index = F.when(F.col("_v.type") == 0, F.col("_v.indices")).otherwise(
            F.transform(F.col("_v.values"), lambda _, i: i))
        raw = raw.select(*keep, F.explode(F.arrays_zip(index.alias("idx"), F.col("_v.values").alias("w"))).alias("_e"))
        out = raw.select(*keep, F.col("_e.idx").alias("idx"), F.col("_e.w").alias("w"))
    else:
        out = df.select(*keep, F.posexplode(F.col(column).cast("array<double>")).alias("idx", "w"))
    return out.filter(F.col("w") != 0)


def width_of(df: DataFrame, column: str) -> int:
    """Number of features, from the first row."""
    size = F.unwrap_udt(F.col(column)) if is_vector(df, column) else None
    if size is None:
        return df.select(F.size(column).alias("d")).first()["d"]
    return df.select(F.coalesce(size["size"], F.size(size["values"])).alias("d")).first()["d"]
