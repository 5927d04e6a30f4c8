"""Ticket selection: types, label columns, empty targets, class frequency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.session import measured
from ticketloom.sources.tickets import INTERACTION, SUMMARY, TYPES

LABEL_COLUMNS = ("y1", "y2", "y3", "y4")


def text_types(df: DataFrame, columns: tuple[str, ...] = (INTERACTION, SUMMARY), null_text: str = "nan") -> DataFrame:
    """Both text columns as strings; a missing text becomes ``null_text``."""
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(null_text)) for c in columns})


def name_labels(df: DataFrame, target: str = "y2") -> DataFrame:
    """Add ``y1..y4``, ``x`` and the target ``y``; originals stay."""
    named = df.withColumns({
        **{short: F.col(f"`{full}`") for short, full in zip(LABEL_COLUMNS, TYPES)},
        "x": F.col(f"`{INTERACTION}`"),
    })
    return named.withColumn("y", F.col(target))


def drop_empty_targets(df: DataFrame, target: str = "y") -> DataFrame:
    return df.filter(F.col(target).isNotNull() & (F.col(target) != ""))


def keep_classes(df: DataFrame, column: str, more_than: int | None = None, at_least: int | None = None) -> DataFrame:
    """Rows whose class is frequent enough; null classes go.

    The class table is a partial aggregate of one column; it is broadcast if it proves
    small and shuffled otherwise.
    """
    if column not in df.columns:
        raise ValueError(f"Column '{column}' does not exist")
    floor = at_least if at_least is not None else more_than + 1
    good = (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") >= floor).select(column)
    )
    return df.join(measured(good), column, "left_semi")


def frequent_classes(df: DataFrame, column: str = "y1", min_count: int = 10) -> DataFrame:
    """Keep classes with strictly more than ``min_count`` rows."""
    return keep_classes(df, column, more_than=min_count)


def select_tickets(
    df: DataFrame, target: str = "y2", filter_frequency: bool = True, frequency_column: str = "y1", min_count: int = 10
) -> DataFrame:
    """Types, labels, target filter and (optionally) the frequency filter."""
    out = drop_empty_targets(name_labels(text_types(df), target))
    return frequent_classes(out, frequency_column, min_count) if filter_frequency else out


def value_distribution(df: DataFrame, columns: list[str], keep_nulls: bool = False) -> DataFrame:
    """Value counts of several columns in one scan, long form."""
    present = [c for c in columns if c in df.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in present])
    values = df.select(F.explode(pairs).alias("p")).select("p.*")
    if not keep_nulls:
        values = values.filter(F.col("value").isNotNull())
    return values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def selection_metadata(df: DataFrame) -> DataFrame:
    """Shape and label distributions as ``(metric, key, value)`` rows."""
    shape = df.agg(F.count(F.lit(1)).alias("value")).select(F.lit("rows").alias("metric"), F.lit("").alias("key"), "value")
    width = df.sparkSession.range(1).select(
        F.lit("columns").alias("metric"), F.lit("").alias("key"), F.lit(len(df.columns)).cast("bigint").alias("value"))
    spread = value_distribution(df, ["y", "y1"]).select(
        F.concat(F.col("column"), F.lit("_distribution")).alias("metric"), F.col("value").alias("key"), F.col("n").alias("value"))
    return shape.unionByName(width).unionByName(spread)
