"""Text cleaning and text statistics."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.noise import NoiseRegistry, strip_noise


def clean_text(text: Column, registry: NoiseRegistry | None = None, lowercase: bool = True) -> Column:
    """Lower-case, drop ticket noise, squeeze whitespace."""
    return strip_noise(text, (registry or NoiseRegistry()).summary_patterns(), lowercase)


def clean_summary(text: Column, registry: NoiseRegistry | None = None) -> Column:
    return clean_text(text, registry)


def clean_interaction(text: Column, registry: NoiseRegistry | None = None) -> Column:
    """Drop every category but the ticket noise, custom ones last."""
    return strip_noise(text, (registry or NoiseRegistry()).interaction_patterns())


SPREAD_BYTES = 512 * 1024


def spread_input(df: DataFrame, split_bytes: int = SPREAD_BYTES) -> DataFrame:
    """Spread a scan that has fewer splits than the cluster has slots, before regex work.

    The number of partitions follows the bytes of the input, up to four a slot. A scan with
    enough splits keeps them: its rows are not moved.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= slots:
        return df
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(max(1, min(4 * slots, math.ceil(size / split_bytes))))


def with_cleaned(df: DataFrame, summary: Column, interaction: Column, names: tuple[str, str] = ("ts", "ic"), drop_empty: bool = True) -> DataFrame:
    """Add two cleaned columns and (optionally) drop rows where either is empty.

    The pair is produced by a generator. A filter on a plain column would be pushed below
    the spreading shuffle and evaluate every pattern a second time, in the scan's tasks.
    """
    pair = F.explode(F.array(F.struct(summary.alias("s"), interaction.alias("i"))))
    out = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in names], pair.alias("_pair"))
    out = out.withColumns({names[0]: F.col("_pair.s"), names[1]: F.col("_pair.i")}).drop("_pair")
    return out.filter((F.col(names[0]) != "") & (F.col(names[1]) != "")) if drop_empty else out


def preprocess(
    df: DataFrame,
    summary_col: str = "Ticket Summary",
    interaction_col: str = "Interaction content",
    clean_summary_col: str = "ts",
    clean_interaction_col: str = "ic",
    registry: NoiseRegistry | None = None,
    spread: bool = True,
) -> DataFrame:
    """Add both cleaned columns and drop rows where either is empty; ``spread`` as in :func:`spread_input`."""
    summary = clean_summary(F.col(f"`{summary_col}`"), registry)
    interaction = clean_interaction(F.col(f"`{interaction_col}`"), registry)
    return with_cleaned(spread_input(df) if spread else df, summary, interaction, (clean_summary_col, clean_interaction_col))


def text_statistics(df: DataFrame, text_column: str) -> DataFrame:
    """One row of counts and lengths over the non-null texts.

    Distinct texts are counted over 16-byte digests, so whole texts are never shuffled.
    """
    if text_column not in df.columns:
        raise ValueError(f"Column '{text_column}' does not exist in DataFrame")
    text = F.col(f"`{text_column}`")
    size = F.length(text)
    per_text = (
        df.filter(text.isNotNull())
        .select(F.unhex(F.md5(text)).alias("digest"), size.alias("size"), (text == "").cast("long").alias("blank"))
        .groupBy("digest", "size")
        .agg(F.count(F.lit(1)).alias("copies"), F.sum("blank").alias("blank"))
    )
    return per_text.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_texts"),
        F.coalesce(F.sum("blank"), F.lit(0)).alias("empty_texts"),
        (F.sum(F.col("size") * F.col("copies")) / F.sum("copies")).alias("avg_length"),
        F.min("size").cast("bigint").alias("min_length"),
        F.max("size").cast("bigint").alias("max_length"),
        F.count(F.lit(1)).alias("unique_texts"),
    )
