"""Label structuring: distributions, hierarchy, encoding, strata groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketloom.operators.rank import rank_by_number
from ticketloom.operators.select import keep_classes, value_distribution
from ticketloom.session import measured


def class_distribution(df: DataFrame, target_columns: list[str]) -> DataFrame:
    """Counts and percentages per column and class; the denominator counts null rows too."""
    counts = value_distribution(df, target_columns, keep_nulls=True)
    rows = F.sum("n").over(W.partitionBy("column"))
    shares = counts.withColumn("percentage", F.round(F.col("n") / rows * 100, 2))
    return shares.filter(F.col("value").isNotNull()).select("column", "value", "n", "percentage")


def balance_gap(df: DataFrame, target_columns: list[str]) -> DataFrame:
    """Sum of squared gaps from an even spread per column; 0 is balanced."""
    counts = value_distribution(df, target_columns)
    sums = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("num_classes"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"),
        F.sum("n").cast("double").alias("total"),
    )
    gap = F.col("squares") / (F.col("total") * F.col("total")) - F.lit(1.0) / F.col("num_classes")
    return sums.select("column", "num_classes", F.when(F.col("num_classes") <= 1, 0.0).otherwise(gap).alias("class_balance"))


def hierarchical_labels(
    df: DataFrame, primary: str, secondary: str | None = None, tertiary: str | None = None, null_text: str = "nan"
) -> DataFrame:
    """Copies of the levels and their joined name; a level below a missing one is not joined."""
    out = df
    levels = [("primary_label", primary), ("secondary_label", secondary), ("tertiary_label", tertiary)]
    present = [(alias, col) for alias, col in levels if col and col in df.columns]
    for alias, col in present:
        out = out.withColumn(alias, F.col(f"`{col}`"))
    names = [alias for alias, _ in present]
    if "secondary_label" in names:
        parts = [F.coalesce(F.col(n).cast("string"), F.lit(null_text)) for n in names]
        out = out.withColumn("hierarchical_label", F.concat_ws("_", *parts))
    return out


def class_mapping(df: DataFrame, columns: list[str], null_text: str = "nan") -> DataFrame:
    """``(column, class, code)`` with alphabetical codes from 0; null is a class of its own."""
    present = [c for c in columns if c in df.columns]
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(null_text)).alias("class"))
        for c in present
    ])
    classes = df.select(F.explode(pairs).alias("p")).select("p.*").distinct()
    code = F.row_number().over(W.partitionBy("column").orderBy("class")) - 1
    return classes.withColumn("code", code.cast("int"))


def encode_labels(df: DataFrame, columns: list[str], mapping: DataFrame | None = None, null_text: str = "nan") -> DataFrame:
    """Add ``<col>_encoded``. With a given mapping an unseen class is an error.

    The mapping is broadcast if it proves small and shuffled otherwise.
    """
    fitted = mapping is not None
    table = mapping if fitted else class_mapping(df, columns, null_text)
    out = df
    for c in [c for c in columns if c in df.columns]:
        codes = table.filter(F.col("column") == c).select(F.col("class").alias("_class"), F.col("code").alias("_code"))
        out = out.withColumn("_class", F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(null_text)))
        out = out.join(measured(codes), "_class", "left")
        code = F.col("_code")
        if fitted:
            unseen = F.raise_error(F.concat(F.lit(f"unseen label in '{c}': "), F.col("_class"))).cast("int")
            code = F.coalesce(code, unseen)
        out = out.withColumn(f"{c}_encoded", code).drop("_class", "_code")
    return out


def multilabel_structure(df: DataFrame, columns: list[str], null_text: str = "nan") -> DataFrame:
    """An array of codes per row, one per valid column."""
    valid = [c for c in columns if c in df.columns]
    if not valid:
        raise ValueError("No valid label columns found")
    coded = encode_labels(df, valid, null_text=null_text)
    return coded.withColumn("label_codes", F.array(*[F.col(f"{c}_encoded") for c in valid])).drop(*[f"{c}_encoded" for c in valid])


def filter_rare_classes(df: DataFrame, label: str, min_samples: int = 10) -> DataFrame:
    """Keep classes with at least ``min_samples`` rows."""
    return keep_classes(df, label, at_least=min_samples)


def stratified_groups(df: DataFrame, label: str, id_col: str, group_size: int = 50) -> DataFrame:
    """Chunks of ``group_size`` rows per class in id order, numbered over all classes.

    Classes are numbered by first appearance (smallest id); null labels keep -1.
    """
    if label not in df.columns:
        raise ValueError(f"Column '{label}' does not exist")
    labelled = df.filter(F.col(label).isNotNull())
    ranked = rank_by_number(labelled, [label], id_col, "_rn")
    per_class = labelled.groupBy(label).agg(F.count(F.lit(1)).alias("_n"), F.min(id_col).alias("_first"))
    groups = F.ceil(F.col("_n") / group_size)
    before = W.partitionBy(F.lit(0)).orderBy("_first").rowsBetween(W.unboundedPreceding, -1)
    starts = per_class.select(label, F.coalesce(F.sum(groups).over(before), F.lit(0)).alias("_start"))
    grouped = ranked.join(measured(starts), label).withColumn(
        "strata_group", (F.col("_start") + F.floor((F.col("_rn") - 1) / group_size)).cast("int")
    ).drop("_rn", "_start")
    unlabelled = df.filter(F.col(label).isNull()).withColumn("strata_group", F.lit(-1))
    return grouped.unionByName(unlabelled)


def data_summary(df: DataFrame, label_columns: list[str]) -> DataFrame:
    """Rows, column roles, null counts, types and label distributions as ``(metric, key, value)`` strings.

    One aggregate over the table yields every count; it is then turned into rows. The label
    columns are counted together; the key of a label's count is ``column=value``.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(f"null_{i}") for i, c in enumerate(df.columns)]
    one = df.agg(*aggs)
    items = [F.struct(F.lit("total_samples").alias("metric"), F.lit("").alias("key"), F.col("rows").cast("string").alias("value"))]
    for i, (name, dtype) in enumerate(df.dtypes):
        role = "label" if name in label_columns else "feature"
        items += [
            F.struct(F.lit("role").alias("metric"), F.lit(name).alias("key"), F.lit(role).alias("value")),
            F.struct(F.lit("missing_values").alias("metric"), F.lit(name).alias("key"), F.coalesce(F.col(f"null_{i}"), F.lit(0)).cast("string").alias("value")),
            F.struct(F.lit("data_type").alias("metric"), F.lit(name).alias("key"), F.lit(dtype).alias("value")),
        ]
    facts = one.select(F.explode(F.array(*items)).alias("i")).select("i.*")
    present = [c for c in label_columns if c in df.columns]
    if not present:
        return facts
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("string").alias("v")) for c in present])).alias("p")
    counts = df.select(pairs).filter("p.v is not null").groupBy("p.c", "p.v").agg(F.count(F.lit(1)).alias("n"))
    return facts.unionByName(counts.select(F.lit("label_distribution").alias("metric"), F.concat_ws("=", "c", "v").alias("key"), F.col("n").cast("string").alias("value")))
