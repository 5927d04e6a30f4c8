"""Data characteristics, supervised feasibility and the strategy advice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketloom.functions.vectors import entries, width_of
from ticketloom.operators.anomaly import detect_anomalies
from ticketloom.operators.cluster import clustering_analysis
from ticketloom.operators.split import class_counts

BALANCE_FLOOR = 0.7
FEASIBLE_TENTHS = 6
MIN_CLASS_ROWS = 10
MIN_ROWS = 100
ROWS_PER_FEATURE = 10
SPARSE_ABOVE = 0.8
LOW_VARIANCE = 0.01


def characteristics(df: DataFrame, features: str = "features") -> DataFrame:
    """One row: samples, features, sparsity, mean population variance of the columns.

    Works on non-zero entries only; zeros are implied by the counts. Entries are summed per
    column map-side before they are shuffled.
    """
    n, d = df.count(), width_of(df, features)
    sums = entries(df, features, []).groupBy("idx").agg(
        F.count(F.lit(1)).alias("nonzero"), F.sum("w").alias("s"), F.sum(F.col("w") * F.col("w")).alias("q"))
    variance = F.col("q") / n - (F.col("s") / n) * (F.col("s") / n)
    return sums.agg(
        F.lit(n).cast("bigint").alias("n_samples"), F.lit(d).cast("bigint").alias("n_features"),
        (1.0 - F.coalesce(F.sum("nonzero"), F.lit(0)) / F.lit(float(n) * d)).alias("data_sparsity"),
        (F.coalesce(F.sum(variance), F.lit(0.0)) / d).alias("feature_variance"))


def label_quality(df: DataFrame, label: str) -> DataFrame:
    """One row: classes, least class, entropy balance (1 is balanced), flags."""
    counts = class_counts(df, label)
    p = F.col("n") / F.sum("n").over(W.partitionBy(F.lit(0)))
    terms = counts.withColumn("_t", -p * F.log2(p + 1e-10))
    one = terms.agg(
        F.count(F.lit(1)).alias("n_unique_labels"), F.min("n").alias("min_class"), F.sum("n").alias("n_labelled"), F.sum("_t").alias("_h"))
    balance = F.when(F.col("n_unique_labels") > 1, F.col("_h") / F.log2(F.col("n_unique_labels").cast("double"))).otherwise(0.0)
    return one.withColumn("label_balance_score", balance).drop("_h").withColumns({
        "is_multiclass": F.col("n_unique_labels") > 2, "is_imbalanced": F.col("label_balance_score") < BALANCE_FLOOR})


def feasibility(df: DataFrame, label: str, n_features: int) -> DataFrame:
    """One row: score, recommendation, and the failed checks in ``reasons``.

    The score is summed in whole tenths, so the threshold is met exactly.
    """
    q = label_quality(df, label)
    n = df.count()
    enough = F.col("min_class") >= MIN_CLASS_ROWS
    even = ~F.col("is_imbalanced")
    many = F.lit(n >= MIN_ROWS)
    narrow = F.lit(n_features <= n / ROWS_PER_FEATURE)
    tenths = sum((F.when(test, worth).otherwise(0) for test, worth in ((enough, 3), (even, 2), (many, 2), (narrow, 2), (even, 1))), F.lit(0))
    reasons = F.concat_ws(
        "; ",
        F.when(~enough, F.format_string("Too few samples per class (min: %d)", "min_class")),
        F.when(~even, "Class is imbalanced"),
        F.when(~many, "Too few samples overall"),
        F.when(~narrow, "Too many features compared to samples"))
    return q.withColumns({"n_samples": F.lit(n).cast("bigint"), "tenths": tenths, "reasons": reasons}).select(
        "n_samples", "n_unique_labels", "min_class", "label_balance_score", "is_multiclass", "is_imbalanced",
        (F.col("tenths") / 10.0).alias("feasibility_score"),
        F.when(F.col("tenths") >= FEASIBLE_TENTHS, "supervised").otherwise("unsupervised").alias("recommendation"), "reasons")


def recommend(
    df: DataFrame, id_col: str, features: str = "features", label: str | None = None, domain: dict | None = None, **clustering
) -> dict:
    """Strategy, confidence, reasons, alternatives and preprocessing advice."""
    shape = characteristics(df, features).first()
    out = {"primary_strategy": None, "confidence": 0.0, "reasoning": [], "alternative_strategies": [], "preprocessing_recommendations": [],
           "n_samples": shape["n_samples"], "n_features": shape["n_features"], "has_labels": label is not None}
    if label is not None:
        row = feasibility(df, label, shape["n_features"]).first()
        if row["recommendation"] == "supervised":
            out.update(primary_strategy="supervised", confidence=row["feasibility_score"])
            out["reasoning"].append("Labels are of good quality")
            if row["is_imbalanced"]:
                out["preprocessing_recommendations"].append("Consider data balancing")
        else:
            out.update(primary_strategy="unsupervised", confidence=1 - row["feasibility_score"])
            out["reasoning"] += [r for r in row["reasons"].split("; ") if r]
            out["alternative_strategies"].append("semi_supervised")
    else:
        found = clustering_analysis(df, id_col, features, **clustering)
        odd = detect_anomalies(df, id_col, features).first()
        if found["clustering_feasible"]:
            out.update(primary_strategy="clustering", confidence=found["best_silhouette_score"])
            out["reasoning"].append(f"Data shows clustering structure (k={found['optimal_k']})")
        else:
            out.update(primary_strategy="anomaly_detection", confidence=0.5)
            out["reasoning"].append("No clear clustering structure")
        if odd["has_significant_anomalies"]:
            out["alternative_strategies"].append("anomaly_detection")
    if shape["data_sparsity"] > SPARSE_ABOVE:
        out["preprocessing_recommendations"].append("Data is very sparse - consider dimensionality reduction")
    if shape["feature_variance"] < LOW_VARIANCE:
        out["preprocessing_recommendations"].append("Low feature variance - consider feature selection")
    if domain and domain.get("requires_interpretability"):
        out["reasoning"].append("Model interpretability required")
    if domain and domain.get("known_classes", 0) > 0:
        out["reasoning"].append(f"Known number of classes: {domain['known_classes']}")
    return out


def recommendation_frame(spark, advice: dict) -> DataFrame:
    row = (advice["primary_strategy"], float(advice["confidence"]), "; ".join(advice["reasoning"]),
           "; ".join(advice["alternative_strategies"]), "; ".join(advice["preprocessing_recommendations"]))
    return spark.createDataFrame(
        [row], "primary_strategy string, confidence double, reasoning string, alternatives string, preprocessing string")


def strategy_report(advice: dict) -> str:
    """The advice as markdown."""
    def section(title: str, items: list[str]) -> list[str]:
        return ["", f"## {title}", *[f"- {i}" for i in items]] if items else []

    lines = ["# Machine Learning Strategy Recommendation Report"]
    lines += section("Data Analysis", [
        f"Number of samples: {advice['n_samples']}", f"Number of features: {advice['n_features']}",
        f"Labels available: {'Yes' if advice['has_labels'] else 'No'}"])
    lines += ["", "## Recommended Strategy", f"**Primary strategy:** {advice['primary_strategy']}",
              f"**Recommendation confidence:** {advice['confidence']:.2f}", "", "## Justification", *[f"- {r}" for r in advice["reasoning"]]]
    lines += section("Alternative Strategies", advice["alternative_strategies"])
    lines += section("Preprocessing Recommendations", advice["preprocessing_recommendations"])
    return "\n".join(lines) + "\n"
