"""Classification metrics on a prediction table ``(id, label, prediction, ...)``.

Rows are reduced to a (label, prediction) or (score) count table first; everything after
that works on those small tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketloom.operators.rank import running_totals


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def pair_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n)`` over the union of true and predicted classes, zero-filled.

    The class list is k values; the k x k frame is unrolled from it.
    """
    pairs = pair_counts(df, label, prediction)
    classes = pairs.select(F.explode(F.array("label", "prediction")).alias("c")).agg(F.array_sort(F.collect_set("c")).alias("cs"))
    frame = classes.select("cs", F.explode("cs").alias("label")).select("label", F.explode("cs").alias("prediction"))
    return frame.join(pairs, ["label", "prediction"], "left").select("label", "prediction", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def normalised_confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Each cell over its row total; a class never true has no defined share."""
    cells = confusion_matrix(df, label, prediction)
    row = F.sum("n").over(W.partitionBy("label"))
    return cells.withColumn("share", F.when(row > 0, F.col("n") / row)).select("label", "prediction", "share")


def _class_table(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(class, tp, fp, tn, fn, support)`` for every true or predicted class."""
    pairs = pair_counts(df, label, prediction)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp"),
                 F.lit(0).cast("bigint").alias("fp"), F.col("n").alias("support")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("tp"),
                 F.when(F.col("label") != F.col("prediction"), F.col("n")).otherwise(0).alias("fp"), F.lit(0).cast("bigint").alias("support")))
    sums = pairs.select(F.explode(sides).alias("s")).select("s.*").groupBy("class").agg(
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("support").alias("support"))
    total = F.sum("support").over(W.partitionBy(F.lit(0)))
    return sums.withColumn("fn", F.col("support") - F.col("tp")).withColumn("tn", total - F.col("tp") - F.col("fp") - F.col("fn"))


def _with_scores(classes: DataFrame) -> DataFrame:
    scored = classes.withColumns({
        "precision": _ratio(F.col("tp"), F.col("tp") + F.col("fp")),
        "recall": _ratio(F.col("tp"), F.col("tp") + F.col("fn")),
    })
    both = F.col("precision") + F.col("recall")
    return scored.withColumn("f1_score", _ratio(2 * F.col("precision") * F.col("recall"), both))


def _named(column: Column, class_names: list[str] | None) -> Column:
    """The name of a class code; the code itself where there is no name."""
    code = column.cast("string")
    if not class_names:
        return code
    code = F.regexp_replace(code, r"\.0$", "")
    return F.coalesce(F.create_map(*[F.lit(x) for i, name in enumerate(class_names) for x in (str(i), name)])[code], code)


def per_class(df: DataFrame, label: str = "label", prediction: str = "prediction", class_names: list[str] | None = None) -> DataFrame:
    """Counts and scores of the classes that occur as true labels; ``class_names`` in code order add ``class_name``."""
    out = _per_class(df, label, prediction)
    return out.withColumn("class_name", _named(F.col("class"), class_names)) if class_names else out


def _per_class(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return _with_scores(_class_table(df, label, prediction)).filter(F.col("support") > 0).select(
        F.col("class"), "precision", "recall", "f1_score", "support",
        F.col("tp").alias("true_positives"), F.col("fp").alias("false_positives"),
        F.col("tn").alias("true_negatives"), F.col("fn").alias("false_negatives"))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction", class_names: list[str] | None = None) -> DataFrame:
    """Scores per class, by name where ``class_names`` (in code order) are given, plus ``accuracy``, ``macro avg`` and ``weighted avg`` rows."""
    classes = _with_scores(_class_table(df, label, prediction))
    rows = classes.select(_named(F.col("class"), class_names).alias("name"), "precision", "recall", "f1_score", "support")
    total = F.sum("support")
    weigh = lambda c: F.sum(F.col(c) * F.col("support")) / total
    macro = classes.agg(F.lit("macro avg").alias("name"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                        F.avg("f1_score").alias("f1_score"), total.alias("support"))
    weighted = classes.agg(F.lit("weighted avg").alias("name"), weigh("precision").alias("precision"), weigh("recall").alias("recall"),
                           weigh("f1_score").alias("f1_score"), total.alias("support"))
    hit = F.sum("tp") / total
    accuracy = classes.agg(F.lit("accuracy").alias("name"), hit.alias("precision"), hit.alias("recall"), hit.alias("f1_score"), total.alias("support"))
    return rows.unionByName(accuracy).unionByName(macro).unionByName(weighted)


def summary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", model: str = "model") -> DataFrame:
    """One row: accuracy and support-weighted precision, recall, F1."""
    classes = _with_scores(_class_table(df, label, prediction))
    total = F.sum("support")
    weigh = lambda c: F.sum(F.col(c) * F.col("support")) / total
    return classes.agg(
        F.lit(model).alias("model"), (F.sum("tp") / total).alias("accuracy"), weigh("precision").alias("precision"),
        weigh("recall").alias("recall"), weigh("f1_score").alias("f1_score"))


def _score_steps(df: DataFrame, positive: Column, score: str, by: list[str]) -> DataFrame:
    """``(by, score, pos, neg, tp, fp)``: counts per distinct score and their running sums,
    highest score first. Scores are counted before they are ordered."""
    hits = df.filter(F.col(score).isNotNull()).groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(positive.cast("bigint")).alias("pos"), F.sum((~positive).cast("bigint")).alias("neg"))
    return running_totals(hits, by, "score", {"pos": "tp", "neg": "fp"}, descending=True)


def precision_recall_curve(df: DataFrame, label: str = "label", score: str = "score", positive=1, by: list[str] = ()) -> DataFrame:
    """``(threshold, precision, recall)`` per distinct score, and the end point (null, 1, 0) of the curve."""
    steps = _score_steps(df, F.col(label) == F.lit(positive), score, list(by))
    total = steps.groupBy(*by).agg(F.sum("pos").alias("_p")) if by else None
    p = total if by else None
    if by:
        steps = steps.join(p, list(by))
    else:
        steps = steps.withColumn("_p", F.lit(steps.agg(F.sum("pos").alias("p")).first()["p"] or 0))
    points = steps.select(
        *by, F.col("score").alias("threshold"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        _ratio(F.col("tp"), F.col("_p")).alias("recall"))
    groups = total.select(*by) if by else df.sparkSession.range(1).select()
    return points.union(groups.select(*by, F.lit(None).cast("double"), F.lit(1.0), F.lit(0.0)))


def _areas(steps: DataFrame, by: list[str]) -> DataFrame:
    """ROC area (ties count half) and average precision from score steps."""
    won = F.col("pos") * (F.col("fp") - F.col("neg")) + F.col("pos") * F.col("neg") / 2
    sums = steps.groupBy(*by).agg(
        F.sum("pos").alias("p"), F.sum("neg").alias("q"), F.sum(won).alias("lost"),
        F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("weighted"))
    both = (F.col("p") > 0) & (F.col("q") > 0)
    return sums.select(
        *by, F.col("p").alias("positives"), F.col("q").alias("negatives"),
        F.when(both, 1.0 - F.col("lost") / (F.col("p").cast("double") * F.col("q"))).alias("auc_roc"),
        F.when(both, F.col("weighted") / F.col("p")).alias("auc_pr"))


def binary_areas(df: DataFrame, label: str = "label", score: str = "score", positive=1) -> DataFrame:
    """One row: ``auc_roc`` and average precision ``auc_pr``."""
    return _areas(_score_steps(df, F.col(label) == F.lit(positive), score, []), []).select("auc_roc", "auc_pr")


def one_vs_rest_areas(df: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """``(class, positives, auc_roc)``: each class against the rest; class i is entry i."""
    return _class_areas(df, label, probability).drop("negatives")


def _class_areas(df: DataFrame, label: str, probability: str) -> DataFrame:
    long = df.select(F.col(label).cast("int").alias("_label"), F.posexplode(probability).alias("class", "score"))
    return _areas(_score_steps(long, F.col("_label") == F.col("class"), "score", ["class"]), ["class"]).select("class", "positives", "negatives", "auc_roc")


def weighted_multiclass_auc(df: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """One row: prevalence-weighted one-vs-rest area, null unless widths equal the classes."""
    areas = _class_areas(df, label, probability)
    # Every entry has rows of its class, and every row's class has an entry.
    fits = (F.min("positives") > 0) & (F.sum("positives") == F.max(F.col("positives") + F.col("negatives")))
    return areas.agg(F.when(fits, F.sum(F.col("auc_roc") * F.col("positives")) / F.sum("positives")).alias("auc_roc"))


def evaluate_classification(
    df: DataFrame, label: str = "label", prediction: str = "prediction", probability: str | None = None, model: str = "model"
) -> DataFrame:
    """One row: accuracy, weighted scores and, with an array of probabilities, the areas."""
    row = summary_metrics(df, label, prediction, model)
    if probability is None:
        return row.withColumns({"auc_roc": F.lit(None).cast("double"), "auc_pr": F.lit(None).cast("double")})
    found = df.agg(F.count_distinct(label).alias("k"), F.max(label).alias("m")).first()
    if found["k"] == 2:
        entry = F.when(F.size(probability) == 2, F.col(probability)[1]).otherwise(F.col(probability)[0])
        got = binary_areas(df.withColumn("_score", entry), label, "_score", found["m"]).first()
        roc, pr = got["auc_roc"], got["auc_pr"]
    else:
        roc, pr = weighted_multiclass_auc(df, label, probability).first()["auc_roc"], None
    return row.withColumns({"auc_roc": F.lit(roc).cast("double"), "auc_pr": F.lit(pr).cast("double")})


def compare_models(evaluations: list[DataFrame]) -> DataFrame:
    """Model rows with missing areas as 0, best weighted F1 first."""
    rows = evaluations[0]
    for other in evaluations[1:]:
        rows = rows.unionByName(other, allowMissingColumns=True)
    return rows.select("model", "accuracy", "precision", "recall", "f1_score", F.coalesce("auc_roc", F.lit(0.0)).alias("auc_roc")).orderBy(
        F.desc("f1_score"), "model")


def best_model(evaluations: list[DataFrame], metric: str = "f1_score") -> tuple[str, float]:
    """The strictly greatest; of equals the first evaluated."""
    if not evaluations:
        raise ValueError("No evaluation results available")
    rows = None
    for i, one in enumerate(evaluations):
        part = one.select(F.lit(i).alias("_i"), "model", F.coalesce(F.col(metric), F.lit(0.0)).alias("score"))
        rows = part if rows is None else rows.unionByName(part)
    top = rows.filter(F.col("score") > 0).orderBy(F.desc("score"), "_i").first()
    if top is None:
        raise ValueError(f"No results available for metric {metric}")
    return top["model"], top["score"]


def evaluation_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction", probability: str | None = None, model: str = "model",
    class_names: list[str] | None = None,
) -> str:
    """Markdown of the metrics, classes and confusion matrix (k and k x k rows); ``class_names`` in code order name the classes."""
    names = {str(i): name for i, name in enumerate(class_names or [])}
    row = evaluate_classification(df, label, prediction, probability, model).first()
    lines = [f"# Model Evaluation: {model}", "", "## Metrics Summary"]
    shown = {"Accuracy": "accuracy", "Precision": "precision", "Recall": "recall", "F1-Score": "f1_score", "AUC-ROC": "auc_roc", "AUC-PR": "auc_pr"}
    lines += [f"- **{title}**: {row[key]:.4f}" for title, key in shown.items() if row[key] is not None]
    lines += ["", "## Per-Class Analysis"]
    for c in per_class(df, label, prediction).orderBy("class").collect():
        code = str(int(c["class"])) if isinstance(c["class"], float) and c["class"].is_integer() else str(c["class"])
        lines += ["", f"### {names.get(code, 'Class_' + str(c['class']))}", f"- Precision: {c['precision']:.4f}", f"- Recall: {c['recall']:.4f}", f"- F1-Score: {c['f1_score']:.4f}",
                  f"- Support: {c['support']}", f"- TP: {c['true_positives']}, FP: {c['false_positives']}",
                  f"- TN: {c['true_negatives']}, FN: {c['false_negatives']}"]
    lines += ["", "## Confusion Matrix"]
    cells = confusion_matrix(df, label, prediction).groupBy("label").agg(F.sort_array(F.collect_list(F.struct("prediction", "n"))).alias("r"))
    lines += ["[" + " ".join(str(x["n"]) for x in r["r"]) + "]" for r in cells.orderBy("label").collect()]
    return "\n".join(lines) + "\n"


def write_report(df: DataFrame, text: str, path: str) -> None:
    """Save a report as one text file in any folder Spark can write."""
    df.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
