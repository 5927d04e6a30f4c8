"""Strategy, clustering, anomalies, models, evaluation and the flow."""

import numpy as np
import pytest

from ticketloom.operators import anomaly, cluster, evaluate, models, strategy
from ticketloom.plans import flow
from ticketloom.sources.tickets import tickets_view


def blobs(spark, noise=3, copies=0, per=40):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 0.05, (per, 3)), rng.normal(3, 0.05, (per, 3)), rng.uniform(50, 90, (noise, 3)), np.full((copies, 3), -5.0)])
    label = [0] * per + [1] * per + [2] * (noise + copies)
    return x, spark.createDataFrame([(i, v.tolist(), c) for i, (v, c) in enumerate(zip(x, label))], "id long, features array<double>, label int")


@pytest.mark.parametrize("block", [16, 4096])
def test_dbscan_finds_planted_blobs(spark, block):
    _, df = blobs(spark, copies=30)
    out = cluster.dbscan(df, "id", eps=0.5, block_rows=block)
    assert cluster.dbscan_summary(out).first().asDict() == {"clusters": 3, "noise_points": 3, "core_points": 110}
    assert {r["cluster"] for r in out.filter("cluster IS NOT NULL").select("cluster").distinct().collect()} == {0, 40, 83}


def test_dbscan_long_chain_and_border(spark):
    rows = [(i, [0.4 * i, 0.0]) for i in range(60)] + [(100, [0.4 * 59 + 0.5, 0.0]), (101, [500.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, features array<double>")
    out = {r["id"]: (r["cluster"], r["is_core"]) for r in cluster.dbscan(df, "id", eps=0.5, min_samples=3).collect()}
    assert out[30] == (1, True) and out[58] == (1, True) and out[0] == (1, False)
    assert out[100][0] == 1 and out[101] == (None, False)


def test_silhouette_matches_formula(spark):
    x, df = blobs(spark, noise=4, per=10)
    got = {r["id"]: r["silhouette"] for r in cluster.silhouette_by_row(df, "id", "label", block_rows=7).collect()}
    label = np.array([0] * 10 + [1] * 10 + [2] * 4)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    for i in range(len(x)):
        a = d[i][(label == label[i]) & (np.arange(len(x)) != i)].mean()
        b = min(d[i][label == c].mean() for c in set(label) - {label[i]})
        assert got[i] == pytest.approx((b - a) / max(a, b), abs=1e-6)


def test_clustering_picks_two(spark):
    _, df = blobs(spark, noise=0)
    found = cluster.clustering_analysis(df, "id", max_clusters=4, n_init=2)
    assert found["optimal_k"] == 2 and found["clustering_feasible"] and found["dbscan_clusters"] == 2


def test_far_rows_are_isolated(spark):
    _, df = blobs(spark, noise=4)
    flagged = anomaly.flag_by_quantile(anomaly.isolation_scores(df, "id"), 0.05).filter("is_anomaly")
    # 0.95 * 83 = 78.85: the five rows above that place lie beyond the quantile
    found = {r["id"] for r in flagged.collect()}
    assert found >= {80, 81, 82, 83} and len(found) == 5
    row = anomaly.detect_anomalies(df, "id", contamination=0.1).first()
    assert row["one_class_anomalies"] == 9 and row["isolation_forest_anomalies"] == 9


def test_feasibility_of_the_published_run(spark):
    rows = [(i, i % 3) for i in range(204)]
    df = spark.createDataFrame(rows, "id long, label int")
    row = strategy.feasibility(df, "label", 4748).first()
    assert row["feasibility_score"] == 0.8 and row["recommendation"] == "supervised"
    assert row["label_balance_score"] == pytest.approx(1.0, abs=1e-6)
    assert row["reasons"] == "Too many features compared to samples"
    few = strategy.feasibility(df.filter("id < 20 OR label = 0"), "label", 2).first()
    assert few["recommendation"] == "unsupervised" and "Too few samples per class (min: 6)" in few["reasons"]


def test_single_class_balance_is_zero(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "id long, label string")
    assert strategy.label_quality(df, "label").first()["label_balance_score"] == 0.0


def test_report_text(spark):
    _, df = blobs(spark, noise=0)
    text = strategy.strategy_report(strategy.recommend(df, "id", label="label"))
    assert "**Primary strategy:** supervised" in text and "- Labels available: Yes" in text


@pytest.mark.parametrize("name", ["random_forest", "logistic_regression", "svm", "knn", "decision_tree", "mlp", "gradient_boosting"])
def test_models_beat_the_majority(spark, name):
    _, df = blobs(spark, noise=10)
    bench = models.ModelBench()
    small = {"random_forest": {"n_estimators": 10}, "gradient_boosting": {"n_estimators": 3}, "mlp": {"max_iter": 60}, "svm": {"landmarks": 64}}
    assert bench.fit(df, name, small.get(name)).train_accuracy > 0.8
    out = bench.predict(df, probability=True)
    assert out.count() == 90 and len(out.first()["probability"]) == 3
    assert out.first()["probability"] and sum(out.first()["probability"]) == pytest.approx(1.0)


def test_bench_errors_persistence_and_importance(spark, tmp_path):
    _, df = blobs(spark)
    bench = models.ModelBench()
    with pytest.raises(ValueError):
        bench.fit(df, "unknown")
    with pytest.raises(ValueError):
        bench.predict(df)
    results = bench.fit_many(df, ["naive_bayes", "decision_tree", "knn"])
    assert "error" in results["naive_bayes"] and bench.best == "decision_tree"
    before = {r["id"]: r["prediction"] for r in bench.predict(df, "knn").collect()}
    bench.save("knn", str(tmp_path / "knn"))
    bench.load(str(tmp_path / "knn"), "again", k=5)
    assert before == {r["id"]: r["prediction"] for r in bench.predict(df, "again").collect()}
    assert bench.feature_importance(spark, "decision_tree").count() == 3
    assert bench.feature_importance(spark, "knn") is None
    assert bench.comparison(spark).count() == 2 or bench.comparison(spark).count() == 3
    tuned = bench.tune(df, "decision_tree", {"max_depth": [1, 3]})
    assert tuned.name == "decision_tree_tuned" and tuned.best_params == {"max_depth": 3}


def scored(spark):
    rows = [(1, 0, 0, 0.1), (2, 0, 1, 0.6), (3, 1, 1, 0.6), (4, 1, 1, 0.9), (5, 1, 2, 0.4)]
    return spark.createDataFrame(rows, "id int, label int, prediction int, score double")


def test_predicted_class_absent_from_truth(spark):
    df = scored(spark)
    assert evaluate.confusion_matrix(df).count() == 9
    assert {r["class"] for r in evaluate.per_class(df).collect()} == {0, 1}
    report = {r["name"]: r for r in evaluate.classification_report(df).collect()}
    assert report["accuracy"]["precision"] == pytest.approx(0.6)
    assert report["macro avg"]["recall"] == pytest.approx((0.5 + 2 / 3 + 0) / 3)
    assert report["weighted avg"]["recall"] == pytest.approx(0.6)


def test_areas_with_ties(spark):
    row = evaluate.binary_areas(scored(spark)).first()
    assert row["auc_roc"] == pytest.approx((1 + 0.5 + 1 + 1 + 1 + 0) / 6)
    assert row["auc_pr"] == pytest.approx((1 * 1.0 + 1 * 2 / 3 + 1 * 3 / 4) / 3)


def test_best_model_rules(spark):
    df = scored(spark)
    a, b = evaluate.evaluate_classification(df, model="first"), evaluate.evaluate_classification(df, model="second")
    assert evaluate.best_model([a, b])[0] == "first"
    with pytest.raises(ValueError):
        evaluate.best_model([a], "auc_roc")
    with pytest.raises(ValueError):
        evaluate.best_model([])
    assert "## Confusion Matrix" in evaluate.evaluation_report(df)


def test_config_merges_and_rejects():
    config = flow.load_config('{"vectorization": {"max_features": 5}}')
    assert config["vectorization"]["max_features"] == 5 and config["vectorization"]["method"] == "tfidf"
    with pytest.raises(ValueError):
        flow.load_config({"nope": {}})
    with pytest.raises(ValueError):
        flow.load_config({"sampling": {"max_ratio": 2}})


def test_flow_end_to_end(spark, sf_dir, tmp_path):
    config = flow.load_config({"vectorization": {"max_features": 100}, "modeling": {"models": ["naive_bayes"]}, "preprocessing": {"spread": False}})
    result = flow.TicketFlow(config).fit(tickets_view(spark, sf_dir))
    assert result.model.best == "naive_bayes" and result.n_features <= 200
    path = str(tmp_path / "flow")
    result.model.save(spark, path)
    new = tickets_view(spark, sf_dir)
    before = result.model.transform(new).orderBy("id").collect()
    assert before == flow.FlowModel.load(spark, path).transform(new).orderBy("id").collect()
    with pytest.raises(ValueError):
        flow.split_step(new, flow.load_config({"data_split": {"method": "odd"}}))


def test_several_trains_the_default_models(spark, sf_dir):
    from ticketloom.plans import catalog

    bench, _ = catalog._several(spark, sf_dir)
    assert set(bench.trained) == {"random_forest", "logistic_regression", "svm", "naive_bayes"} and not bench.errors
