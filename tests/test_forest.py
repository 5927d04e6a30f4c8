"""The forest: exact splits, trees that follow ids alone, persistence."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.linalg import Vectors

from ticketloom.operators import forest, models
from ticketloom.plans import catalog


def table(n=300, wide=40, seed=3):
    rng = np.random.default_rng(seed)
    bins = np.where(rng.random((n, wide)) < 0.7, 2, rng.integers(0, 6, (n, wide))).astype(np.uint8)
    label = ((bins[:, 0] > 2).astype(int) + (bins[:, 1] > 3)).astype(np.int32)
    label[rng.random(n) < 0.1] = 0
    zero_bins = np.full(wide, 2)
    row, index = np.nonzero(bins != 2)
    held = (np.append(0, np.cumsum(np.bincount(row, minlength=n))), index.astype(np.int32), bins[row, index], label)
    return bins, label, zero_bins, forest.Binned(*held), forest.Binned(*held, bins)


def gini(y):
    share = np.bincount(y, minlength=3) / len(y)
    return 1 - (share ** 2).sum()


def test_splits_are_the_best_ones():
    bins, label, zero_bins, sparse, dense = table()
    rows, slot = np.arange(300), np.repeat([0, 1], 150)
    totals = np.stack([np.bincount(label[:150], minlength=3), np.bincount(label[150:], minlength=3)]).astype(float)
    drawn = np.array([[0, 3, 7, 9], [1, 2, 8, 30]])
    for data in (sparse, dense):
        gain, by, last, left = forest._split(data, rows, slot, np.ones(300), totals, drawn, zero_bins)
        for node in (0, 1):
            mine, y = bins[slot == node], label[slot == node]
            found = [gini(y) - (x.sum() * gini(y[x]) + (~x).sum() * gini(y[~x])) / len(y)
                     for f in drawn[node] for b in range(5) for x in [mine[:, f] <= b] if 0 < x.sum() < len(y)]
            assert gain[node] == pytest.approx(max(found))
            assert (left[slot == node] == (mine[:, by[node]] <= last[node])).all()


def test_sparse_and_narrow_rows_grow_the_same_tree(monkeypatch):
    _, _, zero_bins, sparse, dense = table()
    cuts = [np.arange(6.0)] * 40
    trees = [forest.grow_tree(data, cuts, zero_bins, 3, forest.ForestRule(), 5) for data in (sparse, dense)]
    assert len(trees[0]["feature"]) > 10 and all((trees[0][c] == trees[1][c]).all() for c in trees[0])
    monkeypatch.setattr(forest, "SLICE_ENTRIES", 50)  # nodes a few at a time
    sliced = forest.grow_tree(dense, cuts, zero_bins, 3, forest.ForestRule(trees=1), 5)
    monkeypatch.setattr(forest, "SLICE_ENTRIES", 10**6)
    assert all((sliced[c] == v).all() for c, v in forest.grow_tree(dense, cuts, zero_bins, 3, forest.ForestRule(trees=1), 5).items() if c != "gained")


def test_draws_are_distinct():
    for features, wanted in ((5, 9), (64, 8), (5000, 71)):
        drawn = forest._drawn(np.random.default_rng(1), 50, features, wanted)
        assert drawn.shape == (50, min(features, wanted)) and all(len(set(r)) == len(r) for r in drawn.tolist())


def test_a_forest_does_not_depend_on_the_cluster(spark, tmp_path):
    """The bootstrap of Spark's own forest follows the partitions."""
    bins, label, *_ = table(200, 300)
    rows = [(i, int(y), Vectors.sparse(300, [(j, float(v) - 2) for j, v in enumerate(x.tolist()) if v != 2])) for i, (x, y) in enumerate(zip(bins, label))]
    df = spark.createDataFrame(rows, ["id", "label", "features"])
    got = []
    for data in (df.repartition(1), df.repartition(7)):
        bench = models.ModelBench()
        assert bench.fit(data, "random_forest", {"n_estimators": 40}).train_accuracy > 0.8
        got.append({r["id"]: r["probability"] for r in bench.predict(df, probability=True).collect()})
    assert got[0] == got[1] and len(got[0]) == 200
    assert forest.Forest(forest.ForestRule(40), parts=3).fit(df).trees == bench.get("random_forest").trees
    assert bench.feature_importance(spark, "random_forest").agg({"importance": "sum"}).first()[0] == pytest.approx(1.0)
    bench.save("random_forest", str(tmp_path / "f"))
    bench.load(str(tmp_path / "f"), "again", kind=bench.kind("random_forest"))
    assert {r["id"]: r["probability"] for r in bench.predict(df, "again", probability=True).collect()} == got[0]


def test_larger_tables_are_left_to_spark(spark):
    rows = [(i, i % 2, [float(i % 2), 1.0]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, label int, features array<double>")
    assert isinstance(forest.Forest(forest.ForestRule(3), most_entries=10).fit(df), RandomForestClassificationModel)
    model = forest.Forest(forest.ForestRule(3)).fit(df)
    assert [r["prediction"] for r in model.transform(df).orderBy("id").collect()] == [float(i % 2) for i in range(40)]


def test_default_models_are_fitted_side_by_side(spark, monkeypatch):
    """The queries on the default models hand their four fits out together."""
    seen = {}
    monkeypatch.setattr(models.ModelBench, "fit_many", lambda self, train, names=None, validation=None, parallelism=1: seen.update(names=names, at_once=parallelism))
    monkeypatch.setattr(catalog, "settle_table", lambda df, name: df)
    monkeypatch.setattr(catalog, "vec3", lambda s, d: s.createDataFrame([(i, i % 3, [float(i)]) for i in range(30)], "id long, label int, features array<double>"))
    catalog._several(spark, "")
    assert seen == {"names": None, "at_once": 4}


def test_nodes_whose_drawn_features_hold_nothing_stay_leaves():
    """Texts of few words seldom hold a word that is drawn."""
    data = forest.Binned(np.array([0, 1, 1, 1]), np.array([7], np.int32), np.array([1], np.uint8), np.array([0, 1, 1], np.int32))
    gain, *_, left = forest._split(data, np.arange(3), np.zeros(3, int), np.ones(3), np.array([[1.0, 2.0]]), np.array([[1, 2]]), np.zeros(300, int))
    assert gain[0] <= forest.LEAST_GAIN and left.all()
    for tree in range(20):
        forest.grow_tree(data, [np.zeros(1)] * 300, np.zeros(300, int), 2, forest.ForestRule(), tree)
