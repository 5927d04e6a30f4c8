"""Vectors, neighbours and balancing against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketloom.functions.vectors import entries
from ticketloom.operators import balance, neighbours, vectorize

TEXTS = ["app crash app", "app login crash", "login fails", "unrelated words"]


def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id long, t string")


def test_tfidf_by_hand(spark):
    model = vectorize.TextVectorizer(ngram_range=(1, 1), min_df=2, stop_words=None).fit(texts(spark), "t")
    assert model.terms == ["app", "crash", "login"]
    idf = math.log(5 / 3) + 1
    assert model.idf() == pytest.approx([idf] * 3)
    got = {(r["id"], r["term"]): r["weight"] for r in model.weights(texts(spark), "id").collect()}
    assert got[(0, "app")] == pytest.approx(2 / math.sqrt(5)) and got[(1, "login")] == pytest.approx(1 / math.sqrt(3))
    assert (3, "app") not in got
    out = model.transform(spark.createDataFrame([(9, "never seen"), (10, None)], "id long, t string"))
    assert out.count() == 2 and entries(out, "features", ["id"]).count() == 0


def test_ngrams_skip_stop_words_first(spark):
    df = spark.createDataFrame([("crash of the app x",)], "t string")
    got = df.select(vectorize.TextVectorizer().terms(F.col("t")).alias("g")).first()["g"]
    assert got == ["crash", "app", "crash app"]
    with pytest.raises(ValueError):
        vectorize.TextVectorizer("other")


def test_max_df_and_top_features(spark):
    df = spark.createDataFrame([(i, "all " + w) for i, w in enumerate(["bb bb", "bb", "aa", "aa"])], "id long, t string")
    model = vectorize.TextVectorizer("count", max_features=1, ngram_range=(1, 1), stop_words=None).fit(df, "t")
    assert model.terms == ["bb"]


def test_combination_and_embedding(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], [3.0, 4.0])], "id long, a array<double>, b array<double>")
    both = vectorize.combine_features(df, ["a", "b"]).first()["features"]
    assert list(both) == [1, 2, 3, 4]
    assert list(vectorize.combine_features(df, ["a", "b"], "average").first()["features"]) == [2, 3]
    with pytest.raises(ValueError):
        vectorize.combine_features(df, ["a"], "other")
    words = spark.createDataFrame([(1, "  "), (2, "abc"), (3, None)], "id long, t string")
    got = {r["id"]: r["embedding"] for r in vectorize.embed(words, "t", lambda ts: [[float(len(t))] for t in ts]).collect()}
    assert got == {1: [5.0], 2: [3.0], 3: [5.0]}


def test_svd_matches_numpy(spark):
    x = np.random.default_rng(0).normal(size=(30, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, features array<double>")
    out = vectorize.reduce_dimensions(df, "features", 3).orderBy("id").collect()
    got = np.array([r["reduced"].toArray() for r in out])
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    want = u[:, :3] * s[:3]
    assert np.allclose(got @ got.T, want @ want.T, atol=1e-6)
    with pytest.raises(ValueError):
        vectorize.reduce_dimensions(df, "features", 3, "pca")


def cloud(spark, copies=0):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (60, 4)), rng.normal(6, 1, (40, 4)), np.zeros((copies, 4))])
    y = [0 if i % 5 == 0 else 1 for i in range(len(x))]
    return x, y, spark.createDataFrame([(i, v.tolist(), c) for i, (v, c) in enumerate(zip(x, y))], "id long, features array<double>, label int")


@pytest.mark.parametrize("farthest", [False, True])
@pytest.mark.parametrize("grouped", [False, True])
@pytest.mark.parametrize("block", [8, 4096])
def test_neighbours_with_hot_copies(spark, farthest, grouped, block):
    x, y, df = cloud(spark, copies=50)
    got = {}
    for r in neighbours.neighbours(df, df, 4, group_col="label" if grouped else None, farthest=farthest, block_rows=block).collect():
        got.setdefault(r["id"], {})[r["nn_rank"]] = (r["nn_id"], r["distance"])
    d = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), 9)
    for i in range(len(x)):
        order = sorted((j for j in range(len(x)) if j != i and (not grouped or y[i] == y[j])), key=lambda j: (-d[i, j] if farthest else d[i, j], j))[:4]
        assert [got[i][k + 1][0] for k in range(4)] == order


def test_over_sampling_keeps_originals(spark):
    rows = [(i, "a" if i < 68 else "b" if i < 100 else "c") for i in range(118)]
    df = spark.createDataFrame(rows, "id long, label string")
    out = balance.random_oversample(df, "label", "id")
    assert {r["label"]: r["count"] for r in out.groupBy("label").count().collect()} == {"a": 68, "b": 68, "c": 68}
    assert out.filter("copy_no = 0").count() == 118
    assert out.select("id", "copy_no").distinct().count() == 204


def test_large_deficit_is_chunked_and_exact(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id long, label string")
    out = balance.random_oversample(df, "label", "id", {"a": 45_000})
    assert out.filter("label = 'a'").count() == 45_000
    assert out.select("id", "copy_no").distinct().count() == 45_002


def test_sampling_strategies(spark):
    df = spark.createDataFrame([(i, "a" if i < 40 else "b") for i in range(50)], "id long, label string")
    count = lambda out: {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert count(balance.random_oversample(df, "label", "id", 0.5)) == {"a": 40, "b": 20}
    assert count(balance.random_undersample(df, "label", "id", 0.5)) == {"a": 20, "b": 10}
    assert count(balance.random_undersample(df, "label", "id", {"a": 3})) == {"a": 3, "b": 10}
    assert count(balance.custom_balanced(df, "label", "id", 20)) == {"a": 20, "b": 20}
    assert count(balance.custom_balanced(df, "label", "id", 20, "undersample")) == {"a": 20, "b": 10}
    with pytest.raises(ValueError):
        balance.random_oversample(df, "label", "id", {"a": 3})
    assert balance.imbalance_summary(df, "label").first().asDict() == {
        "imbalance_ratio": 4.0, "minority_class": "b", "majority_class": "a", "total_samples": 50, "num_classes": 2, "is_balanced": False}


def test_synthetic_points_lie_between_neighbours(spark):
    x, y, df = cloud(spark)
    out = balance.smote(df, "label", "id").collect()
    made = [r for r in out if r["is_synthetic"]]
    assert len(made) == y.count(1) - y.count(0)
    own = np.array([v for v, c in zip(x, y) if c == 0])
    for r in made:
        seed, point = x[r["src_id"]], np.array(r["features"])
        near = own[np.argsort(((own - seed) ** 2).sum(1))[1:6]]
        gaps = [np.linalg.norm(point - seed) + np.linalg.norm(point - n) - np.linalg.norm(n - seed) for n in near]
        assert min(gaps) < 1e-9
    with pytest.raises(ValueError):
        balance.smote(df.filter("label = 1 OR id < 11"), "label", "id")


def test_tomek_links_on_a_line(spark):
    rows = [(1, [0.0], 0), (2, [1.0], 1), (3, [5.0], 1), (4, [5.4], 1), (5, [9.0], 0), (6, [20.0], 1)]
    df = spark.createDataFrame(rows, "id long, features array<double>, label int")
    assert {r["id"] for r in balance.tomek_undersample(df, "label", "id").collect()} == {1, 3, 4, 5, 6}
    assert {r["id"] for r in balance.tomek_undersample(df, "label", "id", both=True).collect()} == {3, 4, 5, 6}


def test_auto_balance_leaves_balanced_tables(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(10)], "id long, label int")
    assert balance.auto_balance(df, "label", "id").count() == 10


def test_combined_samplers(spark):
    _, _, df = cloud(spark)
    for out in (balance.smote_tomek(df, "label", "id"), balance.smote_enn(df, "label", "id"), balance.adasyn(df, "label", "id")):
        assert out.count() > 0 and out.select("row_key").distinct().count() == out.count()


def test_counts_are_a_least_size_on_request(spark):
    """A class above its count keeps its rows, as in the SQL of b_02_oversample_counts; without the request it is an error."""
    df = spark.createDataFrame([(i, i % 3) for i in range(60)], "id long, label int")
    with pytest.raises(ValueError):
        balance.random_oversample(df, "label", "id", {0: 25, 1: 10})
    out = balance.random_oversample(df, "label", "id", {0: 25, 1: 10}, at_least=True)
    assert {r["label"]: r["count"] for r in out.groupBy("label").count().collect()} == {0: 25, 1: 20, 2: 20}
