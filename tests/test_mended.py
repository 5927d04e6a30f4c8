"""Planted cases: one rule at every size, nulls kept, widths and depths checked, no needless exchange."""

import hashlib

import pytest
from pyspark.sql import functions as F

from ticketloom import session
from ticketloom.operators import anomaly, clean, evaluate, models, neighbours, split, translate, vectorize
from ticketloom.session import measured, settle_table


def _md5(*parts):
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


@pytest.mark.parametrize("n", [32, 33, 400])
def test_isolation_draw_has_one_rule(spark, n):
    df = spark.range(n).select(F.col("id").alias("_id"), F.array(F.col("id").cast("double")).alias("_x"))
    got = {}
    for r in anomaly._deal(df, 4, 8, 42).collect():
        got.setdefault(r["tree"], set()).add(r["_id"])
    assert got == {t: set(sorted(range(n), key=lambda i: _md5(42, t, i))[:8]) for t in range(4)}


def test_depth_above_the_limit_is_an_error(spark):
    df = spark.createDataFrame([(1, [0.0], 0), (2, [1.0], 1)], "id long, features array<double>, label int")
    with pytest.raises(ValueError):
        models.ModelBench().fit(df, "decision_tree", {"max_depth": 31})


def test_measured_looks_at_bytes(spark):
    small = spark.range(5).select(F.repeat(F.lit("x"), 10).alias("t"))
    large = spark.range(5).select(F.repeat(F.lit("x"), 1000).alias("t"))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(measured(small, max_bytes=1000)) and not hinted(measured(large, max_bytes=1000))
    assert measured(large, max_bytes=1000).count() == 5


def test_a_scan_with_enough_splits_is_not_moved(spark):
    slots = spark.sparkContext.defaultParallelism
    wide = settle_table(spark.range(0, 100, 1, slots * 2).withColumn("t", F.lit("a")), "wide")
    if wide.rdd.getNumPartitions() >= slots:
        assert "Exchange" not in clean.spread_input(wide)._jdf.queryExecution().executedPlan().toString()
    assert clean.spread_input(spark.range(0, 100, 1, slots)).rdd.getNumPartitions() == slots
    assert 1 <= clean.spread_input(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() <= 4 * slots


def test_null_language_and_long_texts_are_kept(spark):
    def shout(texts, langs):
        return [f"{lang}:{t}" for t, lang in zip(texts, langs)]

    long = "mot " * 400
    df = spark.createDataFrame([(1, "bonjour", None), (2, "hello", "en"), (3, long, "fr"), (4, None, "fr"), (5, "", None)], "id int, t string, lang string")
    got = {r["id"]: r["t_en"] for r in translate.translate_column(df, "t", shout, lang_col="lang").collect()}
    assert got == {1: "None:bonjour", 2: "hello", 3: "fr:" + long, 4: None, 5: ""}
    profiles = translate.fit_language_profiles(spark.createDataFrame([("bonjour le monde", "fr"), ("hello world", "en")], "t string, lang string"), "t", "lang")
    found = translate.translate_column(df, "t", shout, profiles=profiles, lang_col="lang").filter("id = 1").first()
    assert found["t_en"] == "fr:bonjour"


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else f"g{i % 5}") for i in range(40)], "id long, g string")
    for cap in (None, 100):
        out = split.group_split(df, "g", 0.5, cap).collect()
        assert len(out) == 40
        assert len({r["split"] for r in out if r["g"] is None}) == 1


def test_class_of_one_row_is_refused(spark):
    df = spark.createDataFrame([(i, "a" if i else "b") for i in range(9)], "id long, y string")
    with pytest.raises(ValueError):
        split.stratified_splits(df, "y", "id")


def test_missing_times_come_last(spark):
    df = spark.createDataFrame([(i, None if i < 5 else i) for i in range(10)], "id long, t long")
    got = {r["id"]: r["split"] for r in split.temporal_split(df, "t", "id", 0.2, 0.2).collect()}
    late = sorted(range(5), key=lambda i: _md5(42, i))
    assert {got[i] for i in range(5, 10)} == {"train"}
    assert [got[i] for i in late] == ["train", "validation", "validation", "test", "test"]


def test_area_needs_a_probability_for_every_class(spark):
    rows = [(i % 4, [0.5, 0.3, 0.2]) for i in range(12)]
    df = spark.createDataFrame(rows, "label int, probability array<double>")
    assert evaluate.weighted_multiclass_auc(df).first()["auc_roc"] is None
    assert evaluate.weighted_multiclass_auc(df.filter("label < 3")).first()["auc_roc"] is not None


def test_neighbours_of_other_ids(spark):
    """Training ids may be texts while new rows have whole numbers."""
    train = spark.createDataFrame([(f"{i}|1", [float(i), 0.0]) for i in range(30)], "id string, features array<double>")
    new = spark.createDataFrame([(7, [3.2, 0.0])], "id long, features array<double>")
    got = neighbours.neighbours(new, train, 2, exclude_self=False).orderBy("nn_rank").collect()
    assert [(r["id"], r["nn_id"]) for r in got] == [(7, "3|1"), (7, "4|1")]


def test_class_names_and_embedding_shapes(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (1, 0), (2, 2)], "label int, prediction int")
    names = {r["name"] for r in evaluate.classification_report(df, class_names=["low", "mid"]).collect()}
    assert {"low", "mid", "2", "accuracy"} <= names
    texts = spark.createDataFrame([(i, "red green blue", "one two two") for i in range(4)], "id long, a string, b string")
    fitted = vectorize.vectorize_frame(texts, ["a", "b"], {"a": vectorize.WordEmbedding, "b": vectorize.TextVectorizer("count", min_df=1, max_df=1.0)})
    shapes = {r["vectorizer"]: r["n_features"] for r in fitted.shapes(texts).collect()}
    assert shapes["a_embedding"] == 64 and shapes["total"] == 64 + shapes["b_count"]


def test_scratch_tables_can_be_cleared(spark, monkeypatch):
    monkeypatch.setattr(session, "_SCRATCH", [])
    kept = settle_table(spark.range(3), "gone")
    assert kept.count() == 3 and session.clear_scratch(spark) == 1 and session.clear_scratch(spark) == 0
