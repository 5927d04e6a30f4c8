"""Labels, ranks, splits: micro cases and independence of partitioning."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ticketloom.functions.hashing import keyed_hash
from ticketloom.operators import labels, rank, split


def classes(spark, sizes):
    rows, i = [], 0
    for name, n in sizes.items():
        for _ in range(n):
            rows.append((i, name))
            i += 1
    return spark.createDataFrame(rows, "id long, y string")


def test_balance_and_distribution(spark):
    df = classes(spark, {"a": 3, "b": 1}).unionByName(spark.createDataFrame([(9, None)], "id long, y string"))
    got = {r["value"]: (r["n"], r["percentage"]) for r in labels.class_distribution(df, ["y", "missing"]).collect()}
    assert got == {"a": (3, 60.0), "b": (1, 20.0)}
    assert labels.balance_gap(df, ["y"]).first()["class_balance"] == pytest.approx(0.125)
    assert labels.balance_gap(classes(spark, {"a": 4}), ["y"]).first()["class_balance"] == 0.0


def test_hierarchy_and_codes(spark):
    df = spark.createDataFrame([(1, "a", None, "x"), (2, "b", "m", "y")], "id int, p string, s string, t string")
    got = {r["id"]: r["hierarchical_label"] for r in labels.hierarchical_labels(df, "p", "s", "t").collect()}
    assert got == {1: "a_nan_x", 2: "b_m_y"}
    assert "hierarchical_label" not in labels.hierarchical_labels(df, "p", None, "t").columns
    codes = {r["id"]: r["s_encoded"] for r in labels.encode_labels(df, ["s", "missing"]).collect()}
    assert codes == {1: 1, 2: 0}
    matrix = {r["id"]: r["label_codes"] for r in labels.multilabel_structure(df, ["p", "s"]).collect()}
    assert matrix == {1: [0, 1], 2: [1, 0]}
    with pytest.raises(ValueError):
        labels.multilabel_structure(df, ["none"])


def test_unseen_label_is_an_error(spark):
    mapping = labels.class_mapping(classes(spark, {"a": 1, "b": 1}), ["y"])
    with pytest.raises(Exception, match="unseen label"):
        labels.encode_labels(classes(spark, {"c": 1}), ["y"], mapping).collect()


def test_stratified_groups(spark):
    rows = [(0, "b"), (1, "a"), (2, "a"), (3, None), (4, "a"), (5, "b")]
    df = spark.createDataFrame(rows, "id long, y string")
    got = {r["id"]: r["strata_group"] for r in labels.stratified_groups(df, "y", "id", 2).collect()}
    assert got == {0: 0, 5: 0, 1: 1, 2: 1, 4: 2, 3: -1}


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_ranks_do_not_depend_on_partitions(spark, parts):
    df = classes(spark, {"hot": 300, "cold": 20}).repartition(parts)
    ranked = rank.rank_by_hash(df, ["y"], keyed_hash(1, F.col("id")), "id", "r", digits=1)
    rows = sorted((r["y"], r["r"], r["id"]) for r in ranked.collect())
    import hashlib
    want = []
    for name, ids in (("hot", range(300)), ("cold", range(300, 320))):
        order = sorted(ids, key=lambda i: hashlib.md5(f"1|{i}".encode()).hexdigest())
        want += [(name, n + 1, i) for n, i in enumerate(order)]
    assert rows == sorted(want)
    numbered = rank.rank_by_number(df, ["y"], "id", "r", buckets=7)
    assert all(r["r"] == (r["id"] % 300) + 1 for r in numbered.collect())


def test_full_buckets_are_split_further(spark, monkeypatch):
    monkeypatch.setattr(rank, "BUCKET_ROWS", 5)
    df = classes(spark, {"hot": 300, "cold": 20})
    ranked = rank.rank_by_hash(df, ["y"], keyed_hash(1, F.col("id")), "id", "r", digits=1)
    plain = df.toPandas()
    import hashlib
    plain["h"] = [hashlib.md5(f"1|{i}".encode()).hexdigest() for i in plain["id"]]
    plain["r"] = plain.groupby("y")["h"].rank().astype(int)
    assert {(r["id"], r["r"]) for r in ranked.collect()} == set(zip(plain["id"], plain["r"]))


def test_flag_lowest_breaks_ties_exactly(spark):
    df = spark.createDataFrame([(i, "k", float(i // 10)) for i in range(40)], "id long, g string, v double")
    quota = spark.createDataFrame([("k", 25)], "g string, quota long")
    got = rank.flag_lowest(df, ["g"], "v", quota, keyed_hash(0, F.col("id")), "id", "f").filter("f").collect()
    assert len(got) == 25 and sum(r["v"] == 2.0 for r in got) == 5 and not any(r["v"] == 3.0 for r in got)


def test_largest_remainder_and_exact_sizes(spark):
    out = split.basic_split(classes(spark, {"a": 68, "b": 68, "c": 68}), "y", "id")
    sizes = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert sizes == {("a", "test"): 14, ("b", "test"): 14, ("c", "test"): 13, ("a", "train"): 54, ("b", "train"): 54, ("c", "train"): 55}


def test_split_errors_and_single_class(spark):
    one = classes(spark, {"a": 10})
    assert split.basic_split(one, "y", "id").filter("split = 'test'").count() == 2
    with pytest.raises(ValueError):
        split.stratified_splits(one, "y", "id")
    with pytest.raises(ValueError):
        split.basic_split(classes(spark, {"a": 5, "b": 1}), "y", "id")
    with pytest.raises(ValueError):
        split.temporal_split(one, "missing", "id")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "long"])
def test_temporal_split_with_hot_instant(spark, kind):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(days=0 if 20 <= i < 80 else i - 100)) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, t timestamp")
    df = df.withColumn("t", F.unix_micros("t") if kind == "long" else F.col("t").cast(kind))
    out = split.temporal_split(df, "t", "id").collect()
    by = {name: [r for r in out if r["split"] == name] for name in ("train", "validation", "test")}
    assert {k: len(v) for k, v in by.items()} == {"train": 70, "validation": 10, "test": 20}
    assert max(r["t"] for r in by["train"]) <= min(r["t"] for r in by["validation"]) <= min(r["t"] for r in by["test"])
    assert split.temporal_split(df, "t", "id", 0.2, 0.0).filter("split = 'validation'").count() == 0


def test_group_split_keeps_groups_whole(spark):
    df = spark.range(200).select("id", (F.col("id") % 10).alias("g"))
    out = split.group_split(df, "g")
    assert out.groupBy("g").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0
    assert out.filter("split = 'test'").select("g").distinct().count() == 2
    assert split.group_split(df, "g", max_groups=4).count() == 80


def test_folds_balance_classes(spark):
    df = classes(spark, {"a": 23, "b": 11})
    out = split.cross_validation(df, "y", "id", 5)
    sizes = [r["count"] for r in out.groupBy("fold").count().collect()]
    assert sorted(sizes) == [6, 7, 7, 7, 7]
    nested = split.nested_cross_validation(df, "y", "id", 5, 3)
    assert nested.count() == 34 * 5
    assert nested.filter("role = 'test'").select("id").distinct().count() == 34


def test_rare_classes_never_reach_test(spark):
    out = split.rare_class_split(classes(spark, {"a": 40, "b": 8, "c": 2}), "y", "id")
    assert out.filter("split = 'test'").count() == 10
    assert out.filter("y = 'c' AND split = 'test'").count() == 0


def test_split_quality(spark):
    rows = [("train", "a", 1.0)] * 8 + [("train", "b", 1.0)] * 2 + [("test", "a", 2.0)] * 1 + [("test", "c", 2.0)]
    df = spark.createDataFrame(rows, "split string, y string, v double")
    got = {(r["check"], r["item"]): (round(r["value"], 6), r["flag"]) for r in split.validate_split(df, "y", ["v"]).collect()}
    assert got == {("size_ratio", ""): (0.2, "ok"), ("label_drift", "a"): (0.3, "drift"), ("label_drift", "b"): (0.2, "drift"),
                   ("label_drift", "c"): (0.5, "drift"), ("feature_drift", "v"): (1.0, "drift")}
