"""Solvers, searches and stores against numpy or brute force, and the same results in one block and in many."""

import re

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import functions as F

from ticketloom.operators import balance, boosting, cluster, decompose, evaluate, kernel, logistic, memo, models, neighbours, translate
from ticketloom.plans import flow
from ticketloom.streaming.scoring import score_stream, scored_rows


def sparse(x):
    at = np.flatnonzero(x)
    return Vectors.sparse(len(x), at.tolist(), x[at].tolist())


def planted(spark, k, n=240, d=10, seed=0):
    """Half-empty rows whose class follows from three columns, with some noise."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * (rng.random((n, d)) < 0.5)
    s = 2 * x[:, 0] + x[:, 1] * x[:, 2] + 0.3 * rng.normal(size=n)
    y = np.digitize(s, [-0.5, 0.7]) if k == 3 else (s > 0).astype(int)
    return x, y, spark.createDataFrame([(i, sparse(v), int(c)) for i, (v, c) in enumerate(zip(x, y))], ["id", "features", "label"])


# ---- logistic regression ---------------------------------------------------------------

@pytest.mark.parametrize("k", [2, 3])
def test_dual_solver_reaches_sparks_optimum(spark, k):
    _, _, df = planted(spark, k)
    n = df.count()
    want = LogisticRegression(family="multinomial" if k > 2 else "binomial", maxIter=500, tol=1e-10, regParam=1.0 / n, standardization=False).fit(df)
    for entries, tol in ((10**6, 1e-4), (700, 1e-2)):
        solver = logistic.DualLogistic(block_entries=entries, tol=tol, max_iter=40)
        model = solver.fit(df.repartition(3))
        assert (solver.blocks > 1) == (entries == 700) and solver.gap <= tol
        a, b = (np.vstack([r["probability"].toArray() for r in m.transform(df).orderBy("id").collect()]) for m in (want, model))
        assert np.abs(a - b).mean() < 200 * tol**2 + 0.002


def test_dual_solver_on_odd_tables(spark):
    same = spark.createDataFrame([(i, Vectors.sparse(5, [], []), 0) for i in range(4)], ["id", "features", "label"])
    assert {r["prediction"] for r in logistic.DualLogistic().fit(same).transform(same).collect()} == {0.0}
    with pytest.raises(ValueError):
        logistic.DualLogistic().fit(same.limit(0))
    with pytest.raises(ValueError):
        logistic.DualLogistic().fit(same.withColumn("label", F.lit(-1)))


# ---- boosting --------------------------------------------------------------------------

LEVELS = boosting.BoostRule(rounds=3, depth=3, bins=8)
LEAVES = boosting.BoostRule(rounds=3, rate=0.2, depth=60, leaves=6, l2=0.0, min_hessian=1e-3, min_rows=8, bins=16, top=0.3, other=0.2)


@pytest.mark.parametrize("rule", [LEVELS, LEAVES], ids=["levels", "leaves"])
def test_trees_do_not_depend_on_blocks(spark, rule):
    x, y, df = planted(spark, 3)
    one, many = boosting.Booster(rule).fit(df), boosting.Booster(rule, block_entries=500).fit(df.repartition(5))
    key = lambda m: sorted((r[:4], None if r[4] is None else round(r[4], 9), None if r[5] is None else round(r[5], 9)) for r in m.nodes)
    assert key(one) == key(many) and np.allclose(one.losses, many.losses)
    assert all(b < a for a, b in zip(one.losses, one.losses[1:])) and {r[1] for r in one.nodes} == {0, 1, 2}
    p = np.vstack([r["probability"] for r in one.transform(df).orderBy("id").collect()])
    assert np.isclose(-np.log(p[np.arange(len(y)), y]).mean(), one.losses[-1])
    leaves = {}
    for r in one.nodes:
        if r[3] < 0:
            leaves.setdefault(r[:2], []).append(r[2])
    assert all(len(v) <= (rule.leaves or 2**rule.depth) for v in leaves.values())
    assert all((at + 1).bit_length() - 1 <= rule.depth for v in leaves.values() for at in v)


def test_blocks_are_few_and_rarely_written(spark, monkeypatch):
    """A large table is spread over a fixed number of blocks, written once in some rounds and not in each."""
    _, _, df = planted(spark, 3)
    rule, written = boosting.BoostRule(rounds=9, depth=1, bins=4), []
    monkeypatch.setattr(boosting, "settle_table", lambda df, *a, _keep=boosting.settle_table, **k: written.append(_keep(df, *a, **k)) or written[-1])
    many = boosting.Booster(rule, block_entries=500).fit(df)
    assert len(written) == 2 and all(1 < w.count() <= boosting.PARTS for w in written)
    assert np.allclose(many.losses, boosting.Booster(rule).fit(df).losses)


def test_best_split_equals_brute_force():
    rng = np.random.default_rng(4)
    zero = np.array([1, 0, 2])
    rule = boosting.BoostRule(l2=1.0, min_hessian=0.5, min_rows=2)
    for _ in range(30):
        bins, g, h = rng.integers(0, 4, (40, 3)), rng.normal(size=40), rng.random(40)
        cells = {}
        for i in range(40):
            for f in range(3):
                if bins[i, f] != zero[f] or rng.random() < 0.3:  # explicit entries may also lie in the bin of zeros
                    s = cells.setdefault((f, bins[i, f]), np.zeros(3))
                    s += [g[i], h[i], 1]
        keys = sorted(cells)
        got = boosting.best_split(np.array([k[0] for k in keys]), np.array([k[1] for k in keys]), np.array([cells[k] for k in keys]).T, (g.sum(), h.sum(), 40), zero, rule)
        best = None
        for f in range(3):
            for b in range(3):
                left = bins[:, f] <= b
                if min(left.sum(), (~left).sum()) < 2 or min(h[left].sum(), h[~left].sum()) < 0.5:
                    continue
                score = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1)
                gain = 0.5 * (score(left) + score(~left) - score(np.ones(40, bool)))
                if gain > 0 and (best is None or gain > best + 1e-12):
                    best = gain
        assert (got is None) == (best is None) and (got is None or np.isclose(got.gain, best))


@pytest.mark.parametrize("name", ["xgboost", "lightgbm", "svm", "knn", "logistic_regression"])
def test_saved_models_predict_alike(spark, tmp_path, name):
    _, _, df = planted(spark, 3, n=90)
    bench = models.ModelBench()
    small = {"xgboost": {"n_estimators": 3}, "lightgbm": {"n_estimators": 3}, "svm": {"landmarks": 20}}
    bench.fit(df, name, small.get(name))
    path, kind = str(tmp_path / name), bench.kind(name)
    bench.save(name, path)
    bench.load(path, "again", kind=kind, k=5 if kind == "knn" else None)
    a, b = (sorted((r["id"], r["prediction"], [round(v, 9) for v in r["probability"]]) for r in bench.predict(df, n, True).collect()) for n in (name, "again"))
    assert a == b and all(abs(sum(p) - 1) < 1e-6 for _, _, p in a)


# ---- kernel machine --------------------------------------------------------------------

@pytest.mark.parametrize("k", [2, 3])
def test_kernel_machine_is_calibrated(spark, k):
    x, y, df = planted(spark, k, n=300)
    train, test = df.where("id < 200"), df.where("id >= 200")
    model = kernel.KernelMachine(landmarks=60).fit(train)
    rows = sorted(model.transform(test).collect(), key=lambda r: r["id"])
    p, s, held = np.array([r["probability"] for r in rows]), np.array([r["rawPrediction"] for r in rows]), y[200:]
    assert np.allclose(p.sum(1), 1)
    assert np.mean([r["prediction"] == c for r, c in zip(rows, held)]) > np.bincount(held).max() / len(held)
    plain = 1 / (1 + np.exp(-s))
    plain = np.concatenate([1 - plain, plain], axis=1) if k == 2 else plain / plain.sum(1, keepdims=True)
    loss = lambda q: -np.log(q[np.arange(len(held)), held]).mean()
    assert loss(p) < loss(plain)


# ---- neighbours, DBSCAN, samplers ------------------------------------------------------

@pytest.mark.parametrize("width", [20_000, 12])
def test_sparse_neighbours_equal_brute_force(spark, width):
    rng = np.random.default_rng(5)
    x = np.zeros((120, width))
    for row in x:
        row[rng.choice(min(width, 400), 6, replace=False)] = rng.random(6).round(2)
    x[7] = x[3]
    x[9] = 0
    df = spark.createDataFrame([(i, sparse(v)) for i, v in enumerate(x)], ["id", "features"])
    got = {(r["id"], r["nn_rank"]): (r["nn_id"], r["distance"]) for r in neighbours.neighbours(df, df, 4, block_rows=32).collect()}
    d = np.round(np.sqrt(((x[:, None, :min(width, 400)] - x[None, :, :min(width, 400)]) ** 2).sum(2)), 9)
    for i in range(120):
        want = sorted((d[i, j], j) for j in range(120) if j != i)[:4]
        assert [got[i, r][0] for r in range(1, 5)] == [j for _, j in want]
        assert np.allclose([got[i, r][1] for r in range(1, 5)], [v for v, _ in want], atol=2e-9)


def test_sparse_rows_never_become_matrices():
    from ticketloom.functions.sparse import Rows

    wide = Rows(20_000, None, np.array([0, 2, 3]), np.array([5, 19_999, 5]), np.array([1.0, 2.0, 3.0]))
    assert wide.take(np.array([1, 0])).matrix is None and wide.narrow().matrix is None
    assert wide.dots(wide).tolist() == [[5.0, 3.0], [3.0, 9.0]]
    assert wide.fine(np.array([0]), wide, np.array([1]), 9).tolist() == [round(8 ** 0.5, 9)]


def test_approximate_search_finds_most_neighbours(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(30, 8)).repeat(20, axis=0) * 5 + rng.normal(size=(600, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, features array<double>")
    pairs = lambda how: {(r["id"], r["nn_id"]) for r in neighbours.neighbours(df, df, 5, search=how).collect()}
    exact, near = pairs("exact"), pairs("approximate")
    assert len(near) == len(exact) == 3000 and len(near & exact) >= 0.9 * len(exact)


def test_smote_keeps_sparse_rows_sparse(spark):
    rng = np.random.default_rng(7)
    x = np.zeros((40, 20_000))
    for row in x:
        row[rng.choice(300, 5, replace=False)] = rng.random(5)
    df = spark.createDataFrame([(i, sparse(v), int(i < 10)) for i, v in enumerate(x)], ["id", "features", "label"])
    out = {r["row_key"]: r for r in balance.smote(df, "label", "id", search="exact").collect()}
    small = spark.createDataFrame([(i, v[:300].tolist(), int(i < 10)) for i, v in enumerate(x)], "id long, features array<double>, label int")
    want = {r["row_key"]: r for r in balance.smote(small, "label", "id").collect()}
    assert out.keys() == want.keys() and len(out) == 60
    for key, r in out.items():
        assert isinstance(r["features"], SparseVector) and r["features"].size == 20_000 and len(r["features"].indices) <= 10
        assert np.allclose(r["features"].toArray()[:300], want[key]["features"])


def test_dbscan_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(0, 0.3, (60, 2)), rng.normal(4, 0.3, (40, 2)), rng.uniform(-3, 8, (25, 2)), np.zeros((8, 2))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, features array<double>")
    got = {r["id"]: (r["cluster"], r["is_core"]) for r in cluster.dbscan(df, "id", eps=0.5, min_samples=5, block_rows=20).collect()}
    near = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) <= 0.5
    core = near.sum(1) >= 5
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.array([min(label[j] for j in np.flatnonzero(near[i] & core)) if core[i] else label[i] for i in range(len(x))])
    for i in range(len(x)):
        reach = [label[j] for j in np.flatnonzero(near[i] & core)]
        assert got[i] == ((min(reach) if reach else None), bool(core[i]))


def test_components_of_chains_stars_and_pairs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 150)] + [(201, 200), (300, 300)]
    got = {r["_a"]: r["_b"] for r in cluster.connected(spark.createDataFrame(edges, "_a long, _b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{j: 100 for j in range(101, 150)}, 201: 200}
    assert cluster.connected(spark.createDataFrame([], "_a long, _b long")).count() == 0


# ---- decompositions, memo, profiles ----------------------------------------------------

@pytest.mark.parametrize("centre", [False, True])
def test_randomised_decomposition_finds_a_planted_rank(spark, centre):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(80, 4)) @ rng.normal(size=(4, 300)) + (3.0 if centre else 0.0)
    df = spark.createDataFrame([(i, sparse(v)) for i, v in enumerate(x)], ["id", "features"])
    found = decompose.truncated_svd(df, "features", 6, centre=centre)
    want = np.linalg.svd(x - x.mean(0) if centre else x, compute_uv=False)
    assert np.allclose(found.values[:4], want[:4], rtol=1e-8) and np.all(found.values[4:] < 1e-4 * want[0])
    got = np.vstack([r["p"].toArray() for r in df.select("id", found.project(df, "features").alias("p")).orderBy("id").collect()])
    assert np.allclose(got, x @ found.right)


def test_unseen_texts_only(spark):
    known = spark.createDataFrame([(f"text {i}", "x") for i in range(500)], "text string, translated string")
    asked = spark.createDataFrame([(f"text {i}", i) for i in range(480, 520)] + [("text 510", 1), (None, 2)], "text string, n int")
    got = sorted(r["text"] or "" for r in memo.unseen(asked, "text", known).collect())
    assert got == sorted(["", "text 510"] + [f"text {i}" for i in range(500, 520)])
    tiny = memo.BloomFilter.of(known.select("text"), "text")
    assert tiny.bits == 8192 and len(tiny.words) * 64 == tiny.bits


def test_memo_store_writes_only_what_it_lacked(spark, tmp_path):
    asked = []
    store = memo.MemoStore(spark, str(tmp_path / "memo"))
    for texts in (["a", "b"], ["b", "c"], ["c"]):
        df = spark.createDataFrame([(t, "fr") for t in texts], "text string, lang string")
        asked.append(sorted(r["text"] for r in translate.new_entries(store.table(), df, lambda ts, ls: [t * 2 for t in ts]).collect()))
        translate.extend_store(store, df, lambda ts, ls: [t * 2 for t in ts])
    assert asked == [["a", "b"], ["c"], []]
    assert sorted((r["text"], r["translated"]) for r in store.table().collect()) == [("a", "aa"), ("b", "bb"), ("c", "cc")]


def test_split_join_equals_plain_join(spark):
    words = spark.createDataFrame([(i, w) for i in range(300) for w in ("the", f"w{i}", f"x{i % 40}")], "id long, word string")
    profile = spark.createDataFrame([("en", "the", 5), ("fr", "the", 2), ("en", "w7", 9), ("fr", "x3", 1)], "lang string, word string, weight int")
    got = sorted(tuple(r) for r in translate.meet_profile(words, profile).select("id", "word", "lang", "weight").collect())
    assert got == sorted(tuple(r) for r in words.join(profile, "word").select("id", "word", "lang", "weight").collect())


# ---- streams and reports ---------------------------------------------------------------

class PointFlow:
    """What ``score_stream`` needs of a flow, over points instead of texts."""

    def __init__(self, bench, name):
        self.bench, self.name = bench, name

    def by_batch(self, model_name=None):
        return isinstance(self.bench.get(model_name or self.name), models.NeighbourModel)

    def transform(self, df, model_name=None, keep=None):
        return self.bench.get(model_name or self.name).transform(df).select(*keep, "prediction")


def test_stream_of_neighbour_votes_equals_table(spark, tmp_path):
    x, y, df = planted(spark, 3, n=120)
    dense = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, y))], "id long, features array<double>, label int")
    source = str(tmp_path / "in")
    dense.where("id >= 60").drop("label").repartition(3).write.parquet(source)
    bench = models.ModelBench()
    bench.fit(dense.where("id < 60"), "knn")
    model = PointFlow(bench, "knn")
    stream = spark.readStream.schema("id long, features array<double>").option("maxFilesPerTrigger", 1).parquet(source)
    path = str(tmp_path / "out")
    score_stream(model, stream, ["id"], path, str(tmp_path / "log")).awaitTermination()
    score_stream(model, stream, ["id"], path, str(tmp_path / "log")).awaitTermination()  # nothing new
    want = model.transform(dense.where("id >= 60").drop("label"), keep=["id"])
    assert sorted(tuple(r) for r in scored_rows(spark, path).collect()) == sorted(tuple(r) for r in want.collect())


def test_report_names_its_classes(spark):
    df = spark.createDataFrame([(0, 0.0, 0.0), (1, 1.0, 0.0), (2, 1.0, 1.0)], "id long, label double, prediction double")
    text = evaluate.evaluation_report(df, class_names=["calm", "angry"])
    assert "### calm" in text and "### angry" in text and "Class_" not in text
    assert "### Class_1.0" in evaluate.evaluation_report(df)
    assert {r["name"] for r in evaluate.classification_report(df, class_names=["calm", "angry"]).collect()} >= {"calm", "angry"}


def test_models_side_by_side_are_remembered_in_order(spark):
    _, _, df = planted(spark, 2, n=80)
    bench = models.ModelBench()
    bench.fit_many(df, ["naive_bayes", "decision_tree", "logistic_regression"], parallelism=3)
    assert "naive_bayes" in bench.errors  # negative values
    assert list(bench.trained) == ["decision_tree", "logistic_regression"]
    assert flow.load_config({"modeling": {"parallelism": 2}})["modeling"]["parallelism"] == 2


def test_a_query_travels_to_parts_not_to_cells(spark):
    """Rows without structure open nearly every cell; they are still copied once per part, and the result is exact."""
    x = np.random.default_rng(5).normal(size=(900, 24))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, features array<double>")
    points = neighbours._shaped(df, "id", "features", None).drop("_v")
    cells, _ = neighbours.build_cells(points, 6)
    visits = neighbours.route(points, cells, 6, block_rows=300).groupBy("_id").count().agg(F.max("count")).first()[0]
    assert len(cells.leaves) >= 25 and visits <= 4
    d = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), 9)
    np.fill_diagonal(d, np.inf)
    for far in (False, True):
        got = {(r["id"], r["nn_rank"]): r["nn_id"] for r in neighbours.neighbours(df, df, 5, farthest=far, block_rows=300).collect()}
        want = np.argsort(np.where(np.isinf(d), np.inf, -d) if far else d, axis=1, kind="stable")[:, :5]
        assert got == {(i, r + 1): want[i, r] for i in range(900) for r in range(5)}


@pytest.mark.parametrize("n", [25_000, 50_000, 100_000, 500_000])
def test_parts_do_not_follow_the_table(n):
    """What a search moves is a table times its parts: from some 25,000 rows on there are six."""
    cells = neighbours.Cells.around(neighbours.Rows(2, np.random.default_rng(1).normal(size=(100, 2))), 2)
    cells.width, share = 64.0, n // 100
    cells.summarise("", [{"_cell": i, "n": share, "near": 0.0, "far": 1.0, "top_near": 0.0, "top_far": 1.0, "small": [0.0]} for i in range(100)])
    cells.deal(neighbours.BLOCK_ROWS)
    assert 6 <= len(cells.groups[""]["spans"]) <= 7


def test_searches_move_single_precision_as_it_is(spark):
    """Vectors of floats are widened in the task and not before they are moved; the neighbours stay those of doubles."""
    x = np.random.default_rng(3).normal(size=(120, 4)).astype(np.float32)
    wide = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, features array<double>")
    narrow = wide.withColumn("features", F.col("features").cast("array<float>"))
    assert neighbours._shaped(narrow, "id", "features", None).schema["_x"].dataType["values"].dataType.elementType.typeName() == "float"
    assert sorted(neighbours.neighbours(narrow, narrow, 3).collect()) == sorted(neighbours.neighbours(wide, wide, 3).collect())


def test_silhouette_copies_a_table_some_times(spark):
    """The number of blocks, and so of copies of every row, does not follow the table."""
    df = spark.range(30_000).select("id", F.array(F.col("id").cast("double")).alias("features"), (F.col("id") % 3).alias("label"))
    plan = cluster.silhouette_by_row(df, "id", "label")._jdf.queryExecution().analyzed().toString()
    blocks = {int(n) for n in re.findall(r"pmod\(xxhash64\(_id#\d+L?, \d+\), cast\((\d+)L? as bigint\)", plan)} | {int(n) for n in re.findall(r"sequence\(0, (\d+),", plan)}
    assert blocks and max(blocks) <= neighbours.PARTS


@pytest.mark.parametrize("entries", [boosting.BLOCK_ENTRIES, 8_000])
def test_trees_do_not_depend_on_the_partitioning(spark, entries):
    """Cuts of more values than a sketch keeps apart, and sums over several blocks, are the same in any order."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(a), float(b)], int(a + 0.3 * c > 0)) for i, (a, b, c) in enumerate(rng.normal(size=(12_000, 3)))]
    df = spark.createDataFrame(rows, "id long, features array<double>, label int")
    rule = boosting.BoostRule(rounds=2, depth=4, min_hessian=1e-3)
    fits = [boosting.Booster(rule, block_entries=entries).fit(part).nodes for part in (df.coalesce(1), df.repartition(7))]
    assert sorted(map(str, fits[0])) == sorted(map(str, fits[1]))


@pytest.mark.parametrize("k", [2, 3])
def test_narrow_logit_takes_few_rounds_in_many_blocks(spark, k):
    _, _, df = planted(spark, k, n=400)
    want = LogisticRegression(family="multinomial" if k > 2 else "binomial", maxIter=500, tol=1e-10, regParam=1.0 / 400, standardization=False).fit(df)
    solver = logistic.DualLogistic(block_entries=300, tol=1e-6)
    model = solver.fit(df.repartition(3))
    assert solver.blocks > 5 and solver.rounds < 12 and solver.gap <= 1e-6
    a, b = (np.vstack([r["probability"].toArray() for r in m.transform(df).orderBy("id").collect()]) for m in (want, model))
    assert np.abs(a - b).max() < 2e-3
    wide = logistic.DualLogistic(block_entries=300, tol=1e-2, max_iter=40, newton_width=0)
    wide.fit(df)
    assert wide.gap <= 1e-2


def test_wide_logit_reads_several_blocks_without_rewriting_them(spark, monkeypatch):
    _, _, df = planted(spark, 3, n=400)
    want = LogisticRegression(family="multinomial", maxIter=500, tol=1e-10, regParam=1.0 / 400, standardization=False).fit(df)
    written, kept = [], logistic.settle_table
    monkeypatch.setattr(logistic, "settle_table", lambda df, name, **options: written.append(name) or kept(df, name, **options))
    solver = logistic.DualLogistic(block_entries=1000, newton_width=0, tol=1e-5)
    model = solver.fit(df.repartition(3))
    assert solver.blocks > 1 and solver.gap <= 1e-5 and len(written) == 1
    a, b = (np.vstack([r["probability"].toArray() for r in m.transform(df).orderBy("id").collect()]) for m in (want, model))
    assert np.abs(a - b).max() < 2e-2
