"""Class balancing. Random draws are keyed hashes; see ``functions.hashing``.

Samples are returned as ``row_key, label, features, is_synthetic, src_id, copy_no`` where
new points are made, and as the input rows plus ``copy_no`` where rows are only copied or
dropped. Vector columns stay vectors, sparse ones sparse. ``search`` is passed to the neighbour
search of the methods that need one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketloom.functions.hashing import hash_below, hash_unit, keyed_hash
from ticketloom.functions.sparse import between, vector_parts
from ticketloom.functions.vectors import as_array, is_vector
from ticketloom.operators.neighbours import neighbours
from ticketloom.operators.rank import flag_first, flag_lowest, rank_by_hash
from ticketloom.operators.split import SEED, class_counts
from ticketloom.session import measured, settle_table

BALANCED_RATIO = 1.5
CHUNK = 10_000


def _all():
    """A window over a class table, one row per class."""
    return W.partitionBy(F.lit(0))


def class_shares(df: DataFrame, label: str) -> DataFrame:
    """``(label, n, percentage)`` with the percentage over all rows, nulls included."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    share = counts.withColumn("percentage", F.round(F.col("n") / F.sum("n").over(_all()) * 100, 2))
    return share.filter(F.col(label).isNotNull())


def imbalance_summary(df: DataFrame, label: str) -> DataFrame:
    """One row: ratio, extreme classes (ties by name), totals, ``is_balanced``."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    held = F.col(label).isNotNull()
    size = F.when(held, F.col("n"))
    one = counts.agg(
        (F.max(size) / F.min(size)).alias("imbalance_ratio"),
        F.min(F.when(held, F.struct(F.col("n"), F.col(label).alias("c"))))["c"].alias("minority_class"),
        F.min(F.when(held, F.struct(-F.col("n"), F.col(label).alias("c"))))["c"].alias("majority_class"),
        F.sum("n").alias("total_samples"),
        F.count(size).alias("num_classes"),
    )
    return one.withColumn("is_balanced", F.col("imbalance_ratio") <= BALANCED_RATIO)


def over_plan(df: DataFrame, label: str, strategy="auto", at_least: bool = False) -> DataFrame:
    """``(label, n, target)`` for over-sampling: ``auto``, a binary ratio, or class counts; ``at_least`` leaves classes above their count alone."""
    counts = class_counts(df, label)
    top = F.max("n").over(_all())
    if strategy == "auto":
        return counts.withColumn("target", top)
    if isinstance(strategy, dict):
        return _dict_plan(counts, label, strategy, over=True, at_least=at_least)
    _binary_only(counts)
    return counts.withColumn("target", F.when(F.col("n") == top, F.col("n")).otherwise(F.floor(top * F.lit(float(strategy))).cast("bigint")))


def under_plan(df: DataFrame, label: str, strategy="auto") -> DataFrame:
    """``(label, n, target)`` for under-sampling."""
    counts = class_counts(df, label)
    low = F.min("n").over(_all())
    if strategy == "auto":
        return counts.withColumn("target", low)
    if isinstance(strategy, dict):
        return _dict_plan(counts, label, strategy, over=False)
    _binary_only(counts)
    return counts.withColumn("target", F.when(F.col("n") == low, F.col("n")).otherwise(F.floor(low / F.lit(float(strategy))).cast("bigint")))


def _binary_only(counts: DataFrame) -> None:
    if counts.limit(3).count() != 2:
        raise ValueError("a ratio needs exactly two classes")


def _dict_plan(counts: DataFrame, label: str, strategy: dict, over: bool, at_least: bool = False) -> DataFrame:
    wanted = F.col("n")
    for name, size in strategy.items():
        wanted = F.when(F.col(label) == name, F.lit(int(size)).cast("bigint")).otherwise(wanted)
    plan = counts.withColumn("target", F.greatest("n", wanted) if at_least else wanted)
    wrong = plan.filter(F.col("target") < F.col("n") if over else F.col("target") > F.col("n")).first()
    if wrong is not None:
        raise ValueError(f"target for class {wrong[label]!r} lies on the wrong side of its {wrong['n']} rows")
    return plan


def _numbered(plan: DataFrame, size: str, out: str) -> DataFrame:
    """One row per number 1..``size``. Sizes are cut into chunks that are spread over the
    cluster before they are unrolled, so a single large size is many tasks."""
    chunks = plan.filter(F.col(size) > 0).withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({size} - 1) div {CHUNK}"))))
    spread = chunks.repartition(*plan.columns, "_chunk")
    numbers = F.sequence(F.col("_chunk") * CHUNK + 1, F.least(F.col(size), (F.col("_chunk") + 1) * CHUNK))
    return spread.withColumn(out, F.explode(numbers)).drop("_chunk")


def _redraw(df: DataFrame, label: str, id_col: str, sizes: DataFrame, seed: int) -> DataFrame:
    """``draws`` rows per class with replacement; ``sizes`` is ``(label, n, draws)``.

    Draws are summed to a number of copies per drawn rank before they meet the rows, so
    the join is one row to one row however few rows a class has.
    """
    draws = _numbered(sizes.select(label, "n", "draws"), "draws", "_copy")
    pick = hash_below(keyed_hash(seed, F.col(label), F.col("_copy")), F.col("n")) + 1
    times = draws.select(label, pick.alias("_rank")).groupBy(label, "_rank").agg(F.count(F.lit(1)).alias("_times"))
    drawn_classes = measured(sizes.filter("draws > 0").select(label))
    ranked = rank_by_hash(df.join(drawn_classes, label, "left_semi"), [label], keyed_hash(seed, F.col(id_col)), id_col, "_rank")
    hit = ranked.join(times, [label, "_rank"])
    chunks = hit.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_times - 1) div {CHUNK}"))))
    numbers = F.sequence(F.col("_chunk") * CHUNK + 1, F.least(F.col("_times"), (F.col("_chunk") + 1) * CHUNK))
    return chunks.repartition(F.xxhash64(id_col, "_chunk")).withColumn("copy_no", F.explode(numbers)).select(*df.columns, "copy_no")


def random_oversample(df: DataFrame, label: str, id_col: str, strategy="auto", seed: int = SEED, at_least: bool = False) -> DataFrame:
    """All originals (``copy_no`` 0) plus draws with replacement up to the class targets."""
    plan = over_plan(df, label, strategy, at_least).withColumn("draws", F.col("target") - F.col("n"))
    return df.withColumn("copy_no", F.lit(0).cast("bigint")).unionByName(_redraw(df, label, id_col, plan, seed))


def random_undersample(df: DataFrame, label: str, id_col: str, strategy="auto", seed: int = SEED) -> DataFrame:
    """The first ``target`` rows of each class in hash order."""
    quotas = under_plan(df, label, strategy).select(label, F.col("target").alias("quota"))
    return flag_first(df, [label], quotas, keyed_hash(seed, F.col(id_col)), id_col, "_keep").filter("_keep").drop("_keep")


def custom_balanced(
    df: DataFrame, label: str, id_col: str, target: int | None = None, method: str = "oversample", seed: int = SEED
) -> DataFrame:
    """Every class at ``target`` rows (default: the largest class).

    A smaller class is redrawn whole with replacement (its originals may go missing), or
    left alone unless ``method`` is ``oversample``; a larger one is cut without replacement.
    """
    counts = class_counts(df, label)
    goal = F.lit(int(target)).cast("bigint") if target is not None else F.max("n").over(_all())
    plan = counts.withColumn("target", goal)
    redraw = (F.col("n") < F.col("target")) & F.lit(method == "oversample")
    sized = plan.withColumns({
        "draws": F.when(redraw, F.col("target")).otherwise(F.lit(0).cast("bigint")),
        "quota": F.when(redraw, F.lit(0).cast("bigint")).otherwise(F.least("n", "target")),
    })
    kept = flag_first(df, [label], sized.select(label, "quota"), keyed_hash(seed, F.col(id_col)), id_col, "_keep")
    kept = kept.filter("_keep").drop("_keep").withColumn("copy_no", F.lit(0).cast("bigint"))
    return kept.unionByName(_redraw(df, label, id_col, sized.select(label, "n", "draws"), seed))


def _samples(df: DataFrame, label: str, id_col: str, features: str) -> DataFrame:
    base = df.select(F.col(id_col).alias("_id"), F.col(label).alias("label"), F.col(features).alias("features"))
    base = base if is_vector(base, "features") else as_array(base, "features")
    return base.select(
        F.col("_id").cast("string").alias("row_key"), "label", "features", F.lit(False).alias("is_synthetic"),
        F.col("_id").alias("src_id"), F.lit(0).cast("bigint").alias("copy_no"))


def _between(edges: DataFrame) -> Column:
    """The point at ``_u`` between ``x`` and ``y``: arrays in the plan, vectors by merging their index arrays."""
    if edges.schema["x"].dataType.typeName() == "struct":
        return between("x", "y", "_u")
    return F.zip_with("x", "y", lambda a, b: a + F.col("_u") * (b - a))


def _interpolation_edges(rows: DataFrame, id_col: str, label: str, features: str, k: int, search: str) -> DataFrame:
    """``(label, src_id, nn_rank, nn_id, x, y)``: each row with its same-class neighbours."""
    if is_vector(rows, features):
        vectors = rows.select(F.col(id_col).alias("_id"), vector_parts(rows, features).alias("_x"))
    else:
        vectors = as_array(rows.select(F.col(id_col).alias("_id"), F.col(features).alias("_x")), "_x")
    near = neighbours(rows, rows, k, id_col, features, group_col=label, search=search).select(F.col(id_col).alias("src_id"), "nn_rank", "nn_id")
    own = rows.select(F.col(id_col).alias("src_id"), F.col(label).alias("label"))
    return (
        near.join(own, "src_id")
        .join(vectors.select(F.col("_id").alias("src_id"), F.col("_x").alias("x")), "src_id")
        .join(vectors.select(F.col("_id").alias("nn_id"), F.col("_x").alias("y")), "nn_id")
    )


def _enough_neighbours(plan: DataFrame, label: str, k: int) -> None:
    small = plan.filter((F.col("draws") > 0) & (F.col("n") <= k)).first()
    if small is not None:
        raise ValueError(f"class {small[label]!r} has {small['n']} rows; {k} neighbours need more than {k}")


def smote(
    df: DataFrame, label: str, id_col: str, features: str = "features", strategy="auto", k: int = 5, seed: int = SEED, search: str = "exact"
) -> DataFrame:
    """Originals plus points between a drawn row and one of its k same-class neighbours.

    A draw picks one of the n*k (row, neighbour) slots of its class and a position u. Slots
    drawn very often are replicated and draws salted, so few slots still spread.
    """
    plan = over_plan(df, label, strategy).withColumn("draws", F.col("target") - F.col("n"))
    _enough_neighbours(plan, label, k)
    plan = plan.filter("draws > 0").withColumn("_salts", F.expr(f"1 + draws div (n * {k * CHUNK})"))
    rows = df.join(measured(plan.select(label)), label, "left_semi")
    ranked = rank_by_hash(rows.select(label, id_col), [label], keyed_hash(seed, F.col(id_col)), id_col, "_rank")
    edges = _interpolation_edges(rows, id_col, label, features, k, search).join(
        ranked.select(F.col(id_col).alias("src_id"), "_rank"), "src_id")
    edges = edges.withColumn("_slot", (F.col("_rank") - 1) * k + F.col("nn_rank") - 1)
    salts = measured(plan.select(F.col(label).alias("label"), "_salts"))
    edges = edges.join(salts, "label").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_salts") - 1)))
    draws = _numbered(plan.select(F.col(label).alias("label"), "n", "draws", "_salts"), "draws", "copy_no")
    draws = draws.select(
        "label", "copy_no",
        hash_below(keyed_hash(seed, F.col("label"), F.col("copy_no")), F.col("n") * k).alias("_slot"),
        hash_unit(keyed_hash(seed, F.lit("u"), F.col("label"), F.col("copy_no"))).alias("_u"),
        F.pmod("copy_no", "_salts").alias("_salt"),
    )
    picked = draws.join(edges.select("label", "_slot", "_salt", "src_id", "x", "y"), ["label", "_slot", "_salt"])
    new = picked.select(
        F.concat_ws("|", F.lit("s"), F.col("label").cast("string"), F.col("copy_no").cast("string")).alias("row_key"),
        "label", _between(picked).alias("features"), F.lit(True).alias("is_synthetic"), "src_id", "copy_no")
    return _samples(df, label, id_col, features).unionByName(new)


def adasyn_allocation(
    df: DataFrame, label: str, id_col: str, features: str = "features", strategy="auto", k: int = 5, search: str = "exact"
) -> DataFrame:
    """``(id, label, other_neighbours, n_new)``: new points per row of each short class.

    A row's share follows the number of other-class rows among its k neighbours. Whole
    numbers throughout; halves round to even.
    """
    plan = over_plan(df, label, strategy).withColumn("draws", F.col("target") - F.col("n")).filter("draws > 0")
    short = df.join(measured(plan.select(label)), label, "left_semi").select(id_col, label, features)
    near = neighbours(short, df, k, id_col, features, search=search)
    classes = df.select(F.col(id_col).alias("nn_id"), F.col(label).alias("_other"))
    mixed = near.join(classes, "nn_id").join(short.select(id_col, label), id_col)
    per_row = mixed.groupBy(id_col, label).agg(F.sum((F.col("_other") != F.col(label)).cast("bigint")).alias("other_neighbours"))
    sums = per_row.groupBy(label).agg(F.sum("other_neighbours").alias("_sum")).join(plan.select(label, "draws"), label)
    stuck = sums.filter(F.col("_sum") == 0).first()
    if stuck is not None:
        raise ValueError(f"no neighbour of class {stuck[label]!r} belongs to another class; SMOTE fits better")
    sized = per_row.join(measured(sums), label)
    whole = F.expr("(other_neighbours * draws) div _sum")
    rest = 2 * F.pmod(F.col("other_neighbours") * F.col("draws"), F.col("_sum"))
    up = (rest > F.col("_sum")) | ((rest == F.col("_sum")) & (F.pmod(whole, F.lit(2)) == 1))
    return sized.select(id_col, label, "other_neighbours", (whole + up.cast("bigint")).alias("n_new"))


def adasyn(
    df: DataFrame, label: str, id_col: str, features: str = "features", strategy="auto", k: int = 5, seed: int = SEED, search: str = "exact"
) -> DataFrame:
    """Like :func:`smote`, with the new points given to rows among other classes."""
    shares = settle_table(adasyn_allocation(df, label, id_col, features, strategy, k, search), "adasyn")
    short = df.join(measured(shares.select(label).distinct()), label, "left_semi")
    edges = _interpolation_edges(short, id_col, label, features, k, search)
    wanted = _numbered(shares.filter("n_new > 0").select(F.col(id_col).alias("src_id"), "n_new"), "n_new", "copy_no")
    draws = wanted.select(
        "src_id", "copy_no",
        (hash_below(keyed_hash(seed, F.col("src_id"), F.col("copy_no")), F.lit(k)) + 1).cast("int").alias("nn_rank"),
        hash_unit(keyed_hash(seed, F.lit("u"), F.col("src_id"), F.col("copy_no"))).alias("_u"))
    picked = draws.join(edges, ["src_id", "nn_rank"])
    new = picked.select(
        F.concat_ws("|", F.lit("s"), F.col("src_id").cast("string"), F.col("copy_no").cast("string")).alias("row_key"),
        "label", _between(picked).alias("features"), F.lit(True).alias("is_synthetic"), "src_id", "copy_no")
    return _samples(df, label, id_col, features).unionByName(new)


def _minority(plan: DataFrame, label: str):
    return plan.orderBy("n", label).first()[label]


def nearmiss(
    df: DataFrame, label: str, id_col: str, features: str = "features", strategy="auto", version: int = 1, n_neighbors: int = 3, seed: int = SEED,
    search: str = "exact",
) -> DataFrame:
    """Cut the larger classes down to the rows nearest the smallest class.

    Version 1 averages the distances to the nearest minority rows, 2 to the farthest. 3
    first keeps rows that are a near neighbour of some minority row, then the farthest of
    those on average. Mean distances are rounded to 9 digits; ties go in hash order.
    """
    if version not in (1, 2, 3):
        raise ValueError(f"unknown version: {version}")
    plan = under_plan(df, label, strategy)
    rare = _minority(plan, label)
    minority, others = df.filter(F.col(label) == F.lit(rare)), df.filter(F.col(label) != F.lit(rare))
    if version == 3:
        # One search for all classes: every minority row asks once in each class it is compared with.
        rivals = [r[label] for r in plan.filter(F.col(label) != F.lit(rare)).select(label).collect()]
        asking = minority.withColumn("_rival", F.explode(F.array(*[F.lit(str(c)) for c in rivals])))
        asking = asking.select(F.concat_ws("|", F.col(id_col).cast("string"), "_rival").alias(id_col), features, "_rival")
        held = others.select(id_col, features, F.col(label).cast("string").alias("_rival"))
        near_minority = neighbours(asking, held, n_neighbors, id_col, features, group_col="_rival", exclude_self=False, search=search)
        chosen = near_minority.select(F.col("nn_id").alias(id_col)).distinct()
        others = others.join(settle_table(chosen, "nearmiss"), id_col, "left_semi")
    near = neighbours(others, minority, n_neighbors, id_col, features, farthest=version == 2, exclude_self=False, search="exact" if version == 2 else search)
    mean = near.groupBy(id_col).agg(F.round(F.avg("distance"), 9).alias("_mean"))
    scored = settle_table(others.select(id_col, label).join(mean, id_col), "nearmiss")
    quotas = plan.filter(F.col(label) != F.lit(rare)).select(label, F.col("target").alias("quota"))
    if version == 3:
        have = class_counts(scored, label).withColumnRenamed("n", "_have")
        quotas = quotas.join(have, label).select(label, F.least("quota", "_have").alias("quota"))
    kept = flag_lowest(scored, [label], "_mean", quotas, keyed_hash(seed, F.col(id_col)), id_col, "_keep", descending=version == 3)
    return df.join(kept.filter("_keep").select(id_col), id_col, "left_semi").unionByName(minority)


def tomek_links(df: DataFrame, label: str, id_col: str, features: str = "features", search: str = "exact") -> DataFrame:
    """``(id, mate)``: rows of different classes that are each other's nearest row."""
    near = neighbours(df, df, 1, id_col, features, search=search).select(F.col(id_col).alias("a"), F.col("nn_id").alias("b"))
    back = near.select(F.col("a").alias("b"), F.col("b").alias("a"))
    pairs = near.join(back, ["a", "b"])
    classes = df.select(F.col(id_col), F.col(label).alias("_l"))
    pairs = pairs.join(classes.select(F.col(id_col).alias("a"), F.col("_l").alias("_la")), "a")
    pairs = pairs.join(classes.select(F.col(id_col).alias("b"), F.col("_l").alias("_lb")), "b")
    return pairs.filter(F.col("_la") != F.col("_lb")).select(F.col("a").alias(id_col), F.col("b").alias("mate"), F.col("_la").alias(label))


def tomek_undersample(df: DataFrame, label: str, id_col: str, features: str = "features", both: bool = False, search: str = "exact") -> DataFrame:
    """Drop the members of Tomek links, sparing the smallest class unless ``both``."""
    linked = tomek_links(df, label, id_col, features, search)
    if not both:
        linked = linked.filter(F.col(label) != F.lit(_minority(class_counts(df, label), label)))
    return df.join(linked.select(id_col), id_col, "left_anti")


def smote_tomek(
    df: DataFrame, label: str, id_col: str, features: str = "features", strategy="auto", k: int = 5, seed: int = SEED, search: str = "exact"
) -> DataFrame:
    """SMOTE, then both members of every Tomek link dropped."""
    grown = settle_table(smote(df, label, id_col, features, strategy, k, seed, search), "smote")
    return tomek_undersample(grown, "label", "row_key", "features", both=True, search=search)


def smote_enn(
    df: DataFrame, label: str, id_col: str, features: str = "features", strategy="auto", k: int = 5, n_neighbors: int = 3, seed: int = SEED,
    search: str = "exact",
) -> DataFrame:
    """SMOTE, then rows with any of 3 neighbours in another class dropped."""
    grown = settle_table(smote(df, label, id_col, features, strategy, k, seed, search), "smote")
    near = neighbours(grown, grown, n_neighbors, "row_key", "features", search=search)
    classes = grown.select("row_key", "label")
    mixed = near.join(classes, "row_key").join(classes.select(F.col("row_key").alias("nn_id"), F.col("label").alias("_other")), "nn_id")
    noisy = mixed.filter(F.col("label") != F.col("_other")).select("row_key").distinct()
    return grown.join(noisy, "row_key", "left_anti")


def auto_balance(
    df: DataFrame, label: str, id_col: str, features: str = "features", prefer_oversampling: bool = True, seed: int = SEED
) -> DataFrame:
    """Balanced tables come back as they are; else random over-sampling, or, if not
    preferred, random under-sampling for two classes and NearMiss for more."""
    summary = imbalance_summary(df, label).first()
    if summary["is_balanced"]:
        return df.withColumn("copy_no", F.lit(0).cast("bigint"))
    if prefer_oversampling:
        return random_oversample(df, label, id_col, seed=seed)
    small = random_undersample(df, label, id_col, seed=seed) if summary["num_classes"] == 2 else nearmiss(df, label, id_col, features, seed=seed)
    return small.withColumn("copy_no", F.lit(0).cast("bigint"))


BALANCERS = {
    "original": lambda df, label, id_col, features: df,
    "auto": auto_balance,
    "random_oversample": lambda df, label, id_col, features: random_oversample(df, label, id_col),
    "random_undersample": lambda df, label, id_col, features: random_undersample(df, label, id_col),
    "custom": lambda df, label, id_col, features: custom_balanced(df, label, id_col),
    "smote": smote,
    "adasyn": adasyn,
    "nearmiss": nearmiss,
    "tomek": tomek_undersample,
    "smote_tomek": smote_tomek,
    "smote_enn": smote_enn,
}

COMPARED = ("original", "random_oversample", "random_undersample", "smote", "adasyn")


def compare_methods(df: DataFrame, label: str, id_col: str, features: str = "features", methods: tuple[str, ...] = COMPARED) -> DataFrame:
    """One row per known method: rows, features, imbalance ratio, is_balanced."""
    from ticketloom.functions.vectors import width_of

    width, out = width_of(df, features), None
    for name in [m for m in methods if m in BALANCERS]:
        grown = BALANCERS[name](df, label, id_col, features)
        column = label if label in grown.columns else "label"
        row = imbalance_summary(grown, column).select(
            F.lit(name).alias("method"), F.col("total_samples").alias("samples"), F.lit(width).cast("bigint").alias("features"),
            "imbalance_ratio", "is_balanced")
        out = row if out is None else out.unionByName(row)
    return out
