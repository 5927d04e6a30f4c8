"""Train/test splits and folds, keyed by hashes and exact in size."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketloom.functions.hashing import keyed_hash
from ticketloom.operators.rank import flag_first, hash_cuts, rank_by_hash, time_cut, time_key
from ticketloom.session import measured

SEED = 42


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class, nulls left out."""
    return df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def test_quotas(counts: DataFrame, label: str, test_size: float) -> DataFrame:
    """Test rows per class by largest remainder, ties by class name; total ``ceil(n*t)``.

    Works in whole numbers on the class table, one row per class.
    """
    everything = W.partitionBy(F.lit(0))
    sized = counts.withColumn("_total", F.sum("n").over(everything))
    sized = sized.withColumn("_test", F.ceil(F.col("_total") * F.lit(float(test_size))).cast("bigint"))
    share = F.col("n") * F.col("_test")
    sized = sized.withColumns({
        "_floor": F.expr("(n * _test) div _total"),
        "_rest": F.pmod(share, F.col("_total")),
    })
    missing = F.col("_test") - F.sum("_floor").over(everything)
    place = F.row_number().over(everything.orderBy(F.desc("_rest"), label))
    return sized.select(label, "n", (F.col("_floor") + (place <= missing).cast("bigint")).alias("quota"))


def _split_column(flag: str) -> Column:
    return F.when(F.col(flag), "test").otherwise("train")


def basic_split(
    df: DataFrame, label: str | None, id_col: str, test_size: float = 0.2, stratify: bool = True, seed: int | str = SEED
) -> DataFrame:
    """Add ``split``. Stratified when there is more than one class.

    Per class the first rows in hash order are the test rows, found by one cut value per
    class: the table itself is neither sorted nor shuffled.
    """
    digest = keyed_hash(seed, F.col(id_col))
    if label is not None and stratify:
        counts = class_counts(df, label)
        kinds = counts.agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).first()
        if kinds["k"] > 1:
            if kinds["least"] < 2:
                raise ValueError("The least populated class has only 1 member; stratification needs 2")
            quotas = test_quotas(counts, label, test_size).select(label, "quota")
            return flag_first(df, [label], quotas, digest, id_col, "_test").withColumn("split", _split_column("_test")).drop("_test")
    quota = df.agg(F.ceil(F.count(F.lit(1)) * F.lit(float(test_size))).cast("bigint").alias("quota"))
    return flag_first(df, [], quota, digest, id_col, "_test").withColumn("split", _split_column("_test")).drop("_test")


def stratified_splits(
    df: DataFrame, label: str, id_col: str, test_size: float = 0.2, n_splits: int = 5, seed: int = SEED
) -> DataFrame:
    """``n_splits`` independent stratified splits, long form with ``split_no``.

    The copies share one class table; each copy has its own hash order.
    """
    counts = class_counts(df, label)
    kinds = counts.agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).first()
    if kinds["k"] < 2:
        raise ValueError("Stratification requires at least 2 classes")
    if kinds["least"] < 2:
        raise ValueError("The least populated class has only 1 member; stratification needs 2")
    numbers = F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1)))
    quotas = test_quotas(counts, label, test_size).select(label, "quota", numbers.alias("split_no"))
    copies = df.withColumn("split_no", numbers)
    digest = keyed_hash(seed, F.col("split_no"), F.col(id_col))
    flagged = flag_first(copies, [label, "split_no"], quotas, digest, id_col, "_test")
    return flagged.withColumn("split", _split_column("_test")).drop("_test")


def temporal_split(
    df: DataFrame, time_col: str, id_col: str, test_size: float = 0.2, validation_size: float = 0.1, seed: int = SEED
) -> DataFrame:
    """Add ``split`` by time: oldest rows train, newest test; no validation rows if ``int(n*v)`` is 0.

    Rows on the same instant are ordered by hash. Two cut points are searched for, then the
    split is a plain comparison per row. Missing times sort last, in hash order.
    """
    if time_col not in df.columns:
        raise ValueError(f"Column '{time_col}' does not exist")
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.count(time_col).alias("timed")).first()
    n_test, n_val = int(seen["n"] * test_size), int(seen["n"] * validation_size)
    n_train = seen["n"] - n_test - n_val
    moment = time_key(df, time_col)
    key = F.struct(moment.alias("t"), keyed_hash(seed, F.col(id_col)).alias("digest"), F.col(id_col).alias("id"))

    def upto(position: int) -> Column:
        if position <= 0:
            return F.lit(False)
        if position >= seen["n"]:
            return F.lit(True)
        if position == seen["timed"]:
            return F.col(time_col).isNotNull()
        if position > seen["timed"]:
            digest = keyed_hash(seed, F.col(id_col))
            quota = df.sparkSession.range(1).select(F.lit(position - seen["timed"]).cast("bigint").alias("quota"))
            cut = hash_cuts(df.filter(F.col(time_col).isNull()), [], quota, digest, id_col).first()["cut"]
            own = F.struct(digest.alias("digest"), F.col(id_col).alias("id"))
            return F.col(time_col).isNotNull() | (own <= F.struct(F.lit(cut["digest"]).alias("digest"), F.lit(cut["id"]).alias("id")))
        t, digest, row_id = time_cut(df, moment, id_col, seed, position)
        return F.coalesce(key <= F.struct(F.lit(t).cast("bigint").alias("t"), F.lit(digest).alias("digest"), F.lit(row_id).alias("id")), F.lit(False)) & F.col(time_col).isNotNull()

    in_train, in_val = upto(n_train), upto(n_train + n_val)
    return df.withColumn("split", F.when(in_train, "train").when(in_val, "validation").otherwise("test"))


def group_split(
    df: DataFrame, group_col: str, test_size: float = 0.2, max_groups: int | None = None, seed: int = SEED
) -> DataFrame:
    """Add ``split`` by whole groups in hash order; ``max_groups`` drops the groups beyond it.

    Only distinct groups are counted. Membership is a comparison of the group's hash with
    the cut, so a group holding much of the table is never moved. Null is a group of its own.
    """
    if group_col not in df.columns:
        raise ValueError(f"Column '{group_col}' does not exist")
    name = F.coalesce(F.col(group_col).cast("string"), F.lit("null group"))
    digest, own = keyed_hash(seed, name), F.struct(F.col(group_col).isNull().alias("none"), name.alias("name"))
    groups = df.select(digest.alias("_digest"), own.alias("_group")).distinct()
    n_groups = groups.count()
    kept = min(n_groups, max_groups) if max_groups else n_groups
    key = F.struct(digest.alias("digest"), own.alias("id"))

    def upto(position: int) -> Column:
        if position <= 0:
            return F.lit(False)
        if position >= n_groups:
            return F.lit(True)
        quota = df.sparkSession.range(1).select(F.lit(position).cast("bigint").alias("quota"))
        cut = hash_cuts(groups, [], quota, F.col("_digest"), "_group").first()["cut"]
        last = F.struct(F.lit(cut["id"]["none"]).alias("none"), F.lit(cut["id"]["name"]).alias("name"))
        return key <= F.struct(F.lit(cut["digest"]).alias("digest"), last.alias("id"))

    in_test, in_any = upto(int(kept * test_size)), upto(kept)
    return df.filter(in_any).withColumn("split", F.when(in_test, "test").otherwise("train"))


def cross_validation(
    df: DataFrame, label: str | None, id_col: str, folds: int = 5, stratified: bool = True, seed: int | str = SEED, out: str = "fold"
) -> DataFrame:
    """Add a fold number: hash rank over (label, hash), dealt out round-robin.

    Each class then differs by at most one row between folds.
    """
    digest = keyed_hash(seed, F.col(id_col))
    if label is None or not stratified:
        ranked = rank_by_hash(df, [], digest, id_col, "_rank")
        return ranked.withColumn(out, F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("int")).drop("_rank")
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(F.lit(0)).orderBy(F.col(label).asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(F.col(label).alias("_label"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    ranked = rank_by_hash(df, [label], digest, id_col, "_rank")
    placed = ranked.join(measured(starts), F.col(label).eqNullSafe(F.col("_label"))).drop("_label")
    return placed.withColumn(out, F.pmod(F.col("_from") + F.col("_rank") - 1, F.lit(folds)).cast("int")).drop("_rank", "_from")


def nested_cross_validation(
    df: DataFrame, label: str, id_col: str, outer_folds: int = 5, inner_folds: int = 3, seed: int = SEED
) -> DataFrame:
    """Long form ``(outer_fold, inner_fold, role)`` per row.

    A row is test in one outer fold and, in every other, has an inner fold drawn with that
    outer fold's own seed. All outer folds are ranked in one pass.
    """
    outer = cross_validation(df, label, id_col, outer_folds, seed=seed, out="_own")
    copies = outer.withColumn("outer_fold", F.explode(F.sequence(F.lit(0), F.lit(outer_folds - 1))))
    test = copies.filter(F.col("_own") == F.col("outer_fold")).withColumn("inner_fold", F.lit(None).cast("int"))
    train = copies.filter(F.col("_own") != F.col("outer_fold"))
    digest = keyed_hash(seed, F.col("outer_fold") + 1, F.col(id_col))
    counts = train.groupBy("outer_fold", label).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("outer_fold").orderBy(F.col(label).asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        F.col("outer_fold").alias("_o"), F.col(label).alias("_l"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    ranked = rank_by_hash(train, ["outer_fold", label], digest, id_col, "_rank")
    placed = ranked.join(measured(starts), (F.col("outer_fold") == F.col("_o")) & F.col(label).eqNullSafe(F.col("_l"))).drop("_o", "_l")
    inner = placed.withColumn("inner_fold", F.pmod(F.col("_from") + F.col("_rank") - 1, F.lit(inner_folds)).cast("int")).drop("_rank", "_from")
    both = test.unionByName(inner).drop("_own")
    return both.withColumn("role", F.when(F.col("inner_fold").isNull(), "test").otherwise("train"))


def split_summary(
    df: DataFrame, label: str | None = None, time_col: str | None = None, group_col: str | None = None, by: tuple[str, ...] = ("split",)
) -> DataFrame:
    """Rows per part, with class counts, time ranges or numbers of groups where asked.

    ``by`` names the columns that tell the parts: ``("split",)``, ``("split_no", "split")``,
    ``("fold",)`` or ``("outer_fold", "inner_fold", "role")``. Null counts as one group.
    """
    keys = [*by] + ([label] if label else [])
    aggs = [F.count(F.lit(1)).alias("n")]
    if group_col:
        aggs.append((F.countDistinct(group_col) + F.max(F.col(group_col).isNull().cast("long"))).alias("groups"))
    if time_col:
        aggs += [F.min(time_col).alias("first_time"), F.max(time_col).alias("last_time")]
    return df.groupBy(*keys).agg(*aggs)


def validate_split(df: DataFrame, label: str, features: list[str] = ()) -> DataFrame:
    """Size ratio, label drift and mean drift of a split table as ``(check, item, value, flag)``.

    One aggregate by (split, class) feeds the size and label checks, one by split the
    feature means.
    """
    pairs = df.filter(F.col("split").isin("train", "test"))
    sizes = pairs.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    ratio = sizes.agg(
        (F.sum(F.when(F.col("split") == "test", F.col("n"))) / F.sum(F.when(F.col("split") == "train", F.col("n")))).alias("value"))
    size_rows = ratio.select(
        F.lit("size_ratio").alias("check"), F.lit("").alias("item"), "value",
        F.when(F.col("value") < 0.15, "too small").when(F.col("value") > 0.4, "too large").otherwise("ok").alias("flag"))

    by_class = pairs.filter(F.col(label).isNotNull()).groupBy("split", label).agg(F.count(F.lit(1)).alias("n"))
    share = by_class.withColumn("p", F.col("n") / F.sum("n").over(W.partitionBy("split")))
    drift = share.groupBy(label).agg(F.abs(
        F.coalesce(F.sum(F.when(F.col("split") == "train", F.col("p"))), F.lit(0.0))
        - F.coalesce(F.sum(F.when(F.col("split") == "test", F.col("p"))), F.lit(0.0))).alias("value"))
    label_rows = drift.select(
        F.lit("label_drift").alias("check"), F.col(label).cast("string").alias("item"), "value",
        F.when(F.col("value") > 0.1, "drift").otherwise("ok").alias("flag"))
    out = size_rows.unionByName(label_rows)
    if features:
        means = pairs.agg(*[
            F.avg(F.when(F.col("split") == part, F.col(f"`{c}`"))).alias(f"{part}_{i}")
            for i, c in enumerate(features) for part in ("train", "test")])
        items = F.array(*[
            F.struct(F.lit(c).alias("item"), F.col(f"train_{i}").alias("a"), F.col(f"test_{i}").alias("b"))
            for i, c in enumerate(features)])
        moved = means.select(F.explode(items).alias("i")).select("i.*").filter(F.col("a") != 0)
        value = F.abs(F.col("a") - F.col("b")) / F.abs(F.col("a"))
        out = out.unionByName(moved.select(
            F.lit("feature_drift").alias("check"), "item", value.alias("value"),
            F.when(value > 0.2, "drift").otherwise("ok").alias("flag")))
    return out


def rare_class_split(
    df: DataFrame, label: str, id_col: str, test_size: float = 0.2, min_rows: int = 3, seed: int | str = 0
) -> DataFrame:
    """Classes under ``min_rows`` never reach the test set.

    The test set is ``test_size`` of all rows, drawn without stratification from the
    frequent classes.
    """
    counts = class_counts(df, label).select(F.col(label).alias("_l"), F.col("n").alias("_n"))
    flagged = df.join(measured(counts), F.col(label).eqNullSafe(F.col("_l")), "left").withColumn(
        "_good", F.coalesce(F.col("_n") >= min_rows, F.lit(False))).drop("_l", "_n")
    sizes = flagged.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_good").cast("long")).alias("good")).first()
    share = sizes["n"] * test_size / sizes["good"]
    n_test = min(sizes["good"], math.ceil(sizes["good"] * share))
    quota = df.sparkSession.range(1).select(F.lit(True).alias("_good"), F.lit(n_test).cast("bigint").alias("quota"))
    out = flag_first(flagged, ["_good"], quota, keyed_hash(seed, F.col(id_col)), id_col, "_test")
    return out.withColumn("split", _split_column("_test")).drop("_test", "_good")
