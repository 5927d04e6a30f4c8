"""Exact ranks, cuts and running totals without a single-task window.

A key may hold a third of all rows, so no window runs over a whole key. Rows are put in
ordered buckets, the buckets are counted (map-side combined), the small bucket table is
prefix-summed, and rows are ordered only inside a bucket. When just a boundary is needed
(a quota or a cut point) only the boundary bucket is ordered at all.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.functions.hashing import keyed_hash
from ticketloom.session import measured

HASH_DIGITS = 3
BUCKET_ROWS = 2_000_000
LEAST_BUCKETS = 512


def _before(partition: list, order: str):
    return W.partitionBy(*(partition or [F.lit(0)])).orderBy(order).rowsBetween(W.unboundedPreceding, -1)


def _same(left: DataFrame, right: DataFrame, by: list[str], rest: list[str], how: str = "inner") -> DataFrame:
    """Join on ``by`` with nulls equal and on ``rest``; the right copies are dropped."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in by + rest else F.col(c) for c in right.columns])
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    for c in rest:
        on = on & (F.col(c) == F.col(f"_r_{c}"))
    return left.join(renamed, on, how).drop(*[f"_r_{c}" for c in by + rest])


def _bucket_counts(df: DataFrame, by: list[str]) -> DataFrame:
    return measured(df.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n")))


def _rank_in_buckets(df: DataFrame, by: list[str], order: list[str], out: str, counts: DataFrame | None = None) -> DataFrame:
    """``df`` holds ``_bucket``; buckets are in the wanted order."""
    counts = _bucket_counts(df, by) if counts is None else counts
    starts = counts.select(*by, "_bucket", F.coalesce(F.sum("_n").over(_before(by, "_bucket")), F.lit(0)).alias("_start"))
    inside = F.row_number().over(W.partitionBy(*by, "_bucket").orderBy(*order))
    ranked = _same(df.withColumn("_inside", inside), measured(starts), by, ["_bucket"])
    return ranked.withColumn(out, F.col("_start") + F.col("_inside")).drop("_start", "_inside", "_bucket")


def rank_by_hash(
    df: DataFrame, by: list[str], digest: Column, id_col: str, out: str, digits: int = HASH_DIGITS
) -> DataFrame:
    """1-based rank per ``by`` in (digest, id) order.

    Digests are uniform, so ``16**digits`` buckets split every key evenly. If the fullest
    bucket still holds more than ``BUCKET_ROWS`` rows, more digits are used.
    """
    keyed = df.withColumn("_digest", digest)
    bucketed = keyed.withColumn("_bucket", F.substring("_digest", 1, digits))
    counts = _bucket_counts(bucketed, by)
    most = counts.agg(F.max("_n").alias("m")).first()["m"] or 0
    if most > BUCKET_ROWS:
        digits += math.ceil(math.log(most / BUCKET_ROWS, 16))
        bucketed = keyed.withColumn("_bucket", F.substring("_digest", 1, digits))
        counts = _bucket_counts(bucketed, by)
    return _rank_in_buckets(bucketed, by, ["_digest", id_col], out, counts).drop("_digest")


def number_buckets(df: DataFrame, column: str, buckets: int = LEAST_BUCKETS) -> DataFrame:
    """Add ``_bucket``: which of the (approximate) quantile ranges the number falls in.

    The cut points only shape the buckets; ranks stay exact whatever they are. ``buckets`` is
    the least number: a table that would fill them with more than ``BUCKET_ROWS`` rows gets more.
    """
    value = F.col(column).cast("double")

    def quantiles(n: int):
        shares = [i / n for i in range(1, n)]
        return df.agg(F.percentile_approx(value, shares, max(10_000, 4 * n)).alias("cuts"), F.count(F.lit(1)).alias("n")).first()

    row = quantiles(buckets)
    if row["n"] > buckets * BUCKET_ROWS:
        row = quantiles(math.ceil(row["n"] / BUCKET_ROWS))
    cuts = sorted(set(row["cuts"] or []))
    splits = [float("-inf"), *cuts, float("inf")]
    binned = Bucketizer(splits=splits, inputCol="_value", outputCol="_bucket", handleInvalid="keep")
    return binned.transform(df.withColumn("_value", value)).drop("_value")


def rank_by_number(df: DataFrame, by: list[str], column: str, out: str, buckets: int = LEAST_BUCKETS) -> DataFrame:
    """1-based rank per ``by`` in the order of a unique number such as an id."""
    return _rank_in_buckets(number_buckets(df, column, buckets), by, [column], out)


def running_totals(
    df: DataFrame, by: list[str], column: str, sums: dict[str, str], descending: bool = False, buckets: int = LEAST_BUCKETS
) -> DataFrame:
    """Running sums over distinct values of a number: ``sums`` maps input to output names.

    ``df`` has one row per (``by``, ``column``); totals include the row itself.
    """
    sign = -1.0 if descending else 1.0
    keyed = number_buckets(df.withColumn("_order", F.col(column) * sign), "_order", buckets)
    parts = keyed.groupBy(*by, "_bucket").agg(*[F.sum(c).alias(f"_s_{c}") for c in sums])
    starts = parts.select(
        *by, "_bucket", *[F.coalesce(F.sum(f"_s_{c}").over(_before(by, "_bucket")), F.lit(0)).alias(f"_b_{c}") for c in sums])
    inside = W.partitionBy(*by, "_bucket").orderBy("_order").rowsBetween(W.unboundedPreceding, 0)
    totals = _same(keyed.withColumns({f"_i_{c}": F.sum(c).over(inside) for c in sums}), measured(starts), by, ["_bucket"])
    totals = totals.withColumns({out: F.col(f"_b_{c}") + F.col(f"_i_{c}") for c, out in sums.items()})
    return totals.drop("_bucket", "_order", *[f"_b_{c}" for c in sums], *[f"_i_{c}" for c in sums])


def hash_cuts(
    df: DataFrame, by: list[str], quotas: DataFrame, digest: Column, id_col: str, digits: int = HASH_DIGITS
) -> DataFrame:
    """Per key the (digest, id) of the ``quota``-th row in hash order: ``by, quota, cut``.

    A row belongs to the first ``quota`` rows of its key exactly when its (digest, id) is
    not above the cut, so selecting needs one small join and no sort of the table. Only
    rows of the boundary bucket are ordered, one in ``16**digits``; if the fullest bucket
    holds more than ``BUCKET_ROWS`` rows, more digits are used.
    """
    keyed = df.select(*by, digest.alias("_digest"), F.col(id_col).alias("_id"))

    def bucketed(n: int) -> tuple[DataFrame, DataFrame]:
        rows = keyed.withColumn("_bucket", F.substring("_digest", 1, n))
        return rows, measured(rows.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n")))

    keyed, counts = bucketed(digits)
    most = counts.agg(F.max("_n").alias("m")).first()["m"] or 0
    if most > BUCKET_ROWS:
        keyed, counts = bucketed(digits + math.ceil(math.log(most / BUCKET_ROWS, 16)))
    upto = counts.withColumn("_start", F.coalesce(F.sum("_n").over(_before(by, "_bucket")), F.lit(0)))
    edge = _same(upto, quotas.filter("quota > 0"), by, []).filter(
        (F.col("_start") < F.col("quota")) & (F.col("quota") <= F.col("_start") + F.col("_n")))
    rows = _same(keyed, measured(edge.select(*by, "_bucket", "_start", "quota")), by, ["_bucket"])
    rows = rows.withColumn("_rn", F.row_number().over(W.partitionBy(*by, "_bucket", "quota").orderBy("_digest", "_id")))
    return rows.filter(F.col("_start") + F.col("_rn") == F.col("quota")).select(
        *by, "quota", F.struct(F.col("_digest").alias("digest"), F.col("_id").alias("id")).alias("cut"))


def flag_first(
    df: DataFrame, by: list[str], quotas: DataFrame, digest: Column, id_col: str, out: str, digits: int = HASH_DIGITS
) -> DataFrame:
    """Add ``out``: is the row among the first ``quota`` of its key in hash order?

    ``quotas`` has ``by`` and ``quota`` (at most the size of the key); a key without a
    quota has none of its rows flagged.
    """
    cuts = hash_cuts(df, by, quotas, digest, id_col, digits).select(*by, "cut")
    key = F.struct(digest.alias("digest"), F.col(id_col).alias("id"))
    if not by:
        one = cuts.first()
        if one is None:
            return df.withColumn(out, F.lit(False))
        return df.withColumn(out, key <= F.struct(F.lit(one["cut"]["digest"]).alias("digest"), F.lit(one["cut"]["id"]).alias("id")))
    joined = _same(df, measured(cuts), by, [], "left")
    return joined.withColumn(out, F.coalesce(key <= F.col("cut"), F.lit(False))).drop("cut")


DAY_MICROS = 86_400_000_000


def time_key(df: DataFrame, column: str) -> Column:
    """A whole number that orders the column: microseconds, whatever the session's zone."""
    value, kind = F.col(column), df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("bigint") * DAY_MICROS
    if isinstance(kind, T.TimestampNTZType):
        in_day = F.hour(value) * 3600 + F.minute(value) * 60
        fine = (F.extract(F.lit("SECOND"), value) * 1_000_000).cast("bigint")
        return F.unix_date(value.cast("date")).cast("bigint") * DAY_MICROS + in_day.cast("bigint") * 1_000_000 + fine
    if isinstance(kind, T.IntegralType):
        return value.cast("bigint")
    raise ValueError(f"'{column}' is neither a time nor a whole number")


def time_cut(df: DataFrame, key: Column, id_col: str, seed: int, position: int):
    """The (key, digest, id) at 1-based ``position`` in key order, ties in hash order.

    Narrows day, second, microsecond, then digest prefix: every step counts a bounded
    number of values (days; 86,400; 1,000,000; 4,096) and keeps one of them, so neither a
    hot day nor a hot instant reaches one task.
    """
    rows, left = df.select(key.alias("_k"), F.col(id_col)).filter(F.col("_k").isNotNull()), position
    for step in (DAY_MICROS, 1_000_000, 1):
        counts = rows.groupBy(F.expr(f"(_k - pmod(_k, {step})) div {step}").alias("_t"))
        counts = counts.agg(F.count(F.lit(1)).alias("_n"))
        counts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(_before([], "_t")), F.lit(0)))
        hit = counts.filter((F.col("_start") < left) & (F.lit(left) <= F.col("_start") + F.col("_n"))).first()
        left -= hit["_start"]
        low = hit["_t"] * step
        rows = rows.filter((F.col("_k") >= low) & (F.col("_k") < low + step))
    quota = df.sparkSession.range(1).select(F.lit(left).cast("bigint").alias("quota"))
    cut = hash_cuts(rows, [], quota, keyed_hash(seed, F.col(id_col)), id_col).first()["cut"]
    return low, cut["digest"], cut["id"]


def flag_lowest(
    df: DataFrame, by: list[str], value: str, quotas: DataFrame, digest: Column, id_col: str, out: str, descending: bool = False
) -> DataFrame:
    """Add ``out``: is the row among the ``quota`` lowest (or highest) values of its key?

    Equal values are counted before anything is ordered; ties at the boundary value are
    taken in hash order. No task sees all rows of a key or of a value.
    """
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    upto = running_totals(counts, by, value, {"_n": "_upto"}, descending)
    edges = _same(upto, quotas.filter("quota > 0").select(*by, "quota"), by, []).filter(
        (F.col("_upto") >= F.col("quota")) & (F.col("_upto") - F.col("_n") < F.col("quota")))
    edges = edges.select(*by, F.col(value).alias("_edge"), (F.col("quota") - F.col("_upto") + F.col("_n")).alias("quota"))
    marked = _same(df, measured(edges.select(*by, "_edge")), by, [], "left")
    tied = marked.filter(F.col(value) == F.col("_edge"))
    resolved = flag_first(tied, by, edges.select(*by, "quota"), digest, id_col, out)
    sign = F.col(value) > F.col("_edge") if descending else F.col(value) < F.col("_edge")
    rest = marked.filter(F.coalesce(F.col(value) != F.col("_edge"), F.lit(True))).withColumn(out, F.coalesce(sign, F.lit(False)))
    return resolved.unionByName(rest).drop("_edge")
