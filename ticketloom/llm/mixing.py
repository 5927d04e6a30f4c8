"""Mixing sources to target weights: capped water-filling and seeded whole repetitions.

The plan is one row per source; every document's share of the mix follows from that row, the document's size and
its keyed hash, so the texts are never shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketloom.llm.common import local_if_small, read, word_count
from ticketloom.session import settle_table

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix-1"
ROWS_PER_BUCKET = 50_000
NEVER, ALWAYS = "", "g"  # before and after every hexadecimal digest


def source_key(source: str = "source"):
    """Sortable by code point, null after every name."""
    return F.when(F.col(source).isNull(), F.lit("z")).otherwise(F.concat(F.lit("a"), F.col(source).cast("string")))


def draw(doc_id: str, text: str, seed: str):
    """A hexadecimal digest per document: equal rows draw alike, reruns too."""
    return F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).cast("binary"))


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED) -> DataFrame:
    """(doc_id, k, size, h) per document: source key, words and draw."""
    return docs.select(F.col(doc_id).alias("doc_id"), source_key(source).alias("k"), word_count(text).alias("size"), draw(doc_id, text, seed).alias("h"))


def water_fill(totals: DataFrame, weights=WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Targets of the sources ``(k, source_size)``; adds ``target``.

    The sources share the sum of all sizes by weight; a source whose share passes ``max_epochs`` times its size is
    clamped there and its excess goes to the rest by weight, until none is above. The clamped ones are those with the
    lowest size per weight, so sorting by it gives the level in one pass over the sources.
    """
    by_name, by_ratio = W.orderBy("k"), W.orderBy("ratio", "k")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    t = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs))).withColumn("ratio", F.col("cap") / F.col("weight"))
    t = t.withColumn("all_size", F.sum("source_size").over(W.partitionBy(F.lit(0))))
    t = t.withColumn("level", (F.col("all_size") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    t = t.withColumn("holds", F.when(F.col("level") <= F.col("ratio"), F.col("level")))
    # Of the levels that keep every later source below its cap, the first is the water level.
    t = t.withColumn("water", F.first("holds", ignorenulls=True).over(by_ratio.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    target = F.least(F.col("cap"), F.col("weight") * F.coalesce(F.col("water"), F.lit(float("inf"))))
    return t.select("k", "source_size", target.alias("target"))


def _cut(rows: DataFrame, quota: DataFrame, digits: int) -> DataFrame:
    """Per source the highest draw up to which the words of ``rows`` stay within ``quota``, and the words up to it.

    Words are summed per leading digits of the draw; only the bucket in which the quota runs out is looked at row
    by row. Rows with equal draws stay together.
    """
    bucket = F.substring("h", 1, digits)
    sums = rows.groupBy("k", bucket.alias("b")).agg(F.sum("size").alias("s"))
    sums = sums.withColumn("upto", F.sum("s").over(W.partitionBy("k").orderBy("b"))).join(quota, "k")
    full = sums.groupBy("k").agg(
        F.min(F.when(F.col("upto") > F.col("quota"), F.col("b"))).alias("b"),
        F.coalesce(F.max(F.when(F.col("upto") <= F.col("quota"), F.col("upto"))), F.lit(0)).alias("before"))
    full = local_if_small(full.join(quota, "k"), "mix-cut")
    inside = rows.withColumn("b", bucket).join(full, ["k", "b"])
    run = F.col("before") + F.sum("size").over(W.partitionBy("k").orderBy("h"))
    inside = inside.withColumn("upto", run).where(F.col("upto") <= F.col("quota")).groupBy("k").agg(F.max("h").alias("last"), F.max("upto").alias("upto"))
    cut = F.coalesce(F.col("last"), F.col("b"), F.lit(ALWAYS))
    return full.join(inside, "k", "left").select("k", cut.alias("cut"), F.coalesce("upto", "before").alias("got"))


def fit_mix(sized: DataFrame, weights=WEIGHTS, max_epochs: float = MAX_EPOCHS, passes: int = 3) -> DataFrame:
    """The plan: per source its size, target, whole repetitions and the cuts of its fractional one.

    ``sized`` is what :func:`sizes` returns. The fractional repetition takes documents in draw order while they fit;
    each further pass fills what is left with documents no larger than the gap. Documents without words are in the
    fractional repetition when their draw is.
    """
    totals = sized.groupBy("k").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    rows = sized.count()
    digits = max(2, math.ceil(math.log(max(2, rows / ROWS_PER_BUCKET), 16)) + 1)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = water_fill(totals.select("k", "source_size"), weights, max_epochs).withColumn("whole", F.floor(ratio))
    plan = local_if_small(plan.withColumn("gap0", F.col("target") - F.col("whole") * F.col("source_size")), "mix-plan")
    open_rows, gap = sized, plan.select("k", F.col("gap0").alias("quota"))
    for i in range(1, passes + 1):
        cut = _cut(open_rows, gap, digits)
        plan = plan.join(cut, "k", "left").withColumn(f"cut{i}", F.coalesce("cut", F.lit(NEVER))).withColumn(f"gap{i}", F.col(f"gap{i - 1}") - F.coalesce("got", F.lit(0))).drop("cut", "got")
        plan = local_if_small(plan, "mix-plan")
        gap = plan.select("k", F.col(f"gap{i}").alias("quota"))
        if i < passes:
            left = open_rows.join(plan.select("k", F.col(f"cut{i}").alias("_cut"), F.col(f"gap{i}").alias("_gap")), "k")
            open_rows = left.where((F.col("h") > F.col("_cut")) & (F.col("size") <= F.col("_gap")) & (F.col("size") > 0)).drop("_cut", "_gap")
    return plan


def repetitions(passes: int = 3):
    """Times a document is taken, from its size, its draw and its source's row of the plan."""
    size, h = F.col("size"), F.col("h")
    extra = h <= F.col("cut1")
    for i in range(2, passes + 1):
        extra = extra | ((h <= F.col(f"cut{i}")) & (size <= F.col(f"gap{i - 1}")) & (size > 0))
    return (F.col("whole") + extra.cast("int")).cast("long")


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """How often the mix takes each document.

    Returns one row per input row: doc_id, size, source_size, target, repetitions, taken. A null text is empty and
    has size 0; a null source is a source of its own, after all others; repeated rows are taken alike; other columns
    of ``docs`` are ignored, so their names cannot clash; an empty table gives an empty result.
    """
    sized = settle_table(sizes(docs, doc_id, text, source, seed), "mix-sizes")
    plan = fit_mix(sized, weights, max_epochs)
    out = sized.join(plan, "k").withColumn("repetitions", repetitions())
    return out.select("doc_id", "size", "source_size", "target", "repetitions", (F.col("repetitions") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself: every row of ``docs``, all its columns, as often as the mix takes it."""
    plan = fit_mix(settle_table(sizes(docs, doc_id, text, source, seed), "mix-sizes"), weights, max_epochs)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, source_key(source).alias("k"), word_count(text).alias("size"), draw(doc_id, text, seed).alias("h"))
    out = keyed.join(plan, "k").select("row", F.explode(F.array_repeat(F.lit(1), repetitions().cast("int"))))
    return out.select("row.*")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_sources(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'z' ELSE 'a' || source END AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || md5(coalesce(text, ''))) AS h FROM documents),
totals AS (SELECT k, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY k),
weighed AS (SELECT *, ((row_number() OVER (ORDER BY k) - 1) % 3 + 1)::DOUBLE AS weight, source_size * 3.0::DOUBLE AS cap FROM totals),
levels AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY cap / weight, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
water AS (SELECT coalesce(min_by(level, struct_pack(r := cap / weight, k := k)) FILTER (level <= cap / weight), 'inf'::DOUBLE) AS w FROM levels),
plan AS (SELECT k, source_size, least(cap, weight * w) AS target,
  CASE WHEN source_size > 0 THEN floor(least(cap, weight * w) / source_size) ELSE 0 END AS whole FROM levels, water),
p0 AS (SELECT s.*, source_size, target, whole, target - whole * source_size AS gap0 FROM sized s JOIN plan USING (k)),
p1 AS (SELECT *, sum(size) OVER (PARTITION BY k ORDER BY h) <= gap0 AS in1 FROM p0),
g1 AS (SELECT *, gap0 - coalesce(sum(size) FILTER (in1) OVER (PARTITION BY k), 0) AS gap1 FROM p1),
p2 AS (SELECT *, NOT in1 AND size > 0 AND size <= gap1 AS open2 FROM g1),
q2 AS (SELECT *, open2 AND sum(CASE WHEN open2 THEN size ELSE 0 END) OVER (PARTITION BY k ORDER BY h) <= gap1 AS in2 FROM p2),
g2 AS (SELECT *, gap1 - coalesce(sum(size) FILTER (in2) OVER (PARTITION BY k), 0) AS gap2 FROM q2),
p3 AS (SELECT *, open2 AND NOT in2 AND size <= gap2 AS open3 FROM g2),
q3 AS (SELECT *, open3 AND sum(CASE WHEN open3 THEN size ELSE 0 END) OVER (PARTITION BY k ORDER BY h) <= gap2 AS in3 FROM p3)
SELECT doc_id, size, source_size, target, CAST((whole + CASE WHEN in1 OR in2 OR in3 THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM q3
"""
