"""Target-distribution importance resampling over hashed n-gram counts.

A 256-byte table lower-cases a text and blanks its separators, ``split`` yields the words, and CRC-32 values extend by
chaining: the value of an n-gram is that of its first n - 1 words, continued by a blank and the last word. Bucket counts of
the raw and of the target texts give every bucket a gain; a document's weight is the mean gain of its n-grams. Gumbel noise
keyed by the document turns weights into a sample without replacement: the highest sums are drawn.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketloom.llm.common import PART_BYTES, local_if_small, map_texts, read, term_parts
from ticketloom.session import settle_table

BUCKETS, ORDER = 10_000, 2
MIN_WORDS, PERCENT = 20, 25
SEED = 7


def gram_counts(text: str | None, order: int = ORDER, size: int = PART_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words, CRC-32 values, counts) of the n-grams of 1 to ``order`` words, for each part of a text.

    Parts are of bounded size; the last words of a part are carried into the next, so no n-gram is lost or met twice.
    """
    carry: list[bytes] = []
    for part in term_parts(text, size):
        words = [*carry, *part]
        values, counts, shorter = [], [], {}
        for n in range(1, order + 1):
            grams = Counter(zip(*(words[i:] for i in range(n))))
            for i in range(len(carry) - n + 1):
                grams[tuple(words[i:i + n])] -= 1  # counted with the part before
            shorter = {g: crc32(b" " + g[-1], shorter[g[:-1]]) for g in grams} if n > 1 else {g: crc32(g[0]) for g in grams}
            values.extend(shorter.values())
            counts.extend(grams.values())
        yield len(part), np.array(values, np.int64), np.array(counts, np.int64)
        carry = words[len(words) - order + 1:] if order > 1 else []


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """(bucket, n) over all texts; each task adds up its own, so only ``buckets`` rows a task are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for x in batch.column(0):
                for _, values, counts in gram_counts(x.as_py(), order):
                    np.add.at(held, values % buckets, counts)
        full = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(held[full])], names=["bucket", "n"])

    return texts.select(F.col(f"`{text}`")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", buckets: int = BUCKETS, order: int = ORDER) -> np.ndarray:
    """A gain for each bucket: 1000 times the logarithm of its smoothed share in the target over that in the raw texts.

    Only ``buckets`` numbers come to the driver, whatever the tables hold. Empty tables have no counts.
    """
    def held(df: DataFrame, column: str) -> np.ndarray:
        out, rows = np.zeros(buckets), bucket_counts(df, column, buckets, order).toArrow()
        out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
        return out

    s, t = held(raw, text), held(target, target_text)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def gumbel(doc_id: str, seed: int = SEED) -> Column:
    """1000 times a standard Gumbel draw, floored; it depends on the id and the seed alone. A null id counts as the empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def weigh(docs: DataFrame, gains: np.ndarray, text: str = "text", keep: tuple[str, ...] = ("doc_id",), order: int = ORDER) -> DataFrame:
    """The ``keep`` columns, n_words, n_features and weight of each row: the floored mean gain of its n-grams, 0 without any."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)  # one number a bucket

    def start():
        gain = shared.value

        def make(column: pa.Array) -> list[pa.Array]:
            rows = []
            for x in column:
                n_words = n = total = 0
                for words, values, counts in gram_counts(x.as_py(), order):
                    n_words, n, total = n_words + words, n + int(counts.sum()), total + int(gain[values % len(gain)] @ counts)
                rows.append((n_words, n, total // n if n else 0))
            return [pa.array(x, pa.int64()) for x in (zip(*rows) if rows else ((), (), ()))]

        return make

    return map_texts(docs, text, keep, start, {"n_words": "long", "n_features": "long", "weight": "long"})


def draw_highest(scored: DataFrame, percent: int, eligible: Column, doc_id: str = "doc_id") -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... for the highest scores of ``percent`` of the eligible rows, else null.

    Scores are whole numbers of a bounded range (gain and noise are logarithms), so their histogram is small however many
    rows there are: it gives the lowest score drawn and how many rows lie above each score. Rows are ordered only among
    equal scores, by ``doc_id``.
    """
    counts = local_if_small(scored.where(eligible).groupBy("score").agg(F.count(F.lit(1)).alias("n")), "resample-scores")
    quota = (counts.agg(F.sum("n").alias("n")).first()["n"] or 0) * percent // 100
    above = F.coalesce(F.sum("n").over(W.orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = local_if_small(counts.withColumn("above", above).where(F.col("above") < quota).select("score", "above"), "resample-starts")
    least = starts.agg(F.min("score").alias("s")).first()["s"]
    near = (eligible & (F.col("score") >= F.lit(least))) if least is not None else F.lit(False)
    inside = F.row_number().over(W.partitionBy("score").orderBy(F.col(f"`{doc_id}`").asc_nulls_last()))
    place = (F.col("above") + inside).cast("long")
    drawn = scored.where(near).join(starts, "score").withColumn("rank", F.when(place <= quota, place)).drop("above")
    rest = scored.where(~F.coalesce(near, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return drawn.select(*scored.columns, "rank").union(rest.select(*scored.columns, "rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, text: str = "text", target_text: str = "text",
             doc_id: str = "doc_id", keep: tuple[str, ...] = ("doc_id",), buckets: int = BUCKETS, order: int = ORDER, seed: int = SEED) -> DataFrame:
    """Every row of ``docs``: the ``keep`` columns, n_words, n_features, weight, score and rank, null where it is not drawn.

    With ``keep`` naming all columns, the rows that have a rank are the sample itself. A null text counts as empty: it has no
    features, weight 0, and is not drawn while ``min_words`` is above 0. Equal scores go to the smaller id, null ids last;
    repeated rows weigh and draw alike and each has a rank of its own. An empty ``docs`` gives an empty result, an empty
    ``target`` the gains of no counts. Columns that are not kept are left out, so their names cannot clash; a kept column
    named like a result column is an error.
    """
    if doc_id not in keep:
        raise ValueError(f"keep must hold {doc_id}")
    if clash := {"score", "rank"} & set(keep):
        raise ValueError(f"kept columns clash with new ones: {sorted(clash)}")
    gains = bucket_gains(docs, target, text, target_text, buckets, order)
    scored = settle_table(weigh(docs, gains, text, keep, order).withColumn("score", F.col("weight") + gumbel(doc_id, seed)), "resample")
    return draw_highest(scored, percent, F.col("n_words") >= min_words, doc_id)


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = r"""
WITH texts AS (SELECT 's' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark),
words AS (SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
grams AS (SELECT side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM words),
table256 AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
distinct_grams AS (SELECT g, hex(encode(g)) AS h FROM (SELECT DISTINCT g FROM grams)),
coded AS (SELECT g, list_concat([4294967295], list_transform(range(CAST(len(h) // 2 AS BIGINT)),
  lambda i: 16 * (instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1) + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1)) AS b FROM distinct_grams),
hashed AS (SELECT g, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1])), 4294967295) % 10000 AS bucket FROM coded, table256),
counted AS (SELECT side, id, bucket, count(*) AS n FROM grams JOIN hashed USING (g) GROUP BY ALL),
sides AS (SELECT bucket, sum(n) FILTER (side = 's') AS s, sum(n) FILTER (side = 't') AS t FROM counted GROUP BY bucket),
sums AS (SELECT coalesce(sum(s), 0)::DOUBLE AS all_s, coalesce(sum(t), 0)::DOUBLE AS all_t FROM sides),
gains AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * (all_s + 10000) / ((coalesce(s, 0) + 1) * (all_t + 10000)))) AS BIGINT) AS gain FROM sides, sums),
weights AS (SELECT id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain)::DOUBLE / sum(n)) AS BIGINT) AS weight FROM counted JOIN gains USING (bucket) WHERE side = 's' GROUP BY id),
scored AS (
  SELECT w.id AS doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) AS n_words,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || w.id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM words w LEFT JOIN weights USING (id) WHERE side = 's'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_words >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END AS rank FROM ranked
"""
