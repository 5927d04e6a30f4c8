"""A memo of finished texts, keyed by digest, that keeps known texts out of every shuffle.

Digests of the memo fill a Bloom filter of bounded size. Texts that it cannot hold are new for certain and leave the scan
at once; of the others only digests are compared with the memo, and the few that the filter let through by chance follow.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.session import measured

HASHES, BITS_PER_KEY = 4, 16
LEAST_BITS, MOST_BITS = 1 << 10, 1 << 28
PART_SCHEMA = "digest string, text string, translated string"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


@dataclass(frozen=True)
class BloomFilter:
    """Bits of a set of keys: at most ``MOST_BITS``, so a very large set fills it and then lets more through."""

    bits: int
    words: np.ndarray

    @classmethod
    def of(cls, keys: DataFrame, key: str) -> "BloomFilter":
        bits = LEAST_BITS
        while bits < min(MOST_BITS, BITS_PER_KEY * keys.count()):
            bits *= 2
        place = keys.select(F.explode(F.array(*_places(F.col(key), bits))).alias("p"))
        word = place.groupBy(F.shiftright("p", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(p & 63 AS INT))")).alias("w")).toArrow()
        out = np.zeros(bits // 64, np.uint64)
        out[word.column("at").to_numpy()] = word.column("w").to_numpy().view(np.uint64)
        return cls(bits, out)

    def might_hold(self, spark: SparkSession, key: Column) -> Column:
        shared = spark.sparkContext.broadcast(self.words)  # at most MOST_BITS

        @F.arrow_udf("boolean")
        def held(a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array) -> pa.Array:
            out = np.ones(len(a), bool)
            for p in (x.to_numpy().astype(np.uint64) for x in (a, b, c, d)):
                out &= (shared.value[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1
            return pa.array(out)

        return held(*_places(key, self.bits))


def unseen(texts: DataFrame, column: str, memo: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose text is not in ``memo`` (``text``, and ``digest`` where it is stored). A null text is unseen."""
    known = memo.select((F.col("digest") if "digest" in memo.columns else digest(F.col("text"))).alias("_digest")).filter("_digest IS NOT NULL")
    keyed = texts.withColumn("_digest", F.coalesce(digest(F.col(column)), F.lit("")))
    flagged = keyed.withColumn("_maybe", BloomFilter.of(known, "_digest").might_hold(texts.sparkSession, F.col("_digest")))
    doubtful = flagged.filter("_maybe").select("_digest").distinct().join(known, "_digest", "left_anti")
    late = flagged.filter("_maybe").join(measured(doubtful), "_digest", "left_semi")
    return flagged.filter("NOT _maybe").unionByName(late).drop("_digest", "_maybe")


@dataclass(frozen=True)
class MemoStore:
    """A memo as a folder of parts in shared storage; every extension writes one part and touches no other."""

    spark: SparkSession
    path: str

    def table(self) -> DataFrame:
        """``(digest, text, translated)`` of all parts."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], PART_SCHEMA)
        return self.spark.read.schema(PART_SCHEMA).option("recursiveFileLookup", True).parquet(self.path)

    def add(self, rows: DataFrame) -> None:
        """``rows`` (``text, translated``) that the memo lacks."""
        rows.select(digest(F.col("text")).alias("digest"), "text", "translated").write.parquet(f"{self.path}/{uuid.uuid4().hex}")
