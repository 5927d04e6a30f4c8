"""SimHash near-duplicates: fingerprints linked through pivot distance tables.

Every fingerprint gets its Hamming distances to a set of reference fingerprints (pivots). By the triangle inequality
two fingerprints within ``MAX_BITS`` differ by at most that in each coordinate, so a larger difference in any
coordinate discards a pair; survivors are verified. Distances of unlike 64-bit fingerprints to any pivot lie at 32 +- 4,
so a coordinate alone keeps half of all pairs: pairs are therefore only formed inside buckets that agree in enough
blocks of bits, which by the pigeonhole principle loses no pair.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.common import local_if_small, read
from ticketloom.llm.components import connected
from ticketloom.session import settle_table

SHINGLE = 4
SEED = 42
MAX_BITS = 4
PIVOTS = 24
BUCKET_ROWS = 2_000
SMALL_GROUP = 32
CHUNK_BYTES = 4 << 20
GAP = re.compile(rb"[\x20\x09-\x0d]")


def _shingle_hashes(data: bytes, size: int, seed: int) -> Iterator[np.ndarray]:
    """Hashes of all shingles of lower-cased bytes, in parts of bounded memory."""
    import xxhash

    digest, held, at, any_hash = xxhash.xxh64_intdigest, [], 0, False
    while at < len(data):
        end = len(data)
        if at + CHUNK_BYTES < end and (gap := GAP.search(data, at + CHUNK_BYTES)):
            end = gap.start()
        words = held + data[at:end].split()
        at = end
        if len(words) >= size:
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            begins = [0, *ends[:-size].tolist()]
            yield np.array([digest(line[i:j], seed) for i, j in zip(begins, (ends[size - 1:] - 1).tolist())], "<u8")
            any_hash, words = True, words[len(words) - size + 1:]
        held = words
    if held and not any_hash:
        yield np.array([digest(b" ".join(held), seed)], "<u8")


def fingerprint(text: str | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes; without words all are 0."""
    counts, n = np.zeros(64, np.int64), 0
    for hashes in _shingle_hashes((text or "").encode().lower(), size, seed):
        for i in range(0, len(hashes), 8192):
            part = hashes[i:i + 8192]
            counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
        n += len(hashes)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0]) if n else 0


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, text_hash, fp) per row of ``docs``; fp is the fingerprint as a signed long. Null texts are empty."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"), F.col(text).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x.as_py(), size, seed) for x in batch.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], names=["doc_id", "text_hash", "fp"])

    return narrow.mapInArrow(run, f"doc_id {kind}, text_hash long, fp long")


def block_masks(n: int, max_bits: int = MAX_BITS) -> list[int]:
    """Masks such that two fingerprints within ``max_bits`` agree under at least one of them.

    64 bits are cut into blocks; ``max_bits`` differences leave all but that many blocks equal. More fingerprints get
    more blocks, so that a mask covers about as many bits as tell ``n`` of them apart. Every choice is complete.
    """
    blocks = next((b for b, bits in ((6, 20), (7, 27), (8, 32), (9, 35)) if n <= 1 << bits), 10) + max_bits - MAX_BITS
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(parts, blocks - max_bits)]


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: a fixed draw, so that reruns agree."""
    return np.random.default_rng(7).integers(0, 1 << 64, n, dtype=np.uint64)


def _near(fps: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray, max_bits: int) -> np.ndarray:
    """Which of the pairs (i, j) are within ``max_bits``: discarded coordinate by coordinate, then verified."""
    alive = np.arange(len(i))
    for column in table.T:
        alive = alive[np.abs(column[i[alive]] - column[j[alive]]) <= max_bits]
        if not len(alive):
            return alive
    return alive[np.bitwise_count(fps[i[alive]] ^ fps[j[alive]]) <= max_bits]


def _stars(fps: np.ndarray, table: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Each member of a large bucket's components with the smallest member, without listing the pairs.

    A search from every fingerprint not yet reached looks only at those not yet reached whose first coordinate is near.
    """
    order = np.argsort(table[:, 0], kind="stable")
    first, left, right = table[order, 0], [], []
    open_ = np.ones(len(fps), bool)  # by place in ``order``
    for start in range(len(fps)):
        if not open_[start]:
            continue
        open_[start], todo, group = False, [start], [start]
        while todo:
            at = todo.pop()
            lo, hi = np.searchsorted(first, (first[at] - max_bits, first[at] + max_bits + 1))
            places = lo + np.flatnonzero(open_[lo:hi])
            found = places[_near(fps, table, order[places], np.full(len(places), order[at]), max_bits)]
            open_[found] = False
            todo.extend(found.tolist())
            group.extend(found.tolist())
        if len(group) > 1:
            members = fps[order[group]]
            left.append(members)
            right.append(np.full(len(members), members.min()))
    return (np.concatenate(left), np.concatenate(right)) if left else (fps[:0], fps[:0])


def bucket_links(keys: np.ndarray, fps: np.ndarray, refs: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside the buckets of rows sorted by bucket: pairs in small ones, stars in large ones."""
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    lengths = np.diff(edges)
    left, right = [], []
    many = np.repeat(lengths, lengths)
    rows = np.flatnonzero((many > 1) & (many <= SMALL_GROUP))
    if len(rows):
        own, own_keys = fps[rows], keys[rows]
        table = np.bitwise_count(own[:, None] ^ refs[None, :]).astype(np.int8)
        for shift in range(1, int(many[rows].max())):
            i = np.flatnonzero(own_keys[:-shift] == own_keys[shift:])
            near = i[_near(own, table, i, i + shift, max_bits)]
            left.append(own[near])
            right.append(own[near + shift])
    for at in np.flatnonzero(lengths > SMALL_GROUP):
        own = np.unique(fps[edges[at]:edges[at + 1]])
        found = _stars(own, np.bitwise_count(own[:, None] ^ refs[None, :]).astype(np.int8), max_bits)
        left.append(found[0])
        right.append(found[1])
    return (np.concatenate(left), np.concatenate(right)) if left else (fps[:0], fps[:0])


def link_fingerprints(distinct: DataFrame, max_bits: int = MAX_BITS, n_pivots: int = PIVOTS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b): links between the fingerprints of the one-column table ``distinct`` (fp), enough to connect all that link.

    A bucket with more than ``bucket_rows`` fingerprints is dealt out as pairs of its parts, each to a task of its own.
    """
    masks, refs = block_masks(distinct.count(), max_bits), pivots(n_pivots)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    entry = F.explode(F.array(*[F.struct(F.lit(i).cast("short").alias("mask"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("bits")) for i, m in enumerate(signed)])).alias("e")
    keyed = distinct.select("fp", entry).select("fp", "e.mask", "e.bits")
    full = keyed.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows)
    full = local_if_small(full.select("mask", "bits", F.ceil(F.col("n") / bucket_rows).cast("int").alias("parts")), "simhash-full")
    parted = keyed.join(full, ["mask", "bits"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64(F.col("fp"), F.lit(1)), F.col("parts")).cast("int")
    parted = parted.withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    bucket = F.xxhash64("mask", "bits", F.least("own", "other"), F.greatest("own", "other")).alias("bucket")
    dealt = parted.select(bucket, "fp").repartition("bucket").sortWithinPartitions("bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(keys, fps):
            a, b = bucket_links(keys, fps.view(np.uint64), refs, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy()])
            if len(keys):
                whole = int(np.searchsorted(keys, keys[-1]))  # the last bucket may go on
                yield found(keys[:whole], fps[:whole])
                keys, fps = keys[whole:], fps[whole:]
        yield found(keys, fps)

    return dealt.mapInArrow(run, "a long, b long").where("a <> b").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, seed: int = SEED, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, fp, component_id, kept.

    ``component_id`` is the smallest doc_id reachable over links, the row's own included (null if none has an id).
    ``kept`` marks the row that stands for its component: the one with the smallest doc_id, a null id last, then the
    smallest text hash; exact repeats of that row are marked too. Null and empty texts have fingerprint zero and link
    like any other. Other columns of ``docs`` are ignored; an empty table gives an empty result.

    Copies fall together as one fingerprint before anything is compared.
    """
    own = settle_table(fingerprints(docs, doc_id, text, size, seed), "simhash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    per = settle_table(own.groupBy("fp").agg(first), "simhash-distinct")
    linked = settle_table(connected(link_fingerprints(per.select("fp"), max_bits)), "simhash-components")
    rooted = settle_table(linked.join(per, linked["node"] == per["fp"]).select("fp", "root", "first"), "simhash-rooted")
    firsts = settle_table(rooted.groupBy("root").agg(F.min("first").alias("top")), "simhash-firsts")
    tops = rooted.join(firsts, "root").select("fp", "top")
    per = settle_table(per.join(tops, "fp", "left").select("fp", F.coalesce("top", "first").alias("top")), "simhash-tops")
    kept = F.col("doc_id").eqNullSafe(F.col("top.doc_id")) & (F.col("text_hash") == F.col("top.text_hash"))
    return own.join(per, "fp").select("doc_id", "text_hash", "fp", F.col("top.doc_id").alias("component_id"), kept.alias("kept"))


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their component, one each, all columns kept."""
    ids = near_duplicates(docs, doc_id, text).where("kept").groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).agg(F.count(F.lit(1)).alias("__n"))
    ids = settle_table(ids, "simhash-kept")
    own = F.xxhash64(F.coalesce(docs[text], F.lit("")))
    out = docs.join(ids, docs[doc_id].eqNullSafe(ids["__id"]) & (own == ids["__hash"]))
    many = out.where("__n > 1").dropDuplicates(["__id", "__hash"])
    return (out if ids.where("__n > 1").isEmpty() else out.where("__n = 1").union(many)).select(*[docs[c] for c in docs.columns])


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
