"""Ranked lexical search by Block-Max MaxScore over a stored inverted index.

The index is a table with one row per shard of the documents: a dictionary, and for each term a list of postings in
compressed blocks with the greatest score share of the list and of every block. It is written once and answers any number of
query blocks. In a shard the lists of a query are sorted by their greatest share; lists that together cannot lift a document
above the k-th best score so far are not essential. Candidates come from essential lists alone; the block maxima of the
others reject candidates before a block is decompressed. Each task keeps a heap per query over its shards, and the heaps
are merged: scores are whole numbers under statistics of the whole table, so the merged result is exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketloom.llm.common import read, term_parts
from ticketloom.session import settle_table

TOP = 20
LENGTH_SHARE = 25  # percent of the length norm that follows the document's length
SHARD_DOCS, SHARD_BYTES = 1 << 15, 6 << 20
BLOCK = 64
QUERY_BYTES = 16 << 20
UNIT = 1_000_000_000
INDEX = ("ids", "norms", "terms", "sizes", "bounds", "lasts", "tops", "widths", "data")


def term_counts(text: str | None) -> Counter:
    out: Counter = Counter()
    for part in term_parts(text):
        out.update(part)
    return out


@dataclass(frozen=True)
class Totals:
    """N, the documents with a term, and L, the terms of all documents with repeats."""

    documents: int
    terms: int

    def norm(self, length: int) -> int:
        return 100 - LENGTH_SHARE + LENGTH_SHARE * length * self.documents // self.terms

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1)))


def corpus_totals(docs: DataFrame, text: str = "text") -> Totals:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = total = 0
        for batch in batches:
            for x in batch.column(0):
                own = sum(map(len, term_parts(x.as_py())))
                n, total = n + (own > 0), total + own
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total], pa.int64())], names=["n", "l"])

    row = docs.select(F.col(f"`{text}`")).mapInArrow(run, "n long, l long").agg(F.sum("n").alias("n"), F.sum("l").alias("l")).first()
    return Totals(row["n"] or 0, row["l"] or 0)


def share(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return UNIT * tf // (1000 * tf + 12 * norm)


def _scatter(out: np.ndarray, at: np.ndarray, values: np.ndarray, width: np.ndarray) -> None:
    """Write each value at its place, in so many little-endian bytes."""
    for b in range(4):
        wide = width > b
        out[at[wide] + b] = (values[wide] >> (8 * b)) & 255


def _gather(data: np.ndarray, at: np.ndarray, width: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at), np.int64)
    for b in range(4):
        wide = width > b
        out[wide] |= data[at[wide] + b].astype(np.int64) << (8 * b)
    return out


def _width(most: np.ndarray) -> np.ndarray:
    return 1 + (most > 0xFF) + (most > 0xFFFF) + (most > 0xFFFFFF)


def _runs(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group, position in the group) of every member of groups of these sizes."""
    group = np.repeat(np.arange(len(sizes)), sizes)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def index_shard(rows: list[tuple[int, int, Counter]], totals: Totals) -> dict[str, bytes]:
    """One row of the index from (id, number of terms, term counts); documents are numbered by length, so blocks are alike."""
    rows = sorted(rows, key=lambda r: (r[1], r[0]))
    norms = np.array([totals.norm(n) for _, n, _ in rows], np.int64)
    terms = sorted({t for _, _, counts in rows for t in counts})
    place = {t: i for i, t in enumerate(terms)}
    code = np.array([place[t] for _, _, counts in rows for t in counts], np.int64)
    tf = np.array([n for _, _, counts in rows for n in counts.values()], np.int64)
    doc = np.repeat(np.arange(len(rows)), [len(counts) for _, _, counts in rows])
    order = np.argsort(code, kind="stable")
    code, tf, doc = code[order], tf[order], doc[order]
    sizes = np.bincount(code, minlength=len(terms))
    _, at = _runs(sizes)
    begin = np.flatnonzero(at % BLOCK == 0)
    held = np.diff(np.append(begin, len(code)))
    score = share(tf, norms[doc])
    tops = np.maximum.reduceat(score, begin)
    bounds = np.maximum.reduceat(tops, np.cumsum(-(-sizes // BLOCK)) + sizes // -BLOCK)
    gap = np.diff(doc, prepend=0)
    gap[at == 0] = doc[at == 0]
    wide_gap, wide_tf = _width(np.maximum.reduceat(gap, begin)), _width(np.maximum.reduceat(tf, begin))
    length = held * (wide_gap + wide_tf)
    block, inside = _runs(held)
    start = (np.cumsum(length) - length)[block]
    data = np.zeros(int(length.sum()), np.uint8)
    _scatter(data, start + inside * wide_gap[block], gap, wide_gap[block])
    _scatter(data, start + (held * wide_gap)[block] + inside * wide_tf[block], tf, wide_tf[block])
    arrays = {"ids": np.array([r[0] for r in rows], np.int64), "norms": norms, "sizes": sizes.astype(np.int32), "bounds": bounds.astype(np.int32),
              "lasts": doc[begin + held - 1].astype(np.int32), "tops": tops.astype(np.int32), "widths": (wide_gap + 16 * wide_tf).astype(np.uint8), "data": data}
    return {**{k: v.tobytes() for k, v in arrays.items()}, "terms": b" ".join(terms)}


def build_index(docs: DataFrame, totals: Totals, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index table; rows are of bounded size, except that a single document is never split."""
    narrow = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).where("doc_id is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shard(rows):
            made = index_shard(rows, totals)
            return pa.RecordBatch.from_arrays([pa.array([made[c]], pa.binary()) for c in INDEX], names=INDEX)

        rows, size = [], 0
        for batch in batches:
            for own, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = x.as_py()
                counts = term_counts(text)
                if counts:
                    rows.append((own, sum(counts.values()), counts))
                    size += len(text)
                if len(rows) >= SHARD_DOCS or size >= SHARD_BYTES:
                    yield shard(rows)
                    rows, size = [], 0
        if rows:
            yield shard(rows)

    return narrow.mapInArrow(run, ", ".join(f"{c} binary" for c in INDEX))


class Shard:
    """A row of the index, ready to be searched."""

    def __init__(self, row: dict[str, bytes], vocabulary: list[bytes]):
        load = lambda name, kind: np.frombuffer(row[name], kind)
        self.ids, self.norms, self.data = load("ids", np.int64), load("norms", np.int64), load("data", np.uint8)
        self.sizes, self.bounds = load("sizes", np.int32).astype(np.int64), load("bounds", np.int32).astype(np.int64)
        self.lasts, self.tops = load("lasts", np.int32).astype(np.int64), load("tops", np.int32).astype(np.int64)
        self.first_block = np.concatenate([[0], np.cumsum(-(-self.sizes // BLOCK))])
        owner, at = _runs(np.diff(self.first_block))
        self.block_size = np.minimum(self.sizes[owner] - at * BLOCK, BLOCK)
        self.block_base = np.where(at > 0, np.concatenate([[0], self.lasts[:-1]]), 0)
        widths = load("widths", np.uint8).astype(np.int64)
        self.wide_gap, self.wide_tf = widths & 15, widths >> 4
        length = self.block_size * (self.wide_gap + self.wide_tf)
        self.block_at = np.cumsum(length) - length
        place = {t: i for i, t in enumerate(row["terms"].split(b" "))}
        self.list_of = np.array([place.get(t, -1) for t in vocabulary], np.int64)

    def decompress(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which of the blocks, document, score share) of all their postings."""
        size = self.block_size[blocks]
        which, inside = _runs(size)
        start, gaps, tfs = self.block_at[blocks][which], self.wide_gap[blocks], self.wide_tf[blocks]
        gap = _gather(self.data, start + inside * gaps[which], gaps[which])
        tf = _gather(self.data, start + (size * gaps)[which] + inside * tfs[which], tfs[which])
        total = np.cumsum(gap)
        first = np.cumsum(size) - size
        doc = total - (total[first] - gap[first])[which] + self.block_base[blocks][which]
        return which, doc, share(tf, self.norms[doc])

    def search(self, terms: np.ndarray, weights: np.ndarray, floor: int, k: int, counters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best documents of one query; ``floor`` is the k-th best score known so far.

        ``counters`` adds up the postings of the query's lists and those decompressed.
        """
        lists, held = self.list_of[terms], self.list_of[terms] >= 0
        lists, weights = lists[held], weights[held]
        if not len(lists):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        bound = self.bounds[lists] * weights
        order = np.argsort(bound, kind="stable")
        lists, weights, bound = lists[order], weights[order], bound[order]
        counters[0] += self.sizes[lists].sum()
        # The lists before ``cut`` cannot reach the floor even together; equal scores may still win by their id.
        cut = int(np.searchsorted(np.cumsum(bound), floor))
        if cut == len(lists):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        starts, counts = self.first_block[lists], self.first_block[lists + 1] - self.first_block[lists]
        which, at = _runs(counts[cut:])
        own, doc, value = self.decompress(starts[cut:][which] + at)
        counters[1] += len(doc)
        sums = np.bincount(doc, value * weights[cut:][which][own], minlength=len(self.ids))  # exact: below 2 ** 53
        found = np.flatnonzero(sums)
        score = sums[found].astype(np.int64)
        if len(found) > k:
            floor = max(floor, int(np.partition(score, len(score) - k)[len(score) - k]))
        # Where each candidate would be in the lists that are not essential, and the most it can get there.
        places = np.empty((cut, len(found)), np.int64)
        most = np.zeros((cut, len(found)), np.int64)
        for i in range(cut):
            at = np.searchsorted(self.lasts[starts[i]:starts[i] + counts[i]], found)
            inside = at < counts[i]
            places[i] = np.where(inside, starts[i] + at, -1)
            most[i, inside] = self.tops[places[i, inside]] * weights[i]
        limit = score + most.sum(axis=0)
        for i in range(cut - 1, -1, -1):
            alive = limit >= floor
            found, score, limit, places, most = found[alive], score[alive], limit[alive], places[:, alive], most[:, alive]
            asked = np.unique(places[i][places[i] >= 0])
            gained = np.zeros(len(found), np.int64)
            if len(asked):
                _, doc, value = self.decompress(asked)
                counters[1] += len(doc)
                near = np.minimum(np.searchsorted(doc, found), len(doc) - 1)
                gained = np.where(doc[near] == found, value[near] * weights[i], 0)
            score = score + gained
            limit = limit - most[i] + gained
            if len(found) > k:
                floor = max(floor, int(np.partition(score, len(score) - k)[len(score) - k]))
        best = score >= max(floor, 1)
        found, score = found[best], score[best]
        order = np.lexsort((self.ids[found], -score))[:k]
        return self.ids[found[order]], score[order]


def _asked(queries: DataFrame, item_id: str, text: str) -> DataFrame:
    """(id, term, n) of the queries; of an id that repeats the greatest text counts."""
    narrow = queries.select(F.col(f"`{item_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")).where("id is not null").groupBy("id").agg(F.max("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = term_counts(text.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([own] * len(counts), pa.int64()), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["id", "term", "n"])

    return narrow.mapInArrow(run, "id long, term binary, n long")


def _frequencies(index: DataFrame, vocabulary: list[bytes]) -> np.ndarray:
    """Documents that hold each term, from the sizes of the lists; of the index only dictionaries and sizes are read."""
    shared = index.sparkSession.sparkContext.broadcast(vocabulary)  # terms of a query block, bounded by QUERY_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, terms = np.zeros(len(shared.value), np.int64), shared.value
        for batch in batches:
            for own, sizes in zip(batch.column(0), batch.column(1)):
                place = {t: i for i, t in enumerate(own.as_py().split(b" "))}
                at = np.array([place.get(t, -1) for t in terms], np.int64)
                held[at >= 0] += np.frombuffer(sizes.as_py(), np.int32)[at[at >= 0]]
        full = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(held[full])], names=["at", "n"])

    rows = index.select("terms", "sizes").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(vocabulary), np.int64)
    out[rows.column("at").to_numpy()] = rows.column("n").to_numpy()
    return out


def _answers(index: DataFrame, asked: pa.Table, totals: Totals, k: int) -> DataFrame:
    """(item_id, doc_id, score, listed, read): every task's k best documents of each query of a block."""
    vocabulary = sorted(set(asked.column("term").to_pylist()))
    weights = np.array([totals.weight(int(n)) for n in _frequencies(index, vocabulary)], np.int64)
    place = {t: i for i, t in enumerate(vocabulary)}
    term = np.array([place[t] for t in asked.column("term").to_pylist()], np.int64)
    ids, n = asked.column("id").to_numpy(), asked.column("n").to_numpy()
    order = np.argsort(ids, kind="stable")
    items, begin = np.unique(ids[order], return_index=True)
    queries = [(int(item), term[o], weights[term[o]] * n[o]) for item, o in zip(items, np.split(order, begin[1:]))]
    shared = index.sparkSession.sparkContext.broadcast((vocabulary, queries))  # bounded by QUERY_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, queries = shared.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
        counters = np.zeros((len(queries), 2), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard({c: batch.column(c)[row].as_py() for c in INDEX}, vocabulary)
                for q, (_, terms, weights) in enumerate(queries):
                    ids, scores = best[q]
                    found, value = shard.search(terms, weights, int(scores[-1]) if len(ids) == k else 0, k, counters[q])
                    if len(found):
                        ids, scores = np.concatenate([ids, found]), np.concatenate([scores, value])
                        order = np.lexsort((ids, -scores))[:k]
                        best[q] = ids[order], scores[order]
        sizes = np.array([len(ids) for ids, _ in best], np.int64)
        owner, at = _runs(sizes)
        columns = [np.array([q[0] for q in queries], np.int64)[owner], *(np.concatenate(x) for x in zip(*best)), *(np.where(at == 0, c[owner], 0) for c in counters.T)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["item_id", "doc_id", "score", "listed", "read"])

    return index.mapInArrow(run, "item_id long, doc_id long, score long, listed long, read long")


def search(index: DataFrame, totals: Totals, queries: DataFrame, k: int = TOP, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score, listed, read) from a stored index.

    ``listed`` and ``read`` on a task's best row are the postings in the query's lists and those decompressed. Queries are
    a table; they pass through the driver in blocks of about ``QUERY_BYTES``, each a pass over the index.
    """
    asked = settle_table(_asked(queries, item_id, text), "lexical-asked")
    size = asked.agg(F.sum(F.length("term") + 24).alias("n")).first()["n"] or 0
    blocks = max(1, math.ceil(size / QUERY_BYTES))
    found = None
    for i in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i).toArrow()
        if rows.num_rows and totals.terms:
            own = _answers(index, rows, totals, k)
            found = own if found is None else found.union(own)
    if found is None:
        found = index.sparkSession.createDataFrame([], "item_id long, doc_id long, score long, listed long, read long")
    rank = F.row_number().over(W.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score", "listed", "read")


def ranked_documents(docs: DataFrame, queries: DataFrame, k: int = TOP, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", query_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents with the highest scores above 0 for each query, exactly.

    A query's terms count as often as they occur. Equal scores go to the smaller doc_id. Null or empty texts have no terms:
    such a query returns nothing and such a document is never returned; so does an empty table. Null ids take no part; of an
    item_id that repeats the greatest text counts, of a doc_id that repeats each row is a document. Other columns are ignored.
    """
    totals = corpus_totals(docs.where(F.col(f"`{doc_id}`").isNotNull()), text)
    index = settle_table(build_index(docs, totals, doc_id, text), "lexical-index")
    return search(index, totals, queries, k, item_id, query_text).select("item_id", "rank", "doc_id", "score")


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH words AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
asked AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
overall AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths),
norms AS (SELECT doc_id, 100 - 25 + (25 * n * n_docs) // n_terms AS m FROM lengths, overall),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tfs, overall GROUP BY term),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN norms USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 20
"""
