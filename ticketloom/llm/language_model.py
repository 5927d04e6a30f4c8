"""Language-model scores: a log-bilinear model of words by noise-contrastive estimation.

The model of :mod:`word_net` has representations of all words seen often enough; rarer ones go by their endings and keep
their smoothed share inside. So a known word has the log-probability

    base(word) + log10 P(row | context) - log10 P(row),

where its row is the word itself or its ending. It sums to one over the known words and one unknown word, whose
probability is the smoothed share of no occurrence. Word counts are exact: those of frequent words are looked up in the
task, those of rare words by a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm import word_net
from ticketloom.llm.common import read, remainder, word_parts
from ticketloom.session import settle_table

#: At most so many words have their counts in every task; the others' are joined.
HEAD_WORDS = 200_000
END = b""  # no word is empty
FLUSH_WORDS = 400_000
SLICE_TEXTS = 1024  # scored together, so that contexts and rare words they share are met once


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(token, c) over all texts; each text adds one ``END``. Sums are formed in the tasks before they are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["token", "c"])
            held.clear()
            return out

        for batch in batches:
            for x in batch.column(0):
                for words in word_parts(x.as_py()):
                    held.update(words)
                    if len(held) > FLUSH_WORDS:
                        yield flush()
                held[END] += 1
        yield flush()

    return docs.select(text).mapInArrow(run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """``head``: counts of frequent words; ``tokens``, ``types``: N and V."""

    head: dict[bytes, int]
    tokens: int
    types: int

    @property
    def mass(self) -> float:
        return self.tokens + 0.5 * (self.types + 1)

    def base(self, count: int) -> float:
        return math.log10((count + 0.5) / self.mass)


def vocabulary(counts: DataFrame, head_words: int = HEAD_WORDS) -> Vocabulary:
    """Frequent words are those above the lowest power of two that leaves at most ``head_words`` of them."""
    level = F.floor(F.log2(F.col("c").cast("double"))).cast("int")
    levels = {r["level"]: (r["n"], r["c"]) for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("c")).collect()}
    held, least = 0, 64
    for i in sorted(levels, reverse=True):
        if held + levels[i][0] > head_words:
            break
        held, least = held + levels[i][0], i
    table = counts.where(F.col("c") >= F.lit(2.0) ** least).toArrow()  # at most head_words rows
    head = dict(sorted(zip(table.column("token").to_pylist(), table.column("c").to_pylist()), key=lambda x: (-x[1], x[0])))
    return Vocabulary(head, sum(c for _, c in levels.values()), sum(n for n, _ in levels.values()))


def fit_words(train_docs: DataFrame, counts: DataFrame, words: Vocabulary, text: str = "text") -> word_net.Net:
    """The model of words, trained on all positions of ``train_docs``, with its rows from the table of counts.

    What it holds grows with the vocabulary: some 200 bytes for each word seen ``word_net.LEAST`` times, in each task.
    Without training texts nothing is known and nothing is gained.
    """
    often = (F.col("c") >= word_net.LEAST) | (F.length("token") == 0)
    table = counts.where(often).toArrow()
    head = dict(zip(table.column("token").to_pylist(), table.column("c").to_pylist()))
    group = (F.crc32(F.substring("token", -2, 2)) % word_net.ENDINGS).cast("int").alias("ending")
    rare = {r["ending"]: (r["c"], r["v"]) for r in counts.where(~often).groupBy(group).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()}
    net = word_net.fit(train_docs, word_net.model_rows(head, {i: c for i, (c, _) in rare.items()}), text)
    types = np.ones(len(net.table))
    types[2:2 + word_net.ENDINGS] = [rare.get(i, (0, 0))[1] for i in range(word_net.ENDINGS)]
    mass = net.rows.counts + 0.5 * types
    net.less = np.log10(np.where(mass > 0, mass, 1) / words.mass) - (math.log10(1 - 0.5 / words.mass) if words.tokens else 0.0)
    net.squares = {}
    return net


class _Codes(word_net.Places):
    """A number for each word: its row in the model, or one of its own beyond them where only its count is held.

    ``row`` and ``base`` give the model's row and the base score of each number; ``base`` is NaN where the count is not held.
    """

    def __init__(self, words: Vocabulary, model: word_net.Net):
        super().__init__(model.rows.places())
        more = [w for w in words.head if w not in self]
        rows = len(model.rows.counts)
        self.row = np.concatenate([np.arange(rows), np.array([self[w] for w in more], np.int64)])
        self.update(zip(more, range(rows, rows + len(more))))
        self.base = np.full(len(self.row), np.nan)
        for w, c in words.head.items():
            self.base[self[w]] = words.base(c)


class _Slice:
    """Some texts and what is summed up of them; words wait until enough of them are scored together."""

    def __init__(self, texts: int, codes: _Codes, model: word_net.Net, known: bool):
        self.codes, self.model, self.known = codes, model, known
        self.n, self.met, self.base, self.gain = np.zeros(texts, np.int64), np.zeros(texts, np.int64), np.zeros(texts), np.zeros(texts)
        self.words, self.begin, self.place, self.last = [], [], [], (0, 0)

    def add(self, place: int, words: list[bytes]) -> None:
        """The next words of a text; the parts of a text come one after the other."""
        if not words:
            return
        if not self.place or self.place[-1] != place:
            self.begin.append(len(self.words))
            self.place.append(place)
        self.words += words

    def score(self, more: bool) -> pa.Table | None:
        """Sums up the waiting words; returns those without a count here, once a text. ``more``: the last text is not at its end."""
        if not self.words:
            return None
        code = np.fromiter(map(self.codes.__getitem__, self.words), np.int64, len(self.words))
        begin, place = np.array(self.begin), np.array(self.place)
        c = self.codes.row[code]
        b = np.append(0, c[:-1])
        b[begin] = 0
        b[0] = self.last[1]
        a = np.append(0, b[:-1])
        a[begin] = 0
        a[0] = self.last[0]
        gain, base = self.model.gains(a, b, c) if self.known else np.zeros(len(c)), self.codes.base[code]
        rare = np.isnan(base)
        self.n[place] += np.diff(np.append(begin, len(c)))
        for held, x in ((self.met, ~rare), (self.base, np.where(rare, 0.0, base)), (self.gain, np.where(rare, 0.0, gain))):
            held[place] += np.add.reduceat(x.astype(held.dtype), begin)
        at = np.flatnonzero(rare)
        owner = place[np.searchsorted(begin, at, side="right") - 1]
        out = pa.table({"place": owner, "token": pa.array([self.words[i] for i in at.tolist()], pa.binary()), "gain": gain[at]})
        self.last = (int(b[-1]), int(c[-1])) if more else (0, 0)
        self.words, self.begin, self.place = [], [], self.place[-1:] if more else []
        if more:
            self.begin = [0]
        return out.group_by(["place", "token"], use_threads=False).aggregate([("gain", "count"), ("gain", "sum")]) if len(at) else None


def score_texts(docs: DataFrame, counts: DataFrame, words: Vocabulary, model: word_net.Net, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every whole text, one row per row of ``docs``.

    A null text is empty: its only token is its end. Equal rows are scored once and come out as often as they went
    in; other columns are left out, so their names cannot clash; an empty table gives an empty result.

    Frequent words are summed up in the task. Each rare word of a text becomes a row that meets its exact count by a
    join on the word; as those words are rare, no key is hot.
    """
    shared = docs.sparkSession.sparkContext.broadcast((words, model))  # counts of at most HEAD_WORDS, and the model
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"), F.col(text).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "text_hash", "token", "n", "known", "base", "gain"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, model = shared.value
        codes = _Codes(words, model)

        def rows(batch: pa.RecordBatch, place, token, n, known, base, gain) -> pa.RecordBatch:
            place = pa.array(place, pa.int64())
            return pa.RecordBatch.from_arrays([batch.column(0).take(place), batch.column(1).take(place), token, n, known, base, gain], names=names)

        def rare(batch: pa.RecordBatch, part: _Slice, more: bool) -> Iterator[pa.RecordBatch]:
            found = part.score(more)
            for x in found.to_batches() if found is not None else []:
                none = pa.array(np.zeros(x.num_rows))
                yield rows(batch, x.column("place"), x.column("token"), x.column("gain_count").cast(pa.int64()), none.cast(pa.int64()), none, x.column("gain_sum"))

        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_TEXTS):
                batch = whole.slice(at, SLICE_TEXTS)
                own = _Slice(batch.num_rows, codes, model, words.tokens > 0)
                for place, x in enumerate(batch.column(2)):
                    for part in word_parts(x.as_py()):
                        own.add(place, part)
                        if len(own.words) > FLUSH_WORDS:
                            yield from rare(batch, own, True)
                    own.add(place, [END])
                yield from rare(batch, own, False)
                yield rows(batch, np.arange(batch.num_rows), pa.nulls(batch.num_rows, pa.binary()), *map(pa.array, (own.n, own.met, own.base, own.gain)))

    found = settle_table(narrow.mapInArrow(run, f"doc_id {kind}, text_hash long, token binary, n long, known long, base double, gain double"), "lm-found")
    sums = [F.sum(c).alias(c) for c in ("tokens", "known", "base", "gain")]
    base = F.log10((F.col("c") + 0.5) / F.lit(words.mass))
    rare = found.where("token is not null").select("doc_id", "text_hash", "token", "n", "gain").join(counts, "token", "left").select(
        "doc_id", "text_hash", F.lit(0).cast("long").alias("tokens"), F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0).alias("known"),
        (F.col("n") * F.coalesce(base, F.lit(words.base(0)))).alias("base"), F.when(F.col("c").isNotNull(), F.col("gain")).otherwise(0.0).alias("gain"), F.lit(0).alias("copy"))
    sure = found.where("token is null").select("doc_id", "text_hash", F.col("n").alias("tokens"), "known", "base", "gain", F.lit(1).alias("copy"))
    # Equal rows share a key: their sums are that many times one row's.
    out = sure.unionByName(rare).groupBy("doc_id", "text_hash").agg(*sums, F.sum("copy").alias("copies"))
    one = out.select("doc_id", (F.col("tokens") / F.col("copies")).cast("long").alias("n_tokens"), (F.col("known") / F.col("copies")).cast("long").alias("n_known"),
                     (F.col("base") / F.col("copies")).alias("base_score"), ((F.col("base") + F.col("gain")) / F.col("copies")).alias("score"), F.explode(F.expr("sequence(1, copies)")).alias("_"))
    return one.drop("_")


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    training = docs.where(remainder("doc_id", 5) != 1)
    counts = settle_table(count_words(training), "lm-counts")
    words = vocabulary(counts)
    out = score_texts(docs, counts, words, fit_words(training, counts, words))
    return out.select("doc_id", (remainder("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", F.lit(words.tokens).cast("long").alias("train_tokens"), "base_score", "score")
