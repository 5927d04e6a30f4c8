"""Harmonic packing: pieces of tokenised documents in classes by reciprocals of the capacity, a fixed count to a bin.

A piece of ``n`` tokens belongs to class ``j = capacity // n``: it needs one of ``j`` equal slots of a sequence, and ``j``
pieces of the class fill one. Whole capacities are cut off a document first; what is left is cut where it would waste more
of its slot than its document's slack, into a piece that fills a slot of the next class and a rest. Each task fills bins of
its own; the pieces that complete no bin are numbered within their class over all tasks by a small count table, so at most
``j - 1`` pieces of a class remain, and those few are packed together, longest first.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketloom.llm.bpe import byte_characters
from ticketloom.llm.common import read, word_parts
from ticketloom.session import settle_table

VOCABULARY = "word_bpe_49k.json"
CAPACITY, END_ID, SLACK = 2048, 1, 0.01
CACHE_BYTES, CACHED_WORD, ENTRY_BYTES, CACHED_PARTS = 48 << 20, 256, 150, 200_000
#: Printable ASCII without A-Z and small letters of the Latin-1 block: no normalisation or lower-casing changes them.
COMMON = re.compile(r"[!-@\[-~\xdf-\xf6\xf8-\xff]+").fullmatch
#: The model's pattern on such characters.
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z\xdf-\xf6\xf8-\xff0-9]+").findall
SPECIAL = re.compile(r"<\|(?:start|end)oftext\|>", re.IGNORECASE).search
FLUSH_PIECES = 8192
#: Sequences filled by one task, over tasks, and by the last pieces have ids from different ranges.
TASK_IDS, CLASS_IDS, OVER_TASKS, LAST = 1 << 32, 1 << 44, 1 << 60, 1 << 61


def vocabulary_file() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class WordEncoder:
    """Ids of texts by a ``tokenizers`` model that drops white space, from tables of met words bounded by bytes.

    A word of common letters that lower-casing leaves alone is cut by the model's own pattern and its parts go straight to
    the merges; any other word goes through the whole library.
    """

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.merge = self.tokenizer.model.tokenize
        self.character = dict(enumerate(byte_characters()))
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.held = 0

    def _library(self, word: bytes) -> bytes:
        return array("I", self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()

    def _part(self, part: str) -> bytes:
        ids = array("I", [t.id for t in self.merge(part.encode().decode("latin-1").translate(self.character))]).tobytes()
        if len(self.parts) >= CACHED_PARTS:
            self.parts.clear()
        self.parts[part] = ids
        return ids

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if len(text) > CACHED_WORD or not COMMON(text) or SPECIAL(text):
            return self._library(word)
        known = self.parts
        return b"".join([known.get(p) or self._part(p) for p in PARTS(text)])

    def ids(self, words: list[bytes]) -> bytes:
        """Ids of the words in turn, as little-endian unsigned 32-bit integers."""
        if self.held > CACHE_BYTES:
            self.known, self.older, self.held = {}, self.known, 0
        known, older, long = self.known, self.older, {}
        for word in set(words).difference(known):
            if len(word) > CACHED_WORD:
                long[word] = None
                continue
            ids = known[word] = older.get(word) or self._word(word)
            self.held += len(word) + len(ids) + ENTRY_BYTES
        if not long:
            return b"".join([known[w] for w in words])
        return b"".join([self._library(w) if w in long else known[w] for w in words])

    def text(self, text: str | None) -> Iterator[bytes]:
        """Ids of a text in parts of bounded size. A-Z may be lower-cased first unless that could make a special token."""
        lower = not SPECIAL(text or "")
        return (self.ids(words) for words in word_parts(text, lower=lower))


def cut(length: int, allowed: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of what is left of a document: each wastes at most ``allowed`` tokens of its slot."""
    out = []
    while length:
        j = capacity // length
        if capacity // j - length <= allowed:
            return [*out, length]
        out.append(capacity // (j + 1))
        length -= out[-1]
    return out


def pieces(parts: Iterator[bytes], capacity: int = CAPACITY, end_id: int = END_ID, slack: float = SLACK) -> tuple[int, list[tuple[int, int, int]]]:
    """(tokens, [(start, length, crc32 of the ids)]) of a document whose ids come in parts; the end id is added."""
    out, rest, at, size = [], bytearray(), 0, 4 * capacity
    for part in parts:
        rest += part
        whole = len(rest) // size * size
        for low in range(0, whole, size):
            out.append((at, capacity, crc32(memoryview(rest)[low:low + size])))
            at += capacity
        del rest[:whole]
    rest += int(end_id).to_bytes(4, "little")
    tokens, low = at + len(rest) // 4, 0
    for n in cut(len(rest) // 4, int(tokens * slack), capacity):
        out.append((at, n, crc32(memoryview(rest)[low:low + 4 * n])))
        at, low = at + n, low + 4 * n
    return tokens, out


def _fill(docs: DataFrame, doc_id: str, text: str, model: str, capacity: int, end_id: int, slack: float) -> DataFrame:
    """All pieces: in the bins their task has filled, or without one and numbered within class and task."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a vocabulary file, of fixed size
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "task", "place", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = WordEncoder(shared.value), TaskContext.get().partitionId()
        open_bins: dict[int, list] = {}
        rows, filled, id_type = [], 0, None

        def batch_of(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:])], names=names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for own, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens, found = pieces(encoder.text(x.as_py()), capacity, end_id, slack)
                for start, length, crc in found:
                    j = capacity // length
                    held = open_bins.setdefault(j, [])
                    held.append((own, start, length, crc, tokens))
                    if len(held) == j:
                        offset = 0
                        for p in held:
                            rows.append((*p, j, task, None, task * TASK_IDS + filled, offset))
                            offset += p[2]
                        filled += 1
                        held.clear()
                if len(rows) >= FLUSH_PIECES:
                    yield batch_of(rows)
                    rows = []
        rows += [(*p, j, task, i, None, None) for j, held in open_bins.items() for i, p in enumerate(held)]
        if id_type is not None:
            yield batch_of(rows)

    return narrow.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"`{n}` long" for n in names[1:]))


def _pack_last(capacity: int):
    """The pieces that complete no bin of their class anywhere: fewer than ``j`` of class ``j``, so a bounded number."""
    def work(rows: pa.Table) -> pa.Table:
        null_last = [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]
        rows = rows.sort_by(null_last).drop_columns(["one", "sequence_id", "offset"])
        room: list[int] = []
        bins, offsets = [], []
        for n in rows.column("length").to_pylist():
            at = next((i for i, free in enumerate(room) if free >= n), len(room))
            if at == len(room):
                room.append(capacity)
            bins.append(LAST + at)
            offsets.append(capacity - room[at])
            room[at] -= n
        return rows.append_column("sequence_id", pa.array(bins, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    return work


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, slack: float = SLACK) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and ``end_id``; every id lies in exactly one piece, and pieces lie in their sequence without
    gaps. A piece leaves at most ``slack`` times its document's tokens of its slot empty. A null or empty text is the end id
    alone; repeated rows, also null ids, are documents of their own; other columns are ignored, so their names cannot
    clash; an empty table gives an empty result. Long texts are read in parts: besides the text only the ids of a piece
    are held.
    """
    with open(path or vocabulary_file(), encoding="utf-8") as f:
        model = f.read()
    placed = settle_table(_fill(docs, doc_id, text, model, capacity, end_id, slack), "pack-pieces")
    result = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    over = placed.where("sequence_id is null")
    # One count per class and task stands for the pieces: its running sum numbers them over all tasks.
    counts = over.groupBy("class", "task").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("class").orderBy("task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("class", "task", before.alias("before"), F.sum("n").over(W.partitionBy("class")).alias("all"))
    numbered = over.join(starts, ["class", "task"]).withColumn("number", F.col("before") + F.col("place")).withColumn("bin", F.floor(F.col("number") / F.col("class")))
    numbered = settle_table(numbered, "pack-over")
    whole = F.col("bin") < F.floor(F.col("all") / F.col("class"))
    offset = F.coalesce(F.sum("length").over(W.partitionBy("class", "bin").orderBy("number").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    over_tasks = numbered.where(whole).withColumn("offset", offset).withColumn("sequence_id", F.lit(OVER_TASKS) + F.col("class") * F.lit(CLASS_IDS) + F.col("bin"))
    last = numbered.where(~whole).select(*result)
    last = last.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(_pack_last(capacity), last.schema)
    return placed.where("sequence_id is not null").select(*result).union(over_tasks.select(*result)).union(last)


def op11_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
