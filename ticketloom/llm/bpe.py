"""Byte-level BPE over Arrow batches: encode whole texts by a rank file, decode the ids again.

The rank file becomes a model of the ``tokenizers`` library once, on the driver; its serialised form (a fixed size)
goes to the tasks. A task splits texts by the pattern, has the library merge each distinct piece and keeps a bounded
table of pieces it has met, because most pieces of a text are words it has met.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ticketloom.llm.common import map_texts, read

RANK_FILE = "byte_bpe_50k.tiktoken"
MAX_PIECES, MAX_CHARS = 150_000, 256  # pieces in a table, and characters of one
CHUNK_CHARS = 1 << 20
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: The pattern's matches never cross from one coarse piece into the next.
COARSE = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
UNEVEN = re.compile(f" (?:[{SPACE}]|$)")
SAFE_CUT = re.compile(f"(?<=[^{SPACE}]) (?=[^{SPACE}])")


def rank_file() -> str:
    import public_tokenizers

    return public_tokenizers.path(RANK_FILE)


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is one, else the next free code point from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


def _halves(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two parts whose merge makes ``token``: merge it by all lower ranks."""
    parts, limit = [token[i:i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], limit))
        if ranks.get(parts[best] + parts[best + 1], limit) >= limit:
            raise ValueError(f"rank {limit} cannot be reached by merges")
        parts[best:best + 2] = [parts[best] + parts[best + 1]]
    return parts[0], parts[1]


def serialised_model(path: str) -> str:
    """The rank file as a ``tokenizers`` model, without pattern and special tokens."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    char = byte_characters()
    name = lambda token: "".join(char[b] for b in token)
    merges = [tuple(map(name, _halves(t, ranks))) for t in sorted(ranks, key=ranks.get) if len(t) > 1]
    made = Tokenizer(models.BPE(vocab={name(t): n for t, n in ranks.items()}, merges=merges, cache_capacity=0, ignore_merges=True))
    made.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return made.to_str()


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, model: str, pattern: str):
        import os

        import regex

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.fine = regex.compile(pattern).findall
        self.tokenizer = Tokenizer.from_str(model)
        byte = {c: b for b, c in enumerate(byte_characters())}
        vocab = self.tokenizer.get_vocab()
        self.table: list[bytes] = [b""] * (max(vocab.values()) + 1)
        for token, n in vocab.items():
            self.table[n] = bytes(byte[c] for c in token)
        self.merge = self.tokenizer.model.tokenize
        self.character = dict(enumerate(byte_characters()))
        self.coded = [n.to_bytes(4, "little") for n in range(len(self.table))]
        self.after_space: dict[str, bytes] = {}  # piece -> ids of a blank and the piece
        self.alone: dict[str, bytes] = {}
        self.before: dict[str, dict[str, bytes]] = {"": {}, " ": {}}  # the tables that were full last

    def _ids(self, piece: str, lead: str) -> bytes:
        parts = [x.encode().decode("latin-1").translate(self.character) for x in self.fine(lead + piece)]
        return b"".join([self.coded[t.id] for x in parts for t in self.merge(x)])

    def _learn(self, pieces, known: dict[str, bytes], lead: str) -> dict[str, bytes]:
        """Put the ids of all ``pieces`` into the table ``known``; a full one becomes the second, older table.

        Pieces over ``MAX_CHARS`` are not kept: their ids are returned.
        """
        new = set(pieces).difference(known)
        if not new:
            return {}
        long = {p: self._ids(p, lead) for p in new if len(p) > MAX_CHARS}
        new.difference_update(long)
        if len(known) + len(new) > MAX_PIECES:
            self.before[lead] = dict(known)
            known.clear()
            new = set(pieces).difference(long)
        older, coded, character = self.before[lead], self.coded, self.character
        for p in new:
            ids = older.get(p)
            if ids is None:
                parts = [x.encode().decode("latin-1").translate(character) for x in self.fine(lead + p)]
                ids = b"".join([coded[t.id] for x in parts for t in self.merge(x)])
            known[p] = ids
        return long

    def chunks(self, text: str) -> Iterator[str]:
        """Long texts in parts, cut where the pattern's matches always end."""
        at = 0
        while len(text) - at > CHUNK_CHARS and (cut := SAFE_CUT.search(text, at + CHUNK_CHARS)):
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:]

    def encode(self, text: str) -> bytes:
        """The ids, as little-endian unsigned 32-bit integers."""
        out = []
        for part in self.chunks(text):
            if UNEVEN.search(part, 1) or part[:2] == "  ":
                pieces, known, lead = COARSE.findall(part), self.alone, ""
            else:
                first, *pieces = part.split(" ")
                known, lead = self.after_space, " "
                if first:
                    long = self._learn([first], self.alone, "")
                    out.append(long[first] if long else self.alone[first])
            long = self._learn(pieces, known, lead)
            out.extend([long[p] if p in long else known[p] for p in pieces] if long else [known[p] for p in pieces])
        return b"".join(out)

    def decode(self, ids) -> bytes:
        """The bytes of ids; unknown ids are an error. A character split over ids comes together again."""
        table = self.table
        return b"".join([table[i] for i in ids])


def _map(df: DataFrame, column: str, keep: tuple[str, ...], path: str | None, pattern: str | None, make, fields: dict[str, str]) -> DataFrame:
    import public_tokenizers

    pattern = pattern or public_tokenizers.PATTERN
    model = df.sparkSession.sparkContext.broadcast(serialised_model(path or rank_file()))  # fixed size

    def start():
        codec = Codec(model.value, pattern)
        return lambda values: make(codec, values)

    return map_texts(df, column, keep, start, fields)


def encode_texts(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), path: str | None = None, pattern: str | None = None) -> DataFrame:
    """The ``keep`` columns, then ids array<int> and offsets array<int> per row, in no other order than the input's.

    ``offsets`` holds, for each id, the index of the character (code point) in which its bytes begin; ids that split a
    character share its index. A null or empty text gives empty arrays. Texts are encoded whole, repeated rows alike,
    other columns are left out, so their names cannot clash; an empty table gives an empty result.
    """
    def make(codec: Codec, column: pa.Array) -> list[pa.Array]:
        ids, offsets = [], []
        for text in column.to_pylist():
            data = (text or "").encode()
            own = np.frombuffer(codec.encode(text or ""), "<u4").astype("i4")
            begins = np.cumsum([0] + [len(codec.table[i]) for i in own])[:-1].astype(int)
            character = np.cumsum((np.frombuffer(data, "u1") & 0xC0) != 0x80) - 1
            ids.append(own)
            offsets.append(character[begins].astype("i4") if len(own) else np.zeros(0, "i4"))
        kind = pa.list_(pa.int32())
        return [pa.array(ids, kind), pa.array(offsets, kind)]

    return _map(df, text, keep, path, pattern, make, {"ids": "array<int>", "offsets": "array<int>"})


def decode_ids(df: DataFrame, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",), path: str | None = None) -> DataFrame:
    """The ``keep`` columns, then bytes binary and text string per row of ids.

    Null ids give empty bytes. Where ids begin or end inside a character, its bytes are in ``bytes`` and the
    replacement character is in ``text``. An id outside the rank file is an error.
    """
    def make(codec: Codec, column: pa.Array) -> list[pa.Array]:
        data = [codec.decode(x or ()) for x in column.to_pylist()]
        return [pa.array(data, pa.binary()), pa.array([x.decode(errors="replace") for x in data], pa.string())]

    return _map(df, ids, keep, path, None, make, {"bytes": "binary", "text": "string"})


def round_trip(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), path: str | None = None, pattern: str | None = None, with_ids: bool = False) -> DataFrame:
    """The ``keep`` columns, then n_tokens, ids_sha256 and decoded_sha256 of every text, encoded and decoded again.

    A null text is empty. The ids themselves leave the task only ``with_ids``.
    """
    def make(codec: Codec, column: pa.Array) -> list[pa.Array]:
        counts, coded, decoded, kept = [], [], [], []
        for text in column:
            data = codec.encode(text.as_py() or "")
            ids = np.frombuffer(data, "<u4")
            counts.append(len(ids))
            coded.append(hashlib.sha256(data).hexdigest())
            decoded.append(hashlib.sha256(codec.decode(ids.tolist())).hexdigest())
            kept.append(ids.astype("i4"))
        out = [pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())]
        return [*out, pa.array(kept, pa.list_(pa.int32()))] if with_ids else out

    fields = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    return _map(df, text, keep, path, pattern, make, {**fields, "ids": "array<int>"} if with_ids else fields)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read(spark, sf_dir, "documents"))
