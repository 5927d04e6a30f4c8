"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.session import settle_table

#: A word is a run of other characters than blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
NOT_WORD = " \t\n\x0b\x0c\r"
SMALL_BYTES = 8_000_000
PART_BYTES = 4 << 20
GAP = re.compile(rb"[\x20\x09-\x0d]")
#: Letters and digits of ASCII and every byte above it stay, A-Z as a-z; all other bytes are blanks.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
TERM_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def local_if_small(df: DataFrame, name: str, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Write ``df`` once in the shared folder; when its rows prove to take at most ``max_bytes``, mark it for broadcast.

    A larger table comes back without the mark, and joins with it are shuffled.
    """
    kept = settle_table(df, name)
    width = sum((F.coalesce(F.length(F.to_json(F.struct(F.col(f"`{c}`")))), F.lit(0)) for c in kept.columns), F.lit(16))
    size = kept.agg(F.sum(width.cast("long")).alias("n")).first()["n"] or 0
    return F.broadcast(kept) if size <= max_bytes else kept


def word_count(text) -> Column:
    """Number of words of a text in constant extra memory; null counts as empty.

    Each word, with the white space before it, becomes one letter, so the length is the count.
    """
    col = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    marks = F.regexp_replace(col, r"[\x20\x09-\x0D]*" + WORD, "x")
    return F.length(F.rtrim(marks, F.lit(NOT_WORD))).cast("long")


def _slices(data: bytes, gap: re.Pattern, size: int) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        end = len(data)
        if at + size < end and (found := gap.search(data, at + size)):
            end = found.start()
        yield data[at:end]
        at = end


def word_parts(text: str | None, size: int = PART_BYTES, lower: bool = True) -> Iterator[list[bytes]]:
    """The words of a text, A-Z lower-cased unless told otherwise, in parts of bounded size; a null text has none."""
    data = (text or "").encode()
    for part in _slices(data.lower() if lower else data, GAP, size):
        yield part.split()


def term_parts(text: str | None, size: int = PART_BYTES) -> Iterator[list[bytes]]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased, in parts of bounded size.

    One byte table lower-cases and blanks the separators; no byte of a longer character is touched. A null text has none.
    """
    for part in _slices((text or "").encode(), TERM_GAP, size):
        yield part.translate(TERM_BYTES).split()


def map_texts(df: DataFrame, text: str, keep: tuple[str, ...], start, fields: dict[str, str], rows: int = 256) -> DataFrame:
    """The ``keep`` columns of ``df`` and new ones made from the column ``text``, in Arrow batches of bounded size.

    ``start()`` is called once in each task and returns a function from a text array to the arrays of ``fields``.
    Columns of ``df`` that are not kept are left out, so their names cannot clash with the new ones.
    """
    clash = set(keep) & set(fields)
    if clash:
        raise ValueError(f"kept columns clash with new ones: {sorted(clash)}")
    columns = [*keep] if text in keep else [*keep, text]
    at = columns.index(text)
    narrow = df.select(*[F.col(f"`{c}`") for c in columns])
    kept = [f"`{c}` {narrow.schema[c].dataType.simpleString()}" for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for whole in batches:
            for low in range(0, whole.num_rows, rows):
                batch = whole.slice(low, rows)
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *make(batch.column(at))], names=[*keep, *fields])

    return narrow.mapInArrow(run, ", ".join([*kept, *(f"`{n}` {t}" for n, t in fields.items())]))
