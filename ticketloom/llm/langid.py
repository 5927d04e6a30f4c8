"""Language identification by nearest centroids of TF-IDF character n-grams.

Each language has several centroids, clustered by cosine from a bounded sample of its labelled texts. A text takes the
language of the closest centroid; one too far from all is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketloom.llm.common import local_if_small, map_texts, read, remainder
from ticketloom.session import settle_table

BITS = 14
ORDERS = 3
CENTROIDS = 3
#: At most so many labelled texts of each language fit its centroids: those with the lowest keyed hash.
FIT_ROWS = 800
MIN_COSINE = 0.025
UNKNOWN = "und"
CHUNK_CHARS = 1 << 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def gram_counts(text: str) -> np.ndarray:
    """Counts of hashed runs of 1 to 3 characters; what is not a letter counts as one blank."""
    out = np.zeros(1 << BITS, np.int64)
    text = " " + text.lower() + " "
    for at in range(0, len(text), CHUNK_CHARS):
        chars = np.frombuffer(text[at:at + CHUNK_CHARS + ORDERS - 1].encode("utf-32-le", "replace"), "<u4")
        chars = np.where(letters()[chars], chars, 32)
        chars = chars[np.concatenate([[True], (chars[1:] != 32) | (chars[:-1] != 32)])].astype(np.uint64)
        code = chars
        for n in range(1, ORDERS + 1):
            if n > 1:
                code = code[:-1] * MULTIPLIER + chars[n - 1:]
            mixed = ((code ^ (code >> np.uint64(29))) * MULTIPLIER) >> np.uint64(64 - BITS)
            out += np.bincount(mixed[code != 32].astype(np.int64), minlength=1 << BITS)
    return out


def vector(text: str, idf: np.ndarray) -> np.ndarray:
    """The unit TF-IDF vector of a text, with damped term counts; zero if nothing counts."""
    v = (np.log1p(gram_counts(text)) * idf).astype(np.float32)
    norm = float(np.sqrt(v @ v))
    return v / norm if norm else v


def spherical_clusters(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of unit rows; starts are the mean and then the rows farthest from those taken."""
    unit = lambda m: m / np.maximum(np.sqrt((m * m).sum(axis=-1, keepdims=True)), 1e-12)
    starts = [unit(x.sum(axis=0))]
    while len(starts) < min(k, len(x)):
        starts.append(x[int(np.argmin(np.max(np.stack(starts) @ x.T, axis=0)))])
    centres, before = np.stack(starts), None
    for _ in range(rounds):
        own = np.argmax(centres @ x.T, axis=0)
        if before is not None and (own == before).all():
            break
        before = own
        centres = np.stack([unit(x[own == i].sum(axis=0)) if (own == i).any() else centres[i] for i in range(len(centres))])
    return centres.astype(np.float32)


@dataclass
class LanguageModel:
    langs: list[str]  # of each centroid
    centres: np.ndarray
    idf: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and cosine of the closest centroid; ``und`` and 0 without a letter or without centroids."""
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0
        cosine = self.centres @ vector(text, self.idf)
        best = int(np.argmax(cosine))
        return self.langs[best], float(np.clip(cosine[best], 0, 1))


def _sample(docs: DataFrame, text: str, lang: str, doc_id: str, per_lang: int) -> DataFrame:
    """(lang, text) of at most ``per_lang`` rows of each language: lowest hash first, without sorting a language."""
    unit = F.pmod(F.xxhash64(F.col(doc_id), F.xxhash64(F.col(text)), F.lit("lang")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = docs.where(F.col(lang).isNotNull() & (F.length(text) > 0)).select(F.col(lang).cast("string").alias("lang"), unit.alias("u"), F.col(text).alias("text"))
    counts = local_if_small(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang-counts")
    near = rows.join(counts, "lang").where(F.col("u") * F.col("n") <= F.lit(1.5 * per_lang))
    place = F.row_number().over(W.partitionBy("lang").orderBy("u", "text"))
    return near.withColumn("place", place).where(F.col("place") <= per_lang).select("lang", "text")


def fit_languages(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", per_lang: int = FIT_ROWS, k: int = CENTROIDS) -> LanguageModel:
    """Centroids from ``docs``, which must hold training rows only.

    Rows with a null language or no text are left out. One task clusters one language's bounded sample.
    """
    rows = settle_table(_sample(docs, text, lang, doc_id, per_lang), "lang-rows")

    # Document frequencies are those of all training rows; only the centroids are fitted on the sample.
    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for t in batch.column(0):
                total += gram_counts(t.as_py()) > 0
                n += 1
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1).astype(np.int32)), pa.array(np.append(total[seen], n))], names=["bucket", "df"])

    every = docs.where(F.col(lang).isNotNull() & (F.length(text) > 0)).select(F.col(text).alias("text"))
    table = every.mapInArrow(present, "bucket int, df long").groupBy("bucket").agg(F.sum("df").alias("df")).toArrow()  # a row a bucket
    found = dict(zip(table.column("bucket").to_pylist(), table.column("df").to_pylist()))
    n, df = found.pop(-1, 0), np.zeros(1 << BITS, np.int64)
    df[list(found.keys())] = list(found.values())
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + np.float32(0.1)

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        x = np.stack([vector(t, idf) for t in group["text"] if has_letter(t)] or [np.zeros(1 << BITS, np.float32)])
        centres = [c for c in spherical_clusters(x, k) if c.any()]
        return pd.DataFrame({"lang": [group["lang"].iloc[0]] * len(centres), "centre": [c.tobytes() for c in centres]}, dtype=object)

    found = sorted(((r["lang"], r["centre"]) for r in rows.groupBy("lang").applyInPandas(cluster, "lang string, centre binary").collect()))
    centres = np.stack([np.frombuffer(c, np.float32) for _, c in found]) if found else np.zeros((0, 1 << BITS), np.float32)
    return LanguageModel([name for name, _ in found], centres, idf)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",), min_cosine: float = MIN_COSINE, names: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """The ``keep`` columns, then lang_pred, score and rejected of every whole text.

    ``score`` is the cosine to the closest centroid. ``rejected`` marks texts below ``min_cosine`` and those that are
    ``und``: null, empty or without a letter. Equal cosines go to the language first by name. Repeated rows are judged
    alike; other columns are left out, so their names cannot clash (``names`` are those of the new ones); an empty
    table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages times centroids of a fixed size

    def start():
        model = shared.value

        def make(texts: pa.Array) -> list[pa.Array]:
            found = [model.predict(x.as_py()) for x in texts]
            langs, scores = [x[0] for x in found], np.array([x[1] for x in found], np.float64)
            gone = (scores < min_cosine) | np.array([x == UNKNOWN for x in langs], bool)
            return [pa.array(langs, pa.string()), pa.array(scores), pa.array(gone)]

        return make

    return map_texts(docs, text, keep, start, dict(zip(names, ("string", "double", "boolean"))))


def with_known_language(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are not rejected by a model fitted on ``docs``, all columns kept."""
    model = fit_languages(docs, text, lang, doc_id)
    found = identify(docs, model, text, tuple(docs.columns), names=("__lang", "__score", "__rejected"))
    return found.where("not __rejected").drop("__lang", "__score", "__rejected")


def training_documents(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return docs.where(remainder(doc_id, 4) != 2)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = identify(docs, fit_languages(training_documents(docs)))
    return out.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")
