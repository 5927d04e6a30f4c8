"""Language detection and translation as a distinct-translate-join job.

The translation model is the caller's: ``translate_fn(texts, langs) -> texts`` is called
per Arrow batch inside the tasks, once per distinct text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketloom.operators.memo import MemoStore, unseen
from ticketloom.operators.vectorize import tokens
from ticketloom.session import measured, settle_table, small_copy

TranslateFn = Callable[[Sequence[str], Sequence[str]], Sequence[str]]

MAX_CHARS = 500
TARGET = "en"
SCALE = 1_000_000
PROFILE_PARTS = 64
HEAVY_SHARE = 0.01
SLICE_ROWS = 256

# Detected codes and the codes the translation model knows them by.
LANGUAGE_CODES = {
    "fro": "fr",
    "la": "it",
    "nn": "no",
    "kmr": "tr",
}


def map_language_code(code: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in LANGUAGE_CODES.items() for x in pair])
    return F.coalesce(table[code], code)


def translation_input(text: Column, max_chars: int | None = MAX_CHARS) -> Column:
    """What the model is given: over-long texts end in ``...``; ``None`` keeps them whole."""
    if max_chars is None:
        return text
    return F.when(F.length(text) > max_chars, F.concat(F.substring(text, 1, max_chars), F.lit("..."))).otherwise(text)


def fit_language_profiles(df: DataFrame, text_col: str, lang_col: str, top_words: int | None = None) -> DataFrame:
    """``(lang, word, weight)``: the words of each language.

    The weight is the word's document share in millionths. ``top_words`` keeps only a language's most
    frequent words; they are ranked in salted parts first, and only the best of each part meet in the final ranking.
    """
    words = df.select(F.col(lang_col).alias("lang"), F.explode(F.array_distinct(tokens(F.lower(text_col)))).alias("word"))
    counts = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("docs"))
    sizes = df.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("total"))
    weight = F.expr(f"(docs * {SCALE}) div total").alias("weight")
    if top_words is None:
        return counts.join(measured(sizes), "lang").select("lang", "word", weight)
    best = [F.desc("docs"), F.asc("word")]
    parts = counts.withColumn("_part", F.pmod(F.xxhash64("word"), F.lit(PROFILE_PARTS)))
    parts = parts.withColumn("_rn", F.row_number().over(W.partitionBy("lang", "_part").orderBy(*best))).filter(F.col("_rn") <= top_words)
    top = parts.withColumn("_rn", F.row_number().over(W.partitionBy("lang").orderBy(*best))).filter(F.col("_rn") <= top_words).drop("_rn", "_part")
    return top.join(measured(sizes), "lang").select("lang", "word", weight)


def detect_language(df: DataFrame, text_col: str, id_col: str, profiles: DataFrame, fallback: str | None = None, out: str = "detected") -> DataFrame:
    """Add the best-scoring language; ties go to the smaller code.

    Words meet the profile by a join that is broadcast while the profile is small; see :func:`meet_profile` beyond. The
    scores are summed map-side, so a few rows per text are shuffled.
    """
    words = df.select(F.col(id_col), F.explode(F.array_distinct(tokens(F.lower(text_col)))).alias("word"))
    small = small_copy(profiles)
    met = words.join(F.broadcast(small), "word") if small is not None else meet_profile(words, profiles)
    scores = met.groupBy(id_col, "lang").agg(F.sum("weight").alias("score"))
    best = scores.groupBy(id_col).agg(F.min(F.struct(-F.col("score"), F.col("lang").alias("lang")))["lang"].alias(out))
    joined = df.join(best, id_col, "left")
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(fallback))) if fallback else joined


def meet_profile(words: DataFrame, profiles: DataFrame, share: float = HEAVY_SHARE) -> DataFrame:
    """``words`` joined with a profile of any size; no shuffled word holds more than ``share`` of the rows.

    Words above the share are counted, map-side first; there are at most ``1 / share`` of them, so their part of the
    profile is broadcast and their rows stay where they are. All other words are shuffled.
    """
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    heavy = F.broadcast(settle_table(counts.filter(F.col("n") > share * total).select("word"), "heavy-words"))
    near = words.join(F.broadcast(profiles.join(heavy, "word", "left_semi")), "word")
    far = words.join(heavy, "word", "left_anti").join(profiles.join(heavy, "word", "left_anti").hint("shuffle_hash"), "word")
    return near.unionByName(far.select(*near.columns))


def translated(batches: Iterable[pa.RecordBatch], translate_fn: TranslateFn, batch_size: int) -> Iterator[pa.RecordBatch]:
    """``(text, lang)`` to ``(text, translated)``; a failing text comes back as it was.

    Some ``SLICE_ROWS`` texts at a time become Python strings, however large an Arrow batch is.
    """
    for whole in batches:
        for low in range(0, whole.num_rows, SLICE_ROWS):
            rows, out = whole.slice(low, SLICE_ROWS), []
            texts, langs = rows.column("text").to_pylist(), rows.column("lang").to_pylist()
            for i in range(0, len(texts), batch_size):
                part, codes = texts[i:i + batch_size], langs[i:i + batch_size]
                try:
                    out += list(translate_fn(part, codes))
                except Exception:
                    for text, code in zip(part, codes):
                        try:
                            out += list(translate_fn([text], [code]))
                        except Exception:
                            out.append(text)
            yield pa.RecordBatch.from_arrays([rows.column("text"), pa.array(out, rows.schema.field("text").type)], names=["text", "translated"])


def _run(df: DataFrame, translate_fn: TranslateFn, batch_size: int) -> DataFrame:
    return df.select("text", "lang").mapInArrow(lambda batches: translated(batches, translate_fn, batch_size), "text string, translated string")


def translate_distinct(
    texts: DataFrame, translate_fn: TranslateFn, profiles: DataFrame | None = None, max_chars: int | None = None,
    batch_size: int = 10, memo: DataFrame | None = None,
) -> DataFrame:
    """``(text, lang, translated)`` for a table of distinct, non-empty ``text``.

    Texts already in ``memo`` (``text, translated``) are left out. English texts come back
    in the form the model would have been given. A text whose language is null gets the
    detected one if there are ``profiles``; otherwise the model is asked without a code.
    """
    work = texts.withColumn("given", translation_input(F.col("text"), max_chars))
    if memo is not None:
        work = unseen(work, "given", memo)
    if "lang" not in work.columns:
        work = work.withColumn("_key", F.md5("given"))
        work = detect_language(work, "given", "_key", profiles, TARGET, "lang").drop("_key")
    elif profiles is not None:
        unknown = work.filter(F.col("lang").isNull()).drop("lang").withColumn("_key", F.md5("given"))
        unknown = detect_language(unknown, "given", "_key", profiles, TARGET, "lang").drop("_key")
        work = work.filter(F.col("lang").isNotNull()).unionByName(unknown)
    work = work.withColumn("lang", map_language_code(F.col("lang")))
    english = work.filter(F.col("lang") == TARGET).select("text", "lang", F.col("given").alias("translated"))
    other = work.filter(F.col("lang").isNull() | (F.col("lang") != TARGET))
    done = _run(other.groupBy(F.col("given").alias("text")).agg(F.min("lang").alias("lang")), translate_fn, batch_size)
    foreign = other.join(done.select(F.col("text").alias("given"), "translated"), "given").select("text", "lang", "translated")
    return english.unionByName(foreign)


def translate_column(
    df: DataFrame, column: str, translate_fn: TranslateFn, new_column: str | None = None, profiles: DataFrame | None = None,
    lang_col: str | None = None, max_chars: int | None = None, batch_size: int = 10,
) -> DataFrame:
    """Add ``<column>_en``. Null and empty texts pass through.

    Each distinct text is translated once, whichever and however many rows hold it. The
    language comes from ``lang_col`` or, where that is null or not given, from ``profiles``.
    """
    if column not in df.columns:
        raise ValueError(f"Column '{column}' not found")
    target = new_column or f"{column}_en"
    text = F.col(f"`{column}`")
    asked = df.filter(text.isNotNull() & (text != ""))
    if lang_col:
        distinct = asked.groupBy(text.alias("text")).agg(F.min(lang_col).alias("lang"))
    else:
        if profiles is None:
            raise ValueError("give a language column or fitted profiles")
        distinct = asked.select(text.alias("text")).distinct()
    table = translate_distinct(distinct, translate_fn, profiles, max_chars, batch_size)
    table = table.select(F.col("text").alias("_text"), F.col("translated").alias(target))
    joined = df.join(table, text == F.col("_text"), "left").drop("_text")
    return joined.withColumn(target, F.coalesce(F.col(f"`{target}`"), text))


def new_entries(memo: DataFrame, texts: DataFrame, translate_fn: TranslateFn, profiles: DataFrame | None = None, max_chars: int | None = None) -> DataFrame:
    """``(text, translated)`` of the texts that the memo lacks; known texts are left out before anything is shuffled.

    The memo is keyed by the text the model is given, so an over-long text is looked up by its shortened form.
    """
    given = texts.select(*[c for c in texts.columns if c in ("text", "lang")]).withColumn("text", translation_input(F.col("text"), max_chars))
    given = unseen(given.filter((F.col("text") != "") & F.col("text").isNotNull()), "text", memo)
    given = given.groupBy("text").agg(F.min("lang").alias("lang")) if "lang" in given.columns else given.distinct()
    return translate_distinct(given, translate_fn, profiles, None).select("text", "translated")


def extend_memo(memo: DataFrame, texts: DataFrame, translate_fn: TranslateFn, profiles: DataFrame | None = None, max_chars: int | None = None) -> DataFrame:
    """The memo with the translations it lacked; write it back as parquet to keep it, or use a :class:`MemoStore`."""
    return memo.select("text", "translated").unionByName(new_entries(memo, texts, translate_fn, profiles, max_chars))


def extend_store(store: MemoStore, texts: DataFrame, translate_fn: TranslateFn, profiles: DataFrame | None = None, max_chars: int | None = None) -> DataFrame:
    """Like :func:`extend_memo` on a stored memo: only what it lacked is written, as a part of its own."""
    store.add(new_entries(store.table(), texts, translate_fn, profiles, max_chars))
    return store.table()
