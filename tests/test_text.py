"""Selection, cleaning, translation: hand-computed and regex-checked cases."""

import random
import re
import sys

import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from ticketloom.functions import noise
from ticketloom.functions.noise import NOISE_PATTERNS, NoiseRegistry, fused_registry, java_pattern, squeeze
from ticketloom.operators import clean, select, translate
from ticketloom.sources.tickets import INTERACTION, SUMMARY, read_tickets_csv, write_tickets_csv

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TEXTS = [
    "Dear Customer, thank you for contacting us. 12 March 10:30 Finance for: market",
    "RE: FW : [x] null pointer", "a b c d e", "12x34 may 5", "x y z\x0bq\x1cw\r\nend", "İstanbul ΟΣ ١٢٣",
    "we hope you're doing well. SE is the provider of Huawei Mobile Services to Huawei and Honor device owners in", "", "   ", "自动回复",
    "support.pt 自动回复: hello", "r :\n re\t: from : x", "thank you for your patience during investigation", "I will do my very best to assist you in order to give you the best solution",
]


def expected(text, patterns):
    if not text:
        return ""
    text = text.lower()
    for p in patterns:
        text = re.sub(p, " ", text)
    return re.sub(r"\s+", " ", text).strip()


@pytest.mark.parametrize("which", ["summary", "interaction", "fused"])
def test_cleaning_equals_python_regex(spark, which):
    registry = fused_registry() if which == "fused" else NoiseRegistry()
    patterns = registry.summary_patterns() if which == "summary" else registry.interaction_patterns()
    make = clean.clean_summary if which == "summary" else clean.clean_interaction
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, t string")
    got = {r["id"]: r["c"] for r in df.select("id", make(F.col("t"), registry).alias("c")).collect()}
    assert got == {i: expected(t, patterns) for i, t in enumerate(TEXTS)}


def test_registry_is_immutable_and_ordered():
    base = NoiseRegistry()
    grown = base.with_pattern("mine", "zz").with_pattern("days", "holiday")
    assert base.categories == tuple(NOISE_PATTERNS) and len(base.categories) == 13
    assert grown.categories[-1] == "mine"
    assert grown.patterns("days")[-1] == "holiday"
    assert "zz" in grown.interaction_patterns() and "zz" not in base.interaction_patterns()
    assert len(fused_registry().interaction_patterns()) == len(base.interaction_patterns()) - 2


def test_custom_pattern_applies_last(spark):
    registry = NoiseRegistry().with_pattern("mine", "app").with_pattern("ticket_noise", "bug")
    df = spark.createDataFrame([("bug app one", "bug app one")], [SUMMARY, INTERACTION])
    row = clean.preprocess(df, registry=registry).first()
    assert (row["ts"], row["ic"]) == ("app one", "bug one")


def test_null_and_empty_rules(spark):
    rows = [(1, None, "text body"), (2, "sum mary", None), (3, "", ""), (4, "RE: app", "words here")]
    df = spark.createDataFrame(rows, f"id int, `{SUMMARY}` string, `{INTERACTION}` string")
    out = {r["id"]: r["ic"] for r in clean.preprocess(select.text_types(df)).collect()}
    assert out == {2: "nan", 4: "words here"}


def test_statistics(spark):
    df = spark.createDataFrame([("a",), ("abc",), ("",), (None,), ("a",)], "t string")
    row = clean.text_statistics(df, "t").first()
    assert row.asDict() == {"total_texts": 4, "empty_texts": 1, "avg_length": 1.25, "min_length": 0, "max_length": 3, "unique_texts": 3}
    with pytest.raises(ValueError):
        clean.text_statistics(df, "missing")


def test_targets_and_frequency_thresholds(spark):
    rows = [(i, "ten", "q") for i in range(10)] + [(i, "eleven", "q") for i in range(10, 21)] + [(30, "eleven", ""), (31, None, "q"), (32, "ten", None)]
    df = spark.createDataFrame(rows, "id int, y1 string, y string")
    kept = select.drop_empty_targets(df)
    assert kept.count() == 22
    assert {r["y1"] for r in select.frequent_classes(kept, "y1", 10).collect()} == {"eleven"}
    assert {r["y1"] for r in select.keep_classes(kept, "y1", at_least=10).collect()} == {"ten", "eleven"}


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, 'quote " and, comma', "line one\nline two", "a", "b", "", None), (2, "null", "NaN", "N/A", "x", "y", "z")]
    names = ["id", SUMMARY, INTERACTION, "Type 1", "Type 2", "Type 3", "Type 4"]
    df = spark.createDataFrame(rows, "id long, a string, b string, c string, d string, e string, f string").toDF(*names)
    write_tickets_csv(df, str(tmp_path / "csv"))
    got = {r["id"]: tuple(r)[1:] for r in read_tickets_csv(spark, str(tmp_path / "csv")).collect()}
    assert got == {1: ('quote " and, comma', "line one\nline two", "a", "b", None, None), 2: (None, None, None, "x", "y", "z")}


def shout(texts, langs):
    if any("boom" in t for t in texts):
        raise RuntimeError("model failed")
    return [f"{lang}!{t}" for t, lang in zip(texts, langs)]


def test_translation_rules(spark):
    long_en, long_fr = "e" * 501, "f" * 501
    rows = [(1, "bonjour", "fro"), (2, "hello", "en"), (3, "", "fr"), (4, None, "fr"), (5, long_en, "en"), (6, long_fr, "kmr"),
            (7, "f" * 500, "nn"), (8, "boom", "fr"), (9, "bonjour", "fro")]
    df = spark.createDataFrame(rows, "id int, t string, lang string")
    whole = {r["id"]: r["t_en"] for r in translate.translate_column(df, "t", shout, lang_col="lang").collect()}
    assert (whole[5], whole[6]) == (long_en, "tr!" + long_fr)
    got = {r["id"]: r["t_en"] for r in translate.translate_column(df, "t", shout, lang_col="lang", max_chars=500).collect()}
    assert got == {1: "fr!bonjour", 2: "hello", 3: "", 4: None, 5: "e" * 500 + "...", 6: "tr!" + "f" * 500 + "...", 7: "no!" + "f" * 500, 8: "boom", 9: "fr!bonjour"}
    with pytest.raises(ValueError):
        translate.translate_column(df, "missing", shout, lang_col="lang")


def test_language_detection_and_memo(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, "the end", "en")], "id int, t string, lang string")
    profiles = translate.fit_language_profiles(docs, "t", "lang")
    new = spark.createDataFrame([(1, "the bird"), (2, "le chien noir"), (3, "zzz")], "id int, t string")
    got = {r["id"]: r["detected"] for r in translate.detect_language(new, "t", "id", profiles).collect()}
    assert got == {1: "en", 2: "fr", 3: None}
    memo = spark.createDataFrame([("le chat", "the cat")], "text string, translated string")
    texts = spark.createDataFrame([("le chat",), ("le chien",)], "text string")
    grown = {r["text"]: r["translated"] for r in translate.extend_memo(memo, texts, shout, profiles).collect()}
    assert grown == {"le chat": "the cat", "le chien": "fr!le chien"}


def test_faster_patterns_replace_the_same(spark):
    """Every rewritten pattern, and the squeeze, leave what the plain one leaves."""
    rng = random.Random(5)
    words = ["january", "jan", "june", "maybe", "mar", "march", "augu", "monday", "satur", "day", "hello", "hi there", "hi", "hallo", "from :", "re :", "r\t:", "sent :", "fwd :", "fw:",
             "sv  :", "ynt:", "[x]", "null", "nan", "bonus place my support.pt \u81ea\u52a8\u56de\u590d:", "support!pt \u81ea\u52a8\u56de\u590d:", "aspiegel support issue submit", "12:30", "12 30", "12\n30", "\u0661\u0662x\u0663\u0664",
             "\u00e9", "a", "-", "x1", "\u00a0", "\u2003", "\x1c", "\n", "\t", "  ", " "]
    texts = [(i, "".join(rng.choice(words) + rng.choice(["", " ", "  ", "\n"]) for _ in range(rng.randrange(12)))) for i in range(400)]
    df = spark.createDataFrame([*texts, (400, ""), (401, " "), (402, "a"), (403, "\n")], "id int, text string")
    plain = lambda p: ("(?dU)" if re.search(r"\\[sdwb]", p, re.IGNORECASE) else "(?d)" if "." in p else "") + p
    checks = {f"p{i}": (F.regexp_replace("text", java_pattern(p), " "), F.regexp_replace("text", plain(p), " ")) for i, p in enumerate(noise.FASTER)}
    checks["squeeze"] = squeeze(F.col("text")), F.trim(F.regexp_replace("text", r"(?U)[\s\x{1c}-\x{1f}]+", " "))
    wrong = df.select("id", "text", *[(~a.eqNullSafe(b)).alias(n) for n, (a, b) in checks.items()])
    assert all(java_pattern(p) != plain(p) for p in noise.FASTER)
    assert [r for r in wrong.collect() if any(r[n] for n in checks)] == []


def test_needed_text_is_in_every_match():
    from ticketloom.functions.noise import needed

    assert needed("thank you for reaching us (back)?") == "thank you for reaching us " and needed("sent from my huawei (cell )?phone") == "sent from my huawei "
    assert needed("dear?") == needed("dear|good") == needed("(dear)+") == needed("(?i)dear") == needed("a[b]cdef") == ""
    assert needed("abcdef*") == "abcde" and needed("abc.defg") == "defg" and needed("dear ((customer)|(user))") == "dear "
    assert sum(bool(needed(p)) for group in NOISE_PATTERNS.values() for p in group) > 20


def test_translation_takes_slices_of_a_batch():
    seen = []
    batch = pa.RecordBatch.from_arrays([pa.array([f"t{i}" for i in range(2000)]), pa.array(["fr", None] * 1000)], names=["text", "lang"])
    parts = translate.translated([batch], lambda texts, langs: seen.extend(texts) or [f"{g}:{t}" for t, g in zip(texts, langs)], 10)
    first = next(parts)
    assert len(seen) == first.num_rows == translate.SLICE_ROWS
    whole = pa.Table.from_batches([first, *parts])
    assert whole.column("translated").to_pylist()[:2] == ["fr:t0", "None:t1"] and whole.num_rows == 2000


def test_word_vectors_are_trained_in_several_tasks(spark, monkeypatch):
    from ticketloom.operators import vectorize

    asked = []
    monkeypatch.setattr(vectorize, "WORDS_CHARS", 1000, raising=False)
    monkeypatch.setattr(vectorize, "Word2Vec", lambda _make=vectorize.Word2Vec, **k: asked.append(k.get("numPartitions", 1)) or _make(**k))
    df = spark.createDataFrame([(i, "some words that come again") for i in range(100)], "id int, text string")
    assert vectorize.WordEmbedding.fit(df, "text").transform(df).count() == 100 and asked == [3]
