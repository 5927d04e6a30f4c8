"""Packing against the whole tokenizer, lexical search and resampling against brute force, and all three on odd input."""

import hashlib
import math
import random
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import pytest

from ticketloom.llm import common, lexical, packing, resampling

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"
TERM = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))


def terms(text):
    data = bytes(b if b in TERM else 32 for b in (text or "").encode().lower())
    return data.split()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank and very long texts, repeated rows and ids, ties, other scripts, special tokens, clashing columns."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog"), (1, "the quick brown fox jumps over the lazy dog"), (2, None), (None, "no id here at all"), (None, None),
        (4, ""), (5, " \t\n "), (6, "".join(f"the of and word{i} and the. " for i in range(20_000))), (7, "le chat est sur la table é È ü Straße ΑΣ İ"),
        (8, "Привет мир 中文 😀 don't DON'T 12a3"), (9, "<|ENDOFTEXT|>a <|endoftext|>b A<|startoftext|>"), (10, "The QUICK brown-fox"), (11, "a\x1cb\x85c d́e x" + "z" * 400)]
    rows += [(100 + i, " ".join(random.Random(i).choices(["fox", "dog", "the", "table", "lazy", "über", "run"], k=25))) for i in range(60)]
    clash = "'x' AS score, 1 AS rank, 2 AS start, 3 AS length, 4 AS weight, 5 AS class, 6 AS sequence_id, 7 AS item_id"
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", *clash.split(", ")).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- packing ---------------------------------------------------------------------------

def check_packing(docs, rows, capacity=packing.CAPACITY):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.vocabulary_file())
    found, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        found[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"], r["ids_crc32"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    want = defaultdict(Counter)
    for d in docs:
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids + [packing.END_ID]
        lengths = [capacity] * (len(ids) // capacity) + packing.cut(len(ids) % capacity, int(len(ids) * packing.SLACK), capacity)
        at = 0
        for n in lengths:
            want[d["doc_id"], len(ids)][at, n, zlib.crc32(array("I", ids[at:at + n]).tobytes())] += 1
            at += n
        assert at == len(ids)
    assert {k: Counter(v) for k, v in found.items()} == dict(want)
    padding = 0
    for held in sequences.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_packing_holds_every_id_once(spark, odd, table):
    docs = odd if table == "odd" else spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack(docs).collect()
    padding = check_packing(docs.collect(), rows)
    assert padding <= 0.01 * sum(r["length"] for r in rows) + packing.CAPACITY


def test_packing_other_capacity_and_empty_table(spark, odd, empty):
    few = odd.where("doc_id >= 100")
    check_packing(few.collect(), packing.pack(few, capacity=64).collect(), 64)
    assert packing.pack(empty).count() == 0


@pytest.mark.parametrize("length", [1, 45, 682, 683, 1025, 1500, 2047])
def test_cut_wastes_no_more_than_allowed(length):
    for allowed in (0, 5, 40):
        parts = packing.cut(length, allowed)
        assert sum(parts) == length
        assert all(2048 // (2048 // n) - n <= allowed for n in parts)


def test_word_tables_stay_bounded(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_BYTES", 2000)
    monkeypatch.setattr(packing, "CACHED_PARTS", 5)
    with open(packing.vocabulary_file(), encoding="utf-8") as f:
        encoder = packing.WordEncoder(f.read())
    text = " ".join(f"word{i}, Other{i % 7}" for i in range(300))
    got = b"".join(encoder.text(text))
    assert got == array("I", encoder.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
    b"".join(encoder.text("again and again"))
    assert encoder.held < 2000 and len(encoder.parts) <= 5


# ---- lexical search --------------------------------------------------------------------

def brute_search(docs, queries, k):
    held = [(i, Counter(terms(t))) for i, t in docs if i is not None]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in sorted({i: max(x for j, x in queries if j == i and x is not None) for i, x in queries if i is not None and x is not None}.items()):
        scores = []
        for doc, c in held:
            m = 75 + 25 * sum(c.values()) * n // total
            s = sum(a * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, a in Counter(terms(text)).items() if t in c)
            scores.append((-s, doc))
        out += [(item, r, d, -s) for r, (s, d) in enumerate(sorted(x for x in scores if x[0] < 0)[:k], 1)]
    return out


def test_lexical_equals_brute_force(spark, odd, empty):
    items = [(1, "The lazy FOX the fox"), (2, None), (3, ""), (4, "привет über 中文"), (5, "nothingknown"), (6, "word19999 and table"), (7, "run dog"), (7, "run"), (None, "fox")]
    queries = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in lexical.ranked_documents(odd, queries, k=7).collect())
    assert got == brute_search([(r["doc_id"], r["text"]) for r in odd.collect()], items, 7)
    assert lexical.ranked_documents(empty, queries).count() == 0
    assert lexical.ranked_documents(odd, queries.limit(0)).count() == 0


def test_shards_prune_and_stay_exact(monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", 4)
    rng = random.Random(3)
    words = [f"w{i}".encode() for i in range(200)]
    docs = [(i, rng.choices(words, weights=[1 / (j + 1) for j in range(200)], k=rng.randint(1, 60))) for i in range(900)]
    totals = lexical.Totals(len(docs), sum(len(w) for _, w in docs))
    df = Counter(t for _, w in docs for t in set(w))
    shards = [lexical.index_shard([(i, len(w), Counter(w)) for i, w in docs[a:a + 300]], totals) for a in range(0, 900, 300)]
    read = np.zeros(2, np.int64)
    for q in range(40):
        query = Counter(rng.choices(words, k=6))
        vocabulary = sorted(query)
        weights = np.array([totals.weight(df[t]) * query[t] for t in vocabulary], np.int64)
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for row in shards:
            found, value = lexical.Shard(row, vocabulary).search(np.arange(len(vocabulary)), weights, int(scores[-1]) if len(ids) == 5 else 0, 5, read)
            ids, scores = np.append(ids, found), np.append(scores, value)
            order = np.lexsort((ids, -scores))[:5]
            ids, scores = ids[order], scores[order]
        want = []
        for i, w in docs:
            c, m = Counter(w), totals.norm(len(w))
            want.append((-sum(int(x) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, x in zip(vocabulary, weights) if c[t]), i))
        want = sorted(x for x in want if x[0] < 0)[:5]
        assert list(zip((-scores).tolist(), ids.tolist())) == want
    assert read[1] < 0.9 * read[0]


# ---- resampling ------------------------------------------------------------------------

def brute_features(text):
    w = terms(text)
    return Counter(zlib.crc32(g) % 10_000 for g in [*w, *(a + b" " + b for a, b in zip(w, w[1:]))])


def brute_resample(docs, target, percent=25, least=20):
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(brute_features(x))
    for x in target:
        t.update(brute_features(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))
    out = []
    for i, x in docs:
        f = brute_features(x)
        n = sum(f.values())
        weight = sum(gain(b) * c for b, c in f.items()) // n if n else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(terms(x))))
    rated = sorted((-r[3], r[0]) for r in out if r[4] >= least)[:percent * sum(r[4] >= least for r in out) // 100]
    return out, rated


def test_resampling_equals_brute_force(spark, odd, empty):
    target = spark.createDataFrame([("the lazy fox über",), (None,), ("run fox run",)], "text string")
    got = resampling.resample(odd, target).collect()
    want, drawn = brute_resample([(r["doc_id"], r["text"]) for r in odd.collect()], ["the lazy fox über", None, "run fox run"])
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(r["doc_id"], r["n_features"], r["weight"], r["score"], r["n_words"]) for r in got], key=key) == sorted(want, key=key)
    assert sorted((r["rank"], -r["score"], r["doc_id"]) for r in got if r["rank"]) == [(i, s, d) for i, (s, d) in enumerate(drawn, 1)]
    assert resampling.resample(empty, target).count() == 0
    assert {r["weight"] for r in resampling.resample(odd.where("text = ''"), empty).collect()} == {0}


def test_resampled_rows_are_the_sample(spark, odd):
    target = spark.createDataFrame([("fox",)], "text string")
    rows = resampling.resample(odd.select("doc_id", "text"), target, percent=50, keep=("doc_id", "text")).where("rank IS NOT NULL").collect()
    assert rows and all(r["text"] for r in rows)
    with pytest.raises(ValueError):
        resampling.resample(odd, target, keep=("doc_id", "score"))


def test_n_grams_cross_the_parts_of_a_text():
    text = " ".join(random.Random(1).choices(["a", "bb", "ccc", "d"], k=400))
    for order in (1, 2, 3):
        whole = parts = None
        for size in (1 << 20, 50):
            counts = Counter()
            for _, values, n in resampling.gram_counts(text, order, size):
                for v, c in zip(values.tolist(), n.tolist()):
                    counts[v] += c
            counts = +counts
            whole, parts = (counts, parts) if size > 50 else (whole, counts)
        assert whole == parts and sum(whole.values()) == sum(400 - n + 1 for n in range(1, order + 1))


def test_term_parts_blank_separators_only():
    assert [w for p in common.term_parts("Ab_c-D9\x00é ÀB|x", 4) for w in p] == [b"ab", b"c", b"d9", "é".encode(), "Àb".encode(), b"x"]
