"""Each operator against a brute-force version, an exact round trip or held-out accuracy, and on odd input."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest

from ticketloom.llm import ann, bm25, bpe, langid, language_model, mixing, registry, simhash, template, toxicity, url_rules
from ticketloom import session
from ticketloom.llm import common
from ticketloom.llm.components import connected

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.1"
WORDS = [re.compile(rb"[^\x20\x09-\x0D]+")]
CLASHING = "'x' AS score, 1 AS size, 'y' AS k, 2 AS h, 'z' AS token, 3 AS rank, 4 AS fp, 5 AS ids, 6 AS predicted, 'q' AS lang_pred, 7 AS target, 8 AS host, 9 AS path, 10 AS verdict, 11 AS component_id, 12 AS row, 13 AS n"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORDS[0].findall((text or "").encode().lower())


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows, ties, other scripts, clashing columns."""
    long = "the of and word%d and the. " * 1
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 1), (1, "the quick brown fox jumps over the lazy dog", "en", "a", 1),
        (2, None, None, None, None), (None, "no id here at all", "en", None, 1), (None, None, None, None, None), (4, "", "de", "b", 0),
        (5, " \t\n ", "fr", "b", 4), (6, "".join(long % i for i in range(20_000)), "en", "a", 9), (50, "le chat est sur la table é è ü", "fr", "c", 5),
        (100, "the quick brown fox jumps over the lazy dog", "en", "c", 6), (7, "123 456 !!", "es", "a", 3), (8, "Привет мир 中文 😀", None, "d", 7), (0, "THE end", "en", "é", 1)]
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", *CLASHING.split(", "))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(registry.oracle_sql()[name]).df()
    got = registry.queries()[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    # A whole-number column with nulls comes as floats from one side and as nullable numbers from the other.
    whole = lambda v: str(int(v)) if float(v).is_integer() else repr(round(v, 5))
    cell = lambda v: "~" if pd.isna(v) else whole(v) if isinstance(v, float) else str(v)
    both = [sorted(tuple(map(cell, r)) for r in d[sorted(want.columns)].itertuples(index=False, name=None)) for d in (got, want)]
    assert both[0] == both[1]


# ---- 1 toxicity -------------------------------------------------------------------------

def test_toxicity_held_out(spark):
    got = toxicity.op1_toxicity(spark, LARGER).toPandas()
    truth = duckdb.sql(f"SELECT doc_id, toxic FROM '{LARGER}/labels.parquet'").df()
    seen = got[got.held_out].merge(truth, on="doc_id")
    assert len(got) == 10_000 and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    assert seen[seen.predicted == 1].toxic.mean() > 0.95
    assert seen[seen.toxic == 1].predicted.mean() > 0.85


def test_toxicity_odd(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (6, 0), (7, 0), (None, 1), (8, None), (99, 1), (50, 5)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(odd, labels)
    got = rows_of(toxicity.score_toxicity(odd, model), "doc_id", "score")
    assert len(got) == odd.count() and all(0 <= s <= 1 for _, s in got)
    assert len({s for d, s in got if d in (1, 100)}) == 1  # equal texts score alike
    assert toxicity.score_toxicity(empty, model).count() == 0
    none = toxicity.fit_toxicity(odd, labels.where("false"))
    assert {s for _, s in rows_of(toxicity.score_toxicity(odd, none), "doc_id", "score")} == {0.5}
    assert set(toxicity.without_toxic(odd, labels).columns) == set(odd.columns)


def test_grams_do_not_depend_on_parts(monkeypatch):
    text = "Ein Beispieltext mit einigen Wörtern, é and more. " * 9
    whole = {n: Counter() for n in toxicity.ORDERS}
    counts = Counter(np.concatenate(list(toxicity.gram_codes(text))).tolist())
    monkeypatch.setattr(toxicity, "CHUNK_CHARS", 37)
    assert Counter(np.concatenate(list(toxicity.gram_codes(text))).tolist()) == counts
    assert sum(counts.values()) == sum(len(text) + 2 - n + 1 for n in whole)


# ---- 2 main text ------------------------------------------------------------------------

def test_main_text_of_articles(spark):
    import html

    def want(page):
        inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:h1|p|br)[^>]*>", inner)]
        return "\n".join(p for p in parts if p)

    truth = dict(duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall())
    got = template.op2_main_text(spark, SF).collect()
    assert len(got) == len(truth)
    assert all(r["text"] == want(truth[r["page_id"]]) and r["n_chars"] == len(r["text"]) for r in got)


PAGE = """<html><head><title>x</title><script>if(a<b){"</p>"}</script></head><body><header><h1>Site</h1></header><div class="cookie-notice">We use cookies</div>
<div class="main"><div class="a1"><h2>Title &amp; more %d</h2><p>First <b>bold</b> para<br>line &nbsp; two %d<p>Second &lt;x&gt; &#233;<ul><li>one<li>two</ul><aside>related</aside>
<form><p>Name</p><input></form><div class="ad">buy</div><p class="x7">Reproduced by kind permission</p><section id="comments"><p>nice!</p></section></div></div><div id="sidebar">s</div><footer>f</footer></body></html>"""


def test_template_of_a_host(spark):
    """No article element: the root is deduced, a slot with the same text on all pages goes."""
    pages = spark.createDataFrame([(i, f"http://Host.example/{i}", PAGE % (i, i)) for i in range(8)], "page_id long, url string, html string")
    for r in template.main_texts(pages).collect():
        assert r["text"] == f"Title & more {r['page_id']}\nFirst bold para line two {r['page_id']}\nSecond <x> é\none\ntwo"


def test_main_text_odd(spark):
    pages = [(1, None, None), (None, "x", ""), (2, "http://a", "plain"), (2, "http://a", "plain"), (3, "http://a", "<p>a<p>b<!-- c"), (4, "http://b/", "<p>" + "long words " * 200_000 + "</p>"), (5, "http://c", "<a href='x>y<b"), (6, "http://d", "<article><p>é&#x1F600;</p><style>p{</style></article>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'x' AS host", "'y' AS text", "1 AS n_chars", "'z' AS roots")
    got = sorted(((r["page_id"] or 0, r["text"], r["n_chars"]) for r in template.main_texts(df).collect()), key=lambda r: (r[0], len(r[1])))
    assert [(i, n) for i, _, n in got] == [(0, 0), (1, 0), (2, 5), (2, 5), (3, 3), (4, 200_000 * 11 - 1), (5, 14), (6, 2)]
    assert got[-1][1] == "é😀" and got[4][1] == "a\nb"
    assert template.main_texts(df.where("false")).count() == 0


def _wording(n, layout):
    """Varied paragraphs around one sentence of the site's."""
    return f"""<html><body><div class="menu">menu</div><div class="{layout}"><h2>Heading {n}</h2><p>First paragraph, number {n * n}, of some length.</p><p>Subscribe to our daily letter</p>
<p>Second paragraph with other words {n + 7}.</p><div class="thread"><p>reader {n}</p></div><p>All rights kept by us</p></div></body></html>"""


@pytest.mark.parametrize("n,layouts", [(20, ["content"]), (3, ["content"]), (20, ["content", "story", "b1", "b2", "b3"])])
def test_wording_of_templates_goes(spark, n, layouts):
    """On all pages of a host, on a small host, and in layouts on a fifth of the pages each."""
    pages = [(i, f"https://w.example/{i}", _wording(i, layouts[i % len(layouts)])) for i in range(n)]
    got = {r["page_id"]: r["text"] for r in template.main_texts(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Heading {i}\nFirst paragraph, number {i * i}, of some length.\nSecond paragraph with other words {i + 7}." for i in range(n)}


def test_copied_pages_lose_nothing(spark):
    """Copies and near copies of an article, alone on their host, under an element of their own, and beside others."""
    page = "<html><body><article id='%s'><p>First long paragraph of the text.</p><p>Second one.</p><p>seen %d</p></article></body></html>"
    rows = [(1, "http://a", page % ("one", 1)), (2, "http://a", page % ("one", 2)), (3, "http://b", page % ("x", 1)), (4, "http://b", page % ("x", 1))]
    rows += [(i, "http://c", page % ("abcdefgh"[i // 2 % 8], i)) for i in range(10, 20)]
    got = {r["page_id"]: r["text"] for r in template.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"First long paragraph of the text.\nSecond one.\nseen {1 if i in (3, 4) else i}" for i, _, _ in rows}


def test_constant_blocks_equal_brute_force(spark):
    """Vectors counted page by page: a block goes if it comes as often as an element around it, on every page."""
    pages = [(i, f"http://{'ab'[i % 3 == 0]}.example/", _wording(i, "one" if i % 2 else "two")) for i in range(24)]
    vectors, spans, where = defaultdict(Counter), defaultdict(int), {}
    for i, url, page in pages:
        events = template.events_of(page)
        for path, row in template.tokens(events).items():
            vectors[url, path][i] += row[0]
        for key, (path, n, chars) in template.block_tokens(events).items():
            vectors[url, key][i] += n
            spans[url, key] += chars
            where[url, key] = path
    want = defaultdict(set)
    for (url, path), vector in list(vectors.items()):
        if isinstance(path, str) and len(vector) > 1:
            below = [k for u, k in where if u == url and (where[u, k] + "/").startswith(path + "/")]
            same = {k for k in below if vectors[url, k] == vector}
            if 2 * sum(spans[url, k] for k in same) < sum(spans[url, k] for k in below):
                want[url] |= same
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    classes = common.settle_table(template.equivalence_classes(template.page_tokens(df)), "t")
    got = {r["host"]: set(r["dropped"]) for r in template.constant_blocks(classes).collect()}
    assert got == {url[7:-1]: keys for url, keys in want.items()} and all(len(k) == 4 for k in got.values())  # two sentences in two layouts


def test_deep_pages_are_linear():
    import time

    begun = time.time()
    for page in ("<b>" * 20_000 + "deep", "<div>" * 20_000 + "deep" + "</i></div>" * 20_000, "<p><a>" * 20_000 + "deep", "<a " * 100_000 + "deep"):
        list(template.walk(page, template.is_side))
    assert time.time() - begun < 4
    deep = "<article>" + "<div>" * 300 + "<p>kept</p><nav>menu<p>of links</p></nav>" + "</div>" * 300 + "<p>end</p></article>"
    assert template.extract(deep, ["/article"], []) == "kept\nend"


# ---- 3 language model -------------------------------------------------------------------

def test_language_model_counts(spark):
    got = {r["doc_id"]: r for r in language_model.op3_language_model(spark, SF).collect()}
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    c = Counter()
    for i, t in texts.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            c.update([*words(t), b""])
    n, v = sum(c.values()), len(c)
    for i, t in texts.items():
        own, r = [*words(t), b""], got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(own), sum(w in c for w in own), n, zlib.crc32(str(i).encode()) % 5 == 1)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own), rel=1e-9)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_rare_words_join_like_frequent_ones(spark, odd, monkeypatch):
    docs = odd.select("doc_id", "text")
    counts = language_model.settle_table(language_model.count_words(docs), "t")
    out, net = [], language_model.fit_words(docs, counts, language_model.vocabulary(counts))
    for head in (200_000, 3):
        vocab = language_model.vocabulary(counts, head)
        out.append(sorted(((r["doc_id"] or -1, r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in language_model.score_texts(odd, counts, vocab, net).collect())))
    assert out[0] == out[1] and len(out[0]) == odd.count()


def test_language_model_empty(spark, empty):
    counts = language_model.settle_table(language_model.count_words(empty), "t")
    vocab = language_model.vocabulary(counts)
    net = language_model.fit_words(empty, counts, vocab)
    assert language_model.score_texts(empty, counts, vocab, net).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    (r,) = language_model.score_texts(one, counts, vocab, net).collect()
    assert (r["n_tokens"], r["n_known"], r["base_score"], r["score"]) == (3, 0, 0.0, 0.0)


def test_word_net_is_normalised_and_follows_the_vocabulary(spark, monkeypatch):
    monkeypatch.setattr(language_model.word_net, "LEAST_POSITIONS", 400_000)
    texts = [(i, " ".join(f"w{(i + j) % 200}aa x{(i + j) % 200}bb" for j in range(40)) + f" once{i}") for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    counts = language_model.settle_table(language_model.count_words(docs), "t")
    vocab = language_model.vocabulary(counts)
    net = language_model.fit_words(docs, counts, vocab)
    assert len(net.rows.words) == 400  # each frequent word has a row of its own, not only the first 94
    places, known = net.rows.places(), {bytes(r["token"]): r["c"] for r in counts.collect()}
    of = np.array([places[w] for w in known])
    for a, b in ((0, 0), (0, 2), (places[b"x1bb"], places[b"w2aa"]), (places[b"once3"], 1)):
        gain = net.gains(np.full(len(of), a), np.full(len(of), b), of)
        assert sum(10 ** (vocab.base(c) + g) for c, g in zip(known.values(), gain)) + 10 ** vocab.base(0) == pytest.approx(1, abs=1e-4)
    # w<i>aa is always followed by x<i>bb; classes by ending give each of the 200 at most 1/200.
    rare = [w for w in net.rows.words if w.startswith(b"w")]
    after, own = np.array([places[b"x" + w[1:-2] + b"bb"] for w in rare]), np.array([places[w] for w in rare])
    previous = np.array([places[b"x%dbb" % ((int(w[1:-2]) - 1) % 200)] for w in rare])
    follows = net.log_p(previous, own, after)
    assert follows.mean() > math.log10(0.02)


def test_word_net_sums_once_for_a_context(monkeypatch):
    """Equal contexts share one sum over the groups; the results are those of a plain softmax over all rows."""
    net, rng, met = language_model.word_net, np.random.default_rng(5), []
    rows = net.model_rows({b"": 9, **{b"w%d" % i: 400 - i for i in range(300)}}, {i: 3 for i in range(net.ENDINGS)})
    model = net.start(rows)
    model.table[:, net.WIDTH:2 * net.WIDTH] = rng.normal(0, 0.5, (len(model.table), net.WIDTH))
    model.dense["group"][:] = rng.normal(0, 0.5, model.dense["group"].shape)
    plain = net._log_sums
    monkeypatch.setattr(net, "_log_sums", lambda q, *x: met.append(len(q)) or plain(q, *x))
    c = rng.permutation(np.arange(1, len(rows.counts)))
    a, b = np.where(c % 2, 5, 200), np.where(c % 3, 7, 1)
    got = model.log_p(a, b, c)
    assert met[0] == 4  # contexts, not positions
    group = rows.group(np.arange(len(rows.counts)))
    held = np.bincount(group, rows.counts, minlength=rows.groups) > 0
    for i in range(0, len(c), 29):
        q = model.table[a[i], :net.WIDTH] @ model.dense["far"] + model.table[b[i], :net.WIDTH] @ model.dense["near"]
        z = np.exp(model.dense["group"] @ q + model.dense["bias"]) * held
        want = np.log10(z[group[c[i]]] / z.sum())
        if c[i] >= net.ALONE:
            mine = np.flatnonzero(group == group[c[i]])
            z = np.exp(model.table[mine, net.WIDTH:2 * net.WIDTH] @ q + model.table[mine, 2 * net.WIDTH])
            want += np.log10(z[mine == c[i]][0] / z.sum())
        assert got[i] == pytest.approx(want, abs=1e-4)
    assert len(model.log_p(a[:0], b[:0], c[:0])) == 0


def test_language_model_scores_parts_like_whole_texts(spark, odd, monkeypatch):
    """Wherever waiting words are scored, a text's sums and the context of its next word stay the same."""
    docs = odd.where("doc_id is null or doc_id <> 6").select("doc_id", "text").unionByName(spark.createDataFrame([(900 + i, " ".join(f"v{j % (7 + i)}" for j in range(300))) for i in range(3)], "doc_id long, text string"))
    counts = language_model.settle_table(language_model.count_words(docs), "t")
    vocab = language_model.vocabulary(counts, 3)
    net, out = language_model.fit_words(docs, counts, vocab), []
    for flush, size, part in ((400_000, 1024, 4 << 20), (1, 2, 8)):
        monkeypatch.setattr(language_model, "FLUSH_WORDS", flush)
        monkeypatch.setattr(language_model, "SLICE_TEXTS", size)
        monkeypatch.setattr(language_model, "word_parts", lambda text, part=part: common.word_parts(text, part))
        got = language_model.score_texts(docs, counts, vocab, net).collect()
        out.append(sorted((r["doc_id"] or -1, r["n_tokens"], r["n_known"], round(r["base_score"], 6), r["score"]) for r in got))
    assert [r[:4] for r in out[0]] == [r[:4] for r in out[1]] and len(out[0]) == docs.count()
    assert [r[4] for r in out[0]] == pytest.approx([r[4] for r in out[1]], rel=1e-5)


def test_word_net_rounds_without_positions(spark, monkeypatch):
    """One text has no position for some rounds; what the rounds read is deleted at the end."""
    net = language_model.word_net
    monkeypatch.setattr(net, "LEAST_POSITIONS", 1)
    model = net.fit(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), net.model_rows({b"": 1, b"a": 1, b"b": 1}, {}))
    assert np.isfinite(model.table).all() and not any("lm-ids" in x for x in session._SCRATCH)


def test_word_net_trains_all_positions(spark, monkeypatch):
    """Every position is dealt into a round of the training."""
    net, seen = language_model.word_net, []
    monkeypatch.setattr(net, "LEAST_POSITIONS", 1)
    for n in (300, 600):
        docs = spark.createDataFrame([(i, f"a b c d{i % 5} e") for i in range(n)], "doc_id long, text string")
        ids = net.encode(docs, net.model_rows({b"": n, b"a": n, b"b": n}, {}))
        rows = [(r["turn"], len(r["ids"]) // 4 - 2) for r in ids.collect()]
        assert {t for t, _ in rows} <= set(range(net.ROUNDS))
        seen.append(sum(x for _, x in rows))
    assert seen == [300 * 6, 600 * 6]


# ---- 4 SimHash --------------------------------------------------------------------------

def slow_fingerprint(text):
    import xxhash

    w = words(text)
    shingles = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def slow_components(fps, ids):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    distinct = list(root)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 4:
                root[max(find(a), find(b))] = min(find(a), find(b))
    first = {}
    for f, i in zip(fps, ids):
        if i is not None:
            first[find(f)] = min(first.get(find(f), i), i)
    return [first.get(find(f)) for f in fps]


def test_simhash_query(spark, monkeypatch):
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op4_simhash(spark, SF).collect()}
    fps = [slow_fingerprint(t) for _, t in texts]
    monkeypatch.setattr(common, "PART_BYTES", 64)
    monkeypatch.setattr(simhash, "CHUNK_BYTES", 64)
    assert [simhash.fingerprint(t) for _, t in texts] == fps
    assert [got[i] for i, _ in texts] == list(zip([f"{f:016x}" for f in fps], slow_components(fps, [i for i, _ in texts])))


@pytest.mark.parametrize("bucket_rows", [2_000, 40])
def test_links_of_dense_groups(spark, bucket_rows):
    """Many fingerprints within a few bits of one another, in small and in dealt-out buckets."""
    rng = np.random.default_rng(3)
    fps = [int(x) for x in rng.integers(0, 1 << 64, 300, dtype=np.uint64)]
    for centre in fps[:3]:
        for _ in range(150):
            flip = 0
            for b in rng.integers(0, 64, rng.integers(1, 6)):
                flip ^= 1 << int(b)
            fps.append(centre ^ flip)
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.link_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp long"), bucket_rows=bucket_rows)
    roots = {r["node"]: r["root"] for r in connected(links).collect()}
    got, want = defaultdict(set), defaultdict(set)
    for f, s, w in zip(fps, signed, slow_components(fps, list(range(len(fps))))):
        got[roots.get(s, s)].add(f)
        want[w].add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_block_masks_are_complete():
    rng = np.random.default_rng(1)
    for n in (1, 1 << 21, 1 << 30, 1 << 34, 1 << 40):
        masks = simhash.block_masks(n)
        for _ in range(300):
            flip = sum({1 << int(b) for b in rng.integers(0, 64, 4)})
            assert any(flip & m == 0 for m in masks)


def test_simhash_odd(spark, odd, empty):
    got = rows_of(simhash.near_duplicates(odd), "doc_id", "fp", "component_id")
    source = rows_of(odd, "doc_id", "text")
    fps = sorted((i if i is not None else -1, slow_fingerprint(t)) for i, t in source)
    assert sorted((i if i is not None else -1, f % (1 << 64)) for i, f, _ in got) == fps
    assert {c for i, f, c in got if f == 0} == {2}
    kept = rows_of(simhash.one_per_group(odd), "doc_id", "text")
    assert len(kept) == len(set(slow_components([slow_fingerprint(t) for _, t in source], list(range(len(source))))))
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_per_group(empty).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200, i) for i in range(201, 260)]
    roots = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {roots[i] for i in range(101)} == {0} and {roots[i] for i in range(200, 260)} == {200} and len(roots) == 161


# ---- 5 URL rules ------------------------------------------------------------------------

def test_url_rules_odd(spark):
    rules = url_rules.rule_table(spark, [("net", "/", "block"), ("Example.net", "/en/", "allow"), ("example.net", "/en/x", "block"), ("c.d", "", "block"), ("a.b", "/p", "allow"), ("a.b", "/p", "block")])
    urls = {None: None, "": None, "no scheme": None, "http://x.NET": None, "http://x.net/": "net/", "HTTPS://a.example.net/en/y?q": "example.net/en/", "http://example.net/en/xy#f": "example.net/en/x",
            "http://badexample.net/en/": "net/", "http://c.d": "c.d", "http://z.c.d?x": "c.d", "http://cc.d": None, "ftp://A.b/pq": "a.b/p", "http://x.net/" + "d/" * 5000: "net/", "http://" + "s." * 300 + "net/": "net/", "a://b.net/x://c.org/": "net/"}
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] * 2 + [(None, None)], "page_id long, url string").selectExpr("*", "1 AS host", "2 AS path", "3 AS rule", "4 AS verdict", "5 AS prefix")
    got = url_rules.judge_urls(df, rules).collect()
    assert len(got) == 2 * len(urls) + 1
    names = list(urls)
    assert all(r["rule"] == urls[names[r["page_id"]]] for r in got if r["page_id"] is not None)
    assert {r["verdict"] for r in got if r["rule"] == "a.b/p"} == {"block"}
    assert url_rules.judge_urls(df.where("false"), rules).count() == 0
    assert {r["verdict"] for r in url_rules.judge_urls(df, rules.where("false")).collect()} == {"allow"}


# ---- 6 mixing ---------------------------------------------------------------------------

def slow_targets(sizes, weights):
    left, targets, total = dict(sizes), {}, float(sum(sizes.values()))
    while left:
        share = {s: total * weights[s] / sum(weights[x] for x in left) for s in left}
        over = [s for s in left if share[s] > 3 * sizes[s]]
        if not over:
            return {**targets, **share}
        for s in over:
            targets[s] = 3.0 * sizes[s]
            total -= targets[s]
            del left[s]
    return targets


def test_targets_by_rounds(spark):
    rng = np.random.default_rng(5)
    for _ in range(3):
        sizes = {f"s{i:02d}": int(x) for i, x in enumerate(rng.integers(0, 10 ** int(rng.integers(1, 7)), 9))}
        got = mixing.water_fill(spark.createDataFrame([("a" + s, n) for s, n in sizes.items()], "k string, source_size long"))
        want = slow_targets({s: n for s, n in sizes.items()}, {s: i % 3 + 1 for i, s in enumerate(sorted(sizes))})
        assert {r["k"][1:]: r["target"] for r in got.collect()} == pytest.approx(want)


def test_mixing_near_targets(spark):
    got = mixing.op6_mix_sources(spark, LARGER).toPandas()
    assert (got.taken <= 3 * got["size"]).all() and (got.taken % got["size"].where(got["size"] > 0, 1) == 0).all()
    for _, g in got.groupby(["source_size", "target"]):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= max(50, 0.01 * g.target.iloc[0])
    again = mixing.op6_mix_sources(spark, LARGER).toPandas()
    assert got.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()


def test_mixing_odd(spark, odd, empty):
    got = rows_of(mixing.mix_sources(odd), "doc_id", "size", "taken")
    assert sorted(((i or -1, n) for i, n, _ in got)) == sorted((i or -1, len(words(t))) for i, t in rows_of(odd, "doc_id", "text"))
    assert len({t for i, _, t in got if i == 1}) == 1
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns and sum(len(words(t)) for (t,) in rows_of(mixed, "text")) == sum(t for _, _, t in got)
    assert mixing.mix_sources(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


# ---- 7 language -------------------------------------------------------------------------

def test_language_held_out(spark):
    got = langid.op7_language(spark, LARGER).toPandas()
    truth = duckdb.sql(f"SELECT doc_id, lang FROM '{LARGER}/documents.parquet'").df()
    seen = got[got.held_out].merge(truth, on="doc_id")
    assert len(got) == 10_000 and (seen.lang == seen.lang_pred).mean() > 0.99 and got.rejected.sum() <= 5


def test_language_document_frequencies_cover_all_rows(spark):
    texts = [(i, f"common {'ab' if i % 10 else 'xyz'} {i}", "en") for i in range(200)] + [(1000, "und so", "de"), (1001, None, "de"), (1002, "no language", None)]
    model = langid.fit_languages(spark.createDataFrame(texts, "doc_id long, text string, lang string"), per_lang=3)
    used = [t for _, t, lang in texts if t and lang]
    df = sum((langid.gram_counts(t) > 0).astype(np.int64) for t in used)
    assert np.allclose(model.idf, np.log((1 + len(used)) / (1 + df)) + 0.1, atol=1e-5)


def test_language_odd(spark, odd, empty):
    model = langid.fit_languages(odd)
    got = {(r["doc_id"], r["lang_pred"], r["rejected"]) for r in langid.identify(odd, model).collect()}
    assert {(2, "und", True), (None, "und", True), (4, "und", True), (5, "und", True), (7, "und", True), (1, "en", False), (50, "fr", False)} <= got
    assert langid.identify(empty, model).count() == 0
    none = langid.fit_languages(empty)
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(odd, none).collect()} == {("und", 0.0)}
    assert {r["doc_id"] for r in langid.with_known_language(odd).collect()} <= {0, 1, None, 6, 50, 100, 8}


# ---- 8 neighbours -----------------------------------------------------------------------

def test_chi_square():
    assert ann.chi_square_cdf(15.507, 8) == pytest.approx(0.95, abs=1e-4) and ann.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)


@pytest.mark.parametrize("cell_rows", [16_384, 100])
def test_neighbours_recall(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(ann, "CELL_ROWS", cell_rows)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16))
    x = (centres[rng.integers(0, 20, 1500)] + 0.2 * rng.normal(size=(1500, 16))).astype(np.float32).astype(float)
    x[100:130] = x[100]  # equal vectors tie
    df = spark.createDataFrame([(i, [float(y) for y in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    hit = 0
    got = ann.nearest(df, lambda i: i % 100 == 0).toPandas()
    for q, g in got.groupby("query_id"):
        g, d = g.sort_values("rank"), np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        best = np.lexsort((np.arange(len(x)), d))[:10]
        hit += len(set(best) & set(g.vec_id))
        assert g["rank"].tolist() == list(range(1, 11)) and np.allclose(g.score, d[g.vec_id], rtol=1e-12)
        assert q != 100 or g.vec_id.tolist() == list(range(101, 111))
    assert got.query_id.nunique() == 15 and hit >= 0.95 * 150


def test_neighbours_odd(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [1.0, 0.1]), (2, [1.0, 0.1]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 0.0]), (8, [1.0]), (100, [0.5, 0.5]), (200, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "2 AS cell", "3 AS p", "4 AS v")
    got = sorted(rows_of(ann.nearest(df, lambda i: i % 100 == 0), "query_id", "rank", "vec_id"))
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 2), (0, 4, 100), (100, 1, 1), (100, 2, 2), (100, 3, 2), (100, 4, 0), (100, 5, 0)]
    assert ann.nearest(df.where("false"), lambda i: i % 100 == 0).count() == 0


@pytest.mark.parametrize("block", [8192, 2])
def test_neighbours_of_every_width(spark, monkeypatch, block):
    """Vectors of another length than most are answered too, by rows of their own length."""
    monkeypatch.setattr(ann, "QUERY_BLOCK", block)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4 if i % 15 == 0 else 8)]) for i in range(320)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i % 20 == 0, sure=1 - 1e-12).toPandas()
    by_id, want = {i: np.array(v) for i, v in rows}, []
    for q in range(0, 320, 20):
        near = sorted((float(np.sqrt(((v - by_id[q]) ** 2).sum())), i) for i, v in by_id.items() if i != q and len(v) == len(by_id[q]))
        want += [(q, rank, i) for rank, (_, i) in enumerate(near[:10], 1)]
    assert sorted(got[["query_id", "rank", "vec_id"]].itertuples(index=False, name=None)) == want


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.01"
    got = ann.op8_nearest(spark, sf).toPandas()
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas().dropna(subset=["vec_id", "embedding"])
    ids, v = table["vec_id"].to_numpy(), np.stack([np.asarray(x, np.float64) for x in table["embedding"]])
    found = total = 0
    for at in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((v - v[at]) ** 2).sum(axis=1))
        near = [i for i in np.lexsort((ids, d)) if i != at][:10]
        own = got[got["query_id"] == ids[at]]
        assert np.allclose(own["score"], [np.sqrt(((v[ids == i][0] - v[at]) ** 2).sum()) for i in own["vec_id"]], rtol=0, atol=1e-12)
        found, total = found + len(set(ids[near]) & set(own["vec_id"])), total + len(near)
    assert total and found >= 0.9 * total


# ---- 9 BPE ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tiktoken_encoding():
    import base64

    import public_tokenizers
    import tiktoken

    with open(bpe.rank_file(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken(spark, odd, tiktoken_encoding):
    texts = [*duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall(), *((1000 + i, t) for i, t in enumerate([None, "", "  a  b \n\n c\r\n", "'s 'S don't<|endoftext|>", "é中文😀\u2003x \u00a0 y", "\x1c\x00a b\x85"]))]
    got = {r["doc_id"]: r for r in bpe.round_trip(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    for i, t in texts:
        ids = tiktoken_encoding.encode_ordinary(t or "")
        assert (got[i]["n_tokens"], got[i]["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    coded = bpe.encode_texts(odd)
    assert sorted((t or "") for _, t in rows_of(odd, "doc_id", "text")) == sorted(t for (t,) in rows_of(bpe.decode_ids(coded), "text"))


def test_bpe_parts_tables_and_offsets(spark, monkeypatch, tiktoken_encoding):
    import public_tokenizers

    monkeypatch.setattr(bpe, "CHUNK_CHARS", 9)
    monkeypatch.setattr(bpe, "MAX_PIECES", 5)
    codec = bpe.Codec(bpe.serialised_model(bpe.rank_file()), public_tokenizers.PATTERN)
    rng = np.random.default_rng(4)
    alphabet = ["a", "the", "'s", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "é", "中", "1", "!", "😀", "\x1c", "\x85", " x", "<|endoftext|>"]
    for _ in range(3000):
        t = "".join(alphabet[i] for i in rng.integers(0, len(alphabet), rng.integers(0, 25)))
        assert np.frombuffer(codec.encode(t), "<u4").tolist() == tiktoken_encoding.encode_ordinary(t)
    df = spark.createDataFrame([(1, "aé😀b")], "doc_id long, text string")
    (r,) = bpe.encode_texts(df).collect()
    begins = [0, 1, 2, 3]
    assert set(r["offsets"]) == set(begins) and len(r["ids"]) == len(r["offsets"]) > 4  # an id inside the emoji shares its index
    cut = spark.createDataFrame([(1, r["ids"][:-2]), (2, None)], "doc_id long, ids array<int>")
    out = {x["doc_id"]: x for x in bpe.decode_ids(cut).collect()}
    assert "aé😀b".encode().startswith(bytes(out[1]["bytes"])) and "\ufffd" in out[1]["text"] and bytes(out[2]["bytes"]) == b""


# ---- 10 BM25 ----------------------------------------------------------------------------

def slow_bm25(rows, queries, k=10):
    docs = [(i, Counter(words(t))) for i, t in rows if i is not None]
    n = len(rows)
    df = Counter(w for _, t in rows for w in set(words(t)))
    mean = sum(len(words(t)) for _, t in rows) / n
    out = set()
    for q, text in queries:
        scored = []
        for i, c in docs:
            s = math.fsum(m * math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for w, m in Counter(words(text)).items() if w in c)
            if s > 0:
                scored.append((-round(s, 9), i))
        out |= {(q, r + 1, i, round(-s, 5)) for r, (s, i) in enumerate(sorted(scored)[:k])}
    return out


@pytest.mark.parametrize("sizes", [(4096, 1024, 2_500_000), (70, 40, 500)])
def test_bm25_exact(spark, monkeypatch, sizes):
    for name, value in zip(("SHARD_DOCS", "DENSE_TERMS", "BLOCK_TERMS"), sizes):
        monkeypatch.setattr(bm25, name, value)
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2, "doc_id")
    got = {(r["query_id"], r["rank"], r["doc_id"], round(r["score"], 5)) for r in bm25.top_documents(df, df.where("doc_id % 50 = 0")).collect()}
    want = slow_bm25(rows, [r for r in rows if r[0] % 50 == 0])
    assert {x[:3] for x in got} == {x[:3] for x in want} and len(got) == len(want)


def test_bm25_odd(spark, odd, empty):
    rows = rows_of(odd, "doc_id", "text")
    got = sorted((r["query_id"], r["rank"], r["doc_id"]) for r in bm25.top_documents(odd, odd.where("doc_id % 50 = 0 OR doc_id IN (2, 4)")).collect())
    assert got == sorted(x[:3] for x in slow_bm25(rows, [r for r in rows if r[0] in (0, 50, 100)]))
    assert bm25.top_documents(empty, empty).count() == 0 and bm25.top_documents(odd, empty).count() == 0
