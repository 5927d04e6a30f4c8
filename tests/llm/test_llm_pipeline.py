"""The pipeline, stage by stage, against brute-force versions of what each stage decides."""

import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from test_llm_operators import slow_components, slow_fingerprint, tiktoken_encoding  # noqa: F401
from ticketloom.llm import langid, mixing, toxicity
from ticketloom.session import settle_table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = settle_table(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_columns(stages):
    assert [s[0] for s in corpus_pipeline.STAGES] == ["toxicity", "language", "near_duplicates", "mix", "tokens"]
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_toxicity_stage(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit_toxicity(stages[0], labels)
    want = {r["doc_id"] for r in stages[0].collect() if model.score(r["text"]) < 0.7}
    assert set(ids(stages[1])) == want and 0 < len(ids(stages[0])) - len(want) < 200


def test_language_stage(stages):
    model = langid.fit_languages(stages[1])
    want = {r["doc_id"] for r in stages[1].collect() if model.predict(r["text"])[1] >= langid.MIN_COSINE}
    assert set(ids(stages[2])) == want


def test_near_duplicate_stage(stages):
    rows = [(r["doc_id"], slow_fingerprint(r["text"])) for r in stages[2].collect()]
    assert ids(stages[3]) == Counter(set(slow_components([f for _, f in rows], [i for i, _ in rows])))


def test_mixing_stage(stages):
    plan = {r["doc_id"]: r["repetitions"] for r in mixing.mix_sources(stages[3]).collect()}
    assert ids(stages[4]) == Counter({i: n for i, n in plan.items() if n})


def test_token_stage(stages, tiktoken_encoding):  # noqa: F811
    texts = {r["doc_id"]: r["text"] for r in stages[3].collect()}
    rows = stages[5].collect()
    assert Counter(r["doc_id"] for r in rows) == ids(stages[4])
    for r in rows[:200]:
        assert r["ids"] == tiktoken_encoding.encode_ordinary(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
