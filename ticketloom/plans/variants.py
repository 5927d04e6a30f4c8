"""Parameter sets of the older script form of the flow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.noise import fused_registry
from ticketloom.operators.clean import clean_interaction, clean_summary
from ticketloom.operators.models import ModelBench
from ticketloom.operators.select import drop_empty_targets, frequent_classes, name_labels, text_types
from ticketloom.operators.split import basic_split
from ticketloom.operators.vectorize import FrameVectors, TextVectorizer
from ticketloom.sources.tickets import INTERACTION, SUMMARY

SCRIPT_VECTORIZER = TextVectorizer("tfidf", max_features=2000, ngram_range=(1, 1), min_df=4, max_df=0.9, stop_words=None)
SCRIPT_SEED = 0
SCRIPT_TREES = 1000


def script_selection(df: DataFrame) -> DataFrame:
    """Types, labels and target filter, without the frequency filter."""
    return drop_empty_targets(name_labels(text_types(df)))


def script_cleaning(df: DataFrame, min_count: int = 10) -> DataFrame:
    """The fused patterns, no row dropped for an empty text, frequency filter afterwards."""
    cleaned = df.withColumns({
        "ts": clean_summary(F.col(f"`{SUMMARY}`")),
        "ic": clean_interaction(F.col(f"`{INTERACTION}`"), fused_registry()),
    })
    return frequent_classes(cleaned, "y1", min_count)


def script_vectors(df: DataFrame, interaction_col: str, summary_col: str) -> FrameVectors:
    """Interaction terms first, then summary terms. Texts are lower-cased by that script's
    vectoriser, so hand in lower-cased columns."""
    return FrameVectors({c: SCRIPT_VECTORIZER.fit(df, c, f"_{c}_features") for c in (interaction_col, summary_col)})


def script_split(df: DataFrame, id_col: str = "id", test_size: float = 0.2) -> DataFrame:
    return basic_split(df, None, id_col, test_size, stratify=False, seed=SCRIPT_SEED)


def script_forest(train: DataFrame, trees: int = SCRIPT_TREES) -> ModelBench:
    bench = ModelBench()
    bench.fit(train, "random_forest", {"n_estimators": trees, "seed": SCRIPT_SEED})
    return bench
