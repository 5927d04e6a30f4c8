"""The catalogue against its SQL, on the smallest tables."""

import math

import duckdb
import pytest

from ticketloom.plans.catalog import QUERIES
from ticketloom.plans.oracles import ORACLES

TABLES = "documents labels conversations embeddings events orders".split()
QUICK = ["d_00_flagship", "d_01_csv_scan", "d_05_frequency_filter", "t_05_detect_language", "c_05_preprocess", "s_08_stratified_groups",
         "b_02_random_oversample", "p_01_basic_split", "p_03_temporal_split", "p_04_group_split", "e_05_tied_scores", "e_04_per_class"]


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def cells(df):
    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "~"
        return repr(round(float(v), 6)) if isinstance(v, float) else str(v)
    return sorted(tuple(cell(v) for v in row) for row in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, sf_dir, con, name):
    got, want = QUERIES[name](spark, sf_dir).toPandas(), con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert cells(got) == cells(want)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_stop_words_are_those_of_spark(spark):
    from pyspark.ml.feature import StopWordsRemover

    from ticketloom.operators.vectorize import english_stop_words

    assert english_stop_words() == StopWordsRemover.loadDefaultStopWords("english")
