import pytest

import __spark_entry__ as contract
from verify import DATA, _rows, difference, duck

FAST = (
    "keyword_frequency", "new_terms_tfidf", "corpus_tfidf", "preprocess_tokens", "sim_jaccard",
    "sim_tfidf", "term_precision", "country_counts", "per_type_trend", "type_kpis", "csv_ingest",
    "word_weights",
)


def test_entry_and_keys(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, name):
    sf_dir = DATA / "sf0.001"
    df = contract.queries()[name](spark, str(sf_dir))
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck(sf_dir).execute(contract.oracle_sql()[name])
    theirs = _rows([d[0] for d in cursor.description], cursor.fetchall())
    assert difference(mine, theirs) is None
