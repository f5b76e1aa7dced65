"""Registered queries against their DuckDB oracle on the smallest tables."""
import hashlib
import math

import pytest

import __spark_entry__ as entry
from conftest import SMALL

FAST = ["clean_fulltext", "path_metadata", "general_preprocess", "doc2bow", "assign_ids",
        "topics_by_journal", "cooccurrence_matrix", "topic_word_stats", "coherence_cv",
        "replace_by_key", "skip_processed_docs", "html_to_text", "topic_table", "tfidf_filter",
        "lda_update", "infer_topics_stored", "phrase_entities", "lemmatize_by_table", "replace_in_files",
        "topic_alignment", "stream_unique", "write_bow_buckets", "lda_topic_stability", "lda_merge_candidates", "skip_existing_models", "link_metadata", "harvest_kinds", "write_bow"]


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return repr(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted("|".join(norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    orows = res.fetchall()
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(res.columns, orows)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["journal", "year", "topic_id", "mean_share"]
    assert df.count() > 0
