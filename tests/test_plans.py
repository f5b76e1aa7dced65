"""Plan shapes that matter at scale (checked on the physical plan text)."""
from pyspark.sql import functions as F

from conftest import SMALL
from topiary.functions.text import clean_fulltext
from topiary.operators import tokens as TK
from topiary.operators import vocab as V
from topiary.plans.q_views import topic_terms
from topiary.sources.corpus import decorated_publications, read_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def tokens_df(spark):
    d = decorated_publications(read_table(spark, SMALL, "documents"))
    return TK.general_preprocess(d.withColumn("content", clean_fulltext("content")), "content")


def test_text_processing_is_narrow(spark):
    p = plan(tokens_df(spark).select("doc_id", F.size("tokens")))
    assert "Exchange" not in p


def test_doc_freq_aggregates_map_side(spark):
    p = plan(V.doc_freq(tokens_df(spark)))
    assert "partial_count" in p and "partial_sum" in p


def test_doc2bow_broadcasts_capped_vocabulary(spark):
    t = tokens_df(spark)
    p = plan(V.doc2bow(t, V.build_vocab(t)))
    assert "BroadcastHashJoin" in p


def test_top_n_limits_before_shuffle(spark):
    p = plan(topic_terms(spark, SMALL))
    assert "WindowGroupLimit" in p


def test_no_generate_filter_pushdown(spark):
    # the inferred size(arr) > 0 filter must not reach the scan
    p = plan(V.token_counts(tokens_df(spark)))
    assert "DataFilters: []" in p
