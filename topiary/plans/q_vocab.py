"""Queries for V1-V5 over the T8 tokens of the cleaned corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from topiary.functions.text import clean_fulltext
from topiary.operators import tokens as TK
from topiary.operators import vocab as V
from topiary.plans import sql as S
from topiary.plans.catalog import register
from topiary.session import collect_garbage, stored
from topiary.sources.corpus import decorated_publications, read_table


def corpus_tokens(spark, sf):
    """publications_raw (cleaned) with T8 tokens: (doc_id, journal, year, title, tokens)."""
    d = decorated_publications(read_table(spark, sf, "documents"))
    d = TK.general_preprocess(d.withColumn("content", clean_fulltext("content")), "content", lang="lang")
    return d.select("doc_id", "journal", "year", "title", "tokens")


TOKS = f"WITH {S.PUBS}, {S.DECORATED}, {S.CLEANED}, {S.tokens_ctes('cleaned')}"

VOCAB_CTES = """tc AS (
  SELECT doc_id, t AS token, count(*) AS n FROM (SELECT doc_id, unnest(tokens) AS t FROM toks) GROUP BY doc_id, t),
dfq AS (SELECT token, count(*) AS df, sum(n) AS cf FROM tc GROUP BY token),
nd AS (SELECT count(*) AS n FROM toks),
pruned AS (
  SELECT token, df, cf FROM dfq, nd WHERE df >= 5 AND df <= floor(CAST(0.9 AS DOUBLE) * nd.n)),
vocab AS (SELECT CAST(row_number() OVER (ORDER BY df DESC, token) - 1 AS INTEGER) AS term_id, token, df, cf FROM pruned)"""


@register("doc_freq", f"""{TOKS}, {VOCAB_CTES} SELECT token, df, cf FROM dfq""")
def q_doc_freq(spark, sf):
    return V.doc_freq(corpus_tokens(spark, sf))


@register("prune_vocab", f"""{TOKS}, {VOCAB_CTES} SELECT token, df FROM pruned""")
def q_prune_vocab(spark, sf):
    t = corpus_tokens(spark, sf)
    return V.prune_vocab(V.doc_freq(t), V.n_documents(t)).select("token", "df")


@register("assign_ids", f"""{TOKS}, {VOCAB_CTES} SELECT term_id, token, df FROM vocab""")
def q_assign_ids(spark, sf):
    return V.build_vocab(corpus_tokens(spark, sf)).select("term_id", "token", "df")


@register("doc2bow", f"""{TOKS}, {VOCAB_CTES}
SELECT doc_id, term_id, n AS tf FROM tc JOIN vocab USING (token)""")
def q_doc2bow(spark, sf):
    counts = stored(V.token_counts(corpus_tokens(spark, sf)), "counts")  # read by the vocabulary and by the join
    docs = read_table(spark, sf, "documents")  # N needs no tokens
    return V.doc2bow(None, V.build_vocab(docs, counts=counts), counts=counts)


@register("bow_vectors", f"""{TOKS}, {VOCAB_CTES}
SELECT doc_id, term_id, n AS tf FROM tc JOIN vocab USING (token)""")
def q_bow_vectors(spark, sf):
    """The vectors, read back entry by entry: the same triples as doc2bow."""
    counts = stored(V.token_counts(corpus_tokens(spark, sf)), "counts")
    docs = read_table(spark, sf, "documents").select("doc_id")
    vocab = V.build_vocab(docs, counts=counts)
    collect_garbage(spark)
    vec = V.bow_vectors(docs, vocab, counts=counts).select("doc_id", F.unwrap_udt("features").alias("v"))
    entries = F.arrays_zip(F.col("v.indices").alias("term_id"), F.col("v.values").alias("tf"))
    ex = vec.select("doc_id", F.explode(entries).alias("e"))
    return ex.select("doc_id", F.col("e.term_id").alias("term_id"), F.col("e.tf").cast("bigint").alias("tf"))
