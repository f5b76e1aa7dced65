"""Queries for M1-M5, S9 and X4 (LDA) and for scoring and viewing a fitted model.

A model has no SQL oracle; what must hold for any model (every document has K
shares that sum to one, every document has one dominant topic) has one, over
``documents``. tests/test_model.py holds seed reproducibility, reload equality,
resuming a grid and the coherence of a fitted model against brute force.

Queries that only read a model share one fit per session and input folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from topiary.operators import coherence as CO
from topiary.operators import incremental as INC
from topiary.operators import model as M
from topiary.operators import views as VW
from topiary.operators import vocab as V
from topiary.plans.catalog import register
from topiary.plans.q_vocab import corpus_tokens
from topiary.session import frozen, stored, work_dir
from topiary.sources.corpus import decorated_publications, read_table

K = 10
SEED = 42
PASSES = 15
_FITTED: dict = {}
_TEXTS: dict = {}


def texts(spark, sf):
    """(doc_id, tokens), written once per session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TEXTS:
        _TEXTS[key] = stored(corpus_tokens(spark, sf).select("doc_id", "tokens"), "texts")
    return _TEXTS[key]


def lda_inputs(spark, sf):
    """(vectors, vocab): the cleaned corpus as count vectors; both written once. Tokens that
    are stored are counted there, and not made again."""
    tokens = _TEXTS.get((spark.sparkContext.applicationId, sf))
    counts = stored(V.token_counts(corpus_tokens(spark, sf) if tokens is None else tokens), "counts")
    docs = decorated_publications(read_table(spark, sf, "documents")).select("doc_id", "journal", "year", "title")
    vocab = frozen(V.build_vocab(docs, counts=counts))
    return stored(V.bow_entries(docs, vocab, counts), "vectors"), vocab


def fit(vec):
    return M.fit_lda(vec, K, SEED, PASSES)


def fitted(spark, sf):
    """(model, vectors, vocab), fitted once per session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        vec, vocab = lda_inputs(spark, sf)
        _FITTED[key] = fit(vec), vec, vocab
    return _FITTED[key]


def doc_topics(spark, sf):
    m, vec, _ = fitted(spark, sf)
    return M.infer_topics(m, vec)


@register("fit_lda")
def q_fit_lda(spark, sf):
    vec, _ = lda_inputs(spark, sf)
    return fit(vec).describeTopics(10).select(F.col("topic").alias("topic_id"), "termIndices", "termWeights")


@register("infer_topics")
def q_infer_topics(spark, sf):
    return VW.long_shares(doc_topics(spark, sf), ["doc_id"]).select("doc_id", "topic_id", F.round("share", 6).alias("share"))


@register("lda_document_shares", f"SELECT doc_id, {K} AS n_topics, 1.0::DOUBLE AS total FROM documents")
def q_lda_document_shares(spark, sf):
    """M4, written under the model's key and read back: every document has K shares that sum to one."""
    root = work_dir(spark, "doc_topics")
    point = (K, "auto", SEED, PASSES, 200)
    path = M.write_doc_topics(doc_topics(spark, sf), root, *point)
    M.write_doc_topics(spark.read.parquet(path).transform(frozen), root, *point)  # a rerun replaces the rows
    ls = VW.long_shares(spark.read.parquet(path), ["doc_id"])
    return ls.groupBy("doc_id").agg(F.count("share").cast("int").alias("n_topics"), F.round(F.sum("share"), 6).alias("total"))


@register("lda_dominant_by_journal", "SELECT source AS journal, count(*) AS n_docs FROM documents GROUP BY source")
def q_lda_dominant_by_journal(spark, sf):
    """I2 on the fitted model: every document has exactly one dominant topic."""
    return VW.dominant(doc_topics(spark, sf)).groupBy("journal").agg(F.count("topic_id").alias("n_docs"))


def _totals(view, key):
    return view.groupBy(key).agg(F.count("mean_share").cast("int").alias("n_topics"), F.round(F.sum("mean_share"), 6).alias("total"))


@register("lda_topics_by_year", f"""SELECT CAST(2000 + doc_id % 10 AS INTEGER) AS year, {K} AS n_topics, 1.0::DOUBLE AS total
FROM documents GROUP BY 1""")
def q_lda_topics_by_year(spark, sf):
    """I4 on the fitted model: the mean shares of a year sum to one."""
    return _totals(VW.topics_by_year(doc_topics(spark, sf)), "year")


@register("lda_topics_by_journal", f"SELECT source AS journal, {K} AS n_topics, 1.0::DOUBLE AS total FROM documents GROUP BY 1")
def q_lda_topics_by_journal(spark, sf):
    """I6 on the fitted model."""
    return _totals(VW.topics_by_journal(doc_topics(spark, sf)), "journal")


@register("lda_cooccurrence")
def q_lda_cooccurrence(spark, sf):
    """I7 on the fitted model."""
    c = VW.topic_cooccurrence(doc_topics(spark, sf))
    return c.withColumn("mean_pct", F.round("mean_pct", 6))


@register("lda_coherence")
def q_lda_coherence(spark, sf):
    """E1-E4 on the fitted model: c_v of each of its topics over the corpus."""
    tokens = texts(spark, sf)  # first, so that a fit counts them
    m, _, vocab = fitted(spark, sf)
    top = frozen(M.topic_top_words(m, vocab, CO.TOP_N).withColumn("model_id", F.lit(0)))
    scores = CO.cv_by_topic(CO.npmi(top, *CO.window_counts(tokens, top)))
    return scores.select("topic_id", F.round("coherence", 6).alias("coherence"))


@register("topic_top_words")
def q_topic_top_words(spark, sf):
    m, _, vocab = fitted(spark, sf)
    return M.topic_top_words(m, vocab, 10).withColumn("p", F.round("p", 6))


@register("save_load_model", "SELECT count(*) AS n_docs, 0::BIGINT AS n_different FROM documents")
def q_save_load_model(spark, sf):
    """The reloaded model gives every document the shares that the fitted one gives."""
    m, vec, _ = fitted(spark, sf)
    path = M.model_path(work_dir(spark, "models"), K, "auto", SEED, PASSES, 200)
    M.save_model(m, path)
    a = M.infer_topics(m, vec).select("doc_id", F.map_values("topics").alias("a"))
    b = M.infer_topics(M.load_model(path), vec).select("doc_id", F.map_values("topics").alias("b"))
    far = F.exists(F.arrays_zip("a", "b"), lambda x: F.abs(x["a"] - x["b"]) > 1e-9)
    return a.join(b, "doc_id").agg(F.count(F.lit(1)).alias("n_docs"), F.count_if(far).alias("n_different"))


@register("heldout_likelihood")
def q_heldout_likelihood(spark, sf):
    vec, _ = lda_inputs(spark, sf)
    return M.heldout_likelihood(vec, K, SEED, PASSES)


@register("skip_existing_models", """
WITH pts AS (
  SELECT k, seed, p FROM range(2, 21) r(k), (VALUES (42), (99)) s(seed), (VALUES (5), (10), (15), (20)) q(p))
SELECT CAST(k AS INTEGER) AS k, 'auto' AS dir_prior, CAST(seed AS INTEGER) AS random_state,
       CAST(p AS INTEGER) AS num_pass, CAST(200 AS INTEGER) AS iteration FROM pts
WHERE (k, seed, p) NOT IN (
  SELECT (2 + n_chars % 19, CASE WHEN doc_id % 2 = 0 THEN 42 ELSE 99 END, 5 * (1 + doc_id // 2 % 4))
  FROM documents GROUP BY 1 HAVING sum(doc_id // 8 + n_chars // 19) % 2 = 0)""")
def q_skip_existing_models(spark, sf):
    """M1 + S15: grid points without a model. The documents are dealt into one class
    per grid point by length and id; a point counts as fitted if the sum of what is left of
    both over all documents of its class is even, so every row can change the answer
    and about half the points stay open at any size."""
    k, seed = (F.lit(2) + F.col("n_chars") % 19).cast("int"), F.when(F.col("doc_id") % 2 == 0, 42).otherwise(99)
    passes = F.expr("cast(5 * (1 + doc_id div 2 % 4) as int)")
    classes = read_table(spark, sf, "documents").groupBy(k.alias("k"), seed.alias("random_state"), passes.alias("num_pass")) \
        .agg(F.expr("sum(doc_id div 8 + n_chars div 19) % 2").alias("odd"))
    registry = classes.filter("odd = 0").select("k", F.lit("auto").alias("dir_prior"), "random_state", "num_pass", F.lit(200).alias("iteration"))
    return INC.skip_existing_models(INC.grid(spark), registry)
