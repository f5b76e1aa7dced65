"""Queries for topics paired between models (X5, X6): stand-in models of 2 to 7
topics against every permutation in SQL, and fitted ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from topiary.functions.arrays import explode_rows
from topiary.operators import alignment as A
from topiary.operators import extensions as X
from topiary.operators import online_lda as L
from topiary.operators import topics as TP
from topiary.plans import q_online_lda as Q
from topiary.plans import sql as S
from topiary.plans.catalog import register
from topiary.plans.q_vocab import corpus_tokens
from topiary.session import frozen, stored

KS = tuple(range(2, 8))
FITTED = (Q.SEED, Q.OTHER, 7)

COSINES = """norm AS (SELECT model_id, t, sqrt(sum(p * p)) AS norm FROM dist GROUP BY model_id, t),
cosine AS MATERIALIZED (
  SELECT g.*, CAST(round(coalesce(dot / (na * nb), 0.0) * 1000000) AS BIGINT) AS cosine FROM (
    SELECT a, b, x.t AS t1, y.t AS t2, x.norm AS na, y.norm AS nb
    FROM pairs JOIN norm x ON x.model_id = a JOIN norm y ON y.model_id = b) g
  LEFT JOIN (
    SELECT a, b, x.t AS t1, y.t AS t2, sum(x.p * y.p) AS dot
    FROM pairs JOIN dist x ON x.model_id = a JOIN dist y ON y.model_id = b AND y.term = x.term GROUP BY ALL) d USING (a, b, t1, t2))"""

#: Every one-to-one pairing of models of equal K; the best, ties by the smallest list.
MATCHED = """walk(a, b, t, cols, total) AS (
  SELECT a, b, 0, CAST([] AS INTEGER[]), 0::BIGINT FROM pairs
  UNION ALL
  SELECT w.a, w.b, w.t + 1, list_append(w.cols, c.t2), w.total + c.cosine
  FROM walk w JOIN cosine c ON c.a = w.a AND c.b = w.b AND c.t1 = w.t AND NOT list_contains(w.cols, c.t2)),
best AS (SELECT * FROM (
  SELECT w.*, row_number() OVER (PARTITION BY a, b ORDER BY t DESC, total DESC, cols) AS rn FROM walk w) x WHERE rn = 1),
matched AS (
  SELECT a, b, t1, t2, cosine FROM cosine JOIN best USING (a, b) WHERE cols[t1 + 1] = t2)"""


@register("topic_alignment", f"""WITH RECURSIVE {S.TEXTS},
words AS (SELECT w AS word, count(*) AS cf FROM (SELECT unnest(tokens) AS w FROM texts) GROUP BY w),
models AS (
  SELECT k * 1000 + seed AS model_id, k, CAST(seed AS VARCHAR) || '/' AS salt
  FROM range({KS[0]}, {KS[-1] + 1}) r(k), (VALUES (42), (99)) s(seed)),
pairs AS (SELECT k * 1000 + 42 AS a, k * 1000 + 99 AS b FROM range({KS[0]}, {KS[-1] + 1}) r(k)),
dist AS MATERIALIZED (
  SELECT model_id, CAST({S.word_topic('word', 'k', 'salt')} AS INTEGER) AS t, word AS term, cf::DOUBLE AS p FROM words, models),
{COSINES}, {MATCHED}
SELECT a AS model_a, b AS model_b, t1, t2, cosine FROM matched""")
def q_topic_alignment(spark, sf):
    """The topics of two seeds paired one to one, for each K."""
    words = frozen(TP.word_counts(corpus_tokens(spark, sf)))  # one row per word; the tokens are read once and not written
    dist = X.topic_word_distributions(words, [(k * 1000 + s, k, f"{s}/") for k in KS for s in (42, 99)])
    pairs = spark.createDataFrame([(k * 1000 + 42, k * 1000 + 99) for k in KS], "model_a long, model_b long")
    return A.match_topics(A.cosines(dist.withColumnRenamed("word", "term_id"), pairs))


def fitted(spark, sf):
    """(model_id, topic_id, term_id, p) of one update from each seed."""
    _, bow, vocab = Q.inputs(spark, sf)
    corpus, out = L.pack(bow), None
    for seed in FITTED:
        terms = L.update(corpus, Q.start(vocab, seed)).terms.withColumn("model_id", F.lit(seed).cast("long"))
        rows = explode_rows(terms.select("model_id", "term_id", "lam"), ["model_id", "term_id"], F.col("lam"), ["topic_id", "p"], with_pos=True)
        out = rows if out is None else out.unionByName(rows)
    return stored(out, "models")


_FITTED_SQL = f"""{Q.BOW.replace("WITH", "WITH RECURSIVE", 1)},
{", ".join(Q.updated_ctes(FITTED))},
dist AS MATERIALIZED ({" UNION ALL ".join(f"SELECT {s}::BIGINT AS model_id, k AS t, term_id AS term, lam AS p FROM new_{s}" for s in FITTED)})"""


@register("lda_topic_stability", f"""{_FITTED_SQL},
ids AS (SELECT DISTINCT model_id FROM dist),
pairs AS (SELECT x.model_id AS a, y.model_id AS b FROM ids x JOIN ids y ON x.model_id < y.model_id),
{COSINES}, {MATCHED},
ends AS (SELECT a AS model_id, t1 AS topic_id, cosine FROM matched UNION ALL SELECT b, t2, cosine FROM matched)
SELECT model_id, topic_id, count(*) AS n_models, CAST(sum(cosine) // count(*) AS BIGINT) AS mean_cosine, min(cosine) AS least_cosine
FROM ends GROUP BY model_id, topic_id""")
def q_lda_topic_stability(spark, sf):
    """X5 on three fitted models: how well each topic is found again from the other seeds."""
    ids = sorted(FITTED)
    pairs = spark.createDataFrame([(a, b) for a in ids for b in ids if a < b], "model_a long, model_b long")
    return A.topic_stability(fitted(spark, sf), pairs)


@register("lda_merge_candidates", f"""{_FITTED_SQL},
pairs AS (SELECT DISTINCT model_id AS a, model_id AS b FROM dist),
{COSINES}
SELECT a AS model_id, t1, t2, cosine FROM cosine WHERE t1 < t2 AND cosine >= 500000""")
def q_lda_merge_candidates(spark, sf):
    """X6 within three fitted models."""
    return A.merge_candidates(fitted(spark, sf), 500_000)
