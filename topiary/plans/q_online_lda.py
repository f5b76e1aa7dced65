"""Queries for the online model on partitioned statistics.

The start is a fixed function of seed, term and topic and the inner loop is capped,
so an update, what it infers and its top words have exact SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from topiary.functions.arrays import explode_rows
from topiary.operators import coherence as CO
from topiary.operators import coherence_store as CS
from topiary.operators import doc_topics as DT
from topiary.operators import online_lda as L
from topiary.operators import views as VW
from topiary.operators import vocab as V
from topiary.plans import sql_lda as SL
from topiary.plans.catalog import register
from topiary.plans.q_coherence import COUNT_CTES
from topiary.plans.q_vocab import TOKS, VOCAB_CTES, corpus_tokens
from topiary.session import collect_garbage, frozen, stored, work_dir
from topiary.sources.corpus import read_table

K, SEED, ROUNDS = 4, 42, 3
RHO = 2 ** -L.DECAY

BOW = f"{TOKS}, {VOCAB_CTES}, bow AS MATERIALIZED (SELECT doc_id, term_id, n FROM tc JOIN vocab USING (token))"
START = f"{BOW}, {SL.start_ctes(K, SEED)}, {SL.e_ctes(ROUNDS, 1 / K)}"
UPDATED = f"{START}, {SL.m_ctes(1 / K, RHO)}"


def inputs(spark, sf, tokens=None):
    """(documents, bow, vocab), the counts frozen; ``tokens`` that are stored are counted and not made again."""
    counts = stored(V.token_counts(corpus_tokens(spark, sf) if tokens is None else tokens), "counts")
    docs = read_table(spark, sf, "documents").select("doc_id")
    vocab = frozen(V.build_vocab(docs, counts=counts))
    collect_garbage(spark)
    bow = stored(V.doc2bow(None, vocab, counts=counts), "bow")
    collect_garbage(spark)
    return docs, bow, vocab


def start(vocab, seed=SEED):
    """K topics at the start, priors fixed, ``ROUNDS`` inner rounds; it counts as having had one update."""
    model = L.start(vocab, K, seed, "symmetric", "symmetric", ROUNDS, threshold=0.0)
    model.updates = 1
    return model


@register("lda_update", f"{UPDATED} SELECT term_id, k AS topic_id, round(lam, 6) AS lam FROM lam1")
def q_lda_update(spark, sf):
    """M2: every term's statistics after one update from all documents."""
    _, bow, vocab = inputs(spark, sf)
    model = L.update(L.pack(bow), start(vocab))
    rows = explode_rows(model.terms.select("term_id", "lam"), ["term_id"], F.col("lam"), ["topic_id", "lam"], with_pos=True)
    return rows.select("term_id", F.col("topic_id").cast("int").alias("topic_id"), F.round("lam", 6).alias("lam"))


@register("lda_update_top_words", f"""{UPDATED},
p AS (SELECT k, token, lam / sum(lam) OVER (PARTITION BY k) AS p FROM lam1 JOIN vocab USING (term_id)),
r AS (SELECT k, token, p, row_number() OVER (PARTITION BY k ORDER BY p DESC, token) AS rank FROM p)
SELECT k AS topic_id, CAST(rank AS INTEGER) AS rank, token AS word, round(p, 6) AS p FROM r WHERE rank <= 10""")
def q_lda_update_top_words(spark, sf):
    """M5 on the updated model."""
    _, bow, vocab = inputs(spark, sf)
    top = L.top_words(L.update(L.pack(bow), start(vocab)), vocab, 10)
    return top.select("topic_id", F.col("rank").cast("int").alias("rank"), "word", F.round("p", 6).alias("p"))


_SHARES = f"""{START},
shares AS (
  SELECT d.doc_id, g.k, coalesce(e.share, {1 / K!r}::DOUBLE) AS share
  FROM documents d CROSS JOIN (SELECT CAST(k AS INTEGER) AS k FROM range({K}) r(k)) g
  LEFT JOIN (SELECT doc_id, k, gamma / sum(gamma) OVER (PARTITION BY doc_id) AS share FROM e_g) e ON e.doc_id = d.doc_id AND e.k = g.k)"""


@register("infer_topics_stored", f"{_SHARES} SELECT doc_id, k AS topic_id, round(share, 6) AS share, 0::BIGINT AS again FROM shares")
def q_infer_topics_stored(spark, sf):
    """M4: two thirds of the documents are inferred and stored, then all, then all
    again: the second run adds the rest, the third (``again``) none."""
    docs, bow, vocab = inputs(spark, sf)
    root, model = work_dir(spark, "shares"), start(vocab)
    DT.infer_into(root, docs.filter("doc_id % 3 <> 0"), bow.filter("doc_id % 3 <> 0"), model, "start")
    DT.infer_into(root, docs, bow, model, "start")
    again = DT.infer_into(root, docs, bow, model, "start")
    ls = VW.long_shares(DT.read_shares(spark, root, "start"), ["doc_id"])
    return ls.select("doc_id", "topic_id", F.round("share", 6).alias("share"), F.lit(again).cast("long").alias("again"))


@register("lda_views_dominant", f"""{_SHARES},
dom AS (SELECT doc_id, k, row_number() OVER (PARTITION BY doc_id ORDER BY round(share, 9) DESC, k) AS rn FROM shares),
j AS (SELECT d.source AS journal, CAST(2000 + d.doc_id % 10 AS INTEGER) AS year, s.k, s.share FROM shares s JOIN documents d USING (doc_id))
SELECT 'journal' AS view, journal AS key, k AS topic_id, round(avg(share), 6) AS value FROM j GROUP BY journal, k
UNION ALL SELECT 'year', CAST(year AS VARCHAR), k, round(avg(share), 6) FROM j GROUP BY year, k
UNION ALL SELECT 'dominant', CAST(d.k AS VARCHAR), s.k, round(avg(s.share), 6)
          FROM dom d JOIN shares s USING (doc_id) WHERE d.rn = 1 GROUP BY d.k, s.k""")
def q_lda_views(spark, sf):
    """I2, I4, I6, I7 over inferred shares: means by journal, by year and by dominant topic."""
    docs, bow, vocab = inputs(spark, sf)
    named = read_table(spark, sf, "documents").select("doc_id", F.col("source").alias("journal"),
                                                      (F.lit(2000) + F.col("doc_id") % 10).cast("string").alias("year"), F.lit("").alias("title"))
    found = frozen(L.infer_all(named, L.pack(bow, 1), start(vocab)))
    out = lambda df, view, key: df.select(F.lit(view).alias("view"), F.col(key).cast("string").alias("key"), "topic_id",
                                          F.round("mean_share", 6).alias("value"))
    # a tie in exact arithmetic must stay one: the argmax is taken on 9 places
    rounded = found.withColumn("topics", F.transform_values("topics", lambda _, v: F.round(v, 9)))
    top = VW.dominant(rounded).select("doc_id", F.col("topic_id").alias("dominant"))
    per = VW.mean_by(found.join(top, "doc_id"), "dominant")
    return out(VW.topics_by_journal(found), "journal", "journal").unionByName(out(VW.topics_by_year(found), "year", "year")) \
        .unionByName(out(per, "dominant", "dominant"))


OTHER = 99


def updated_ctes(seeds) -> list[str]:
    """new_<seed>(term_id, k, lam) of each model after one update."""
    parts = []
    for seed in seeds:
        own = SL.start_ctes(K, seed).replace("lam AS", f"lam_{seed} AS").replace(" lam GROUP", f" lam_{seed} GROUP").replace("FROM lam JOIN", f"FROM lam_{seed} JOIN")
        own = own.replace("beta_tot", f"beta_{seed}_tot").replace("beta AS", f"beta_{seed} AS")
        parts += [own, SL.e_ctes(ROUNDS, 1 / K, f"beta_{seed}", f"e{seed}"), SL.m_ctes(1 / K, RHO, f"lam_{seed}", f"e{seed}", f"new_{seed}")]
    return parts


def _two_models_sql() -> str:
    """``top``(model_id, topic_id, word) of the models that the seeds give after one update."""
    parts = updated_ctes((SEED, OTHER))
    both = " UNION ALL ".join(f"SELECT {s}::BIGINT AS model_id, * FROM new_{s}" for s in (SEED, OTHER))
    parts.append(f"""top AS MATERIALIZED (
  SELECT model_id, k AS topic_id, token AS word FROM (
    SELECT model_id, k, token, row_number() OVER (PARTITION BY model_id, k ORDER BY lam DESC, token) AS rank
    FROM ({both}) x JOIN vocab USING (term_id)) r WHERE rank <= {CO.TOP_N})""")
    return ",\n".join(parts)


@register("coherence_by_batches", f"""{BOW},
texts AS (SELECT doc_id, tokens FROM toks),
{_two_models_sql()},
{COUNT_CTES.rstrip().rstrip(",")}
SELECT model_id, topic_id, round(coherence, 6) AS coherence, 0::BIGINT AS again FROM cvt""")
def q_coherence_by_batches(spark, sf):
    """E4 + S16 for two fitted models: one is scored on half of the documents, then
    both on all; asked again (``again``) no pair is missing."""
    texts = stored(corpus_tokens(spark, sf).select("doc_id", "tokens"), "texts")
    _, bow, vocab = inputs(spark, sf, texts)
    corpus, root = L.pack(bow), work_dir(spark, "window_counts")
    tops = [L.top_words(L.update(corpus, start(vocab, s)), vocab, CO.TOP_N).withColumn("model_id", F.lit(s).cast("long")) for s in (SEED, OTHER)]
    both = frozen(tops[0].unionByName(tops[1]))
    halves = [(str(i), texts.filter(F.col("doc_id") % 2 == i)) for i in (0, 1)]
    CS.add_batch(root, *halves[0], both.filter(F.col("model_id") == SEED))
    for batch, part in halves:
        CS.add_batch(root, batch, part, both)
    again = sum(CS.add_batch(root, batch, part, both) for batch, part in halves)
    return CS.topic_scores(spark, root, both).select("model_id", "topic_id", F.round("coherence", 6).alias("coherence"), F.lit(again).cast("long").alias("again"))
