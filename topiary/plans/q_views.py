"""Queries for I1-I9, C11-C13 and M6 over the stand-in document-topic table.

LDA output has no SQL oracle, so the views are checked on the deterministic
stand-in model (FIXTURES.md); the same view functions run on LDA output.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from topiary.functions.text import format_prob, mask_nonpositive, topic_label
from topiary.operators import topics as TP
from topiary.operators import views as VW
from topiary.plans import sql as S
from topiary.plans.catalog import register
from topiary.plans.q_vocab import corpus_tokens
from topiary.session import frozen, stored

K = 10


def standin_texts(spark, sf):
    """(doc_id, journal, year, title, tokens): the full T8 tokens of the cleaned
    corpus, written once (the views read them several times)."""
    return stored(corpus_tokens(spark, sf), "texts")


def doc_topics(spark, sf):
    """The stand-in's shares, written once: K numbers per document instead of its tokens."""
    return frozen(TP.standin_doc_topics(corpus_tokens(spark, sf), K))


def r6(c):
    return F.round(c, 6)


DT = f"""WITH {S.TEXTS},
wt AS (SELECT doc_id, {S.word_topic('w', K)} AS t FROM (SELECT doc_id, unnest(tokens) AS w FROM texts)),
cnt AS (SELECT doc_id, t, count(*) AS c FROM wt GROUP BY doc_id, t),
dt AS (
  SELECT x.doc_id, x.journal, x.year, x.title, CAST(g.t AS INTEGER) AS topic_id,
         (coalesce(cnt.c, 0) + 1) / (len(x.tokens) + {K}) AS share
  FROM texts x CROSS JOIN range({K}) g(t) LEFT JOIN cnt ON cnt.doc_id = x.doc_id AND cnt.t = g.t),
dom AS (
  SELECT doc_id, year, title, journal, topic_id, share FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY share DESC, topic_id) AS rn FROM dt)
  WHERE rn = 1)"""


@register("topics_to_array", f"{DT} SELECT doc_id, topic_id, round(share, 6) AS share FROM dt")
def q_topics_to_array(spark, sf):
    ls = VW.long_shares(doc_topics(spark, sf), ["doc_id"])
    return ls.select("doc_id", "topic_id", r6(F.col("share")).alias("share"))


_DOM_COLS = "doc_id, year, title, journal, topic_id, round(share, 6) AS share"


def _dom(spark, sf):
    d = VW.dominant(doc_topics(spark, sf))
    return d.withColumn("share", r6(F.col("share")))


@register("dominant_topic", f"{DT} SELECT {_DOM_COLS} FROM dom")
def q_dominant_topic(spark, sf):
    return _dom(spark, sf)


@register("titles_per_topic", f"{DT} SELECT {_DOM_COLS} FROM dom ORDER BY topic_id, share DESC, doc_id")
def q_titles_per_topic(spark, sf):
    return VW.titles_per_topic(doc_topics(spark, sf)).withColumn("share", r6(F.col("share")))


@register("topic_label", f"{DT} SELECT doc_id, topic_id, {S.label_of('topic_id')} AS label, "
          "'Topic ' || CAST(topic_id AS VARCHAR) AS plain_label FROM dom")
def q_topic_label(spark, sf):
    d = VW.dominant(doc_topics(spark, sf))
    return d.select("doc_id", "topic_id", topic_label("topic_id").alias("label"),
                    topic_label("topic_id", labels_available=False).alias("plain_label"))


@register("topics_by_year", f"""{DT}
SELECT CAST(year AS INTEGER) AS year, topic_id, round(avg(share), 6) AS mean_share FROM dt GROUP BY ALL""")
def q_topics_by_year(spark, sf):
    v = VW.topics_by_year(doc_topics(spark, sf))
    return v.withColumn("mean_share", r6(F.col("mean_share")))


def _wide_sql(key, src):
    from topiary.functions.lexicon import TOPIC_LABELS
    cols = ", ".join(f'round(max(CASE WHEN topic_id = {t} THEN mean_share END), 6) AS "{TOPIC_LABELS[t]}"'
                     for t in range(K))
    return f"SELECT {key}, {cols} FROM {src} GROUP BY {key}"


@register("topics_by_year_stacked", f"""{DT},
ym AS (SELECT CAST(year AS INTEGER) AS year, topic_id, avg(share) AS mean_share FROM dt GROUP BY ALL)
{_wide_sql('year', 'ym')}""")
def q_topics_by_year_stacked(spark, sf):
    v = VW.topics_by_year(doc_topics(spark, sf)).withColumn("mean_share", r6(F.col("mean_share")))
    return VW.wide_by_label(v, "year", "mean_share", k=K)


@register("topics_by_journal", f"""{DT}
SELECT journal, topic_id, round(avg(share), 6) AS mean_share FROM dt GROUP BY ALL""")
def q_topics_by_journal(spark, sf):
    v = VW.topics_by_journal(doc_topics(spark, sf))
    return v.withColumn("mean_share", r6(F.col("mean_share")))


def topics_by_journal_year(spark, sf):
    """Flagship: mean topic share per (journal, year)."""
    ls = VW.long_shares(doc_topics(spark, sf), ["journal", "year"])
    return (ls.groupBy("journal", "year", "topic_id").agg(r6(F.avg("share")).alias("mean_share")))


register("topics_by_journal_year", f"""{DT}
SELECT journal, year, topic_id, round(avg(share), 6) AS mean_share FROM dt GROUP BY ALL""")(topics_by_journal_year)


COOC = f"""{DT},
cooc AS (
  SELECT dt.topic_id, dom.topic_id AS dominant_id, avg(dt.share) * 100 AS mean_pct
  FROM dt JOIN dom USING (doc_id) GROUP BY ALL),
m AS (SELECT *, max(mean_pct) OVER (PARTITION BY topic_id) AS row_max FROM cooc),
lm AS (
  SELECT topic_id, {S.label_of('topic_id')} || ' (' || CAST(round(row_max, 2) AS VARCHAR) || '%)' AS row_label,
         dominant_id, {S.label_of('dominant_id')} AS col_label,
         CASE WHEN topic_id = dominant_id THEN 0.0 ELSE mean_pct END AS value, row_max
  FROM m)"""


@register("topic_cooccurrence", f"{COOC} SELECT topic_id, dominant_id, round(mean_pct, 6) AS mean_pct FROM cooc")
def q_topic_cooccurrence(spark, sf):
    c = VW.topic_cooccurrence(doc_topics(spark, sf))
    return c.withColumn("mean_pct", r6(F.col("mean_pct")))


def _matrix(spark, sf):
    return VW.cooccurrence_matrix(VW.topic_cooccurrence(doc_topics(spark, sf)))


@register("cooccurrence_matrix", f"""{COOC}
SELECT topic_id, row_label, dominant_id, col_label, round(value, 6) AS value, round(row_max, 6) AS row_max FROM lm""")
def q_cooccurrence_matrix(spark, sf):
    m = _matrix(spark, sf)
    return m.withColumn("value", r6(F.col("value"))).withColumn("row_max", r6(F.col("row_max")))


@register("cooccurrence_wide", f"""{COOC}
SELECT row_label, {', '.join(f"round(max(CASE WHEN dominant_id = {t} THEN value END), 6) AS {S.quoted(S.TOPIC_LABELS[t])}" for t in range(K))}
FROM lm GROUP BY row_label""")
def q_cooccurrence_wide(spark, sf):
    """I8 as the table that is drawn: a column per dominant topic."""
    return VW.matrix_wide(_matrix(spark, sf).withColumn("value", r6(F.col("value"))), k=K)


@register("mask_nonpositive", f"""{COOC}
SELECT topic_id, dominant_id, round(CASE WHEN value > 0 THEN value END, 6) AS value FROM lm""")
def q_mask_nonpositive(spark, sf):
    m = _matrix(spark, sf)
    return m.select("topic_id", "dominant_id", r6(mask_nonpositive("value")).alias("value"))


# --- M6 / C11: topic-word table of the stand-in model ------------------------------

TERMS = f"""WITH {S.TEXTS},
words AS (SELECT w AS word, count(*) AS cf FROM (SELECT unnest(tokens) AS w FROM texts) GROUP BY w),
wt AS (SELECT word, cf, CAST({S.word_topic('word', K)} AS INTEGER) AS topic_id FROM words),
tot AS (SELECT topic_id, sum(cf) AS tot FROM wt GROUP BY topic_id),
ranked AS (
  SELECT topic_id, word, cf / tot AS p,
         row_number() OVER (PARTITION BY topic_id ORDER BY cf / tot DESC, word) AS rank
  FROM wt JOIN tot USING (topic_id)),
top AS (SELECT topic_id, rank, word, p FROM ranked WHERE rank <= 10)"""


def topic_terms(spark, sf, top_n=10):
    return TP.standin_topic_terms(corpus_tokens(spark, sf), K, top_n)  # the tokens are read once


@register("topic_word_stats", f"{TERMS} SELECT topic_id, CAST(rank AS INTEGER) AS rank, word, round(p, 6) AS p FROM top")
def q_topic_word_stats(spark, sf):
    t = topic_terms(spark, sf)
    return t.select("topic_id", F.col("rank").cast("int").alias("rank"), "word", r6(F.col("p")).alias("p"))


@register("format_prob", f"""{TERMS}
SELECT topic_id, CAST(rank AS INTEGER) AS rank, upper(word) AS word, replace(printf('%.3f', p), '0.', '.') AS prob
FROM top""")
def q_format_prob(spark, sf):
    t = topic_terms(spark, sf)
    return t.select("topic_id", F.col("rank").cast("int").alias("rank"), F.upper("word").alias("word"),
                    format_prob("p").alias("prob"))
