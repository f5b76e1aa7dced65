"""Queries for X1-X3 and X6 (extensions described in the reference's prose)
and the streaming form of the preprocessing step."""

from __future__ import annotations

from pyspark.sql import functions as F

from topiary.functions.text import strip_boilerplate
from topiary.operators import extensions as X
from topiary.operators import topics as TP
from topiary.operators import vocab as V
from topiary.plans import sql as S
from topiary.plans.catalog import register
from topiary.plans.q_views import standin_texts
from topiary.plans.q_vocab import TOKS, VOCAB_CTES, corpus_tokens
from topiary.session import stored, work_dir
from topiary.sources.corpus import decorated_publications, read_table
from topiary.streaming import ingest


@register("custom_stopwords", f"""WITH {S.TEXTS},
dfq AS (SELECT w, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(tokens) AS w FROM texts) GROUP BY w),
cs AS (SELECT list(w) AS cl FROM (SELECT w FROM dfq ORDER BY df DESC, w LIMIT 20))
SELECT doc_id, len(t) AS n_tokens, {S.md5_list('t')} AS tokens_md5
FROM (SELECT doc_id, list_filter(tokens, lambda x: NOT list_contains(cl, x)) AS t FROM texts, cs)""")
def q_custom_stopwords(spark, sf):
    texts = standin_texts(spark, sf)
    out = X.remove_custom_stopwords(texts, X.corpus_stopwords(texts, 20))
    return out.select("doc_id", F.size("tokens").alias("n_tokens"),
                      F.md5(F.array_join("tokens", "|")).alias("tokens_md5"))


@register("tfidf_filter", f"""{TOKS}, {VOCAB_CTES}
SELECT doc_id, token, tc.n AS tf, round(tc.n * ln((nd.n + 1) / (df + 1)), 6) AS tfidf
FROM tc JOIN vocab USING (token), nd
WHERE tc.n * ln((nd.n + 1) / (df + 1)) >= 2.0""")
def q_tfidf_filter(spark, sf):
    counts, docs = stored(V.token_counts(corpus_tokens(spark, sf)), "counts"), read_table(spark, sf, "documents")
    vocab = V.build_vocab(docs, counts=counts)  # frozen: built once
    band = X.tfidf_band(V.doc2bow(None, vocab, counts=counts), vocab, V.n_documents(docs), 2.0)
    return band.select("doc_id", "token", "tf", F.round("tfidf", 6).alias("tfidf"))


_BOILER = r"\[1\] x"


@register("strip_boilerplate", f"""WITH {S.PUBS}, {S.DECORATED},
s AS (SELECT doc_id, regexp_replace(content, {S.lit(_BOILER)}, '', 'g') AS c FROM decorated),
t AS (SELECT doc_id, substr(c, 21, greatest(length(c) - 20, 0)) AS c FROM s)
SELECT doc_id, md5(c) AS content_md5, length(c) AS content_len FROM t""")
def q_strip_boilerplate(spark, sf):
    d = decorated_publications(read_table(spark, sf, "documents"))
    c = strip_boilerplate("content", _BOILER, 20)
    return d.select("doc_id", F.md5(c).alias("content_md5"), F.length(c).alias("content_len"))


_SIM_MODELS = [(42, 10, "42/"), (99, 10, "99/")]


@register("similar_topics", f"""WITH {S.TEXTS},
words AS (SELECT w AS word, count(*) AS cf FROM (SELECT unnest(tokens) AS w FROM texts) GROUP BY w),
models AS (SELECT * FROM (VALUES (42, 10, '42/'), (99, 10, '99/')) m(model_id, k, salt)),
wt AS (SELECT model_id, word, cf, CAST({S.word_topic('word', 'k', 'salt')} AS INTEGER) AS topic_id FROM words, models),
tot AS (SELECT model_id, topic_id, sum(cf) AS tot FROM wt GROUP BY ALL),
d AS (SELECT model_id, topic_id, word, cf / tot AS p FROM wt JOIN tot USING (model_id, topic_id)),
a AS (SELECT topic_id AS t1, word, p AS pa FROM d WHERE model_id = 42),
b AS (SELECT topic_id AS t2, word, p AS pb FROM d WHERE model_id = 99),
dot AS (SELECT t1, t2, sum(pa * pb) AS dot FROM a JOIN b USING (word) GROUP BY ALL),
na AS (SELECT t1, sqrt(sum(pa * pa)) AS na FROM a GROUP BY t1),
nb AS (SELECT t2, sqrt(sum(pb * pb)) AS nb FROM b GROUP BY t2)
SELECT t1, t2, round(dot / (na * nb), 6) AS cosine FROM dot JOIN na USING (t1) JOIN nb USING (t2)""")
def q_similar_topics(spark, sf):
    words = TP.word_counts(standin_texts(spark, sf))
    dist = X.topic_word_distributions(words, _SIM_MODELS)
    return X.similar_topics(dist, 42, 99).withColumn("cosine", F.round("cosine", 6))


@register("stream_preprocess", f"""WITH {S.PUBS}, {S.DECORATED}, {S.CLEANED}, {S.tokens_ctes('cleaned')}
SELECT doc_id, len(tokens) AS n_tokens, {S.md5_list('tokens')} AS tokens_md5 FROM toks""")
def q_stream_preprocess(spark, sf):
    """Structured Streaming: new document files -> clean -> tokens -> parquet
    sink (exactly once via the checkpoint), run until caught up, read back."""
    out, ckpt = work_dir(spark, "stream_tokens"), work_dir(spark, "stream_ckpt")
    # a pattern: the table is one file, or a folder of part files with names of their own
    q = ingest.start_preprocess_stream(spark, f"{sf.rstrip('/')}/documents*.parquet", out, ckpt, glob="*")
    q.awaitTermination()
    back = spark.read.parquet(out)
    return back.select("doc_id", F.size("tokens").alias("n_tokens"),
                       F.md5(F.array_join("tokens", "|")).alias("tokens_md5"))


@register("stream_unique", f"""WITH {S.PUBS}, {S.DECORATED}, {S.CLEANED}, {S.tokens_ctes('cleaned')}
SELECT doc_id, len(tokens) AS n_tokens, {S.md5_list('tokens')} AS tokens_md5 FROM toks""")
def q_stream_unique(spark, sf):
    """S13 in the stream: two thirds of the documents are delivered and processed, then
    all of them in new files, and the stream starts again: each document comes out once."""
    docs = read_table(spark, sf, "documents").select(*[c.split()[0] for c in ingest.DOCUMENTS_SCHEMA.split(", ")])
    into, out, ckpt = (work_dir(spark, f"stream_unique_{x}") for x in ("in", "out", "ckpt"))
    for delivery in (docs.filter(F.col("doc_id") % 3 != 0), docs):
        delivery.write.mode("append").parquet(into)
        ingest.start_unique_stream(spark, into, out, ckpt).awaitTermination()
    return spark.read.parquet(out).select("doc_id", F.size("tokens").alias("n_tokens"),
                                          F.md5(F.array_join("tokens", "|")).alias("tokens_md5"))
