"""Steps the reference describes in prose (corpus-specific stop
words, a TF-IDF band, boilerplate removal, near-identical topics)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiary.operators import tokens as TK
from topiary.operators.topics import word_topic
from topiary.operators.vocab import broadcast_if_small, doc_freq


def corpus_stopwords(texts: DataFrame, n: int = 20, tokens_col: str = "tokens") -> list:
    """The n words found in most documents (ties by word). The list is
    n rows, so it is collected and becomes a hash-set filter."""
    top = doc_freq(texts, tokens_col).orderBy(F.desc("df"), F.asc("token")).limit(n)
    return [r["token"] for r in top.collect()]


def remove_custom_stopwords(texts: DataFrame, extra: list, tokens_col: str = "tokens") -> DataFrame:
    """A corpus-specific list, dropped from tokens that T2 has been through already."""
    return texts.withColumn(tokens_col, TK.remove_stopwords(tokens_col, list(extra)))


def tfidf_band(bow: DataFrame, vocab: DataFrame, n_docs, lo: float = 2.0, hi: float | None = None) -> DataFrame:
    """Tf * ln((N + 1) / (df + 1)) per (doc, term), kept inside [lo, hi].
    The vocabulary is broadcast if it is small (counted), else the join shuffles."""
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    j = bow.join(broadcast_if_small(vocab.select("term_id", "token", "df")), "term_id")
    score = F.col("tf") * F.log((n + 1) / (F.col("df") + 1))
    j = j.withColumn("tfidf", score)
    cond = F.col("tfidf") >= lo
    if hi is not None:
        cond = cond & (F.col("tfidf") <= hi)
    return j.filter(cond)


def topic_word_distributions(words: DataFrame, models: list) -> DataFrame:
    """(model_id, topic_id, word, p) of stand-in models over all words."""
    arr = F.array(*[F.struct(F.lit(m).alias("model_id"), F.lit(k).alias("k"), F.lit(s or "").alias("salt"))
                    for m, k, s in models])
    wm = words.select("word", "cf", F.inline(arr))
    wm = wm.select("model_id", "word", "cf", word_topic(F.col("word"), F.col("k"), F.col("salt")).cast("int").alias("topic_id"))
    tot = wm.groupBy("model_id", "topic_id").agg(F.sum("cf").alias("__tot"))
    return (wm.join(F.broadcast(tot), ["model_id", "topic_id"])
              .select("model_id", "topic_id", "word", (F.col("cf") / F.col("__tot")).alias("p")))


def similar_topics(dist: DataFrame, model_a, model_b) -> DataFrame:
    """Cosine between every topic of model A and every topic of model B (the
    same model: between its different topics, the merge candidates) over their word distributions. Joined on word: each word meets one row
    per model and topic containing it (at most K per model), so no group
    grows with the corpus; the K x K result is then small."""
    a = dist.filter(F.col("model_id") == model_a).select(F.col("topic_id").alias("t1"), "word", F.col("p").alias("pa"))
    b = dist.filter(F.col("model_id") == model_b).select(F.col("topic_id").alias("t2"), "word", F.col("p").alias("pb"))
    dot = a.join(b, "word").groupBy("t1", "t2").agg(F.sum(F.col("pa") * F.col("pb")).alias("dot"))
    na = a.groupBy("t1").agg(F.sqrt(F.sum(F.col("pa") * F.col("pa"))).alias("na"))
    nb = b.groupBy("t2").agg(F.sqrt(F.sum(F.col("pb") * F.col("pb"))).alias("nb"))
    if model_a == model_b:
        dot = dot.filter("t1 < t2")
    return (dot.join(F.broadcast(na), "t1").join(F.broadcast(nb), "t2")
               .select("t1", "t2", (F.col("dot") / (F.col("na") * F.col("nb"))).alias("cosine")))
