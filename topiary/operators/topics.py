"""Document-topic tables and topic-word tables.

Two sources feed the same downstream views:
* an LDA model (operators/model.py), and
* a deterministic stand-in used for exact checks: every word hashes to a
  topic (md5 prefix mod K, optionally salted by a model key), and a
  document's share of topic t is (n_t + 1) / (n + K).

Both produce ``doc_topics(doc_id, journal, year, title, topics map<int,double>)``
with all K entries present, and ``topic_terms(topic_id, rank, word, p)``.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topiary.functions import batches as B
from topiary.session import frozen


def word_topic(word, k, salt=None) -> Column:
    """Stand-in topic of a word: first 8 hex digits of md5 as an integer, mod k."""
    w = F.col(word) if isinstance(word, str) else word
    src = w if salt is None else F.concat(salt if isinstance(salt, Column) else F.lit(salt), w)
    k = F.lit(k) if isinstance(k, int) else k
    return F.conv(F.substring(F.md5(src), 1, 8), 16, 10).cast("bigint") % k


def standin_doc_topics(texts: DataFrame, k: int = 10, tokens_col: str = "tokens",
                       keep=("doc_id", "journal", "year", "title")) -> DataFrame:
    """Per-row, no shuffle: topic ids of the tokens (a word is hashed once per Arrow
    batch), then K smoothed shares."""
    def shares(tokens: pa.Array) -> pa.Array:
        return B.hashed_shares(tokens, k)
    d = texts.select(*keep, F.arrow_udf(shares, "array<double>")(tokens_col).alias("__shares"))
    return d.select(*keep, F.map_from_arrays(F.sequence(F.lit(0), F.lit(k - 1)), "__shares").alias("topics"))


def word_counts(texts: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """(word, cf): corpus count of every word (counts per Arrow batch, then one
    partially aggregated shuffle)."""
    return texts.select(tokens_col).mapInArrow(B.word_totals, "word string, n long").groupBy("word").agg(F.sum("n").alias("cf"))


def standin_topic_terms_grid(words: DataFrame, models: list, top_n: int = 10) -> DataFrame:
    """Top words of several stand-in models at once.

    ``models`` = [(model_id, k, salt)], a short literal list: a task hashes its
    words once per salt and hands on each topic's total and its best words only
    (models x K x top_n rows); one windowed top-n picks among these.
    (model_id, topic_id, rank, word, p), p = cf / cf of the topic.
    """
    from topiary.operators.ranking import top_n_per_group
    rows = frozen(words.select("word", "cf").mapInArrow(B.top_hashed(models, top_n), "model_id long, topic_id int, word string, cf long"))
    totals = rows.filter("word is null").groupBy("model_id", "topic_id").agg(F.sum("cf").alias("__tot"))
    wm = rows.filter("word is not null").join(F.broadcast(totals), ["model_id", "topic_id"]).withColumn("p", F.col("cf") / F.col("__tot"))
    top = top_n_per_group(wm, ["model_id", "topic_id"], [F.desc("p"), F.asc("word")], top_n)
    return top.select("model_id", "topic_id", "rank", "word", "p")


def standin_topic_terms(texts: DataFrame, k: int = 10, top_n: int = 10, tokens_col: str = "tokens",
                        salt=None) -> DataFrame:
    """M6 twin: (topic_id, rank, word, p) with p = count(word) / count(all
    words of the topic); top_n per topic by p desc, then word."""
    t = standin_topic_terms_grid(word_counts(texts, tokens_col), [(0, k, salt)], top_n)
    return t.drop("model_id")


def topics_array(topics) -> Column:
    """Map -> array ordered by the integer key."""
    m = F.col(topics) if isinstance(topics, str) else topics
    return F.transform(F.sort_array(F.map_entries(m)), lambda e: e["value"])


def dominant_topic(arr) -> Column:
    """Argmax, lowest id on ties."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")

