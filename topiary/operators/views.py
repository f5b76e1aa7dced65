"""Descriptive views over doc_topics.

Every view is one hash aggregate over (key, topic) with map-side partial
aggregation; hot keys (one year or one journal with a third of all
documents) collapse to a row per map task before the shuffle. Only the
final K x K / keys x K tables are small enough to pivot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topiary.functions.arrays import explode_rows
from topiary.functions.lexicon import TOPIC_LABELS
from topiary.functions.text import cast_year, row_label_pct, topic_label
from topiary.operators.topics import dominant_topic, topics_array


def long_shares(doc_topics: DataFrame, keep: list) -> DataFrame:
    """(keep..., topic_id, share) from the topic map (I1 + explode)."""
    d = doc_topics.filter(F.col("topics").isNotNull()).select(*keep, topics_array("topics").alias("__arr"))
    out = explode_rows(d, keep, F.col("__arr"), ["topic_id", "share"], with_pos=True)
    return out.withColumn("topic_id", F.col("topic_id").cast("int"))


def dominant(doc_topics: DataFrame) -> DataFrame:
    """(doc_id, year, title, journal, topic_id, share) of the argmax topic."""
    d = doc_topics.filter(F.col("topics").isNotNull()).withColumn("__arr", topics_array("topics"))
    d = d.withColumn("topic_id", dominant_topic("__arr"))
    return d.select("doc_id", "year", "title", "journal", "topic_id",
                    F.get(F.col("__arr"), F.col("topic_id")).alias("share"))


def titles_per_topic(doc_topics: DataFrame) -> DataFrame:
    """Documents under their dominant topic, strongest first (range-sorted,
    so a hot topic is split across many sort tasks)."""
    return dominant(doc_topics).orderBy("topic_id", F.desc("share"), "doc_id")


def mean_by(doc_topics: DataFrame, key: str, key_expr=None) -> DataFrame:
    """(key, topic_id, mean_share): plain mean per key, every document weighs 1."""
    src = doc_topics if key_expr is None else doc_topics.withColumn(key, key_expr)
    ls = long_shares(src, [key])
    return ls.groupBy(key, "topic_id").agg(F.avg("share").alias("mean_share"))


def topics_by_year(doc_topics: DataFrame) -> DataFrame:
    """I4: mean topic share per integer year."""
    return mean_by(doc_topics, "year", cast_year("year"))


def topics_by_journal(doc_topics: DataFrame) -> DataFrame:
    """Mean topic share per journal (documents without topics ignored)."""
    return mean_by(doc_topics, "journal")


def _labels(k: int, labels_available: bool) -> list[str]:
    """A name per topic; topics beyond the labelled ones are numbered."""
    return [TOPIC_LABELS[t] if labels_available and t in TOPIC_LABELS else f"Topic {t}" for t in range(k)]


def wide_by_label(long_df: DataFrame, key: str, value: str, *, k: int,
                  labels_available: bool = True) -> DataFrame:
    """One column per topic label (pivot over the model's K ids, no extra job)."""
    lab = _labels(k, labels_available)
    w = long_df.groupBy(key).pivot("topic_id", list(range(k))).agg(F.first(value))
    return w.select(key, *[F.col(str(t)).alias(lab[t]) for t in range(k)])


def topic_cooccurrence(doc_topics: DataFrame) -> DataFrame:
    """Mean share x 100 of each topic among documents dominated by a topic."""
    d = doc_topics.filter(F.col("topics").isNotNull()).withColumn("__arr", topics_array("topics"))
    d = d.withColumn("dominant_id", dominant_topic("__arr"))
    ls = explode_rows(d, ["dominant_id"], F.col("__arr"), ["topic_id", "share"], with_pos=True)
    return (ls.groupBy(F.col("topic_id").cast("int").alias("topic_id"), "dominant_id")
              .agg((F.avg("share") * 100).alias("mean_pct")))


def cooccurrence_matrix(cooc: DataFrame, labels_available: bool = True) -> DataFrame:
    """I8 (long form): row = topic, column = dominant topic. Row max is taken
    before the diagonal is zeroed; row label '{label} ({max}%)'. Topics never
    dominant have no column (they are simply absent)."""
    w = Window.partitionBy("topic_id")  # over a K x K table: bounded
    m = cooc.withColumn("row_max", F.max("mean_pct").over(w))
    row_lab = topic_label("topic_id", labels_available)
    return m.select(
        "topic_id",
        row_label_pct(row_lab, F.col("row_max")).alias("row_label"),
        "dominant_id",
        topic_label("dominant_id", labels_available).alias("col_label"),
        F.when(F.col("topic_id") == F.col("dominant_id"), F.lit(0.0)).otherwise(F.col("mean_pct")).alias("value"),
        "row_max")


def matrix_wide(long_m: DataFrame, *, k: int, labels_available: bool = True) -> DataFrame:
    """I8 as a table: rows by max desc, columns by label ascending. A topic that
    is never dominant has an empty column."""
    cols = sorted(_labels(k, labels_available))
    w = long_m.groupBy("row_label", "row_max").pivot("col_label", cols).agg(F.first("value"))
    return w.orderBy(F.desc("row_max"), "row_label").drop("row_max")
