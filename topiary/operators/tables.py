"""Coherence pivot, best model, topic list and topic table.

All inputs here are small by construction (grid points, K x top_n words);
the functions are still plain DataFrame code so they run where the data is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiary.functions.text import format_prob, topic_label


def topic_list(terms: DataFrame) -> DataFrame:
    """(topic_no = topic_id + 1, 'w1, w2, ...' in rank order)."""
    agg = terms.groupBy("topic_id").agg(F.sort_array(F.collect_list(F.struct("rank", "word"))).alias("__w"))
    return agg.select((F.col("topic_id") + 1).cast("int").alias("topic_no"),
                      F.array_join(F.transform("__w", lambda x: x["word"]), ", ").alias("words"))


def topic_table(terms: DataFrame, labels_available: bool = False, numbered: bool = False) -> DataFrame:
    """Per topic a header row, a 'word,prob.' row, the words (upper case,
    '.042' probabilities) and a blank row; (topic_id, section, rank) orders it.
    Header: 'TOPIC k' (the code's form) or, numbered, '(k+1) LABEL' (the form
    of the reference's sample output)."""
    topics = terms.select(F.col("topic_id").cast("int").alias("topic_id")).distinct()
    head = F.upper(topic_label("topic_id", labels_available))
    if numbered:
        head = F.concat(F.lit("("), (F.col("topic_id") + 1).cast("string"), F.lit(") "), head)
    header = topics.select("topic_id", F.lit(0).alias("section"), F.lit(0).alias("rank"),
                           head.alias("c1"), F.lit(None).cast("string").alias("c2"))
    colhdr = topics.select("topic_id", F.lit(1).alias("section"), F.lit(0).alias("rank"),
                           F.lit("word").alias("c1"), F.lit("prob.").alias("c2"))
    words = terms.select(F.col("topic_id").cast("int").alias("topic_id"), F.lit(2).alias("section"),
                         F.col("rank").cast("int").alias("rank"), F.upper("word").alias("c1"),
                         format_prob("p").alias("c2"))
    blank = topics.select("topic_id", F.lit(3).alias("section"), F.lit(0).alias("rank"),
                          F.lit("").alias("c1"), F.lit(None).cast("string").alias("c2"))
    return header.unionByName(colhdr).unionByName(words).unionByName(blank)


def coherence_pivot(scores: DataFrame, min_k: int = 2, max_k: int = 20) -> DataFrame:
    """E5: rows 'prior-seed-pass-iter', one column per k; duplicates: the
    last in sorted order wins (the highest score among equal keys); missing
    cells stay NULL."""
    cfg = F.concat_ws("-", "dir_prior", F.col("random_state").cast("string"),
                      F.col("num_pass").cast("string"), F.col("iteration").cast("string"))
    ks = list(range(min_k, max_k + 1))
    keys = ["dir_prior", "random_state", "num_pass", "iteration"]
    return (scores.withColumn("config", cfg).groupBy(*keys, "config").pivot("k", ks)
                  .agg(F.max("coherence_score")).orderBy(*keys).drop(*keys))  # rows in numeric order


def best_model(scores: DataFrame) -> DataFrame:
    """The highest-scoring configuration (ties: smallest k, seed, passes)."""
    return scores.orderBy(F.desc("coherence_score"), "k", "random_state", "num_pass", "iteration").limit(1)


def seed_stability(scores: DataFrame) -> DataFrame:
    """Mean and spread of the score over random starts per configuration."""
    return (scores.groupBy("k", "dir_prior", "num_pass", "iteration")
                  .agg(F.avg("coherence_score").alias("mean_score"),
                       F.stddev_samp("coherence_score").alias("std_score"),
                       F.count(F.lit(1)).alias("n_seeds")))


def _csv_field(c, alone):
    """Minimal CSV quoting: quote on ',', '"' or line breaks; an empty field
    is quoted only when it is the whole row (so the row is not blank)."""
    needs = c.contains(",") | c.contains('"') | c.contains("\n") | c.contains("\r") | ((F.length(c) == 0) & alone)
    return F.when(needs, F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)


def table_lines(table: DataFrame) -> DataFrame:
    """E8 rows as CSV lines: (topic_id, section, rank, line)."""
    alone = F.col("c2").isNull()
    line = F.when(alone, _csv_field(F.col("c1"), F.lit(True))).otherwise(
        F.concat(_csv_field(F.col("c1"), F.lit(False)), F.lit(","), _csv_field(F.col("c2"), F.lit(False))))
    return table.select("topic_id", "section", "rank", line.alias("line"))


def write_table_csv(table: DataFrame, path: str) -> None:
    """S6 for E8/E7: one ordered file ('\n' line ends). The table is K x
    (top_n + 3) rows, so a single output partition is bounded."""
    (table_lines(table).orderBy("topic_id", "section", "rank").select("line")
        .coalesce(1).write.mode("overwrite").option("lineSep", "\n").text(path))
