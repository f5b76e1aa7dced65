"""X5, X6 on fitted models: which topic of one run is which topic of another.

A model is given as (model_id, topic_id, term_id, p), p up to a factor per topic. The K x K cosines of two
models come from one join on the term; each word meets at most K rows a model, so
no group grows with the corpus. The topics are then paired one to one such that the
sum of the pairs' cosines is as large as possible: each pair of models is a group of
K^2 rows, solved in its task by shortest augmenting paths with a price per topic
(Kuhn 1955; Jonker and Volgenant 1987).

Cosines enter as integers (millionths), so the optimum is exact and does not depend
on the order of summing; among optimal pairings the one whose list of partners (by
ascending topic of the model with fewer topics, A if both have as many) is smallest is taken.

Defined cases: topics without a common word have cosine 0; a model whose topics are
more than the other's leaves its surplus unpaired (no row); a topic whose probabilities are all 0
or NULL is no topic; an empty input gives an empty result; other columns are not read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiary.operators.vocab import broadcast_if_small
from topiary.session import frozen

SCALE = 1_000_000
MATCH = "model_a long, model_b long, t1 int, t2 int, cosine long"


def cosines(dist: DataFrame, pairs: DataFrame) -> DataFrame:
    """(model_a, model_b, t1, t2, cosine) in millionths for every topic of A and of B, for
    the (model_a, model_b) in ``pairs``; a model may be paired with itself."""
    rows = dist.filter("p > 0").select(F.col("model_id").cast("long").alias("model_id"), F.col("topic_id").cast("int").alias("t"), "term_id", "p")
    norms = frozen(rows.groupBy("model_id", "t").agg(F.sqrt(F.sum(F.col("p") * F.col("p"))).alias("norm")))
    pairs = frozen(pairs.select(F.col("model_a").cast("long").alias("model_a"), F.col("model_b").cast("long").alias("model_b")).distinct().coalesce(1))
    few, others = broadcast_if_small(pairs), broadcast_if_small(frozen(pairs.select("model_b").distinct().coalesce(1)))  # counted: a model's rows stay where they are
    a = rows.select(F.col("model_id").alias("model_a"), F.col("t").alias("t1"), "term_id", F.col("p").alias("pa")).join(few, "model_a")
    b = rows.select(F.col("model_id").alias("model_b"), F.col("t").alias("t2"), "term_id", F.col("p").alias("pb")).join(others, "model_b", "left_semi")
    dot = a.join(b, ["model_b", "term_id"]).groupBy("model_a", "model_b", "t1", "t2").agg(F.sum(F.col("pa") * F.col("pb")).alias("dot"))
    na = norms.select(F.col("model_id").alias("model_a"), F.col("t").alias("t1"), F.col("norm").alias("na"))
    nb = norms.select(F.col("model_id").alias("model_b"), F.col("t").alias("t2"), F.col("norm").alias("nb"))
    grid = pairs.join(na, "model_a").join(nb, "model_b")  # K x K rows a pair, those without a common word too
    return grid.join(dot, ["model_a", "model_b", "t1", "t2"], "left").select(
        "model_a", "model_b", "t1", "t2", F.round(F.coalesce(F.col("dot") / (F.col("na") * F.col("nb")), F.lit(0.0)) * SCALE).cast("long").alias("cosine"))


def assign(gain: list[list[int]]) -> list[int]:
    """The column of each row, all different, of largest total gain; ties: the smallest
    list. Rows may not be more than columns. Prices keep every reduced cost non-negative."""
    n, m = len(gain), len(gain[0])
    # the tie rule as the lower digits of an exact integer: earlier rows weigh more
    unit = (m + 1) ** n
    cost = [[-g * unit + j * (m + 1) ** (n - 1 - i) for j, g in enumerate(row)] for i, row in enumerate(gain)]
    row_price, price, owner = [0] * (n + 1), [0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        owner[0], at = i, 0
        slack: list = [None] * (m + 1)
        came, done = [0] * (m + 1), [False] * (m + 1)
        while owner[at]:
            done[at] = True
            r, step, nearest = owner[at], None, 0
            for j in range(1, m + 1):
                if done[j]:
                    continue
                reduced = cost[r - 1][j - 1] - row_price[r] - price[j]
                if slack[j] is None or reduced < slack[j]:
                    slack[j], came[j] = reduced, at
                if step is None or slack[j] < step:
                    step, nearest = slack[j], j
            for j in range(m + 1):
                if done[j]:
                    row_price[owner[j]] += step
                    price[j] -= step
                elif slack[j] is not None:
                    slack[j] -= step
            at = nearest
        while at:
            owner[at] = owner[came[at]]
            at = came[at]
    out = [0] * n
    for j in range(1, m + 1):
        if owner[j]:
            out[owner[j] - 1] = j - 1
    return out


def match_topics(table: DataFrame) -> DataFrame:
    """The pairs (model_a, model_b, t1, t2, cosine) of the best one-to-one pairing of
    each two models in ``cosines``' table; min(K_a, K_b) rows a pair of models."""

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        grid = group.pivot(index="t1", columns="t2", values="cosine").sort_index().sort_index(axis=1)
        rows, cols, gain = list(grid.index), list(grid.columns), [[int(x) for x in r] for r in grid.to_numpy()]
        if len(rows) <= len(cols):
            pairs = list(enumerate(assign(gain)))
        else:
            pairs = [(i, j) for j, i in enumerate(assign([list(c) for c in zip(*gain)]))]
        a, b = int(group["model_a"].iloc[0]), int(group["model_b"].iloc[0])
        return pd.DataFrame([(a, b, rows[i], cols[j], gain[i][j]) for i, j in pairs], columns=["model_a", "model_b", "t1", "t2", "cosine"])

    return table.groupBy("model_a", "model_b").applyInPandas(solve, MATCH)


def topic_stability(dist: DataFrame, pairs: DataFrame) -> DataFrame:
    """X5 by topic: (model_id, topic_id, n_models, mean_cosine, least_cosine) over the
    topic's partners in the models that ``pairs`` sets beside its own; cosines in
    millionths, the mean rounded down. A topic without any partner has no row."""
    found = frozen(match_topics(cosines(dist, pairs)))
    both = found.select(F.col("model_a").alias("model_id"), F.col("t1").alias("topic_id"), "cosine").unionByName(
        found.select(F.col("model_b").alias("model_id"), F.col("t2").alias("topic_id"), "cosine"))
    return both.groupBy("model_id", "topic_id").agg(F.count(F.lit(1)).alias("n_models"), F.expr("sum(cosine) div count(1)").alias("mean_cosine"),
                                                    F.min("cosine").alias("least_cosine"))


def merge_candidates(dist: DataFrame, least: int = 500_000) -> DataFrame:
    """X6 within each model: pairs of different topics whose cosine is ``least`` millionths or more."""
    ids = dist.filter("p > 0").select(F.col("model_id").cast("long").alias("model_a")).distinct()
    found = cosines(dist, ids.withColumn("model_b", F.col("model_a")))
    return found.filter((F.col("t1") < F.col("t2")) & (F.col("cosine") >= least)) \
                .select(F.col("model_a").alias("model_id"), "t1", "t2", "cosine")
