"""Top-n per group.

``row_number() <= n`` over a window is planned by Spark (3.5+) with a
partial WindowGroupLimit before the shuffle, so each map task forwards at
most n rows per group: a hot group (one topic holding a third of all words)
never moves more than n x tasks rows to a single reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group_cols: list, order_cols: list, n: int,
                    rank_col: str = "rank") -> DataFrame:
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)
