"""Per-row array helpers built from Spark higher-order functions.

Everything here works inside one row (one document), so none of it shuffles.
Intermediate arrays are materialised as columns and referenced from lambdas
only through those columns, so Catalyst never inlines a sort into a lambda
body (which would make the work quadratic in document length).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_run_lengths(df: DataFrame, src: str, out: str, value: str = "value",
                     count: str = "n") -> DataFrame:
    """``out`` = array<struct<value, n>>: distinct elements of ``src`` in
    ascending order with their multiplicity (a per-row Counter).

    sort_array (native ordering) + one linear pass for run starts; no shuffle.
    """
    s, st = f"__{out}_sorted", f"__{out}_starts"
    df = df.withColumn(s, F.sort_array(F.col(src)))
    df = df.withColumn(
        st,
        F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                 lambda i: (i == 0) | (F.get(F.col(s), i) != F.get(F.col(s), i - 1))))
    runs = F.transform(
        F.col(st),
        lambda p, j: F.struct(
            F.get(F.col(s), p).alias(value),
            (F.coalesce(F.get(F.col(st), j + 1), F.size(F.col(s))) - p).alias(count)))
    # an empty input yields one bogus run of length 0: drop it
    df = df.withColumn(out, F.filter(runs, lambda r: r[count] > 0))
    return df.drop(s, st)


def adjacent_pairs(tokens: Column, sep: str = " ") -> Column:
    """Adjacent pairs 'a b' of a token array (empty for fewer than 2 tokens)."""
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    left = F.slice(tokens, 1, n)
    right = F.slice(tokens, 2, n)
    return F.transform(F.arrays_zip(left.alias("l"), right.alias("r")),
                       lambda z: F.concat(z["l"], F.lit(sep), z["r"]))


def empty_if_null(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def explode_rows(df: DataFrame, keep: list, arr, names: list, with_pos: bool = False) -> DataFrame:
    """One row per array element, rows with empty/NULL arrays dropped.

    Uses the *_outer generators and filters above them: a plain explode makes
    Catalyst infer ``size(arr) > 0`` and push it below the projection, which
    re-evaluates the whole array expression (and inlines it into lambdas).
    """
    if with_pos:
        out = df.select(*keep, F.posexplode_outer(arr).alias(*names))
        return out.filter(F.col(names[0]).isNotNull())
    if len(names) == 1:
        out = df.select(*keep, F.explode_outer(arr).alias(names[0]))
        return out.filter(F.col(names[0]).isNotNull())
    out = df.select(*keep, F.inline_outer(arr))
    return out.filter(F.col(names[0]).isNotNull())
