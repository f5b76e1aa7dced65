"""Mixing sources to target weights by systematic sampling (native).

Every document of a source is expected ``target / source_size`` times. Its
expected copies are prefix-summed within the source in order of size, one
random offset per source is added, and the document is emitted once for each
integer the running sum crosses. Ordering by size makes the words taken follow
the target to within about one long document, as neighbours in the order are
interchangeable.

Targets: sources in code-point order (NULL last) weigh 1, 2, 3, repeating, and
share the total by weight; none takes more than ``most`` times its size, and
what is cut off is shared again by weight among the others. The fixed point is
reached directly: in order of cap per unit of weight, a source is capped
exactly when its cap is below its share of what the capped ones before it left.

Scale: the prefix sum is a global range partition (source, size, doc_id) with
per-partition offsets, so a source with a third of all rows is spread over many
tasks. Per-source figures are one row per source.

Defined cases: NULL text has size 0 and contributes nothing (taken 0); NULL
source is a source of its own; repeated rows are sampled separately; an empty
table gives an empty result. Reruns agree: the offset depends on seed and
source only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topiary.llm.common import dense_rank_all, frozen

WORD = r"[^\x20\x09-\x0D]+"
MOST = 3
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size)."""
    by_code = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("weight", ((F.row_number().over(by_code) - 1) % 3 + 1).cast("long"))
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = (w.withColumn("cap", most * F.col("source_size"))
          .withColumn("left_size", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
          .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    w = w.withColumn("capped", F.col("cap") * F.col("left_weight") <= F.col("left_size") * F.col("weight"))
    # the first source that is not capped fixes the rate of all later ones
    w = w.withColumn("rate", F.first(F.when(~F.col("capped"), F.col("left_size") / F.col("left_weight")), ignorenulls=True).over(everything))
    return w.select("source", "source_size",
                    F.when(F.col("capped"), F.col("cap").cast("double"))
                     .otherwise(F.col("weight") * F.col("rate")).alias("target"))


def offset(source: Column, seed: str) -> Column:
    """The source's random offset in [0, 1), from an MD5 digest."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(source, F.lit("\\N"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def mix(docs: DataFrame, most: int = MOST, seed: str = SEED, keep: tuple = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), one row per
    row, and the columns ``keep`` (small ones, such as keys)."""
    rows = frozen(docs.select("doc_id", F.col("source").cast("string").alias("source"),
                              word_count(F.col("text")).alias("size"), *keep))
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    targets = source_targets(per.select("source", "source_size"), most)
    ranked = dense_rank_all(rows, ["source", "size", "doc_id"], "rank")
    # ranks start at a source's first row: rows of the sources before it, NULL first as in the sort
    earlier = Window.orderBy(F.col("source").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    bases = per.select(F.col("source").alias("s"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("base"))
    plan = targets.join(bases, targets["source"].eqNullSafe(bases["s"])).drop("s") \
                  .withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    place = F.col("rank") - F.col("base")
    upto = lambda k: F.floor(rate * k + offset(F.col("of"), seed))
    copies = F.least(upto(place + 1) - upto(place), F.lit(most).cast("long"))
    return (ranked.join(plan, ranked["source"].eqNullSafe(plan["of"]))
            .withColumn("copies", copies.cast("long"))
            .select("doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken"), *keep))


def mixed_rows(docs: DataFrame, most: int = MOST, seed: str = SEED) -> DataFrame:
    """``docs`` with each row as often as the mix takes it. Rows are matched to
    their copies by a hash of id, source and text; rows equal in all three share
    their copies evenly."""
    key = F.xxhash64("doc_id", "source", "text")
    keyed = docs.withColumn("__key", key)
    taken = mix(keyed, most, seed, keep=("__key",)).groupBy("__key").agg(
        F.sum("copies").alias("__all"), F.count(F.lit(1)).alias("__rows")).filter("__all > 0")
    same = Window.partitionBy("__key").orderBy("__key")
    out = keyed.join(taken.hint("merge"), "__key").withColumn("__place", F.row_number().over(same))
    times = F.expr("cast(__all div __rows + if(__place <= __all % __rows, 1, 0) as int)")
    return out.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), times))).select(*docs.columns)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source),
-- the rate at which the sources not capped at it take up just what is left
r AS (
  SELECT max(left_size::DOUBLE / left_weight) AS rate FROM (
    SELECT a.weight, a.source_size, sum(b.source_size)
             - 3 * coalesce(sum(b.source_size) FILTER (b.source_size * a.weight < a.source_size * b.weight), 0) AS left_size,
           sum(b.weight) FILTER (b.source_size * a.weight >= a.source_size * b.weight) AS left_weight
    FROM s a CROSS JOIN s b GROUP BY a.source, a.weight, a.source_size) x
  WHERE 3 * source_size * left_weight > left_size * weight),
t AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, weight * (SELECT rate FROM r)) AS target FROM s),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         (row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) - 1)::DOUBLE AS place,
         ('0x' || substr(md5('mix-1:' || coalesce(d.source, '\N')), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (least(floor(rate * (place + 1) + u) - floor(rate * place + u), 3) * size)::BIGINT AS taken
FROM p
"""
