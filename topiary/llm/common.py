"""Helpers shared by the operators: materialising narrow tables, dense ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topiary.session import checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def frozen(df: DataFrame) -> DataFrame:
    """The rows as written once to the shared checkpoint folder.

    Used for narrow tables (ids, digests, counts) that several branches read;
    later branches neither recompute them nor depend on one executor's disk.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def lower_az(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does exactly that on pure ASCII text and
    is much cheaper than ``translate``, which handles the rest."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def dense_rank_all(df: DataFrame, order: list, out: str) -> DataFrame:
    """``out`` = 0-based position in ``order`` over all rows, gapless, without
    a one-task window: range-partition, freeze, then add to each row's place in
    its partition the row count of the partitions before it (one row each)."""
    ranged = frozen(df.repartitionByRange(*order).sortWithinPartitions(*order)
                      .withColumn("__pid", F.spark_partition_id())
                      .withColumn("__mid", F.monotonically_increasing_id()))
    per = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__c"), F.min("__mid").alias("__m0"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("__pid", (F.coalesce(F.sum("__c").over(before), F.lit(0)) - F.col("__m0")).alias("__off"))
    return (ranged.join(F.broadcast(per), "__pid")
                  .withColumn(out, F.col("__off") + F.col("__mid"))
                  .drop("__pid", "__mid", "__off"))
