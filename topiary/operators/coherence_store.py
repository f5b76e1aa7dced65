"""E4 step by step: window counts that are kept per document batch and model.

c_v needs counts only, and every count is a sum over documents. So each (batch,
model) pair is counted once, written below its own path and registered
afterwards; scores add up what is registered. New documents bring their own batch,
new models only their own words, and a run that finds nothing missing opens no
text. A run that dies between writing and registering leaves files that no
registered pair names, and they are never read.

A model is named by its id: other top words need another id. The number of
missing models of a batch is what reaches the driver (a row per model).

Defined cases: a batch without any top word counts no window; an empty batch is
registered like any other; the same batch given again is skipped whatever it
holds; scores of a model without a registered pair do not appear.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiary.operators import coherence as CO
from topiary.session import frozen

REGISTRY = "batch string, model_id long, part string"
TABLES = {"occ": "model_id long, word string, occ long",
          "co": "model_id long, topic_id int, w1 string, w2 string, co long",
          "nwin": "model_id long, num_windows long"}


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, empty if there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def registered(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, os.path.join(root, "registry"), REGISTRY)


def add_batch(root: str, batch: str, texts: DataFrame, top: DataFrame, window: int = CO.WINDOW) -> int:
    """Count the windows of a batch for the models of ``top`` (model_id, topic_id,
    word) that have not been counted there; the number of these models."""
    spark = texts.sparkSession
    top = top.select(F.col("model_id").cast("long").alias("model_id"), F.col("topic_id").cast("int").alias("topic_id"), "word")
    done = registered(spark, root).filter(F.col("batch") == batch)
    missing = sorted(r["model_id"] for r in top.select("model_id").distinct().join(done, "model_id", "left_anti").collect())
    if not missing:
        return 0
    top = frozen(top.filter(F.col("model_id").isin(missing)))
    occ, co, nwin = CO.window_counts(texts, top, window)
    of_model = top.select("model_id", "word").distinct()
    part = hashlib.sha256(",".join(map(str, missing)).encode()).hexdigest()[:16]
    counts = {"occ": of_model.join(occ, "word"), "co": co, "nwin": nwin}
    for name, rows in counts.items():
        path = os.path.join(root, name, f"batch={batch}", f"part={part}")
        rows.selectExpr(*(f"cast({c.split()[0]} as {c.split()[1]}) as {c.split()[0]}" for c in TABLES[name].split(", "))) \
            .write.mode("overwrite").parquet(path)
    spark.createDataFrame([(batch, m, part) for m in missing], REGISTRY).coalesce(1).write.mode("append").parquet(os.path.join(root, "registry"))
    return len(missing)


def merged(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """occ, co and nwin per model, added over the registered batches."""
    pairs = registered(spark, root).distinct()
    out = {}
    for name, schema in TABLES.items():
        rows = _read(spark, os.path.join(root, name), schema + ", batch string, part string")
        *keys, value = [c.split()[0] for c in schema.split(", ")]
        rows = rows.join(F.broadcast(pairs), ["batch", "part", "model_id"])  # a row per batch and model
        out[name] = rows.groupBy(*keys).agg(F.sum(value).alias(value))
    return out


def topic_scores(spark: SparkSession, root: str, top: DataFrame) -> DataFrame:
    """(model_id, topic_id, coherence) of the models of ``top`` from the stored counts alone."""
    counts = merged(spark, root)
    return CO.cv_by_topic(CO.npmi(frozen(top), counts["occ"], counts["co"], counts["nwin"]))


def model_scores(spark: SparkSession, root: str, top: DataFrame) -> DataFrame:
    """(model_id, coherence): the mean of the model's topics."""
    return topic_scores(spark, root, top).groupBy("model_id").agg(F.avg("coherence").alias("coherence"))
