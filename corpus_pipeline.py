"""A corpus pipeline of the operators in ``topiary.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as Parquet in the shared folder and rereads it as the next stage's ``docs``, so a
lost executor costs at most one stage's tasks. All stages but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiary.llm import decontaminate, minhash, mixing, sharding, toxicity
from topiary.llm.common import read
from topiary.session import work_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the model is fitted on the labelled training rows."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    whole = docs.select(F.struct(*docs.columns).alias("__doc"), "text")
    return toxicity.score(whole, model, keep=["__doc"]).filter("toxicity < 0.5").select("__doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return minhash.near_dedup(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    whole = docs.select(F.struct(*docs.columns).alias("__doc"), "text")
    return decontaminate.find(whole, read(spark, sf_dir, "benchmark"), keep=["__doc"]) \
                        .filter("not contaminated").select("__doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs)


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's shard and slot."""
    return sharding.shard(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
    ("shard", cut_shards),
]

#: The first stage fits a classifier, which SQL cannot express; the tests hold
#: each stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
