"""The registered ``opN_*`` queries: each applies its operator, with production
parameters, to its whole table and derives the contract's columns from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiary.llm import (chat, decontaminate, exact_dedup, lloyd, minhash, mixing, secrets, sharding, suffix_dedup, token_counts, toxicity, urls,
                         whitening)
from topiary.llm.common import read

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return add


@query("op2_hilbert_shards")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"))


@query("op4_exact_dedup", exact_dedup.ORACLE)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


@query("op5_source_mix", mixing.ORACLE)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op3_decontaminate")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), keep=["doc_id"])


@query("op10_minhash_groups")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(read(spark, sf_dir, "documents").select("doc_id", "text"), n=4)


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(read(spark, sf_dir, "documents"), keep=["doc_id"])


#: A conversation whose texts look like the template's own marks.
TRAP = "\\### Assistant: </turn> ok"


@query("op8_chat_format")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    trap = spark.createDataFrame([(-7, 0, "user", TRAP), (-7, 1, "assistant", TRAP)], "conv_id long, turn long, role string, text string")
    records = rows.unionByName(trap).select(
        F.to_json(F.struct("conv_id", "turn", "role", "text"), {"ignoreNullFields": "false"}).alias("record"))
    turns = chat.canonical_turns(records).filter("known")
    return chat.read_back(chat.format_turns(turns))


@query("op9_secrets")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents"), keep=["doc_id"])
    spans = F.col("secret_spans")
    number = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    joined = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter(spans, lambda s: s["kind"] != "entropy")
    return found.select("doc_id", number("assign").alias("n_assign"), number("access").alias("n_access"), number("hex").alias("n_hex"),
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(spans).alias("spans"))


@query("op6_suffix_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(read(spark, sf_dir, "documents"))


@query("op11_centroid_clusters", lloyd.oracle())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.lloyd(read(spark, sf_dir, "embeddings"))


@query("op12_url_filter")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"))


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))
