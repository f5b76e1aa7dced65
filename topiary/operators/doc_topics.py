"""M4 stored: shares per model and document bucket, replaced bucket by bucket.

The table is partitioned by (model, bucket), the bucket a hash of the document's
id. A run infers only documents that are new or whose words changed (a digest of
their counted terms is stored with them), and rewrites only the buckets that hold
one: their other rows are carried over, all other files stay as they are. A run
with nothing new writes nothing. The overwrite is Spark's dynamic one, which
swaps the touched partitions when the job commits.

Defined cases: a NULL doc_id is refused (it has no bucket to be replaced in); a
document without a known term is stored with the normalised alpha; documents that
are no longer given keep their rows; an empty corpus stores nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiary.operators import online_lda as L
from topiary.session import frozen

BUCKETS = 16
STORED = "doc_id long, version long, topics map<int,double>, model string, bucket int"


def bucket_of(buckets: int):
    return F.pmod(F.xxhash64(F.lit("bucket"), F.col("doc_id")), F.lit(buckets)).cast("int")


def read_shares(spark: SparkSession, root: str, model_id: str | None = None) -> DataFrame:
    """The stored rows (of one model); none if nothing has been stored yet."""
    try:
        rows = spark.read.schema(STORED).parquet(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORED)
    return rows if model_id is None else rows.filter(F.col("model") == model_id)


def versions(docs: DataFrame, bow: DataFrame) -> DataFrame:
    """(doc_id, version): a digest of each document's counted terms, whatever their order."""
    bags = bow.groupBy("doc_id").agg(F.sum(F.xxhash64("term_id", "tf").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n"))
    return docs.select("doc_id").join(bags, "doc_id", "left").select("doc_id", F.xxhash64("s", "n").alias("version"))


def infer_into(root: str, docs: DataFrame, bow: DataFrame, model: L.Model, model_id: str, buckets: int = BUCKETS) -> int:
    """Bring the stored shares of ``model_id`` up to date with ``docs`` (doc_id) and
    ``bow`` (doc_id, term_id, tf). Returns the number of documents inferred."""
    spark = docs.sparkSession
    now = frozen(versions(docs, bow).withColumn("bucket", bucket_of(buckets)))
    if now.filter("doc_id is null").limit(1).count():
        raise ValueError("a document without an id cannot be stored")
    stored = read_shares(spark, root, model_id)
    changed = frozen(now.join(stored.select("doc_id", "version"), ["doc_id", "version"], "left_anti"))
    hit = [r["bucket"] for r in changed.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
    if not hit:
        return 0
    corpus = L.pack(bow.join(changed.select("doc_id"), "doc_id", "left_semi"), 1)
    fresh = L.infer_all(changed, corpus, model, ["doc_id", "version", "bucket"])
    rest = stored.filter(F.col("bucket").isin(hit)).join(changed.select("doc_id"), "doc_id", "left_anti")
    cols = ["doc_id", "version", "topics", F.lit(model_id).alias("model"), "bucket"]
    # frozen: the files that ``rest`` reads are about to be replaced
    rows = frozen(rest.select(*cols).unionByName(fresh.select(*cols)))
    (rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("model", "bucket").parquet(root))
    return changed.count()
