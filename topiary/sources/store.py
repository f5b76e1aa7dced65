"""Tables in storage.

The reference keeps documents in a document store and features in files.
Here every relation is a parquet (or CSV) directory under a shared location;
writes are whole-DataFrame jobs (one task per partition), never row by row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, path: str, columns: list | None = None) -> DataFrame:
    """Full scan; selecting columns prunes the parquet read."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def append_rows(df: DataFrame, path: str) -> None:
    """Append a batch (one job, not one insert per row)."""
    df.write.mode("append").parquet(path)


def overwrite_rows(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def replace_by_key(base: DataFrame, upd: DataFrame, key: str) -> DataFrame:
    """S3: replace whole rows of ``base`` whose key appears in ``upd``; keys
    only in ``upd`` are dropped (no upsert). Several updates of one key: the
    largest row, compared column by column, wins (reduced map-side). One left
    join: a single shuffle (or a broadcast of ``upd`` when AQE measures it small)."""
    cols = [c for c in base.columns if c != key]
    u = upd.groupBy(key).agg(F.max(F.struct(*[F.col(c) for c in cols])).alias("__new"))
    j = base.join(u, key, "left")
    hit = F.col("__new").isNotNull()
    return j.select(key, *[F.when(hit, F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) for c in cols])


def list_files(spark: SparkSession, directory: str, glob: str = "*.*") -> DataFrame:
    """Recursive listing of names with a dot; file bytes are not read
    because only path and length are selected."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
          .option("pathGlobFilter", glob).load(directory))
    return df.select("path", "length", "modificationTime")


def has_suffix(path_col, suffix: str):
    """S5."""
    p = F.col(path_col) if isinstance(path_col, str) else path_col
    return p.endswith(suffix)


# NULL is written as \N, an empty string as "" in quotes (the writer's default);
# a text that is exactly \N would come back as NULL.
CSV_OPTIONS = {"header": "false", "quote": '"', "escape": '"', "lineSep": "\n", "nullValue": "\\N",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


# Rows of one CSV part file: a reading task gets whole files.
CSV_PART_ROWS = 50_000


def write_csv(df: DataFrame, path: str) -> None:
    """Header-less CSV, '\\n' line ends, overwrite; quotes doubled."""
    df.write.mode("overwrite").option("maxRecordsPerFile", CSV_PART_ROWS).options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Header-less CSV with an explicit schema and unlimited field size.
    multiLine keeps quoted line breaks inside a field. Spark cannot split such a
    file, so write_csv bounds the rows of a part (``CSV_PART_ROWS``)."""
    return (spark.read.schema(schema).options(**CSV_OPTIONS)
            .option("maxCharsPerColumn", "-1").option("multiLine", "true").csv(path))


def write_bow(vocab: DataFrame, bow: DataFrame, folder: str) -> None:
    """Vocabulary and sparse corpus as parquet (coordinate triples)."""
    vocab.write.mode("overwrite").parquet(f"{folder}/vocab")
    bow.write.mode("overwrite").parquet(f"{folder}/bow")


def read_bow(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """A missing folder raises AnalysisException (the reference exits)."""
    return spark.read.parquet(f"{folder}/vocab"), spark.read.parquet(f"{folder}/bow")


BOW_BUCKETS = 64


def write_bow_buckets(vocab: DataFrame, bow: DataFrame, folder: str, buckets: int = BOW_BUCKETS) -> None:
    """S8 laid out for joins on the term: both tables hashed on ``term_id`` into the same
    number of buckets, one sorted file each, so that joining them back moves no row. Size ``buckets``
    for the corpus: a bucket is read by one task, and a term's rows (one per document
    that holds it at most) are in one bucket."""
    name = "topiary_bow_" + uuid.uuid4().hex[:12]
    for part, df in (("vocab", vocab), ("bow", bow)):
        df.repartition(buckets, "term_id").write.mode("overwrite").bucketBy(buckets, "term_id").sortBy("term_id") \
          .option("path", f"{folder}/{part}").saveAsTable(f"{name}_{part}")
        df.sparkSession.sql(f"DROP TABLE {name}_{part}")  # the entry; the files of a table with a path stay
    layout = [(part, buckets, df.schema.toDDL()) for part, df in (("vocab", vocab), ("bow", bow))]
    bow.sparkSession.createDataFrame(layout, "part string, buckets int, columns string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/layout")


def read_bow_buckets(spark: SparkSession, folder: str, name: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(vocab, bow) as bucketed tables, in any session; they are entered in the
    catalog as <name>_vocab and <name>_bow (made up if not given). A missing folder raises AnalysisException."""
    layout = {r["part"]: r for r in spark.read.parquet(f"{folder}/layout").collect()}
    name, out = name or "topiary_bow_" + uuid.uuid4().hex[:12], []
    for part in ("vocab", "bow"):
        where = f"{folder}/{part}".replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name}_{part} ({layout[part]['columns']}) USING parquet CLUSTERED BY (term_id) "
                  f"SORTED BY (term_id) INTO {layout[part]['buckets']} BUCKETS LOCATION '{where}'")
        out.append(spark.table(f"{name}_{part}"))
    return out[0], out[1]
