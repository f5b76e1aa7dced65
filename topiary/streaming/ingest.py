"""Incremental preprocessing as a Structured Streaming query.

The reference re-runs its preprocessing and skips documents it has already
stored. A file-source stream does the same bookkeeping natively: the
checkpoint remembers which files were processed, each new file is cleaned
and tokenized once, and the parquet sink commits every micro-batch exactly
once. ``trigger(availableNow=True)`` processes what is there and stops, so
the same code serves scheduled batch runs and a continuously running job.
``start_preprocess_stream`` is stateless (per document).

A document may be delivered again in another file, before or after a restart.
``start_unique_stream`` keeps the keys it has let through (S13's journal, year and title) in
the stream's state: the first row of a key passes, later ones are dropped before their
text is cleaned. A delivery's time is that of its micro-batch, which only rises, so no row is
ever late for the watermark and none is lost, however old its file. A key leaves the state
``keep_for`` after its first delivery, so the state holds the keys of that time only (the
RocksDB state store keeps them off the heap), and a copy delivered later than that passes again. State and
sink commit with the same micro-batch in the checkpoint: a restart neither repeats nor forgets.

Defined cases: a NULL in the key is a value of its own (two rows with the same NULLs
are copies); of copies in one micro-batch any one passes, so rows of one key are
taken to be equal; an empty folder gives an empty sink without files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from topiary.functions.text import clean_fulltext
from topiary.operators.tokens import general_preprocess
from topiary.sources.corpus import decorated_publications

DOCUMENTS_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def document_stream(spark: SparkSession, directory: str, glob: str = "documents*.parquet",
                    max_files_per_trigger: int = 16) -> DataFrame:
    """New document files appearing in ``directory`` (schema fixed up front) whose own
    names fit ``glob``; ``directory`` may be a pattern of files and folders."""
    return (spark.readStream.schema(DOCUMENTS_SCHEMA)
            .option("pathGlobFilter", glob)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(directory))


def preprocess(docs: DataFrame) -> DataFrame:
    """publications_raw -> C8 clean-up -> T8 tokens (same code as batch)."""
    d = decorated_publications(docs)
    d = general_preprocess(d.withColumn("content", clean_fulltext("content")), "content", lang="lang")
    return d.select("doc_id", "journal", "year", "title", "tokens")


def first_deliveries(files: DataFrame, keep_for: str = "30 days") -> DataFrame:
    """Rows of ``document_stream`` whose (journal, year, title) is new, as published."""
    timed = files.withColumn("delivered", F.current_timestamp())
    return (decorated_publications(timed, keep=("delivered",)).withWatermark("delivered", keep_for)
            .dropDuplicatesWithinWatermark(["journal", "year", "title"]).drop("delivered"))


def start_unique_stream(spark: SparkSession, directory: str, out_path: str, checkpoint: str, keep_for: str = "30 days",
                        available_now: bool = True, glob: str = "*.parquet", max_files_per_trigger: int = 16) -> StreamingQuery:
    """Each document's tokens once, however often it is delivered within ``keep_for``."""
    d = first_deliveries(document_stream(spark, directory, glob, max_files_per_trigger), keep_for)
    d = general_preprocess(d.withColumn("content", clean_fulltext("content")), "content", lang="lang")
    w = (d.select("doc_id", "journal", "year", "title", "tokens").writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(out_path)


def start_preprocess_stream(spark: SparkSession, directory: str, out_path: str,
                            checkpoint: str, available_now: bool = True, glob: str = "documents*.parquet") -> StreamingQuery:
    w = (preprocess(document_stream(spark, directory, glob)).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(out_path)

