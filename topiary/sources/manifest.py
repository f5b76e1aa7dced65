"""S3 on a stored table: copy-on-write by file.

The data files of a table and its list of current files (the manifest, one version
per change) lie side by side. A replacement finds the files that hold a hit key by
the scan's own ``_metadata.file_path`` (only the key column is read), rewrites the
rows of those files beside the old ones and writes the next manifest, which is the
change: readers open what the latest complete manifest names. Files without a hit
keep their name and time; a run that dies before its manifest leaves files that
nobody reads. Old files stay for readers under way; removing them is the owner's to
decide. One writer at a time: a second one that started from the same version finds
its manifest's folder taken and fails.

The driver holds the file names, as Spark itself does for any scan.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiary.sources.store import replace_by_key
from topiary.session import frozen

FILES = "file string, v int"


def current(spark: SparkSession, root: str) -> tuple[int, list[str]]:
    """(version, files) of the latest complete manifest; (0, []) before the first."""
    try:
        rows = spark.read.schema(FILES).parquet(os.path.join(root, "manifest"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, []
    version = rows.agg(F.max("v")).first()[0] or 0
    return version, sorted(r["file"] for r in rows.filter(F.col("v") == version).select("file").collect())


def _commit(spark: SparkSession, root: str, version: int, files: list[str]) -> None:
    spark.createDataFrame([(f,) for f in files], "file string").coalesce(1) \
         .write.mode("error").parquet(os.path.join(root, "manifest", f"v={version}"))


def _written(df: DataFrame, root: str) -> list[str]:
    """The files of ``df`` as written below a folder of its own."""
    path = os.path.join(root, "data", uuid.uuid4().hex)
    df.write.parquet(path)
    back = df.sparkSession.read.parquet(path)
    return [r["f"] for r in back.select(F.col("_metadata.file_path").alias("f")).distinct().collect()]


def create(df: DataFrame, root: str) -> None:
    """The table's first version, or a new one that holds just ``df``."""
    spark = df.sparkSession
    _commit(spark, root, current(spark, root)[0] + 1, _written(df, root))


def read(spark: SparkSession, root: str) -> DataFrame:
    version, files = current(spark, root)
    if not files:
        raise FileNotFoundError(f"no rows in version {version} of {root}")
    return spark.read.parquet(*files)


def replace(root: str, upd: DataFrame, key: str) -> int:
    """Replace whole rows by key as ``store.replace_by_key`` does; the number of
    files rewritten. Updates without a row are dropped; without any hit there is no new version."""
    spark = upd.sparkSession
    version, files = current(spark, root)
    if not files:
        return 0
    upd = frozen(upd)
    base = spark.read.parquet(*files)
    at = base.select(key, F.col("_metadata.file_path").alias("__file"))
    hit = [r["__file"] for r in at.join(upd.select(key).distinct(), key, "left_semi").select("__file").distinct().collect()]
    if not hit:
        return 0
    new = _written(replace_by_key(spark.read.parquet(*hit), upd.select(*base.columns), key), root)
    _commit(spark, root, version + 1, [f for f in files if _plain(f) not in {_plain(h) for h in hit}] + new)
    return len(hit)


def _plain(path: str) -> str:
    """One spelling of file:/x, file:///x and /x."""
    return re.sub(r"^file:/+", "/", path)
