import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from topiary.session import get_session
    return get_session("local[4]", 8, extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})


@pytest.fixture(scope="session")
def small_docs():
    """[(doc_id, text)] of the smallest table."""
    import duckdb
    return duckdb.connect().execute(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet' ORDER BY doc_id").fetchall()


#: Nulls, empty texts, repeated rows, clashing extra columns.
AWKWARD = [(1, None, None, None, 7), (2, "", "en", "s", 7), (3, "  \n", "en", "s", 7), (4, "one two three four five six", "en", "s", 7),
           (4, "one two three four five six", "en", "s", 7), (None, "one two three four five six", "en", None, 7),
           (5, "ONE two Three four five six", None, "s", 7), (6, "é ü 😀 \u0000 x" * 3, "fr", "t", 7), (None, None, None, None, None)]
SCHEMA = "doc_id long, text string, lang string, source string, n_words long"


@pytest.fixture(scope="session")
def awkward(spark):
    df = spark.createDataFrame([*AWKWARD, (7, "word " * 60_000, "en", "s", 1)], SCHEMA)
    return df.selectExpr("*", "'x' AS kept", "0 AS shard", "1.0 AS score", "'y' AS d", "1L AS id", "2L AS n")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
