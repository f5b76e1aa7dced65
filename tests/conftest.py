import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from topiary.session import get_session
    s = get_session("local[4]", 8, extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from topiary.sources.corpus import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con
