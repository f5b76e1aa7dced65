"""Picking texts by id: the filter, and results that do not depend on how sharp it is."""
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from topiary.llm import bloom, minhash, suffix_dedup
from topiary.llm.common import frozen, read


def test_every_id_is_known_and_few_others(spark):
    ids = frozen(spark.range(0, 60_000, 3).select((F.col("id") * 7919 - 50_000).alias("rep")).unionByName(spark.sql("SELECT cast(null as long) AS rep")))
    known = bloom.bloom_of(ids).value
    own = np.arange(0, 60_000, 3) * 7919 - 50_000
    assert known.knows(pa.array(own)).all()
    others = np.arange(10_000_000_000, 10_000_100_000)
    assert known.knows(pa.array(others)).mean() < 0.01
    assert known.knows(pa.array([None, int(own[0]), -(1 << 63)], pa.int64())).tolist()[:2] == [False, True]
    assert not bloom.bloom_of(frozen(ids.limit(0))).value.knows(pa.array(own)).any()


def test_known_rows_keep_all_columns(spark):
    df = spark.createDataFrame([(i, f"t{i}", None) for i in range(100)], "doc_id long, text string, x int")
    kept = bloom.known_rows(df, "doc_id", bloom.bloom_of(frozen(spark.range(5))))
    assert kept.schema == df.schema and {0, 1, 2, 3, 4} <= {r["doc_id"] for r in kept.collect()} and kept.count() < 20


@pytest.mark.parametrize("bits", [1 << 16, 1 << 28])
def test_size_is_bounded(monkeypatch, bits):
    monkeypatch.setattr(bloom, "MAX_BITS", bits)
    assert [bloom.bits_for(n) for n in (0, 10, 10 ** 12)] == [1 << 16, 1 << 16, bits]


def test_results_do_not_depend_on_the_filter(spark, monkeypatch):
    """As with a filter so full that it knows every id."""
    docs = read(spark, SMALL, "documents").select("doc_id", "text")
    run = lambda: (sorted(map(tuple, minhash.near_groups(docs, 4).collect()), key=str),
                   sorted(map(tuple, suffix_dedup.suffix_dedup(docs).collect()), key=str))
    sharp = run()

    def full(ids):
        return ids.sparkSession.sparkContext.broadcast(bloom.Bloom(np.full(1 << 10, np.iinfo(np.uint64).max)))

    for module in (minhash, suffix_dedup):
        monkeypatch.setattr(module, "bloom_of", full)
    assert run() == sharp
