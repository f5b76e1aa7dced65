"""Arrow batches to the Python tasks: bounded in bytes, and no result depends on where they end."""

import pyarrow as pa
import pytest
from conftest import SMALL

from topiary.llm import decontaminate, minhash, toxicity
from topiary.llm.common import read
from topiary.session import BATCH_BYTES

CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def unset(spark):
    spark.conf.unset(CONF)
    yield
    spark.conf.unset(CONF)


def largest(docs):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    return docs.mapInArrow(sizes, "n long").agg({"n": "max"}).first()[0]


@pytest.mark.parametrize("call", [
    lambda spark, docs: toxicity.score(docs, toxicity.Model([], [], None, 0.0)),
    lambda spark, docs: toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int")),
    lambda spark, docs: minhash.near_groups(docs),
    lambda spark, docs: decontaminate.find(docs, spark.createDataFrame([("b", "no such words")], "item_id string, text string")),
], ids=["score", "fit", "near_groups", "decontaminate"])
def test_batches_of_long_texts_are_bounded(spark, unset, call):
    docs = spark.range(0, 300, 1, 1).selectExpr("id AS doc_id", "repeat(concat(id, ' '), 20000) AS text")
    assert largest(docs) > 4 * BATCH_BYTES
    call(spark, docs.limit(20))
    assert largest(docs) < 1.2 * BATCH_BYTES


def test_a_size_set_by_the_caller_stays(spark, unset):
    spark.conf.set(CONF, str(1 << 16))
    toxicity.score(spark.createDataFrame([("a",)], "text string"), toxicity.Model([], [], None, 0.0))
    assert int(spark.conf.get(CONF).rstrip("b")) == 1 << 16


def test_stages_give_the_same_rows_in_small_batches(spark, unset):
    import corpus_pipeline
    docs = read(spark, SMALL, "documents")
    found = []
    for size in (64 << 20, 1 << 14):
        spark.conf.set(CONF, str(size))
        found.append([sorted(stage(spark, docs, SMALL).collect()) for _, stage in corpus_pipeline.STAGES[:3]])
    assert found[0] == found[1]
    assert all(0 < len(rows) <= docs.count() for rows in found[0])
