"""The stream that lets each document through once, over files and restarts."""
from collections import Counter

from topiary.streaming import ingest


def _run(spark, tmp_path, keep_for="30 days"):
    at = {x: str(tmp_path / x) for x in ("in", "out", "ckpt")}
    # one file a micro-batch: copies meet through the state, not within a batch
    q = ingest.start_unique_stream(spark, at["in"], at["out"], at["ckpt"], keep_for, max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    return Counter((r["doc_id"], r["journal"], " ".join(r["tokens"] or [])) for r in spark.read.parquet(at["out"]).collect())


def _deliver(spark, tmp_path, rows):
    df = spark.createDataFrame([(*r, 0) for r in rows], ingest.DOCUMENTS_SCHEMA)
    df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def test_each_document_once_over_restarts(spark, tmp_path):
    doc = lambda i, s="a": (i, f"gray whales swim {i}", "en", s)
    _deliver(spark, tmp_path, [doc(3), doc(3), doc(7)])
    _deliver(spark, tmp_path, [doc(7), doc(11), (15, "", "en", None)])
    first = _run(spark, tmp_path)
    assert Counter(k[:2] for k in first) == {(3, "a"): 1, (7, "a"): 1, (11, "a"): 1, (15, None): 1} and set(first.values()) == {1}
    assert next(k[2] for k in first if k[0] == 3).startswith("gray")
    assert _run(spark, tmp_path) == first  # nothing new
    _deliver(spark, tmp_path, [doc(3), (15, "", "en", None), doc(3, "b"), doc(19)])
    again = _run(spark, tmp_path)
    assert again - first == Counter({k: 1 for k in again if k[:2] in ((3, "b"), (19, "a"))}) and sum(again.values()) == 6


def test_old_keys_leave_the_state(spark, tmp_path):
    for i in (3, 7, 11, 3):
        _deliver(spark, tmp_path, [(i, "x", "en", "a")])
        found = _run(spark, tmp_path, keep_for="0 seconds")
    assert {k[0] for k in found} == {3, 7, 11}
    assert sum(found.values()) == 4  # the first key was forgotten: its copy passes


def test_documents_in_part_files(spark, tmp_path):
    """A table may be one file or a folder of parts."""
    from topiary.plans.q_extensions import q_stream_preprocess
    rows = [(i, f"gray whales swim {i}", "en", "a", 0) for i in range(6)]
    df = spark.createDataFrame(rows, ingest.DOCUMENTS_SCHEMA)
    df.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(r["doc_id"] for r in q_stream_preprocess(spark, str(tmp_path)).collect()) == list(range(6))
