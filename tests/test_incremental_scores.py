"""Stored shares (M4) and window counts (E4): what a second run reads and writes."""
import os

import pytest
from pyspark.sql import functions as F

from topiary.operators import coherence as CO
from topiary.operators import coherence_store as CS
from topiary.operators import doc_topics as DT
from topiary.operators import online_lda as L
from topiary.operators import tables as TB


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


@pytest.fixture(scope="module")
def model(spark):
    vocab = spark.range(12).select(F.col("id").cast("int").alias("term_id"), F.concat(F.lit("w"), "id").alias("token"))
    return L.start(vocab, 3, 5, "symmetric", "symmetric", 4)


def bow_of(spark, docs):
    return spark.createDataFrame([(d, t, n) for d, words in docs.items() for t, n in words], "doc_id long, term_id int, tf long")


def test_one_changed_document_rewrites_one_bucket(spark, model, tmp_path):
    root = str(tmp_path / "shares")
    docs = {d: [(d % 12, 1 + d % 3), ((d + 5) % 12, 2)] for d in range(60)}
    ids = spark.range(62).select(F.col("id").alias("doc_id"))  # 60 and 61 have no word
    assert DT.infer_into(root, ids, bow_of(spark, docs), model, "m") == 62
    first, before = DT.read_shares(spark, root).collect(), files(root)
    assert sorted(r["doc_id"] for r in first) == list(range(62))
    assert DT.infer_into(root, ids, bow_of(spark, docs).repartition(3, "term_id"), model, "m") == 0 and files(root) == before
    docs[7] = [(3, 9)]
    assert DT.infer_into(root, ids, bow_of(spark, docs), model, "m") == 1
    after = files(root)
    gone = {os.path.dirname(f) for f in before if f not in after}
    assert len(gone) == 1 and all(after[f] == t for f, t in before.items() if os.path.dirname(f) not in gone)
    second = {r["doc_id"]: r for r in DT.read_shares(spark, root).collect()}
    assert len(second) == 62
    for r in first:
        assert (second[r["doc_id"]]["topics"] == r["topics"]) == (r["doc_id"] != 7)
    assert DT.infer_into(root, ids.limit(5), bow_of(spark, docs), model, "other") == 5  # another model has buckets of its own
    assert DT.read_shares(spark, root, "m").count() == 62 and DT.read_shares(spark, root).count() == 67
    assert second[61]["topics"] == {0: 1 / 3, 1: 1 / 3, 2: 1 / 3}


def test_awkward_ids(spark, model, tmp_path):
    root = str(tmp_path / "shares")
    none = spark.createDataFrame([], "doc_id long")
    assert DT.infer_into(root, none, bow_of(spark, {}), model, "m") == 0 and DT.read_shares(spark, root).count() == 0
    with pytest.raises(ValueError, match="without an id"):
        DT.infer_into(root, spark.createDataFrame([(None,)], "doc_id long"), bow_of(spark, {1: [(1, 1)]}), model, "m")


def texts_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, tokens array<string>")


def test_batches_add_up_and_are_read_once(spark, tmp_path):
    root = str(tmp_path / "counts")
    rows = [(d, [f"w{(d * k + k) % 9}" for k in range(3, 3 + d % 17)]) for d in range(60)] + [(99, [])]
    top = spark.createDataFrame([(m, t, f"w{(t * 3 + i + m) % 9}") for m in (1, 2) for t in (0, 1) for i in range(3)],
                                "model_id long, topic_id int, word string")
    whole, unread = texts_of(spark, rows), texts_of(spark, rows).withColumn("tokens", F.raise_error(F.lit("a text was read")).cast("array<string>"))
    halves = {"a": whole.filter("doc_id % 2 = 0"), "b": whole.filter("doc_id % 2 = 1")}
    assert CS.add_batch(root, "a", halves["a"], top.filter("model_id = 1"), window=5) == 1
    assert CS.add_batch(root, "a", halves["a"], top, window=5) == 1
    assert CS.add_batch(root, "b", halves["b"], top, window=5) == 2
    for batch in "ab":
        assert CS.add_batch(root, batch, unread, top, window=5) == 0
    with pytest.raises(Exception, match="a text was read"):
        CS.add_batch(root, "c", unread, top, window=5)
    occ, co, nwin = CO.window_counts(whole, top, 5)
    got = CS.merged(spark, root)
    sort = lambda df, cols: sorted(map(tuple, df.select(*cols).collect()))
    assert sort(got["co"], ["model_id", "topic_id", "w1", "w2", "co"]) == sort(co, ["model_id", "topic_id", "w1", "w2", "co"])
    assert sort(got["nwin"], ["model_id", "num_windows"]) == sort(nwin, ["model_id", "num_windows"])
    assert set(sort(got["occ"], ["word", "occ"])) == set(sort(occ, ["word", "occ"]))
    want = {r["model_id"]: r["coherence"] for r in CO.coherence_cv(whole, top, 5).collect()}
    scores = {r["model_id"]: r["coherence"] for r in CS.model_scores(spark, root, top).collect()}
    assert scores.keys() == want.keys() and all(abs(scores[m] - want[m]) < 1e-12 for m in want)


def test_files_of_a_run_that_died_are_not_counted(spark, tmp_path):
    root = str(tmp_path / "counts")
    top = spark.createDataFrame([(1, 0, "x"), (1, 0, "y")], "model_id long, topic_id int, word string")
    CS.add_batch(root, "a", texts_of(spark, [(1, ["x", "y", "z"])]), top, window=2)
    orphan = os.path.join(root, "occ", "batch=a", "part=died")
    spark.createDataFrame([(1, "x", 1000)], CS.TABLES["occ"]).write.parquet(orphan)
    assert {r["word"]: r["occ"] for r in CS.merged(spark, root)["occ"].collect()} == {"x": 1, "y": 2}


def test_the_mean_of_two_scores_is_rounded_once(spark):
    """Rounded to six places first, 0.5763794 and 0.5872764 would average to a half of the last place."""
    scores = spark.createDataFrame([(16, "auto", s, 5, 200, v) for s, v in ((42, 0.5763794), (99, 0.5872764))],
                                   "k int, dir_prior string, random_state int, num_pass int, iteration int, coherence_score double")
    r = TB.seed_stability(scores).select(F.round("mean_score", 6), F.round("std_score", 6), "n_seeds").first()
    assert tuple(r) == (0.581828, 0.007705, 2)


def test_two_models_are_scored_on_tokens_made_once(spark, monkeypatch):
    """They were made for the counts and again for the windows."""
    from topiary.plans import q_online_lda as Q
    made, real = [], Q.corpus_tokens
    monkeypatch.setattr(Q, "corpus_tokens", lambda *a: made.append(1) or real(*a))
    assert Q.q_coherence_by_batches(spark, "/root/testdata/sf0.001").count() == 2 * Q.K and made == [1]
