from pyspark.sql import functions as F

from topiary.operators import vocab as V


def test_prune_bounds_and_ids(spark):
    rows = [(i, ["a"] * (1 if i < 4 else 0) + ["b"] * (1 if i < 5 else 0) + ["c"] * (1 if i < 9 else 0)
             + ["d"] * (1 if i < 10 else 0) + ["u"]) for i in range(10)]
    rows.append((10, None))
    rows.append((11, []))
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    vocab = V.build_vocab(docs, no_below=5, no_above=0.9).collect()
    # N = 12 documents, int(0.9 * 12) = 10: a (df 4) dropped, b (5) kept, d and u (10) kept
    got = {r["token"]: (r["term_id"], r["df"]) for r in vocab}
    assert set(got) == {"b", "c", "d", "u"}
    assert sorted(got.values()) == [(0, 10), (1, 10), (2, 9), (3, 5)]


def test_doc2bow_drops_unknown(spark):
    docs = spark.createDataFrame([(1, ["x", "x", "y"]), (2, ["zz"])], "doc_id long, tokens array<string>")
    vocab = spark.createDataFrame([(0, "x", 1, 2)], "term_id int, token string, df long, cf long")
    bow = V.doc2bow(docs, vocab).collect()
    assert [(r["doc_id"], r["term_id"], r["tf"]) for r in bow] == [(1, 0, 2)]


def test_keep_n_binds(spark):
    rows = [(i, [f"t{j}" for j in range(40) if i % (j + 1) == 0 or j < 3]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    every = [(r["token"], r["df"]) for r in V.build_vocab(docs, no_below=1, no_above=1.0).orderBy("term_id").collect()]
    assert every == sorted(every, key=lambda x: (-x[1], x[0]))
    for n in (1, 2, 5):  # ties on df at the cut are settled by the token
        got = [(r["token"], r["df"]) for r in V.build_vocab(docs, no_below=1, no_above=1.0, keep_n=n).orderBy("term_id").collect()]
        assert got == every[:n]


def test_vocabulary_is_not_capped(spark):
    n = 150_000
    df = spark.range(n).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("token"), F.lit(7).cast("long").alias("df"))
    out = V.assign_ids(V.prune_vocab(df, 100)).agg(F.count_distinct("term_id").alias("n"), F.max("term_id").alias("m")).first()
    assert (out["n"], out["m"]) == (n, n - 1)


def test_bow_vectors_refuse_a_larger_vocabulary(spark, monkeypatch):
    import pytest
    monkeypatch.setattr(V, "DRIVER_MAX_TERMS", 1)
    docs = spark.createDataFrame([(1, ["x", "y"])], "doc_id long, tokens array<string>")
    with pytest.raises(ValueError, match="2 terms"):
        V.bow_vectors(docs, V.build_vocab(docs, no_below=1, no_above=1.0))


def test_doc2bow_without_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame([(1, ["x", "x", "y"]), (2, ["y"])], "doc_id long, tokens array<string>")
    vocab = V.build_vocab(docs, no_below=1, no_above=1.0)
    want = sorted(map(tuple, V.doc2bow(docs, vocab).collect()))
    monkeypatch.setattr(V, "BROADCAST_MAX_TERMS", 0)
    monkeypatch.setattr(V.broadcast_if_small, "__defaults__", (0,))
    assert sorted(map(tuple, V.doc2bow(docs, vocab).collect())) == want


def test_dense_index_without_cap(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("df"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("token"))
    out = V.assign_ids(df).collect()
    assert sorted(r["term_id"] for r in out) == list(range(1000))
    assert all(r["term_id"] == 999 - r["df"] for r in out)


def test_large_vocabulary_is_hashed_not_sorted(spark, monkeypatch):
    """Beyond the broadcast limit the rows of documents and terms are moved, but no task sorts them."""
    docs = spark.createDataFrame([(1, ["x", "x", "y"]), (2, ["y"])], "doc_id long, tokens array<string>")
    vocab = V.build_vocab(docs, no_below=1, no_above=1.0)
    monkeypatch.setattr(V.broadcast_if_small, "__defaults__", (0,))
    plan = V.doc2bow(docs, vocab)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_bow_vectors_of_a_larger_vocabulary(spark, monkeypatch):
    """The query raised beyond DRIVER_MAX_TERMS; with counts the vocabulary is joined, broadcast or not."""
    from pyspark.ml.linalg import SparseVector
    from topiary.plans import q_vocab as Q
    docs = spark.createDataFrame([(1, ["x", "x", "y"]), (2, ["y"]), (3, ["zz"]), (4, []), (5, None)], "doc_id long, tokens array<string>")
    vocab = V.build_vocab(docs.filter("doc_id < 3"), no_below=1, no_above=1.0)  # y 0, x 1
    want = {1: SparseVector(2, [0, 1], [1.0, 2.0]), 2: SparseVector(2, [0], [1.0]), **{d: SparseVector(2, [], []) for d in (3, 4, 5)}}
    monkeypatch.setattr(V, "DRIVER_MAX_TERMS", 1)
    for limit in (V.BROADCAST_MAX_TERMS, 0):
        monkeypatch.setattr(V, "BROADCAST_MAX_TERMS", limit)
        monkeypatch.setattr(V.broadcast_if_small, "__defaults__", (limit,))
        got = V.bow_vectors(docs.select("doc_id"), vocab, counts=V.token_counts(docs))
        assert {r["doc_id"]: r["features"] for r in got.collect()} == want
    sf = "/root/testdata/sf0.001"
    assert sorted(map(tuple, Q.q_bow_vectors(spark, sf).collect())) == sorted(map(tuple, Q.q_doc2bow(spark, sf).collect()))
