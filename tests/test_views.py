from pyspark.sql import functions as F

from topiary.operators import views as VW


def dt(spark, rows):
    return spark.createDataFrame(
        [(i, "j", "2001", f"t{i}", {k: v for k, v in enumerate(r)}) for i, r in enumerate(rows)],
        "doc_id long, journal string, year string, title string, topics map<int,double>")


def test_dominant_ties_lowest_id(spark):
    d = VW.dominant(dt(spark, [[0.4, 0.4, 0.2], [0.1, 0.2, 0.7]])).orderBy("doc_id").collect()
    assert [r["topic_id"] for r in d] == [0, 2]


def test_cooccurrence_absent_column_and_diag(spark):
    c = VW.topic_cooccurrence(dt(spark, [[0.6, 0.3, 0.1], [0.5, 0.2, 0.3]]))
    m = VW.cooccurrence_matrix(c).collect()
    assert {r["dominant_id"] for r in m} == {0}            # topics 1, 2 never dominant: no column
    diag = [r for r in m if r["topic_id"] == 0][0]
    assert diag["value"] == 0.0 and abs(diag["row_max"] - 55.0) < 1e-9
    assert diag["row_label"] == "Convergence (55.0%)"


def test_means_by_year(spark):
    v = VW.topics_by_year(dt(spark, [[1.0, 0.0], [0.0, 1.0]])).orderBy("topic_id").collect()
    assert [(r["year"], r["mean_share"]) for r in v] == [(2001, 0.5), (2001, 0.5)]


def test_top_words_of_hashed_models(spark):
    """The best of each task, whatever the partitions and batches, are the best of all; models of one salt share its hashes."""
    from topiary.functions.batches import word_hash
    from topiary.operators import topics as TP
    rows = [(f"w{i}é", 1 + i * 7 % 5) for i in range(300)]
    models = [(7, 3, "a/"), (8, 4, "a/"), (9, 2, None)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        got = TP.standin_topic_terms_grid(spark.createDataFrame(rows, "word string, cf long").repartition(5), models, 4).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = set()
    for m, k, salt in models:
        for t in range(k):
            own = sorted((-cf, w) for w, cf in rows if word_hash(w, salt or "") % k == t)
            want |= {(m, t, i + 1, w, -n / -sum(c for c, _ in own)) for i, (n, w) in enumerate(own[:4])}
    assert {(r["model_id"], r["topic_id"], r["rank"], r["word"], r["p"]) for r in got} == want
