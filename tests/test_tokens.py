from pyspark.sql import functions as F

from topiary.operators import tokens as TK


def arr(spark, col, value, schema="c string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_tokenize_whole_words_only(spark):
    out = arr(spark, TK.tokenize("c"), "Abc abc123 a Über x_y mail me@x.org http://a.b/c ok")
    assert out == ["abc", "über", "mail", "ok"]


def test_stopwords_keep_order_and_duplicates(spark):
    out = arr(spark, TK.remove_stopwords("c"), ["the", "model", "of", "model"], "c array<string>")
    assert out == ["model", "model"]


def test_lemmas(spark):
    assert arr(spark, TK.lemmatize("c"), ["data", "models", "graph"], "c array<string>") == ["datum", "model", "graph"]


def test_bigrams_edge_sizes(spark):
    for toks, exp in [([], []), (["a"], []), (["a", "b"], ["a b"]), (["a", "b", "c"], ["a b", "b c"])]:
        assert arr(spark, TK.bigrams("c"), toks, "c array<string>") == exp


def test_frequent_bigrams_per_document(spark):
    doc1 = ["a b"] * 5 + ["c d"] * 4 + ["x y"] * 3
    doc2 = ["x y"] * 3 + ["e f"] * 6
    df = spark.createDataFrame([(1, doc1), (2, doc2), (3, [])], "doc_id long, b array<string>")
    out = {r["doc_id"]: r["fb"] for r in TK.with_frequent_bigrams(df, "b", "fb", 5).collect()}
    assert out[1] == ["a b"] * 5          # c d: 4 < 5; x y: 3+3 across documents is not 6
    assert out[2] == ["e f"] * 6
    assert out[3] == []


def test_entities_rules(spark):
    text = "We met Johann Sebastian Bach and Ada Lovelace at  New York City Hall with Émile Zola Durand."
    out = arr(spark, TK.entities("c"), text)
    assert "johann sebastian bach" in out
    assert "ada lovelace" not in out                      # two words only
    assert all(all(ord(ch) < 128 for ch in e) for e in out)


def test_general_preprocess_concatenates(spark):
    text = " ".join(["neural network"] * 6) + " Alpha Beta Gamma"
    df = spark.createDataFrame([(1, text)], "doc_id long, content string")
    toks = TK.general_preprocess(df, "content").first()["tokens"]
    assert toks[:12] == ["neural", "network"] * 6
    assert toks.count("neural network") == 6 and toks[-1] == "alpha beta gamma"


def test_stopwords_per_language(spark):
    df = spark.createDataFrame([("en", ["the", "le", "modèle"]), ("fr", ["the", "le", "modèle"]), ("xx", ["the", "le"])],
                               "lang string, t array<string>")
    out = [r["r"] for r in df.select(TK.remove_stopwords("t", lang="lang").alias("r")).collect()]
    assert out == [["le", "modèle"], ["the", "modèle"], ["the", "le"]]


def test_frequent_pairs_equal_bigrams_counted(spark):
    """T4 -> T5 in one pass; counts neither cross rows nor meet NULL words."""
    rows = [(1, ["a", "b"] * 6), (2, ["b", "a", "é", "a", "é", "a"] * 3 + ["b"]), (3, []), (4, None), (5, ["a"]), (6, ["b", "a", "b"])]
    df = spark.createDataFrame(rows, "doc_id long, u array<string>")
    both = TK.with_frequent_bigrams(df.withColumn("b", TK.bigrams("u")), "b", "fb", 5).withColumn("fp", TK.frequent_pairs("u", 5))
    got = {r["doc_id"]: r for r in both.collect()}
    assert all(r["fp"] == r["fb"] for r in got.values())
    assert got[1]["fp"] == ["a b"] * 6 + ["b a"] * 5 and got[2]["fp"] == ["a é"] * 6 + ["é a"] * 6
    assert got[3]["fp"] == [] and got[4]["fp"] is None


def test_document_work_is_counted_in_batches(spark):
    """Pairs, words and stand-in topics of a document are counted on Arrow batches, not in sorted arrays per row."""
    from topiary.operators import topics as TP
    from topiary.operators import vocab as V
    d = TK.general_preprocess(spark.createDataFrame([(1, "a b", "j", "y", "t")], "doc_id long, content string, journal string, year string, title string"), "content")
    for df in (d.select("tokens"), V.token_counts(d), TP.standin_doc_topics(d), TP.word_counts(d)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "sort_array" not in plan and "md5" not in plan and ("ArrowEvalPython" in plan or "MapInArrow" in plan)


def test_large_batches_are_counted_in_pieces(monkeypatch):
    import pyarrow as pa

    from topiary.functions import batches as B
    lists = pa.array([["a", "b"] * 5, None, ["c"] * 9, [], ["a", "b"] * 2, ["b", "a", "b"]], pa.list_(pa.string()))
    batch = pa.record_batch({"doc_id": pa.array(range(6)), "t": lists})
    flat = lambda found: [r for b in found for r in b.to_pylist()]
    whole = B.frequent_pairs(lists, 4), flat(B.rows_of_counts([batch]))
    monkeypatch.setattr(B, "WORDS_AT_ONCE", 4)
    assert len(list(B.pieces([batch], 1))) > 2 and flat(B.pieces([batch], 1)) == batch.to_pylist()
    assert B.frequent_pairs(lists, 4).equals(whole[0])
    rows = lambda found: sorted(tuple(r.values()) for r in found)
    assert rows(flat(B.rows_of_counts([batch]))) == rows(whole[1])
