"""Phrase lists (T6) and lemma tables (T3) of any size."""
import pytest
from pyspark.sql import functions as F

from topiary.operators import phrases as PH
from topiary.operators import tokens as TK

PHRASES = ["new york", "New York City", "york city council", "a b a", "b a", "single", "", None, "new york", "café au lait", "x y1 z", "a b a b a"]
TEXTS = ["I love New York City council and new york", "aa bb aa", "", None, "a", "single new", "café au lait Café AU lait au", "the york city council of new york",
         "new york city council new york new york city", "nothing here at all", "new", "be ab be ab be"]


def brute(text, phrases, tokenize):
    words = tokenize(text)
    if words is None:
        return []
    known, out, at = {tuple(p) for p in phrases}, [], 0
    while at < len(words):
        n = max((len(p) for p in known if tuple(words[at:at + len(p)]) == p), default=0)
        if n:
            out.append(" ".join(words[at:at + n]))
        at += n or 1
    return out


@pytest.fixture(scope="module")
def cut(spark):
    def run(texts):
        return [r["t"] for r in spark.createDataFrame([(t,) for t in texts], "text string").select(TK.tokenize("text").alias("t")).collect()]
    return run


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_longest_phrase_from_left_to_right(spark, cut, broadcast):
    """Also with a list that is never broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        table = PH.phrase_table(spark.createDataFrame([(p,) for p in PHRASES], "phrase string"))
        docs = spark.createDataFrame([(i, t, "h", 5, ["x"]) for i, t in enumerate(TEXTS)], "doc_id long, text string, h string, n int, words array<string>") \
                    .withColumn("tokens", TK.tokenize("text"))
        found = PH.phrase_matches(docs, table)
        if broadcast == "-1":
            assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
        got = {r["doc_id"]: r["phrases"] for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    listed = [p for p in cut([p for p in PHRASES if p is not None]) if len(p) >= 2]
    want = {i: brute(t, listed, lambda x: None if x is None else cut([x])[0]) for i, t in enumerate(TEXTS)}
    assert got == {i: p for i, p in want.items() if p} and len(got) >= 4


def test_no_phrases_no_documents(spark):
    table = PH.phrase_table(spark.createDataFrame([("single",)], "phrase string"))
    docs = spark.createDataFrame([(1, ["a", "b"])], "doc_id long, tokens array<string>")
    assert PH.phrase_matches(docs, table).count() == 0
    table = PH.phrase_table(spark.createDataFrame([("aa bb",)], "phrase string"))
    assert PH.phrase_matches(docs.limit(0), table).count() == 0


def test_a_lemma_table_of_300_000_words(spark):
    table = spark.range(300_000).select(F.concat(F.lit("w"), "id").alias("word"), F.concat(F.lit("l"), F.col("id") % 7).alias("lemma"))
    table = table.unionByName(spark.createDataFrame([("w5", "a"), ("w5", None), (None, "x")], "word string, lemma string"))
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("x").alias("word"), F.array(
        F.lit("w5"), F.concat(F.lit("w"), F.col("id") * 100), F.lit("zz"), F.lit("w5")).alias("tokens"))
    docs = docs.unionByName(spark.createDataFrame([(-1, "x", None), (-2, "x", []), (-3, "x", ["w6", None])], "doc_id long, word string, tokens array<string>"))
    got = {r["doc_id"]: r["tokens"] for r in PH.lemmatize_by_table(docs, table, chunk_docs=100).collect()}
    assert len(got) == 3003 and got[-1] is None and got[-2] == [] and got[-3] == ["l6", None]
    assert all(got[i] == ["a", f"l{i * 100 % 7}", "zz", "a"] for i in range(1, 3000))


def test_a_hot_word_meets_the_table_once_per_chunk(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.array(F.lit("hot"), F.lit("hot")).alias("tokens"))
    seen = []
    with pytest.MonkeyPatch.context() as patch:
        explode = PH.explode_rows
        patch.setattr(PH, "explode_rows", lambda *a, **k: seen.append(explode(*a, **k)) or seen[-1])
        out = PH.lemmatize_by_table(docs, spark.createDataFrame([("hot", "warm")], "word string, lemma string"), chunk_docs=250)
    assert seen[0].distinct().count() == 4 and out.filter("tokens = array('warm', 'warm')").count() == 1000
