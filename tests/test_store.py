import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from topiary.operators import incremental as INC
from topiary.operators import tokens as TK
from topiary.sources import store as ST
from topiary.sources import web


def test_csv_keeps_null_and_empty_apart(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, 'a "b", c\nd'), (4, " x ")]
    path = str(tmp_path / "c")
    ST.write_csv(spark.createDataFrame(rows, "a int, b string"), path)
    assert sorted(map(tuple, ST.read_csv(spark, path, "a int, b string").collect())) == rows


def test_replace_by_key_with_repeated_updates(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    upd = spark.createDataFrame([(1, "x"), (1, "y"), (9, "z")], "k int, v string")
    assert sorted(map(tuple, ST.replace_by_key(base, upd, "k").collect())) == [(1, "y"), (2, "b"), (3, "c")]


def test_bow_buckets_are_joined_without_an_exchange(spark, tmp_path):
    from topiary.plans.q_store import _per_term
    vocab = spark.createDataFrame([(i, f"w{i}", 5) for i in range(50)], "term_id long, token string, df long")
    bow = spark.createDataFrame([(d, t, d % 3 + 1) for d in range(40) for t in range(d, 50)] + [(99, 7, None)], "doc_id long, term_id long, tf long")
    folder = str(tmp_path / "it's here")
    ST.write_bow_buckets(vocab, bow, folder, 4)
    v, b = ST.read_bow_buckets(spark, folder)
    assert sorted(map(tuple, b.collect()), key=str) == sorted(map(tuple, bow.collect()), key=str)
    out = _per_term(v, b)
    rows = sorted(map(tuple, out.collect()))
    assert rows == sorted(map(tuple, _per_term(vocab, bow).collect())) and len(rows) == 50
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    files = [f for f in os.listdir(f"{folder}/bow") if f.endswith(".parquet")]
    assert len(files) == 4
    ST.write_bow_buckets(vocab.limit(0), bow.limit(0), str(tmp_path / "none"), 4)
    assert _per_term(*ST.read_bow_buckets(spark, str(tmp_path / "none"))).count() == 0
    with pytest.raises(AnalysisException):
        ST.read_bow_buckets(spark, str(tmp_path / "missing"))


def test_list_files_is_the_walk(spark, tmp_path):
    for name in ("a.txt", "x/b.csv", "x/y/c.d.e", "x/nodot"):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text("1")
    want = sorted(os.path.join(d, f) for d, _, fs in os.walk(tmp_path) for f in fs if "." in f)
    assert sorted(r["path"].removeprefix("file:") for r in ST.list_files(spark, str(tmp_path)).collect()) == want


def test_skip_reduces_the_done_set_first(spark):
    todo = spark.createDataFrame([(i, "j") for i in range(5)], "year int, journal string")
    done = spark.createDataFrame([(1, "j")] * 50 + [(3, "j")], "year int, journal string")
    left = INC.skip_done(todo, done, ["year", "journal"])
    assert sorted(r["year"] for r in left.collect()) == [0, 2, 4]
    assert "Aggregate" in left._jdf.queryExecution().optimizedPlan().toString()


def test_entities_of_a_very_long_run(spark):
    name = "Alpha Beta " * 10_000 + "Gamma"
    got = spark.createDataFrame([(name,), ("One Two",), ("A1 Big Red Dog x",)], "t string").select(TK.entities("t").alias("e")).collect()
    assert got[0]["e"] == [name.lower()] and got[1]["e"] == [] and got[2]["e"] == ["big red dog"]


def test_lemma_table_and_surface_stop_words(spark):
    lemmas = spark.createDataFrame([("cats", "cat"), ("cats", "zz"), ("ran", "run")], "word string, lemma string")
    df = spark.createDataFrame([("THE cats ran The dogs",)], "content string")
    one = lambda **k: TK.general_preprocess(df, lemmas=lemmas, **k).first()["tokens"]
    assert one() == ["cat", "run", "dogs"]
    assert one(case_sensitive=True) == ["the", "cat", "run", "dogs"]  # THE is neither "the" nor "The"


def test_stop_words_by_language(spark):
    df = spark.createDataFrame([("the und des y dog", x) for x in ("en", "de", "fr", "es", "xx", None)], "content string, lang string")
    got = [r["t"] for r in df.select(TK.remove_stopwords(TK.tokenize("content"), lang="lang").alias("t")).collect()]
    assert got == [["und", "des", "dog"], ["the", "dog"], ["the", "und", "dog"], ["the", "und", "des", "dog"]] + [["the", "und", "des", "dog"]] * 2


def test_character_references(spark):
    import html
    cases = ["a &amp; b", "&amp;lt;", "&eacute;&#233;&#xE9;", "&#128512;", "&nope; & AT&T &", "&copy", "x&quot;&apos;y", "no"]
    got = spark.createDataFrame([(c,) for c in cases], "t string").select(web.unescape_entities(F.col("t")).alias("u")).collect()
    want = [html.unescape(c) for c in cases]
    want[5] = "&copy"  # only references that end with a semicolon
    assert [r["u"] for r in got] == want


def test_checkpoint_dir_is_required_on_a_cluster():
    from topiary import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Fake:
        class sparkContext:
            master = "spark://host:7077"

            class _jsc:
                @staticmethod
                def sc():
                    class S:
                        @staticmethod
                        def getCheckpointDir():
                            class D:
                                @staticmethod
                                def isDefined():
                                    return False
                            return D
                    return S

            @staticmethod
            def getConf():
                return Conf()
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Fake)
