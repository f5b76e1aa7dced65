from pyspark.sql import functions as F

from topiary.functions import text as T


def one(spark, col, value):
    return spark.createDataFrame([(value,)], "c string").select(col.alias("r")).first()["r"]


def test_cut_references_rules(spark):
    cut = T.cut_references(F.col("c"))
    assert one(spark, cut, "References at start") == "References at start"          # position 0: kept
    assert one(spark, cut, "body References a References b") == "body References a "  # last occurrence
    assert one(spark, cut, "no marker") == "no marker"
    assert one(spark, cut, "xReferences") == "x"


def test_acknowledgment_variants(spark):
    cut = T.cut_acknowledgment(F.col("c"))
    assert one(spark, cut, "text Acknowledgments thanks") == "text "
    assert one(spark, cut, "text Acknowledgement thanks") == "text Acknowledgement thanks"


def test_clean_fulltext_order(spark):
    raw = "eﬃcient ﬂow—\nover co-\noperate – − soft­\nware body\nReferences\n[1] x"
    assert one(spark, T.clean_fulltext(F.col("c")), raw) == "efficient flowover cooperate - - software body "


def test_path_metadata(spark):
    p = "files/pdf/NIPS/2015/123-some-title-4123.pdf"
    assert one(spark, T.path_journal(F.col("c")), p) == "NIPS"
    assert one(spark, T.path_year(F.col("c")), p) == "2015"
    assert one(spark, T.path_title(F.col("c")), p) == "some title 4123"
    assert one(spark, T.path_title(F.col("c")), "files/pdf/j/2000/ab.pdf") == ""


def test_format_prob_and_labels(spark):
    df = spark.createDataFrame([(0.042, 3), (0.0625, 9)], "p double, t int")
    r = df.select(T.format_prob("p").alias("f"), T.topic_label("t").alias("l"),
                  T.topic_label("t", labels_available=False).alias("u")).collect()
    assert r[0]["f"] == ".042" and r[0]["l"] == "NLP" and r[0]["u"] == "Topic 3"
    assert r[1]["l"] == "Neural Network Structure"


def test_row_label_pct(spark):
    df = spark.createDataFrame([("Inference", 12.3456), ("NLP", 10.0)], "l string, v double")
    assert [r[0] for r in df.select(T.row_label_pct("l", "v")).collect()] == ["Inference (12.35%)", "NLP (10.0%)"]


def test_topic_table_csv_lines(spark):
    from topiary.operators import tables as TB
    terms = spark.createDataFrame([(1, 1, "state", 0.026), (1, 2, "policy", 0.0175)],
                                  "topic_id int, rank int, word string, p double")
    t = TB.topic_table(terms, labels_available=True, numbered=True)
    lines = [r["line"] for r in TB.table_lines(t).orderBy("topic_id", "section", "rank").collect()]
    assert lines == ['"(2) STATE, POLICY, ACTION"', "word,prob.", "STATE,.026", "POLICY,.018", '""']
