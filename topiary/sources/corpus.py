"""Reading the given tables and binding them to the reference's relations.

The reference stores articles as (journal, year, title, content) rows and PDF
files under files/pdf/<journal>/<year>/<name>.pdf. The driver's ``documents``
table is bound to those shapes here (see FIXTURES.md); the bindings are plain
column expressions, so Catalyst prunes every column a query does not use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


SCAN_PARTITIONS_CONF = "topiary.scan.partitions"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """S1 scan: one parquet table; projection and filters reach the scan.

    Parquet splits at row-group boundaries, so a file written as one large
    row group is read by one task however many cores there are, and every
    per-document stage after it (clean-up, tokens, hashing) runs serially.
    When the session sets ``topiary.scan.partitions`` the rows are spread
    round-robin over that many partitions right after the scan. Unset by
    default: inputs with normal row groups already scan in parallel, and a
    blanket repartition would shuffle the whole corpus for nothing.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    n = spark.conf.get(SCAN_PARTITIONS_CONF, None)
    if n:
        df = df.repartition(int(n))
    return df


def year_of(doc_id) -> F.Column:
    return (F.lit(2000) + doc_id % 10).cast("string")


def publications_raw(docs: DataFrame, keep: tuple = ()) -> DataFrame:
    """documents -> publications_raw(doc_id, journal, year, title, content, lang), and the columns ``keep``."""
    d = F.col("doc_id")
    return docs.select(
        d.alias("doc_id"),
        F.col("source").alias("journal"),
        year_of(d).alias("year"),
        F.concat(F.lit("doc-"), d.cast("string")).alias("title"),
        F.col("text").alias("content"),
        F.col("lang"),
        *keep,
    )


def pdf_paths(docs: DataFrame) -> DataFrame:
    """documents -> (doc_id, path) laid out like the reference's PDF tree."""
    d = F.col("doc_id")
    path = F.concat(
        F.lit("files/pdf/"), F.col("source"), F.lit("/"), year_of(d), F.lit("/"),
        F.lpad((d % 1000).cast("string"), 3, "0"), F.lit("-some-title-"), d.cast("string"),
        F.lit(".pdf"))
    return docs.select(d.alias("doc_id"), path.alias("path"))


# Decorations that exercise the clean-up operators (FIXTURES.md), by doc_id % 4.
DECOR_HEAD = "eﬃcient ﬂow—\nover co-\noperate – − soft­\nware "
DECOR_ACK = "\nAcknowledgments\nthanks References old\n"
DECOR_REFS = "\nReferences\n[1] x"
DECOR_LEAD = "References "


def decorated_text(doc_id, text) -> F.Column:
    case = doc_id % 4
    return (F.when(case == 0, F.concat(F.lit(DECOR_HEAD), text, F.lit(DECOR_ACK), F.lit(DECOR_REFS)))
             .when(case == 1, F.concat(F.lit(DECOR_LEAD), text))
             .when(case == 2, F.concat(text, F.lit(DECOR_REFS)))
             .otherwise(text))


PAGE_REFS = "<p>&eacute;&#233;&#x20AC;&#128512; &amp;copy; &unknown; AT&T &#0;</p>\n"


def decorated_pages(pages: DataFrame) -> DataFrame:
    """pages with what a proceedings site has: three of four hold a book link
    with a year, some paper links and PDF links, all hold character references."""
    d = F.col("page_id")
    book = F.concat(F.lit('<a href="/book/proceedings-'), (F.lit(1990) + d % 30).cast("string"), F.lit('">book</a>\n'))
    paper = F.concat(F.lit('<a href="/paper/'), d.cast("string"), F.lit('-some-title">paper</a>\n<a href="/paper/x-'),
                     d.cast("string"), F.lit('">other</a>\n'))
    pdf = F.concat(F.lit('<a href="/paper/'), d.cast("string"), F.lit('-some-title.pdf">pdf</a>\n'))
    head = F.when(d % 4 == 0, F.concat(book, paper, pdf)).when(d % 4 == 1, F.concat(book, paper)) \
            .when(d % 4 == 2, F.concat(book, pdf)).otherwise(F.lit(""))
    return pages.select("page_id", "url", F.concat(head, F.lit(PAGE_REFS), F.col("html")).alias("html"))


def decorated_publications(docs: DataFrame, keep: tuple = ()) -> DataFrame:
    """publications_raw with decorated raw content (input to C2-C8)."""
    pubs = publications_raw(docs, keep)
    return pubs.withColumn("content", decorated_text(F.col("doc_id"), F.col("content")))
