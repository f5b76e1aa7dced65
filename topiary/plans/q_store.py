"""Queries for S1-S9 and S13-S17 (storage round trips and skip logic).

Written tables go below the cluster's checkpoint directory (work_dir)."""

from __future__ import annotations

from pyspark.sql import functions as F

from topiary.functions import text as T
from topiary.functions.arrays import explode_rows
from topiary.operators import incremental as INC
from topiary.operators import tokens as TK
from topiary.operators import vocab as V
from topiary.plans import sql as S
from topiary.plans.catalog import register
from topiary.plans.q_vocab import TOKS, VOCAB_CTES, corpus_tokens
from topiary.session import stored, work_dir
from topiary.sources import manifest as MF
from topiary.sources import store as ST
from topiary.sources import web
from topiary.sources.corpus import pdf_paths, publications_raw, read_table


def _pubs(spark, sf):
    return publications_raw(read_table(spark, sf, "documents"))


@register("scan_collection", f"WITH {S.PUBS} SELECT doc_id, journal, year, title, content FROM pubs")
def q_scan_collection(spark, sf):
    return _pubs(spark, sf).select("doc_id", "journal", "year", "title", "content")


@register("append_docs", f"WITH {S.PUBS} SELECT doc_id, journal, year, title FROM pubs")
def q_append_docs(spark, sf):
    """Two batches appended to one table, read back whole."""
    p = _pubs(spark, sf).select("doc_id", "journal", "year", "title")
    path = work_dir(spark, "publications_raw")
    ST.append_rows(p.filter(F.col("doc_id") % 2 == 0), path)
    ST.append_rows(p.filter(F.col("doc_id") % 2 == 1), path)
    return ST.scan(spark, path)


_UPD_SQL = f"""WITH {S.PUBS},
upd AS (
  SELECT doc_id, journal, year, title, 'updated ' || title AS content FROM pubs WHERE doc_id % 3 = 0
  UNION ALL
  SELECT doc_id + 1000000000, journal, year, title, 'phantom' FROM pubs WHERE doc_id % 7 = 0)
SELECT p.doc_id, p.journal, p.year, p.title, md5(coalesce(u.content, p.content)) AS content_md5
FROM pubs p LEFT JOIN upd u USING (doc_id)"""


def _base_and_updates(spark, sf):
    base = _pubs(spark, sf).select("doc_id", "journal", "year", "title", "content")
    upd = (base.filter(F.col("doc_id") % 3 == 0).withColumn("content", F.concat(F.lit("updated "), F.col("title")))
           .unionByName(base.filter(F.col("doc_id") % 7 == 0)
                        .withColumn("doc_id", F.col("doc_id") + 1000000000)
                        .withColumn("content", F.lit("phantom"))))
    return base, upd


@register("replace_by_key", _UPD_SQL)
def q_replace_by_key(spark, sf):
    base, upd = _base_and_updates(spark, sf)
    out = ST.replace_by_key(base, upd, "doc_id")
    return out.select("doc_id", "journal", "year", "title", F.md5("content").alias("content_md5"))


@register("replace_in_files", _UPD_SQL)
def q_replace_in_files(spark, sf):
    """S3 on a stored table, file by file: the updates of a third of the documents, in two batches."""
    base, upd = _base_and_updates(spark, sf)
    root = work_dir(spark, "publications")
    MF.create(base.repartitionByRange(8, "doc_id"), root)
    for i in (0, 1):
        MF.replace(root, upd.filter(F.col("doc_id") % 2 == i), "doc_id")
    out = MF.read(spark, root)
    return out.select("doc_id", "journal", "year", "title", F.md5("content").alias("content_md5"))


@register("list_files", "SELECT DISTINCT source AS journal FROM documents WHERE source IS NOT NULL")
def q_list_files(spark, sf):
    """The documents stored in a folder per journal; the journals found by listing the files."""
    path = work_dir(spark, "journal_tree")
    _pubs(spark, sf).select("doc_id", "journal").write.partitionBy("journal").parquet(path)
    found = ST.list_files(spark, path, "*.parquet")
    return found.select(F.regexp_extract("path", "/journal=([^/]+)/", 1).alias("journal")) \
                .filter(~F.col("journal").isin("", "__HIVE_DEFAULT_PARTITION__")).distinct()


@register("write_csv", f"WITH {S.PUBS} SELECT doc_id, journal, year, title FROM pubs")
def q_write_csv(spark, sf):
    p = _pubs(spark, sf).select("doc_id", "journal", "year", "title")
    path = work_dir(spark, "titles_csv")
    ST.write_csv(p, path)
    return ST.read_csv(spark, path, "doc_id bigint, journal string, year string, title string")


@register("read_csv", f"WITH {S.PUBS} SELECT doc_id, md5(content) AS content_md5, length(content) AS content_len FROM pubs")
def q_read_csv(spark, sf):
    """Full texts (quotes, line breaks, 30k+ characters) survive a CSV round trip."""
    p = _pubs(spark, sf).select("doc_id", "content")
    path = work_dir(spark, "content_csv")
    ST.write_csv(p, path)
    back = ST.read_csv(spark, path, "doc_id bigint, content string")
    return back.select("doc_id", F.md5("content").alias("content_md5"), F.length("content").alias("content_len"))


@register("write_bow", f"""{TOKS}, {VOCAB_CTES}
SELECT doc_id, token, n AS tf FROM tc JOIN vocab USING (token)""")
def q_write_bow(spark, sf):
    counts = stored(V.token_counts(corpus_tokens(spark, sf)), "counts")
    folder = work_dir(spark, "lda_files")
    vocab = V.build_vocab(read_table(spark, sf, "documents"), counts=counts)  # frozen term ids: built once
    ST.write_bow(vocab, V.doc2bow(None, vocab, counts=counts), folder)
    v, b = ST.read_bow(spark, folder)
    return b.join(V.broadcast_if_small(v.select("term_id", "token")), "term_id").select("doc_id", "token", "tf")


@register("write_bow_buckets", f"""{TOKS}, {VOCAB_CTES}
SELECT token, count(*) AS n_docs, sum(n) AS n, max(n) AS most FROM tc JOIN vocab USING (token) GROUP BY token""")
def q_write_bow_buckets(spark, sf):
    """S8 read back by term: joined and counted where the buckets lie, without an exchange."""
    counts = stored(V.token_counts(corpus_tokens(spark, sf)), "counts")
    folder = work_dir(spark, "lda_buckets")
    vocab = V.build_vocab(read_table(spark, sf, "documents"), counts=counts)
    ST.write_bow_buckets(vocab, V.doc2bow(None, vocab, counts=counts), folder)
    return _per_term(*ST.read_bow_buckets(spark, folder))


def _per_term(vocab, bow):
    per = bow.join(vocab.select("term_id", "token").hint("merge"), "term_id").groupBy("term_id", "token").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("tf").alias("n"), F.max("tf").alias("most"))
    return per.select("token", "n_docs", "n", "most")


# --- skip logic ----------------------------------------------------------------------

@register("skip_processed_docs", f"""WITH {S.PATHS}, {S.PUBS},
files AS (
  SELECT path, split_part(path, '/', 3) AS journal, split_part(path, '/', 4) AS year,
         trim(substr(replace(split_part(path, '/', 5), '-', ' '), 5,
                     greatest(length(split_part(path, '/', 5)) - 8, 0))) AS title
  FROM paths),
stored AS (
  SELECT journal, year, 'some title ' || CAST(doc_id AS VARCHAR) AS title FROM pubs WHERE doc_id % 3 = 0)
SELECT path, journal, year, title FROM files f
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.journal = f.journal AND s.year = f.year AND s.title = f.title)""")
def q_skip_processed_docs(spark, sf):
    docs = read_table(spark, sf, "documents")
    p = pdf_paths(docs)
    files = p.select("path", T.path_journal("path").alias("journal"), T.path_year("path").alias("year"),
                     T.path_title("path").alias("title"))
    stored = (publications_raw(docs).filter(F.col("doc_id") % 3 == 0)
              .select("journal", "year", F.concat(F.lit("some title "), F.col("doc_id").cast("string")).alias("title")))
    return INC.skip_processed_docs(files, stored)


@register("skip_tokenized", f"""WITH {S.PUBS}, {S.tokens_ctes('pubs')}
SELECT doc_id, len(tk) AS n_tokens, {S.md5_list('tk')} AS tokens_md5
FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN ['processed'] ELSE tokens END AS tk FROM toks)""")
def q_skip_tokenized(spark, sf):
    """Rows already tokenized keep their tokens; the rest are tokenized. The two
    sets are disjoint, so their union is the new table: no join, no shuffle."""
    p = _pubs(spark, sf).select("doc_id", "content", "lang")
    base = p.withColumn("tokens", F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("processed"))))
    todo = INC.skip_tokenized(base)
    done = TK.general_preprocess(todo.drop("tokens"), "content", lang="lang")
    finished = base.filter(F.col("tokens").isNotNull())
    out = finished.select("doc_id", "tokens").unionByName(done.select("doc_id", "tokens"))
    return out.select("doc_id", F.size("tokens").alias("n_tokens"),
                      F.md5(F.array_join("tokens", "|")).alias("tokens_md5"))


@register("skip_downloaded", """
WITH links AS (
  SELECT page_id, unnest(regexp_extract_all(html, '<a href="(/.*?)">', 1)) AS link FROM pages),
meta AS (
  SELECT page_id, link, 'site' AS journal, right(link, 4) AS year, string_split(link, '/')[-1] AS name FROM links),
known AS (SELECT journal, year, name FROM meta WHERE page_id % 2 = 0)
SELECT page_id, link, year, name FROM meta m
WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.journal = m.journal AND k.year = m.year AND k.name = m.name)""")
def q_skip_downloaded(spark, sf):
    pages = read_table(spark, sf, "pages")
    links = web.harvest_links(pages, "/").withColumn("domain", F.lit(""))
    meta = web.link_metadata(links).withColumn("journal", F.lit("site"))
    known = meta.filter(F.col("page_id") % 2 == 0)
    return INC.skip_downloaded(meta, known).select("page_id", "link", "year", "name")
