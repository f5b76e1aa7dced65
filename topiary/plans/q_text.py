"""Queries for C1-C13 (text scalars) and S10-S12 (pages)."""

from __future__ import annotations

from pyspark.sql import functions as F

from topiary.functions import text as T
from topiary.functions.arrays import explode_rows
from topiary.plans import sql as S
from topiary.plans.catalog import register
from topiary.sources import web
from topiary.sources.corpus import decorated_pages, decorated_publications, pdf_paths, publications_raw, read_table


def _docs(spark, sf):
    return read_table(spark, sf, "documents")


def _digest(col, name="content"):
    """(md5, length) of a text column: compact, exact, engine-neutral."""
    return [F.md5(col).alias(f"{name}_md5"), F.length(col).alias(f"{name}_len")]


def _sql_digest(expr, name="content"):
    return f"md5({expr}) AS {name}_md5, length({expr}) AS {name}_len"


# --- C1 path_metadata ---------------------------------------------------------

@register("path_metadata", f"""WITH {S.PATHS}
SELECT doc_id, path, split_part(path, '/', 3) AS journal, split_part(path, '/', 4) AS year,
       trim(substr(replace(split_part(path, '/', 5), '-', ' '), 5,
                   greatest(length(split_part(path, '/', 5)) - 8, 0))) AS title
FROM paths""")
def q_path_metadata(spark, sf):
    p = pdf_paths(_docs(spark, sf))
    return p.select("doc_id", "path", T.path_journal("path").alias("journal"),
                    T.path_year("path").alias("year"), T.path_title("path").alias("title"))


# --- S5 filter_suffix -----------------------------------------------------------

@register("filter_suffix", f"""WITH {S.PATHS},
listing AS (SELECT doc_id, path FROM paths UNION ALL SELECT doc_id, left(path, length(path) - 4) || '.txt' FROM paths)
SELECT doc_id, path FROM listing WHERE right(path, 4) = '.pdf'""")
def q_filter_suffix(spark, sf):
    p = pdf_paths(_docs(spark, sf))
    listing = p.unionByName(p.select("doc_id", F.concat(F.expr("left(path, length(path) - 4)"), F.lit(".txt")).alias("path")))
    return listing.filter(F.col("path").endswith(".pdf"))


# --- C2..C8 over decorated content ---------------------------------------------

_DEC = f"WITH {S.PUBS}, {S.DECORATED}"

_STEPS = {
    "unify_dashes": (T.unify_dashes, S.unify_dashes),
    "dehyphenate": (lambda c: T.dehyphenate(T.unify_dashes(c)), lambda c: S.dehyphenate(S.unify_dashes(c))),
    "unwrap_lines": (T.unwrap_lines, S.unwrap_lines),
    "expand_ligatures": (T.expand_ligatures, S.expand_ligatures),
    "cut_references": (T.cut_references, lambda c: S.cut_before_last(c, "References")),
    "cut_acknowledgment": (T.cut_acknowledgment, lambda c: S.cut_before_last(c, "Acknowledgment")),
    "clean_fulltext": (T.clean_fulltext, S.clean_fulltext),
}


def _make_step(name, spark_fn, sql_fn):
    @register(name, f"{_DEC} SELECT doc_id, {_sql_digest(sql_fn('content'))} FROM decorated")
    def q(spark, sf):
        d = decorated_publications(_docs(spark, sf))
        return d.select("doc_id", *_digest(spark_fn(F.col("content"))))
    q.__name__ = f"q_{name}"
    return q


for _n, (_sf, _qf) in _STEPS.items():
    _make_step(_n, _sf, _qf)


# --- C9 normalize_case, C10 cast_year -------------------------------------------

@register("normalize_case", f"""WITH {S.PUBS}
SELECT doc_id, {_sql_digest('lower(content)', 'lower')}, upper(title) AS title_upper,
       upper(left(journal, 1)) || lower(substr(journal, 2)) AS journal_title
FROM pubs""")
def q_normalize_case(spark, sf):
    p = publications_raw(_docs(spark, sf))
    return p.select("doc_id", *_digest(T.normalize_case("content", "lower"), "lower"),
                    T.normalize_case("title", "upper").alias("title_upper"),
                    T.normalize_case("journal", "title").alias("journal_title"))


@register("cast_year", f"WITH {S.PUBS} SELECT doc_id, year, CAST(year AS INTEGER) AS year_int FROM pubs")
def q_cast_year(spark, sf):
    p = publications_raw(_docs(spark, sf))
    return p.select("doc_id", "year", T.cast_year("year").alias("year_int"))


# --- S10-S12 over pages ---------------------------------------------------------------

@register("harvest_links", """
SELECT page_id, pos, link FROM (
  SELECT page_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS link
  FROM (SELECT page_id, regexp_extract_all(html, '<a href="(/.*?)">', 1) AS l FROM pages))""")
def q_harvest_links(spark, sf):
    return web.harvest_links(read_table(spark, sf, "pages"), "/")


@register("harvest_kinds", f"""
WITH {S.PAGES}, k AS (
  SELECT page_id, 'book' AS kind, regexp_extract_all(html, '<a href="(/book.*?)">', 1) AS l FROM dpages
  UNION ALL SELECT page_id, 'paper', regexp_extract_all(html, '<a href="(/paper.*?)">', 1) FROM dpages
  UNION ALL SELECT page_id, 'pdf', list_filter([regexp_extract(html, 'href="(/paper/.*\\.pdf)">', 1)], lambda x: x <> '') FROM dpages
  UNION ALL SELECT page_id, 'other', list_filter(regexp_extract_all(html, '<a href="(/.*?)">', 1),
                                                 lambda x: NOT starts_with(x, '/book') AND NOT starts_with(x, '/paper')) FROM dpages)
SELECT page_id, kind, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS link FROM k""")
def q_harvest_kinds(spark, sf):
    """S10, its three patterns (book links, paper links, the first PDF link) and all other links."""
    pages = decorated_pages(read_table(spark, sf, "pages"))
    kind = lambda name, pattern: web.harvest_kind(pages, pattern, ["page_id"]).withColumn("kind", F.lit(name))
    pdf = pages.select("page_id", F.lit(0).alias("pos"), web.first_pdf_link("html").alias("link"), F.lit("pdf").alias("kind"))
    every = F.regexp_extract_all("html", F.lit(web.link_pattern("/")), 1)
    rest = F.filter(every, lambda x: ~x.startswith("/book") & ~x.startswith("/paper"))
    other = explode_rows(pages, ["page_id"], rest, ["pos", "link"], with_pos=True).withColumn("kind", F.lit("other"))
    return kind("book", web.BOOK_LINK).unionByName(kind("paper", web.PAPER_LINK)).unionByName(pdf.filter("link <> ''")).unionByName(other)


@register("link_metadata", f"""
WITH {S.PAGES}, links AS (
  SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) AS domain,
         regexp_extract(html, 'href="(/paper/.*\\.pdf)">', 1) AS pdf_link,
         regexp_extract(html, '<a href="(/book.*?)">', 1) AS book_link,
         unnest(regexp_extract_all(html, '<a href="(/.*?)">', 1)) AS link
  FROM dpages), dated AS (SELECT *, right(coalesce(nullif(book_link, ''), link), 4) AS year FROM links)
SELECT page_id, link, year, try_cast(year AS INTEGER) AS year_int, domain || link AS abs_url,
       string_split(link, '/')[-1] AS name, pdf_link
FROM dated""")
def q_link_metadata(spark, sf):
    """S11 for every link of a page; the year is that of the page's book link if it has one."""
    pages = decorated_pages(read_table(spark, sf, "pages"))
    links = web.harvest_kind(pages, web.link_pattern("/"), [
        "page_id", web.site_domain("url").alias("domain"), web.first_pdf_link("html").alias("pdf_link"),
        F.nullif(F.regexp_extract("html", web.BOOK_LINK, 1), F.lit("")).alias("book_link")])
    out = web.link_metadata(links, year_col="book_link")
    return out.select("page_id", "link", "year", F.col("year").try_cast("int").alias("year_int"), "abs_url", "name", "pdf_link")


_HTML_SQL = r"""trim(regexp_replace(
  replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
      '(?is)<script\b.*?</script>', ' ', 'g'), '(?is)<style\b.*?</style>', ' ', 'g'),
      '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&copy;', chr(169)),
    '&middot;', chr(183)), '&eacute;', chr(233)), '&#233;', chr(233)), '&#x20AC;', chr(8364)), '&#128512;', chr(128512)),
    '&amp;', '&'),
  '\s+', ' ', 'g'))"""


@register("html_to_text", f"""WITH {S.PAGES}
SELECT page_id, md5(t) AS content_md5, length(t) AS content_len
FROM (SELECT page_id, {_HTML_SQL} AS t FROM dpages) WHERE t IS NOT NULL AND length(t) > 0""")
def q_html_to_text(spark, sf):
    d = web.pages_as_documents(decorated_pages(read_table(spark, sf, "pages")))
    return d.select("page_id", *_digest(F.col("content")))
