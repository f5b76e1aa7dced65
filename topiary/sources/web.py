"""Links and text out of stored HTML pages.

The reference crawls a site over HTTP; the network client is not rebuilt.
What it computes from each fetched page (links, link metadata, plain text) is
done here over the ``pages`` table, row by row with JVM regex functions.
"""

from __future__ import annotations

import re
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topiary.functions.arrays import explode_rows

# The crawl's link patterns, as written in the reference.
BOOK_LINK = r'<a href="(/book.*?)">'
PAPER_LINK = r'<a href="(/paper.*?)">'
PDF_LINK = r'href="(/paper/.*\.pdf)">'


def link_pattern(prefix: str = "/") -> str:
    """``<a href="(<prefix>.*?)">`` (the reference's form, any prefix)."""
    return '<a href="(' + re.escape(prefix) + '.*?)">'


def harvest_links(pages: DataFrame, prefix: str = "/", html_col: str = "html",
                  key: str = "page_id") -> DataFrame:
    """Every link matching the pattern, with its position on the page."""
    links = F.regexp_extract_all(F.col(html_col), F.lit(link_pattern(prefix)), 1)
    return explode_rows(pages, [F.col(key)], links, ["pos", "link"], with_pos=True)


def harvest_kind(pages: DataFrame, pattern: str, keep: list) -> DataFrame:
    """The links of one kind (BOOK_LINK, PAPER_LINK), with their position."""
    return explode_rows(pages, keep, F.regexp_extract_all("html", F.lit(pattern), 1), ["pos", "link"], with_pos=True)


def first_pdf_link(html) -> Column:
    """S10 (third page): the first PDF link, '' when there is none."""
    html = F.col(html) if isinstance(html, str) else html
    return F.regexp_extract(html, PDF_LINK, 1)


def site_domain(url) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    return F.regexp_extract(url, r"^(https?://[^/]+)", 1)


def link_metadata(links: DataFrame, domain_col: str = "domain", link_col: str = "link",
                  year_col: str | None = None) -> DataFrame:
    """year = last 4 chars of the link, or of the book link ``year_col``
    that led to it if there is one; absolute url = domain + link, name = last segment."""
    link = F.col(link_col)
    dated = link if year_col is None else F.coalesce(F.col(year_col), link)
    return links.withColumns({
        "year": F.right(dated, F.lit(4)),
        "abs_url": F.concat(F.col(domain_col), link),
        "name": F.element_at(F.split(link, "/"), -1),
    })


#: Named entities (HTML 4, from the standard library); a no-break space is a blank here.
NAMED = {name: " " if name == "nbsp" else chr(code) for name, code in name2codepoint.items()} | {"apos": "'"}
_ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def unescape_entities(text) -> Column:
    """Named, decimal and hexadecimal character references, each once (so
    ``&amp;lt;`` becomes ``&lt;``); anything else after an ampersand stays."""
    named = F.create_map(*[F.lit(x) for kv in sorted(NAMED.items()) for x in kv])

    def code_point(n):
        wide = F.unhex(F.lpad(F.hex(n), 8, "0"))
        return F.when((n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF), F.decode(wide, "UTF-32"))

    def piece(x):
        name = F.regexp_extract(x, _ENTITY, 1)
        number = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 8), 16, 10)) \
                  .when(name.startswith("#"), F.substring(name, 2, 8)).cast("bigint")
        char = F.when(name.startswith("#"), code_point(number)).when(name != "", F.try_element_at(named, name))
        return F.when(char.isNotNull(), F.concat(char, F.substr(x, F.length(name) + 2))).otherwise(F.concat(F.lit("&"), x))

    parts = F.split(text, "&")
    rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), piece)
    return F.when(F.instr(text, "&") > 0, F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))).otherwise(text)


def html_to_text(html) -> Column:
    """Drop script/style/comments/tags, unescape entities, squeeze spaces."""
    h = F.col(html) if isinstance(html, str) else html
    h = F.regexp_replace(h, F.lit(r"(?is)<script\b.*?</script>"), F.lit(" "))
    h = F.regexp_replace(h, F.lit(r"(?is)<style\b.*?</style>"), F.lit(" "))
    h = F.regexp_replace(h, F.lit(r"(?s)<!--.*?-->"), F.lit(" "))
    h = F.regexp_replace(h, F.lit(r"<[^>]*>"), F.lit(" "))
    return F.trim(F.regexp_replace(unescape_entities(h), F.lit(r"\s+"), F.lit(" ")))


def pages_as_documents(pages: DataFrame) -> DataFrame:
    """Pages whose text could be extracted (NULL/empty ones are skipped)."""
    return (pages.select("page_id", "url", html_to_text("html").alias("content"))
                 .filter(F.col("content").isNotNull() & (F.length("content") > 0)))
