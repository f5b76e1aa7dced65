"""DuckDB SQL building blocks for the oracle queries.

They restate, in plain SQL over the driver's tables, the same bindings and
per-document rules the Spark operators use; constants come from the same
Python values so that both sides can never drift apart.
"""

from __future__ import annotations

from topiary.functions.lexicon import LEMMAS, TOPIC_LABELS, stop_words
from topiary.functions.text import DASHES, LIGATURES
from topiary.sources.corpus import DECOR_ACK, DECOR_HEAD, DECOR_LEAD, DECOR_REFS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def quoted(s: str) -> str:
    return '"' + s.replace('"', '""') + '"'


def str_list(words) -> str:
    return "[" + ", ".join(lit(w) for w in words) + "]"


def in_list(words) -> str:
    return "(" + ", ".join(lit(w) for w in words) + ")"


STOP_EN = in_list(stop_words("english"))

LEMMA_CASE = "CASE x " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in sorted(LEMMAS.items())) + " ELSE x END"

LABEL_CASE = ("CASE {t} " + " ".join(f"WHEN {k} THEN {lit(v)}" for k, v in TOPIC_LABELS.items())
              + " END")


def label_of(expr: str) -> str:
    return LABEL_CASE.replace("{t}", expr)


YEAR = "CAST(2000 + doc_id % 10 AS VARCHAR)"

PUBS = f"""pubs AS (
  SELECT doc_id, source AS journal, {YEAR} AS year, 'doc-' || CAST(doc_id AS VARCHAR) AS title,
         text AS content, lang
  FROM documents)"""

PATHS = f"""paths AS (
  SELECT doc_id, 'files/pdf/' || source || '/' || {YEAR} || '/' || lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0')
         || '-some-title-' || CAST(doc_id AS VARCHAR) || '.pdf' AS path
  FROM documents)"""

PAGES = f"""dpages AS (
  SELECT page_id, url,
         CASE WHEN page_id % 4 < 3 THEN '<a href="/book/proceedings-' || (1990 + page_id % 30) || '">book</a>' || chr(10) ELSE '' END
      || CASE WHEN page_id % 4 < 2 THEN '<a href="/paper/' || page_id || '-some-title">paper</a>' || chr(10)
                                     || '<a href="/paper/x-' || page_id || '">other</a>' || chr(10) ELSE '' END
      || CASE WHEN page_id % 4 IN (0, 2) THEN '<a href="/paper/' || page_id || '-some-title.pdf">pdf</a>' || chr(10) ELSE '' END
      || '<p>&eacute;&#233;&#x20AC;&#128512; &amp;copy; &unknown; AT&T &#0;</p>' || chr(10) || html AS html
  FROM pages)"""

DECORATED = f"""decorated AS (
  SELECT doc_id, journal, year, title, lang,
         CASE doc_id % 4
           WHEN 0 THEN {lit(DECOR_HEAD)} || content || {lit(DECOR_ACK)} || {lit(DECOR_REFS)}
           WHEN 1 THEN {lit(DECOR_LEAD)} || content
           WHEN 2 THEN content || {lit(DECOR_REFS)}
           ELSE content END AS content
  FROM pubs)"""


def unify_dashes(c: str) -> str:
    return f"translate({c}, {lit(DASHES)}, {lit('-' * len(DASHES))})"


def dehyphenate(c: str) -> str:
    return f"replace({c}, '-' || chr(10), '')"


def unwrap_lines(c: str) -> str:
    return f"replace({c}, chr(10), ' ')"


def expand_ligatures(c: str) -> str:
    out = c
    for lig, repl in LIGATURES:
        out = f"replace({out}, {lit(lig)}, {lit(repl)})"
    return out


def cut_before_last(c: str, marker: str) -> str:
    return f"regexp_replace({c}, '(?s)\\A(.+){marker}.*\\z', '\\1')"


def clean_fulltext(c: str) -> str:
    out = expand_ligatures(unwrap_lines(dehyphenate(unify_dashes(c))))
    return cut_before_last(cut_before_last(out, "References"), "Acknowledgment")


CLEANED = f"""cleaned AS (
  SELECT doc_id, journal, year, title, lang, {clean_fulltext('content')} AS content FROM decorated)"""

URL_OR_EMAIL = r"(?:https?://|www\.)\S+|\S+@\S+"
WORD = r"[\p{L}\p{N}_]+"
ENTITY = r"\p{Lu}\p{L}+(?: \p{Lu}\p{L}+){2,}"


def tokenize(c: str) -> str:
    return (f"list_filter(regexp_extract_all(regexp_replace(lower({c}), {lit(URL_OR_EMAIL)}, ' ', 'g'), "
            f"{lit(WORD)}), lambda w: regexp_full_match(w, '\\p{{L}}{{2,}}'))")


def remove_stopwords(t: str, stop: str = STOP_EN) -> str:
    return f"list_filter({t}, lambda x: x NOT IN {stop})"


#: The languages of the test tables.
LANGUAGES = ("en", "fr", "de", "es")


def remove_stopwords_by_lang(t: str, lang: str = "lang") -> str:
    """The stop list of the row's language."""
    return (f"CASE {lang} " + " ".join(f"WHEN '{c}' THEN {remove_stopwords(t, in_list(stop_words(c)))}" for c in LANGUAGES)
            + f" ELSE {t} END")


def lemmatize(t: str) -> str:
    return f"list_transform({t}, lambda x: {LEMMA_CASE})"


def unigrams(c: str, lang: str | None = None) -> str:
    t = tokenize(c)
    return lemmatize(remove_stopwords(t) if lang is None else remove_stopwords_by_lang(t, lang))


def bigrams(u: str) -> str:
    return f"list_transform(range(1, len({u})), lambda i: {u}[i] || ' ' || {u}[i + 1])"


def entities(c: str) -> str:
    return (f"list_filter(list_transform(regexp_extract_all({c}, {lit(ENTITY)}), lambda x: trim(lower(x))), "
            f"lambda x: length(x) = strlen(x) AND NOT regexp_matches(x, '[0-9]'))")


def frequent_bigrams_cte(src: str, bg_col: str, name: str, min_count: int = 5) -> str:
    """Per document pairs seen >= min_count times, repeated, most frequent first."""
    return f"""{name}_c AS (
  SELECT doc_id, bg, count(*) AS cnt
  FROM (SELECT doc_id, unnest({bg_col}) AS bg FROM {src})
  GROUP BY doc_id, bg HAVING count(*) >= {min_count}),
{name} AS (
  SELECT s.doc_id, coalesce(f.fb, []::VARCHAR[]) AS fb
  FROM {src} s LEFT JOIN (
    SELECT doc_id, flatten(list(list_transform(range(cnt), lambda i: bg) ORDER BY cnt DESC, bg)) AS fb
    FROM {name}_c GROUP BY doc_id) f USING (doc_id))"""


def tokens_ctes(src: str = "cleaned", min_count: int = 5) -> str:
    """T8 over ``src``(doc_id, content, lang): CTE ``toks``(doc_id, tokens)."""
    return f"""uni AS (
  SELECT doc_id, content, {unigrams('content', 'lang')} AS u FROM {src}),
bgs AS (SELECT doc_id, {bigrams('u')} AS b FROM uni),
{frequent_bigrams_cte('bgs', 'b', 'fbg', min_count)},
toks AS (
  SELECT uni.doc_id, list_concat(list_concat(uni.u, fbg.fb), {entities('uni.content')}) AS tokens
  FROM uni JOIN fbg USING (doc_id))"""


def md5_list(t: str) -> str:
    return f"md5(array_to_string({t}, '|'))"


# Topic of a word under the deterministic stand-in model (FIXTURES.md).
def word_topic(w: str, k: str | int = 10, salt: str | None = None) -> str:
    src = w if salt is None else f"({salt} || {w})"
    return f"(('0x' || substr(md5({src}), 1, 8))::BIGINT % {k})"


# Texts for the topic views and coherence: the full T8 tokens of the cleaned corpus.
TEXTS = f"""{PUBS}, {DECORATED}, {CLEANED}, {tokens_ctes('cleaned')},
texts AS (SELECT p.doc_id, p.journal, p.year, p.title, t.tokens FROM pubs p JOIN toks t USING (doc_id))"""
