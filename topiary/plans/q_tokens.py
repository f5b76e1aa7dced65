"""Queries for T1-T8. Token arrays are reported as (count, md5 of the
'|'-joined list), which pins order and multiplicity exactly."""

from __future__ import annotations

from pyspark.sql import functions as F

from topiary.functions.text import clean_fulltext
from topiary.operators import phrases as PH
from topiary.operators import tokens as TK
from topiary.plans import sql as S
from topiary.plans.catalog import register
from topiary.sources.corpus import decorated_publications, publications_raw, read_table


def _digest(col, name="tokens"):
    return [F.size(col).alias(f"n_{name}"), F.md5(F.array_join(col, "|")).alias(f"{name}_md5")]


def _sql_digest(expr, name="tokens"):
    return f"len({expr}) AS n_{name}, {S.md5_list(expr)} AS {name}_md5"


def _pubs(spark, sf):
    return publications_raw(read_table(spark, sf, "documents"))


_P = f"WITH {S.PUBS}"


@register("tokenize", f"{_P} SELECT doc_id, {_sql_digest(S.tokenize('content'))} FROM pubs")
def q_tokenize(spark, sf):
    return _pubs(spark, sf).select("doc_id", *_digest(TK.tokenize("content")))


@register("remove_stopwords",
          f"{_P} SELECT doc_id, {_sql_digest(S.remove_stopwords_by_lang(S.tokenize('content')))} FROM pubs")
def q_remove_stopwords(spark, sf):
    return _pubs(spark, sf).select("doc_id", *_digest(TK.remove_stopwords(TK.tokenize("content"), lang="lang")))


@register("lemmatize", f"{_P} SELECT doc_id, {_sql_digest(S.unigrams('content', 'lang'))} FROM pubs")
def q_lemmatize(spark, sf):
    return _pubs(spark, sf).select("doc_id", *_digest(TK.unigrams("content", lang="lang")))


@register("bigrams", f"""{_P}, uni AS (SELECT doc_id, {S.unigrams('content', 'lang')} AS u FROM pubs)
SELECT doc_id, {_sql_digest(S.bigrams('u'), 'bigrams')} FROM uni""")
def q_bigrams(spark, sf):
    d = _pubs(spark, sf).withColumn("u", TK.unigrams("content", lang="lang"))
    return d.select("doc_id", *_digest(TK.bigrams("u"), "bigrams"))


@register("frequent_bigrams", f"""{_P}, uni AS (SELECT doc_id, {S.unigrams('content', 'lang')} AS u FROM pubs),
bgs AS (SELECT doc_id, {S.bigrams('u')} AS b FROM uni),
{S.frequent_bigrams_cte('bgs', 'b', 'fbg', 5)}
SELECT doc_id, {_sql_digest('fb', 'bigrams')} FROM fbg""")
def q_frequent_bigrams(spark, sf):
    d = _pubs(spark, sf).withColumn("u", TK.unigrams("content", lang="lang")).withColumn("b", TK.bigrams("u"))
    d = TK.with_frequent_bigrams(d, "b", "fb", 5)
    return d.select("doc_id", *_digest(F.col("fb"), "bigrams"))


@register("entities", f"""{_P}, ent AS (SELECT doc_id, {S.entities('content')} AS e FROM pubs)
SELECT doc_id, {_sql_digest('e', 'entities')} FROM ent""")
def q_entities(spark, sf):
    return _pubs(spark, sf).select("doc_id", *_digest(TK.entities("content"), "entities"))


@register("assemble_tokens", f"""{_P}, {S.tokens_ctes('pubs')}
SELECT doc_id, {_sql_digest('tokens')} FROM toks""")
def q_assemble_tokens(spark, sf):
    d = TK.general_preprocess(_pubs(spark, sf), "content", lang="lang")
    return d.select("doc_id", *_digest(F.col("tokens")))


@register("general_preprocess", f"""WITH {S.PUBS}, {S.DECORATED}, {S.CLEANED}, {S.tokens_ctes('cleaned')}
SELECT doc_id, {_sql_digest('tokens')} FROM toks""")
def q_general_preprocess(spark, sf):
    d = decorated_publications(read_table(spark, sf, "documents"))
    d = TK.general_preprocess(d.withColumn("content", clean_fulltext("content")), "content", lang="lang")
    return d.select("doc_id", *_digest(F.col("tokens")))


# --- lists of any size -----------------------------------------------------------------

#: Three phrases of an item: its first three and first four words (a shared beginning) and its fifth to eighth.
_RUNS = ((0, 3), (0, 4), (4, 4))


@register("phrase_entities", f"""{_P}, b AS (SELECT {S.tokenize('text')} AS t FROM benchmark),
ph AS (SELECT DISTINCT w FROM ({' UNION ALL '.join(f"SELECT t[{a + 1}:{a + n}] AS w FROM b WHERE len(t) >= {a + n}" for a, n in _RUNS)}) x),
d AS (SELECT doc_id, {S.tokenize('content')} AS t FROM pubs),
g AS (SELECT doc_id, i - 1 AS pos, n, t[i:i + n - 1] AS w
      FROM (SELECT doc_id, t, n, unnest(range(1, len(t) - n + 2)) AS i FROM d, (VALUES (3), (4)) v(n)) x),
m AS (SELECT doc_id, pos, max(n) AS n, arg_max(array_to_string(w, ' '), n) AS p FROM g JOIN ph USING (w) GROUP BY doc_id, pos),
l AS (SELECT doc_id, list(struct_pack(free := pos, n := n, found := [p]) ORDER BY pos) AS h FROM m GROUP BY doc_id),
r AS (SELECT doc_id, list_reduce(list_prepend(struct_pack(free := 0::BIGINT, n := 0, found := []::VARCHAR[]), h), lambda a, x:
        CASE WHEN x.free >= a.free THEN struct_pack(free := x.free + x.n, n := 0, found := list_concat(a.found, x.found)) ELSE a END).found AS found
      FROM l)
SELECT doc_id, len(found) AS n_phrases, {S.md5_list('found')} AS phrases_md5 FROM r""")
def q_phrase_entities(spark, sf):
    """T6 with a list: phrases of the benchmark's items found in the documents, longest first."""
    items = read_table(spark, sf, "benchmark").select(TK.tokenize("text").alias("t"))
    runs = F.array(*[F.when(F.size("t") >= a + n, F.array_join(F.slice("t", a + 1, n), " ")) for a, n in _RUNS])
    phrases = PH.phrase_table(items.select(F.explode(runs).alias("phrase")).filter("phrase is not null"))
    found = PH.phrase_matches(_pubs(spark, sf).select("doc_id", TK.tokenize("content").alias("tokens")), phrases)
    return found.select("doc_id", F.size("phrases").alias("n_phrases"), F.md5(F.array_join("phrases", "|")).alias("phrases_md5"))


@register("lemmatize_by_table", f"""{_P},
lem AS (SELECT w AS word, min(left(w, len(w) - 1 - lang_len)) AS lemma
        FROM (SELECT unnest({S.tokenize('text')}) AS w, len(source) % 2 AS lang_len FROM documents) x WHERE len(w) > 4 GROUP BY w),
tk AS (SELECT doc_id, generate_subscripts(t, 1) AS i, unnest(t) AS w FROM (SELECT doc_id, {S.tokenize('content')} AS t FROM pubs) x),
new AS (SELECT doc_id, list(coalesce(lemma, w) ORDER BY i) AS t FROM tk LEFT JOIN lem ON lem.word = tk.w GROUP BY doc_id)
SELECT doc_id, len(t) AS n_tokens, {S.md5_list('t')} AS tokens_md5 FROM new""")
def q_lemmatize_by_table(spark, sf):
    """T3 with a table: every longer word of the corpus has a shorter lemma in it, or two."""
    docs = _pubs(spark, sf).select("doc_id", "journal", TK.tokenize("content").alias("tokens"))
    words = docs.select(F.explode("tokens").alias("word"), (F.length("journal") % 2).alias("odd")).distinct()
    table = words.filter("length(word) > 4").selectExpr("word", "left(word, length(word) - 1 - odd) AS lemma")
    out = PH.lemmatize_by_table(docs.select("doc_id", "tokens").filter(F.size("tokens") > 0), table)
    return out.select("doc_id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", "|")).alias("tokens_md5"))
