"""Tokens, stop words, lemmas, bigrams, phrases.

All per document: JVM built-ins, and Arrow batches for the counts of bigrams; a
document never leaves its row, so the whole stage is a narrow map over the input
partitions (no shuffle).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topiary.functions import batches as B
from topiary.functions.arrays import adjacent_pairs, empty_if_null
from topiary.functions.lexicon import LEMMAS, stop_words, title_forms
from topiary.functions.text import clean_fulltext

# URLs and e-mail addresses are one non-alphabetic token each for a statistical
# tokenizer, so they never yield words: remove them first. The e-mail branch
# is anchored at the start of a non-space run: it matches exactly what
# "\S+@\S+" matches, but Java's backtracking engine then needs one attempt per
# run instead of one per character (long junk runs were quadratic).
URL_OR_EMAIL = r"(?:https?://|www\.)\S+|(?<!\S)\S+@\S+"
# A maximal run of letters, digits and '_' that consists of >= 2 letters only.
# Lookarounds make "abc123" vanish instead of shrinking to "abc".
ALPHA_WORD = r"(?<![\p{L}\p{N}_])\p{L}{2,}+(?![\p{L}\p{N}_])"
# Capitalised runs of three or more words stand in for multi-word entities.
# Possessive: nothing is given back, so a run of any length needs no recursion.
ENTITY = r"\p{Lu}\p{L}++(?: \p{Lu}\p{L}++){2,}+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text, lowercase: bool = True) -> Column:
    """Words that are wholly alphabetic and longer than one character."""
    t = _col(text)
    if lowercase:
        t = F.lower(t)
    # the pattern needs one of these substrings; plain byte searches skip the
    # regex pass for texts without any
    maybe = t.contains("@") | t.contains("://") | t.contains("www.")
    t = F.when(maybe, F.regexp_replace(t, F.lit(URL_OR_EMAIL), F.lit(" "))).otherwise(t)
    return F.regexp_extract_all(t, F.lit(ALPHA_WORD), 0)


#: Languages whose stop lists are chosen by row; any of lexicon.SPARK_LANGUAGES may be added.
LANGUAGES = ("en", "fr", "de", "es")


def remove_stopwords(tokens, words=None, case_sensitive: bool = False,
                     lang=None) -> Column:
    """Drop stop words, keeping order and duplicates.

    ``x IN (<list>)`` becomes a hash-set probe (InSet) after optimisation.
    Default: tokens are lower case and compared with the lower-case list.
    ``case_sensitive``: the literal rule, surface token against the list plus
    its Title forms (tokens must then keep their case). ``lang``: a column that
    chooses Spark's list per row; ``words`` are dropped besides. Rows of an
    unknown language keep their other words.
    """
    tokens = _col(tokens)
    def without(words):
        words = list(title_forms(words)) if case_sensitive else list(words)
        return F.filter(tokens, lambda x: ~x.isin(words))

    if lang is not None:
        out = None  # the language is looked up once per row, not per token
        for code in LANGUAGES:
            hit, kept = _col(lang) == code, without([*stop_words(code), *(words or ())])
            out = F.when(hit, kept) if out is None else out.when(hit, kept)
        return out.otherwise(without(words) if words else tokens)
    return without(words if words is not None else stop_words("english"))


def lemmatize(tokens, lemmas: dict | None = None) -> Column:
    """Token -> lemma via a small literal lookup; others keep their form."""
    lemmas = LEMMAS if lemmas is None else lemmas
    if not lemmas:
        return _col(tokens)
    m = F.create_map(*[F.lit(x) for kv in sorted(lemmas.items()) for x in kv])
    keys = sorted(lemmas)
    # hash-set probe first: most tokens have no entry and skip the map scan
    return F.transform(_col(tokens), lambda x: F.when(x.isin(keys), F.try_element_at(m, x)).otherwise(x))


def bigrams(tokens) -> Column:
    """T4: adjacent pairs of the filtered list, 'a b'."""
    return adjacent_pairs(_col(tokens), " ")


def with_frequent_bigrams(df: DataFrame, bigrams_col: str, out: str,
                          min_count: int = 5) -> DataFrame:
    """T5: per document keep pairs seen >= min_count times, each repeated by
    its count, most frequent first (ties: alphabetical)."""
    return df.withColumn(out, _counted(B.frequent, min_count)(bigrams_col))


def frequent_pairs(tokens, min_count: int = 5) -> Column:
    """T4 -> T5: the frequent bigrams of the filtered list. Pairs are counted as
    pairs of word codes, and only those that are kept become strings."""
    return _counted(B.frequent_pairs, min_count)(_col(tokens))


def _counted(count, min_count: int):
    """``count`` over the rows of an Arrow batch, in the task that holds them."""
    def run(lists: pa.Array) -> pa.Array:
        return count(lists, min_count)
    return F.arrow_udf(run, "array<string>")


def entities(content) -> Column:
    """Multi-word names (>= 3 words), lower case, ASCII only, no digit."""
    found = F.transform(F.regexp_extract_all(_col(content), F.lit(ENTITY), 0),
                        lambda x: F.trim(F.lower(x)))
    return F.filter(found, lambda x: (F.length(x) == F.octet_length(x)) & ~x.rlike("[0-9]"))


def assemble_tokens(unigrams, bigrams_, entities_) -> Column:
    """Unigrams + bigrams + entities, order and multiplicity kept."""
    return F.concat(empty_if_null(_col(unigrams)), empty_if_null(_col(bigrams_)),
                    empty_if_null(_col(entities_)))


def unigrams(content, stop=None, lemmas=None, lang=None, case_sensitive: bool = False) -> Column:
    """T1 -> T2 -> T3. ``case_sensitive``: stop words are tested on the surface
    form, and what is left is lower-cased afterwards."""
    return unigrams_of(tokenize(content, lowercase=not case_sensitive), stop, lemmas, lang, case_sensitive)


def unigrams_of(tokens, stop=None, lemmas=None, lang=None, case_sensitive: bool = False) -> Column:
    """T2 -> T3 on tokens."""
    kept = remove_stopwords(tokens, stop, case_sensitive, lang)
    if case_sensitive:
        kept = F.transform(kept, F.lower)
    return lemmatize(kept, lemmas)


def general_preprocess(df: DataFrame, content_col: str = "content", out: str = "tokens",
                       min_bigram_count: int = 5, stop=None, lemmas=None, lang=None,
                       case_sensitive: bool = False) -> DataFrame:
    """Content -> tokens (unigrams + frequent bigrams + entities).
    ``lemmas``: a dict, or a (word, lemma) DataFrame of any size, which is joined."""
    df = df.withColumn("__tok", tokenize(content_col, lowercase=not case_sensitive))
    if isinstance(lemmas, DataFrame):
        from topiary.operators.phrases import lemmatize_by_table
        df = df.withColumn("__uni", unigrams_of("__tok", stop, {}, lang, case_sensitive)).drop("__tok")
        df = lemmatize_by_table(df, lemmas, "__uni").withColumn("__tok", F.lit(None).cast("array<string>"))
    else:
        df = df.withColumn("__uni", unigrams_of("__tok", stop, lemmas, lang, case_sensitive))
    df = df.withColumn("__fbg", frequent_pairs("__uni", min_bigram_count))
    df = df.withColumn(out, assemble_tokens("__uni", "__fbg", entities(content_col)))
    return df.drop("__tok", "__uni", "__fbg")


def clean_and_tokenize(df: DataFrame, raw_col: str = "content", **kw) -> DataFrame:
    """C8 then T8 (full_text_preprocessing followed by general_preprocessing)."""
    return general_preprocess(df.withColumn(raw_col, clean_fulltext(raw_col)), raw_col, **kw)
