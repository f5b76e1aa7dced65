"""T6 by a phrase list, T3 by a lemma table: lists of any size, joined instead of
carried in the plan.

Phrases: every run of tokens as long as some phrase gets a 64-bit hash inside its
document's row; (document, place, length, hash) rows meet the hashed phrase table,
and what agrees goes back to its document, where the words themselves are compared
and matches are taken from left to right, the longest at each place. The lengths
that occur (a few numbers) are all that the driver sees.

Lemmas: documents are dealt into chunks of about ``CHUNK_DOCS``; a chunk's distinct
words are joined to the table, so a word found in every document reaches the join
once per chunk, and the chunk's tokens are then mapped in place, order and
multiplicity kept.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from topiary.functions.arrays import explode_rows
from topiary.operators.tokens import tokenize
from topiary.session import frozen

CHUNK_DOCS = 512


def phrase_table(phrases: DataFrame, col: str = "phrase", min_words: int = 2) -> DataFrame:
    """(h, n, words): the distinct phrases of at least ``min_words`` words, cut like texts."""
    words = phrases.select(tokenize(col).alias("words")).filter(F.size("words") >= min_words).distinct()
    return frozen(words.select(F.xxhash64("words").alias("h"), F.size("words").alias("n"), "words"))


def phrase_matches(docs: DataFrame, phrases: DataFrame, tokens_col: str = "tokens", key: str = "doc_id") -> DataFrame:
    """(key, phrases array<string>) of the documents that hold one; ``phrases`` from
    ``phrase_table``, tokens cut the same way. Keys are unique and not NULL.

    A phrase inside a longer match, or begun in one, is not counted; overlapping
    ones go to the one that starts first. A NULL or empty token list, an empty
    list of phrases: no row."""
    lengths = sorted(r["n"] for r in phrases.select("n").distinct().collect())
    docs = docs.select(key, F.col(tokens_col).alias("__t"))
    if not lengths:
        return docs.select(key, F.lit(None).cast("array<string>").alias("phrases")).limit(0)

    def grams(n):
        starts = F.sequence(F.lit(1), F.size("__t") - (n - 1))
        runs = F.transform(starts, lambda i: F.struct((i - 1).alias("pos"), F.lit(n).alias("n"), F.xxhash64(F.slice("__t", i, n)).alias("h")))
        return F.when(F.size("__t") >= n, runs).otherwise(F.array().cast("array<struct<pos:int,n:int,h:bigint>>"))

    rows = explode_rows(docs, [key], F.concat(*[grams(n) for n in lengths]), ["pos", "n", "h"])
    hits = rows.join(phrases, ["h", "n"]).groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("pos", (-F.col("n")).alias("m"), "words"))).alias("__hits"))
    both = docs.join(hits, key)
    same = F.filter("__hits", lambda x: F.slice(F.col("__t"), x["pos"] + 1, -x["m"]) == x["words"])
    start = F.struct(F.lit(0).alias("free"), F.array().cast("array<string>").alias("found"))
    taken = F.aggregate(F.col("__same"), start, lambda a, x: F.when(
        x["pos"] >= a["free"], F.struct((x["pos"] - x["m"]).alias("free"), F.concat(a["found"], F.array(F.array_join(x["words"], " "))).alias("found")))
        .otherwise(a))
    return both.select(key, same.alias("__same")).select(key, taken["found"].alias("phrases")).filter(F.size("phrases") > 0)


def lemmatize_by_table(df: DataFrame, table: DataFrame, tokens_col: str = "tokens", chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """``df`` with the tokens of ``tokens_col`` replaced by their lemmas of ``table``
    (word, lemma). A word without a lemma stays; of several lemmas the smallest
    counts; NULL words and lemmas are ignored; NULL and empty lists stay as they are."""
    rows = frozen(df.withColumn("__at", F.xxhash64(F.monotonically_increasing_id())))
    chunks = max(1, math.ceil(rows.count() / chunk_docs))
    rows = rows.withColumn("__chunk", F.pmod("__at", F.lit(chunks))).drop("__at")
    words = explode_rows(rows, ["__chunk"], F.array_distinct(tokens_col), ["word"]).distinct()
    lemmas = table.filter("word is not null and lemma is not null").groupBy("word").agg(F.min("lemma").alias("lemma"))
    found = words.join(lemmas, "word").select(F.col("__chunk").alias("__of"), "word", "lemma")

    def replace(docs: pa.Table, known: pa.Table) -> pa.Table:
        lemma = dict(zip(known.column("word").to_pylist(), known.column("lemma").to_pylist()))
        at = docs.column_names.index(tokens_col)
        new = [None if t is None else [lemma.get(w, w) for w in t] for t in docs.column(at).to_pylist()]
        return docs.set_column(at, tokens_col, pa.array(new, pa.list_(pa.string()))).drop_columns(["__chunk"])

    schema = StructType([StructField(f.name, ArrayType(StringType())) if f.name == tokens_col else f for f in df.schema])
    return rows.groupBy("__chunk").cogroup(found.groupBy("__of")).applyInArrow(replace, schema)
