"""Benchmark decontamination by a prefix-filtered set join.

A window is ``width`` consecutive words of a benchmark item (the whole item if
shorter). As a set, a window is its runs of three words (shingles); a document
holds the window only if it holds every shingle of it, so one prefix token,
the window's rarest shingle, is enough to find all candidates. Rarity is
counted over all documents; a window with a token that no document has is dropped there.

The benchmark is as distributed as the documents: windows, their tokens, the
counts and the prefixes are tables. Documents are read, never moved: tasks probe
their tokens against a Bloom filter, and a place that may begin a candidate leaves
with its digest and the words around it. These places meet the prefixes in a join on the
token; the offset inside the window gives the start, positional and length bounds drop
starts for which the window does not fit into the document, and exact comparison of the
words over the item-sized window decides. Marks are kept per distinct text and
come back to the documents that another Bloom filter knows; the other
documents are clean. So documents are read four times, whatever the size of the benchmark.

Defined cases: NULL or empty texts have no words and are clean; items without
words have no windows; several rows with one item_id are one item, a NULL
item_id is written as the empty string; repeated document rows are judged one by
one; an empty benchmark leaves every document clean. Other columns of ``docs`` are
handed through by ``keep``; one with a name that ``find`` adds is replaced by the added one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topiary.llm.bloom import bloom_of
from topiary.llm.common import frozen
from topiary.llm.textbytes import ALNUM, Words, blocks, shingles
from topiary.session import small_batches

WIDTH = 13
SHINGLE = 3
#: Windows, or places with their words, per Arrow batch while they are made.
BATCH_WINDOWS = 8192
ADDED = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def tokens(w: Words) -> np.ndarray:
    """Hash of the shingle that starts at each word: of SHINGLE words, for the
    last ones of a row of as many as are left."""
    n = len(w)
    out = np.zeros(n, dtype=np.uint64)
    left = w.first[1:][w.doc] - np.arange(n) if n else np.zeros(0, dtype=np.int64)
    for k in range(1, SHINGLE + 1):
        at = np.flatnonzero(left >= k if k == SHINGLE else left == k)
        if len(at):
            out[at] = shingles(w.hash, k)[at]
    return out


def windows(items: DataFrame, width: int) -> DataFrame:
    """(words, size, tokens, item_id), distinct, of the rows (item_id, text). ``words``
    are joined by a blank, ``tokens`` the hashes of the window's shingles, in order; a
    window of fewer than SHINGLE words is held by longer runs, so it has its words' hashes."""
    def made(words, sizes, tokens_, ids):
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(sizes, pa.int64()), pa.array(tokens_, pa.list_(pa.int64())),
                                           pa.array(ids, pa.string())], ["words", "size", "tokens", "item_id"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple = ([], [], [], [])
            for first, _, data, offsets in blocks(batch.column(1)):
                w = Words(data, offsets, ALNUM)
                runs = shingles(w.hash, SHINGLE)
                for row in range(len(offsets) - 1):
                    a, b = int(w.first[row]), int(w.first[row + 1])
                    size = min(width, b - a)
                    if not size:
                        continue
                    item, inner = batch.column(0)[first + row].as_py(), size >= SHINGLE
                    text = w.text(a, b)
                    own = (runs if inner else w.hash)[a:b].view(np.int64).tolist()
                    held = size - SHINGLE + 1 if inner else size
                    at = np.concatenate([[0], np.cumsum(w.end[a:b] - w.start[a:b] + 1)]).tolist()
                    for i in range(b - a - size + 1):
                        for column, value in zip(out, (text[at[i]:at[i + size] - 1], size, own[i:i + held], item), strict=True):
                            column.append(value)
                        if len(out[0]) >= BATCH_WINDOWS:
                            yield made(*out)
                            out = ([], [], [], [])
            yield made(*out)

    return items.select("item_id", "text").mapInArrow(cut, "words binary, size long, tokens array<long>, item_id string").distinct()


def _known(hashes: np.ndarray, bloom) -> np.ndarray:
    return np.flatnonzero(bloom.knows(pa.array(hashes.view(np.int64))))


def _token_sets(w: Words, short: bool) -> list[np.ndarray]:
    """``short``: some windows have fewer than SHINGLE words, whose tokens are words."""
    return [tokens(w), w.hash] if short else [tokens(w)]


def _counts(docs: DataFrame, vocabulary, short: bool) -> DataFrame:
    """(token, n): occurrences over all documents of the tokens that the filter knows, added up map-side."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in blocks(batch.column(0)):
                w = Words(data, offsets, ALNUM)
                for t in _token_sets(w, short):
                    token, n = np.unique(t[_known(t, vocabulary.value)], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n.astype(np.int64))], ["token", "n"])

    return docs.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _places(docs: DataFrame, prefixes, short: bool, width: int) -> DataFrame:
    """(digest, at, token, before, around) of each document word whose token may be a prefix:
    its place, and the words up to ``width`` - 1 before (``before`` of them) and after it."""
    names = ["digest", "at", "token", "before", "around"]
    types = [pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.string()]

    def find_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, offsets in blocks(batch.column(1)):
                w = Words(data, offsets, ALNUM)
                for t in _token_sets(w, short):
                    found = _known(t, prefixes.value)
                    for k in range(0, len(found), BATCH_WINDOWS):
                        p = found[k:k + BATCH_WINDOWS]
                        row = w.doc[p]
                        low = np.maximum(w.first[row], p - width + 1)
                        high = np.minimum(w.first[row + 1], p + width)
                        around = [w.text(a, b) for a, b in zip(low.tolist(), high.tolist(), strict=True)]
                        columns = [batch.column(0).take(pa.array(first + row)), p - w.first[row], t[p].view(np.int64), p - low, around]
                        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, kind)
                                                          for c, kind in zip(columns, types, strict=True)], names)

    return docs.select("__digest", "text").mapInArrow(find_places, "digest binary, at long, token long, before int, around string")


def _with_words(docs: DataFrame, bloom, known: bool) -> DataFrame:
    """``__keep`` and ``__digest`` of the rows whose digest the filter knows (or not), with ``n_words``."""
    schema = T.StructType([docs.schema["__keep"], docs.schema["__digest"], T.StructField("n_words", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = bloom.value.knows(batch.column("__key"))
            batch = batch.filter(pa.array(hit if known else ~hit))
            n = [np.diff(Words(data, offsets, ALNUM).first) for _, _, data, offsets in blocks(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("__keep"), batch.column("__digest"),
                                              pa.array(np.concatenate(n) if n else np.zeros(0, np.int64), pa.int64())], schema.names)

    return docs.mapInArrow(cut, schema)


def _prefixes(windows_: DataFrame, docs: DataFrame, short: bool) -> DataFrame:
    """(token, place, window, words, size): each window under its rarest token; ties take the least hash."""
    places = frozen(windows_.select("window", F.posexplode("tokens").alias("place", "token")))
    counts = _counts(docs, bloom_of(frozen(places.select("token").distinct())), short)
    rarest = (places.join(counts, "token", "left").groupBy("window")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "place")).alias("r")).filter("r.n > 0"))
    return frozen(rarest.select("window", "r.token", "r.place").join(windows_.select("window", "words", "size"), "window"))


def _hits(docs: DataFrame, prefixes: DataFrame, short: bool, width: int) -> DataFrame:
    """(digest, a, b, window), distinct: the occurrences of windows, by word places."""
    found = frozen(_places(docs, bloom_of(frozen(prefixes.select("token").distinct())), short, width))
    start = F.col("before") - F.col("place")  # in the words around the place
    words = F.split("around", " ", -1)
    both = found.join(prefixes, "token").filter((start >= 0) & (start + F.col("size") <= F.size(words)))
    own = F.array_join(F.slice(words, (start + 1).cast("int"), F.col("size").cast("int")), " ")
    return both.filter(own == F.col("words").cast("string")).select(
        "digest", (F.col("at") - F.col("place")).alias("a"), (F.col("at") - F.col("place") + F.col("size")).alias("b"), "window").distinct()


def find(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (needs ``text``), or only its columns ``keep``, with n_words, n_hit, n_items, items_sha256,
    contaminated. n_hit counts document words inside any occurrence of a window."""
    small_batches(docs.sparkSession)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ADDED]
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                             F.coalesce(F.col("text"), F.lit("")).alias("text"))
    held = frozen(windows(items, width))
    distinct = frozen(held.select("words", "size", "tokens").distinct().withColumn("window", F.monotonically_increasing_id()))
    short = distinct.filter(F.col("size") < SHINGLE).limit(1).count() > 0
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    work = docs.select(F.struct(*keep).alias("__keep"), "text", digest.alias("__digest"))
    hits = frozen(_hits(work, _prefixes(distinct, work, short), short, width))

    spans = hits.groupBy("digest").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("spans"))
    hit = F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
                      lambda s, x: F.struct((s["n"] + F.greatest(x["b"] - F.greatest(x["a"], s["upto"]), F.lit(0))).alias("n"),
                                            F.greatest(s["upto"], x["b"]).alias("upto")), lambda s: s["n"])
    of_items = held.select("words", "item_id").join(distinct.select("words", "window"), "words").select("window", "item_id")
    ids = (hits.select("digest", "window").distinct().join(of_items, "window").groupBy("digest")
               .agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    marks = frozen(spans.select("digest", hit.alias("n_hit")).join(ids, "digest").select(
        F.col("digest").alias("__digest"), "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")))

    key = F.xxhash64("__digest").alias("__key")
    bloom = bloom_of(frozen(marks.select(key)))
    work = work.select("*", key)
    clean = _with_words(work, bloom, False).select(
        "__keep.*", "n_words", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"), F.sha2(F.lit("").cast("binary"), 256).alias("items_sha256"))
    rest = _with_words(work, bloom, True).join(marks, "__digest", "left").select(
        "__keep.*", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"))
    return clean.unionByName(rest).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def brute_force(docs: list[tuple], items: list[tuple], width: int = WIDTH) -> dict:
    """Reference result for small tables: {doc_id: (n_words, n_hit, n_items, sha, contaminated)}."""
    import re
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    cut = lambda t: pattern.findall((t or "").translate(lower))
    windows = [("" if i is None else str(i), w[k:k + min(width, len(w))]) for i, t in items if (w := cut(t))
               for k in range(len(w) - min(width, len(w)) + 1)]
    out = {}
    for doc, text in docs:
        words, hit, ids = cut(text), set(), set()
        for i, win in windows:
            for k in range(len(words) - len(win) + 1):
                if words[k:k + len(win)] == win:
                    hit.update(range(k, k + len(win)))
                    ids.add(i)
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out[doc] = (len(words), len(hit), len(ids), sha, bool(hit) and 20 * len(hit) >= len(words))
    return out
