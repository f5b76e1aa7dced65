"""Counting inside a batch of documents, on Arrow arrays.

A task gets its documents in Arrow batches; words become codes of the batch, a
sort of (row, code) numbers counts them. Nothing crosses a row except what is
summed on purpose, so every function is a narrow map over the documents.

Defined cases: a NULL list gives NULL (per-row functions) or no rows; a NULL word
is in no pair and is not counted; words come in UTF-8 byte order.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need numpy and Arrow only, wherever this package lies

#: Rows of an Arrow batch that is handed back.
OUT_ROWS = 65_536
#: Words that are counted at once (or one row's, if it has more): bounds a task's arrays.
WORDS_AT_ONCE = 1 << 20


def pieces(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The rows in order, in batches of about ``WORDS_AT_ONCE`` words of a list column."""
    for b in batches:
        upto = np.cumsum(pc.fill_null(pc.list_value_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // WORDS_AT_ONCE
        cuts = [0, *(np.flatnonzero(upto[1:] != upto[:-1]) + 1).tolist(), b.num_rows]
        for i, j in zip(cuts, cuts[1:]):
            yield b.slice(i, j - i)


def coded(lists) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(length per row, code per word, words); a NULL word has the code len(words)."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().dictionary_encode()
    codes = pc.fill_null(values.indices, len(values.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
    return n, codes, values.dictionary


def run_lengths(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def _frequent(lists: pa.ListArray, min_count: int, pairs: bool) -> pa.ListArray:
    n, codes, words = coded(lists)
    v = len(words) + 1
    size = v * v if pairs else v
    if len(n) > 1 and (len(codes) > WORDS_AT_ONCE or len(n) * size >= 1 << 62):  # the numbers below must fit a long
        mid = len(n) // 2
        return pa.concat_arrays([_frequent(lists.slice(0, mid), min_count, pairs), _frequent(lists.slice(mid), min_count, pairs)])
    row = np.repeat(np.arange(len(n)), n)
    known = codes < len(words)
    if pairs:
        at = np.flatnonzero((row[1:] == row[:-1]) & known[1:] & known[:-1])
        keys = row[at] * size + codes[at] * v + codes[at + 1]
    else:
        keys = (row * size + codes)[known]
    keys, count = run_lengths(keys)
    kept = count >= min_count
    keys, count = keys[kept], count[kept]
    row, code = keys // size, keys % size
    text = pc.binary_join_element_wise(words.take(pa.array(code // v)), words.take(pa.array(code % v)), " ") if pairs else words.take(pa.array(code))
    order = pc.sort_indices(pa.table({"row": row, "n": -count, "text": text}),
                            sort_keys=[("row", "ascending"), ("n", "ascending"), ("text", "ascending")]).to_numpy()
    times = count[order]
    ends = np.concatenate(([0], np.cumsum(np.bincount(row, weights=count, minlength=len(n))))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), text.take(pa.array(np.repeat(order, times))), mask=lists.is_null())


def frequent(lists: pa.Array, min_count: int) -> pa.Array:
    """Per row the words seen ``min_count`` times or more, each repeated by its count, most frequent first, then by word."""
    return _frequent(lists, min_count, False)


def frequent_pairs(lists: pa.Array, min_count: int) -> pa.Array:
    """The same of the adjacent pairs 'a b' of a row."""
    return _frequent(lists, min_count, True)


def word_hash(word: str, salt: str = "") -> int:
    """The first 8 hex digits of md5, as a number."""
    return int(hashlib.md5((salt + word).encode()).hexdigest()[:8], 16)


def hashed_shares(lists: pa.Array, k: int) -> pa.Array:
    """Per row k numbers: (words whose hash mod k is t, plus 1) / (words + k)."""
    n, codes, words = coded(lists)
    topic = np.array([*(word_hash(w) % k for w in words.to_pylist()), k], np.int64)
    row = np.repeat(np.arange(len(n)), n)
    counts = np.bincount(row * (k + 1) + topic[codes], minlength=len(n) * (k + 1)).reshape(len(n), k + 1)[:, :k]
    shares = (counts + 1) / (n + k)[:, None]
    ends = np.arange(0, len(n) * k + 1, k, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(shares.ravel()), mask=lists.is_null())


def rows_of_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, words) -> (key, token, n): a row per distinct word of a row."""
    for b in pieces(batches, 1):
        name = b.schema.names[0]
        n, codes, words = coded(b.column(1))
        v = len(words) + 1
        keys, count = run_lengths((np.repeat(np.arange(len(n)), n) * v + codes)[codes < len(words)])
        for at in range(0, len(keys), OUT_ROWS):
            part = keys[at:at + OUT_ROWS]
            yield pa.record_batch({name: b.column(0).take(pa.array(part // v)), "token": words.take(pa.array(part % v)),
                                   "n": pa.array(count[at:at + OUT_ROWS].astype(np.int32))})


def word_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(words) -> (word, n): counts of a batch, to be summed."""
    for b in pieces(batches, 0):
        _, codes, words = coded(b.column(0))
        count = np.bincount(codes, minlength=len(words) + 1)[:len(words)]
        for at in range(0, len(words), OUT_ROWS):
            yield pa.record_batch({"word": words.slice(at, OUT_ROWS), "n": pa.array(count[at:at + OUT_ROWS])})


def top_hashed(models: list, top_n: int):
    """(word, cf) -> (model_id, topic_id, word, cf) of a task: per hashed model (model_id, k, salt) and
    topic its ``top_n`` words by cf, then by word, and a row without a word that holds the sum of cf. The best of
    all tasks are among the best of each, so no word leaves its task once per model."""
    salts = sorted({s or "" for _, _, s in models})

    def best(hashes):
        """Per model the topics and places of its top words; the words are in rank order."""
        for m, k, salt in models:
            topic = hashes[salts.index(salt or "")] % k
            order = np.argsort(topic, kind="stable")
            sizes = np.bincount(topic, minlength=k)
            rank = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield topic[order[rank < top_n]], order[rank < top_n]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, cf, hashes = pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros((len(salts), 0), np.int64)
        totals = [np.zeros(k, np.int64) for _, k, _ in models]
        for b in batches:
            new, n = b.column(0), b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            text = new.to_pylist()
            own = np.array([[word_hash(w, s) for w in text] for s in salts], np.int64).reshape(len(salts), -1)
            for (_, k, salt), sums in zip(models, totals):
                np.add.at(sums, own[salts.index(salt or "")] % k, n)
            words, cf, hashes = pa.concat_arrays([words, new]), np.append(cf, n), np.concatenate((hashes, own), axis=1)
            order = pc.sort_indices(pa.table({"cf": cf, "word": words}), sort_keys=[("cf", "descending"), ("word", "ascending")]).to_numpy()
            words, cf, hashes = words.take(pa.array(order)), cf[order], hashes[:, order]
            kept = np.zeros(len(cf), bool)
            for _, at in best(hashes):
                kept[at] = True
            words, cf, hashes = words.filter(pa.array(kept)), cf[kept], hashes[:, kept]
        for (m, k, _), sums, (topic, at) in zip(models, totals, best(hashes)):
            some = np.flatnonzero(sums)
            yield pa.record_batch({"model_id": pa.array(np.full(len(at) + len(some), m, np.int64)), "topic_id": pa.array(np.append(topic, some).astype(np.int32)),
                                   "word": pa.concat_arrays([words.take(pa.array(at)), pa.nulls(len(some), pa.string())]),
                                   "cf": pa.array(np.append(cf[at], sums[some]))})
    return run
