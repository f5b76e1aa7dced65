"""Token counts by a map-side two-tier lookup.

A text's token count is the sum over its pre-tokens, and the same pre-tokens
come again and again. Tier 1 is a compact table of the most frequent pre-tokens
and their token counts, broadcast to every task. Tier 2 is a cache in each
worker: a pre-token that is in neither is encoded by the tokenizer once and
remembered. Nothing is shuffled by pre-token.

The table is found over all documents without such a shuffle: each task keeps a
Misra-Gries summary of at most ``TABLE`` pre-tokens and hands it on as one row;
rows are merged pairwise in rounds, each merge again cut back to ``TABLE``
entries, until one is left. So neither a task nor the driver holds more than
that number of entries. The table only saves work: counts are exact for any
table.

Cutting text into pre-tokens is done here only for characters on which the
pattern engines agree (letters, digits and punctuation of Latin scripts, blank,
tab, line ends). A text with any other character, or with a special-token string, is
given to the tokenizer whole.

Defined cases: NULL and empty texts have 0 bytes and 0 tokens; repeated rows are
counted one by one; columns other than ``text`` pass through unread; very long
texts are cut at line ends and blanks into runs of pre-tokens by the same scan,
so memory follows the text.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE = "byte_bpe_50k.json"
TABLE = 1 << 15
#: Entries of a worker's cache; it is emptied when full.
CACHE = 1 << 20
LIMIT = 512
SPECIAL = "<|endoftext|>"
#: ``'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+`` for safe texts.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_DIGITS = "0-9²³¹¼-¾"
_SAFE = re.compile(r"[\t\n\r\x20-\x7e¡-¬®-ɏ‐-―‘-‟…‹›€™−]*")
#: Alternatives that begin with different characters are tried in order of frequency.
_PIECE = re.compile(rf" ?[{_LETTERS}]+| ?[{_DIGITS}]+|'(?:s|t|re|ve|m|ll|d)| ?[^\s{_LETTERS}{_DIGITS}]+|\s+(?!\S)|\s+", re.A)


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(FILE)


class Counts:
    """Token counts of texts, by the table first, then the worker's cache."""

    def __init__(self, path: str, table: dict[str, int]):
        self.tokenizer, self.table, self.cache = load(path), table, {}

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def of(self, texts: list[str]) -> list[int]:
        out, pieces = [0] * len(texts), {}
        table, cache = self.table, self.cache
        missing = set()
        for i, text in enumerate(texts):
            if not text:
                continue
            if _SAFE.fullmatch(text) is None or SPECIAL in text:
                out[i] = self.whole(text)
                continue
            own = _PIECE.findall(text)
            lengths = list(map(table.get, own))
            if None in lengths:
                left = [p for p, n in zip(own, lengths, strict=True) if n is None]
                out[i] = sum(n for n in lengths if n is not None)
                pieces[i] = left
                missing.update(left)
            else:
                out[i] = sum(lengths)
        unknown = [p for p in missing if p not in cache]
        if len(cache) + len(unknown) > CACHE:
            cache.clear()
            unknown = list(missing)
        for k in range(0, len(unknown), 4096):
            part = unknown[k:k + 4096]
            for p, e in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False), strict=True):
                cache[p] = len(e.ids)
        for i, left in pieces.items():
            out[i] += sum(map(cache.__getitem__, left))
        return out


def cut_back(counts: Counter, size: int) -> Counter:
    """Misra-Gries: lowers all counts by the (size + 1)-th largest, which leaves
    at most ``size`` of them positive."""
    if len(counts) <= size:
        return counts
    least = sorted(counts.values(), reverse=True)[size]
    return Counter({k: n - least for k, n in counts.items() if n > least})


def frequent(docs: DataFrame, size: int = TABLE) -> list[str]:
    """The frequent pre-tokens of all texts, at most ``size``, in one summary."""
    kind = "pieces array<string>, counts array<long>"

    def row(c: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([list(c)], pa.list_(pa.string())),
                                           pa.array([list(c.values())], pa.list_(pa.int64()))], ["pieces", "counts"])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text and _SAFE.fullmatch(text):
                    held.update(_PIECE.findall(text))
                    if len(held) > 8 * size:
                        held = cut_back(held, size)
        yield row(cut_back(held, size))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counter()
        for batch in batches:
            for pieces, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.update(dict(zip(pieces, counts, strict=True)))
                held = cut_back(held, size)
        yield row(held)

    parts = docs.select("text").mapInArrow(summarise, kind)
    n = docs.rdd.getNumPartitions()
    while n > 1:
        n = -(-n // 8)
        parts = parts.repartition(n).mapInArrow(merge, kind)
    found = parts.collect()
    total = Counter()
    for r in found:
        total.update(dict(zip(r["pieces"], r["counts"], strict=True)))
    return [p for p, _ in total.most_common(size)]


def count(docs: DataFrame, path: str | None = None, limit: int = LIMIT, size: int = TABLE,
          keep: list[str] | None = None) -> DataFrame:
    """``docs`` (needs ``text``), or only its columns ``keep``, with n_bytes,
    n_tokens, over_limit. ``path``: tokenizer file, the same on every executor."""
    path = path or default_path()
    keep = docs.columns if keep is None else keep
    docs = docs.select(*dict.fromkeys([*keep, "text"]))
    pieces = frequent(docs, size)
    shared = docs.sparkSession.sparkContext.broadcast(dict(zip(pieces, Counts(path, {}).of(pieces), strict=True)))
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(path, shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n_bytes = pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64())
            n_tokens = [n for k in range(0, len(texts), 256) for n in counts.of(texts[k:k + 256])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), n_bytes, pa.array(n_tokens, pa.int64())],
                                             [*keep, "n_bytes", "n_tokens"])

    return docs.mapInArrow(counted, schema).withColumn("over_limit", F.col("n_tokens") > limit)
