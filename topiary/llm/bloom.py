"""Picking few rows of a wide table by id, the same way at every size.

A Bloom filter of the wanted ids is built by an aggregate and sent to the tasks
that read the table; rows that it does not know stay where they are, and the few
that it knows go on to an exact join. So texts that nobody asked for are never
shuffled, whatever the number of ids: no size decides between two plans.

The filter takes ``BITS_PER_ID`` bits an id (about 0.3 % of the other rows pass)
up to ``MAX_BITS`` = 32 MB, which is what the driver and a broadcast hold at most.
Beyond 22 million ids the share of rows that pass in vain grows; results never
change, as the join behind it is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiary.llm.textbytes import mixed

BITS_PER_ID = 12
LEAST_BITS, MAX_BITS = 1 << 16, 1 << 28
PROBES = 4
#: 64-bit words of a part in which the filter comes to the driver.
PART = 1 << 10


def places(ids: np.ndarray, bits: int) -> np.ndarray:
    """The PROBES bits of each id."""
    ids = ids.astype(np.int64, copy=False).view(np.uint64)
    a = mixed(ids)
    b = mixed(a ^ np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return (a[:, None] + np.arange(PROBES, dtype=np.uint64) * b[:, None]) & np.uint64(bits - 1)


class Bloom:
    def __init__(self, words: np.ndarray):
        self.words = words

    def knows(self, ids: pa.Array) -> np.ndarray:
        """Which ids may be among those it was built from; a NULL never is."""
        known = np.asarray(ids.is_valid())
        at = places(ids.fill_null(0).to_numpy(zero_copy_only=False), len(self.words) * 64)
        hit = (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)
        return hit.all(axis=1) & known


def bits_for(n: int) -> int:
    return min(MAX_BITS, max(LEAST_BITS, 1 << (max(1, n * BITS_PER_ID) - 1).bit_length()))


def bloom_of(ids: DataFrame):
    """The broadcast filter of a frozen table's only column (long)."""
    spark, name = ids.sparkSession, ids.columns[0]
    bits = bits_for(ids.count())

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = places(batch.column(0).drop_null().to_numpy(zero_copy_only=False), bits).ravel()
            word, bit = at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63))
            order = np.argsort(word, kind="stable")
            found, first = np.unique(word[order], return_index=True)
            value = np.bitwise_or.reduceat(bit[order], first) if len(found) else bit[:0]
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(value.view(np.int64))], ["word", "bits"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            for word, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if word // PART != at:
                    if at is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([held.tobytes()])], ["part", "words"])
                    at, held = word // PART, np.zeros(PART, np.int64)
                held[word % PART] = value
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([held.tobytes()])], ["part", "words"])

    merged = ids.select(F.col(name).cast("long")).mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    whole = np.zeros(bits // 64, np.uint64)
    cut = merged.repartition(F.expr(f"word div {PART}")).sortWithinPartitions("word").mapInArrow(parts, "part long, words binary")
    for r in cut.collect():  # MAX_BITS at most
        whole[r["part"] * PART:(r["part"] + 1) * PART] = np.frombuffer(r["words"], np.uint64)
    return spark.sparkContext.broadcast(Bloom(whole))


def known_rows(df: DataFrame, column: str, bloom) -> DataFrame:
    """The rows of ``df`` whose id the filter knows."""
    at = df.columns.index(column)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bloom.value.knows(batch.column(at))))

    return df.mapInArrow(keep, df.schema)
