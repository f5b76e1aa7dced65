"""Exact deduplication with heavy hitters split off (native).

1. One narrow pass computes (row, doc_id, digest) and freezes it.
2. A Misra-Gries summary (``freqItems``) of 1/support counters names every
   digest that holds more than ``support`` of the rows. The summary is merged
   from one partial state per task. It counts digests as hex strings: binary
   values are told apart by array identity there.
3. The named digests (at most 1/support, a fixed number) are counted exactly;
   these verified winners are broadcast and resolve their rows map-side, so no
   shuffle ever sees the copies of a huge group.
4. The remaining digests, none of which holds more than ``support`` of the
   rows, go through an ordinary aggregate and a join on the digest.

Defined cases: NULL text counts as empty; a repeated row (same doc_id, same
text) is a copy like any other and exactly one of them stays; rows without a
doc_id lose to rows with one; an empty table gives an empty result; columns
other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiary.llm.common import frozen, lower_az

#: A digest with more than this share of all rows is removed map-side.
SUPPORT = 0.0005


def digests(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.unhex(F.sha2(lower_az(text).cast("binary"), 256)).alias("digest")) \
               .withColumn("row", F.monotonically_increasing_id())


def _winners(rows: DataFrame) -> DataFrame:
    best = F.max(F.struct("doc_id", "row"))
    return rows.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))


def heavy_digests(rows: DataFrame, support: float) -> DataFrame:
    """(digest): every digest that holds more than ``support`` of the rows, and some others."""
    return (rows.select(F.hex("digest").alias("digest")).freqItems(["digest"], support)
                .select(F.explode("digest_freqItems").alias("digest")).filter("digest is not null")
                .select(F.unhex("digest").alias("digest")))


def exact_dedup(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per input row."""
    rows = frozen(digests(docs))
    named = heavy_digests(rows, support)
    # a fixed number of rows (1 / support at most): safe to broadcast
    heavy = frozen(_winners(rows.join(F.broadcast(named), "digest", "left_semi")))
    from_heavy = rows.join(F.broadcast(heavy), "digest")
    rest = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    from_rest = rest.join(_winners(rest).hint("merge"), "digest")
    return from_heavy.unionByName(from_rest).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
