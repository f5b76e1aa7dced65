"""Sharding along a Hilbert curve over quantised metadata (native).

Each document becomes a cell of a small cube whose axes are language, source
and size; the cells are numbered along a Hilbert curve and the documents sorted
by that number. Cutting the sorted run into equal pieces gives shards whose
ranges are narrow in every axis at once, so a reader that filters on any of
them can skip most files.

Law ``rows``: shard counts differ by at most one. Sizes are quantised by half
octaves, names by their place in code-point order, the order in which Parquet keeps
a column's least and greatest value: a name's bucket is the share of rows with a
smaller name (equal depth), so shards hold narrow ranges of names and a filter on one
opens few shards besides those that hold it. The names are counted by one aggregate
over the two columns; a bucket is found from the least name of each bucket, at most
2^bits a column. A rerun gives the same shards whatever the partitioning.

Defined cases: NULL text has size 16 and the CRC of an empty text; a NULL name counts
as an empty one; ties on the curve are ordered by the CRC (equal texts of one
cell lie side by side), then doc_id; repeated rows get slots of their own; an
empty table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topiary.llm.common import dense_rank_all, frozen

SHARDS = 40
BITS = 5  # per axis


def hilbert_index(axes: list[Column], bits: int) -> Column:
    """Index of a cell (``bits`` bits on each axis) along the Hilbert curve,
    by Skilling's transform: undo the excess rotations, Gray-encode, interleave."""
    n = len(axes)
    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i"))
                      for b in range(bits - 1, 0, -1) for i in range(n)])

    def turn(x: Column, s: Column) -> Column:
        low = s["q"] - 1
        hit = F.get(x, s["i"]).bitwiseAND(s["q"]) != 0
        swap = F.get(x, F.lit(0)).bitwiseXOR(F.get(x, s["i"])).bitwiseAND(low)
        return F.transform(x, lambda v, j: (
            F.when((j == 0) & hit, v.bitwiseXOR(low))
             .when(~hit & ((j == 0) | (j == s["i"])), v.bitwiseXOR(F.when(s["i"] == 0, F.lit(0)).otherwise(swap)))
             .otherwise(v)))

    start = F.array(*[a.cast("int") for a in axes])
    turned = F.aggregate(steps, start, turn) if bits > 1 else start

    def finish(x: Column) -> Column:
        gray = reduce(lambda acc, i: F.concat(acc, F.array(F.element_at(acc, -1).bitwiseXOR(F.get(x, F.lit(i))))),
                      range(1, n), F.array(F.get(x, F.lit(0))))
        last = F.element_at(gray, -1)
        flip = reduce(lambda t, b: t.bitwiseXOR(
            F.when(last.bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0))),
            range(bits - 1, 0, -1), F.lit(0))
        return F.transform(gray, lambda v: v.bitwiseXOR(flip))

    final = F.element_at(F.transform(F.array(turned), finish), 1)  # the turned cell is computed once
    order = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(i).alias("i"))
                      for b in range(bits - 1, -1, -1) for i in range(n)])
    together = F.transform(F.array(final), lambda x: F.aggregate(
        order, F.lit(0).cast("long"),
        lambda h, s: h * 2 + F.when(F.get(x, s["i"]).bitwiseAND(F.element_at(
            F.array(*[F.lit(1 << b) for b in range(bits)]), s["b"] + 1)) != 0, 1).otherwise(0)))
    return F.element_at(together, 1)


def half_octave(size: Column, bits: int) -> Column:
    """Size from 16 bytes up in steps of a factor sqrt(2), the last bucket open."""
    return F.least(F.floor(2 * F.log2(F.greatest(size, F.lit(16)) / 16)), F.lit((1 << bits) - 1)).cast("int")


def bucket_starts(counts: DataFrame, column: str, bits: int) -> list[tuple[str, int]]:
    """(least name, bucket) of each bucket that holds rows: at most 2^bits.
    ``counts`` is (column, n), a name in any number of rows."""
    names = counts.groupBy(F.col(column).alias("name")).agg(F.sum("n").alias("n"))
    # running sums per range of names, then the ranges' own: no window over all names
    ranged = frozen(names.repartitionByRange("name").withColumn("part", F.spark_partition_id()))
    parts = ranged.groupBy("part").agg(F.sum("n").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    total = ranged.agg(F.sum("n")).first()[0] or 0
    at = (ranged.withColumn("own", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(F.broadcast(parts), "part")
                .withColumn("bucket", F.expr(f"((base + own) * {1 << bits}L) div {max(total, 1)}L")))
    found = at.groupBy("bucket").agg(F.min("name").alias("name")).collect()
    return sorted((r["name"], r["bucket"]) for r in found)


def name_bucket(name: Column, starts: list[tuple[str, int]]) -> Column:
    """The bucket of the last start that is not above the name; no table, no buckets."""
    pairs = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(b).alias("b")) for s, b in starts or [("", 0)]])
    return F.array_max(F.transform(F.filter(pairs, lambda p: p["s"] <= name), lambda p: p["b"])).cast("int")


def shard(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, curve), one row per row."""
    named = docs.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source")})
    counts = frozen(named.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")))
    text = F.coalesce(F.col("text"), F.lit(""))
    cells = named.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        name_bucket(F.col("lang"), bucket_starts(counts, "lang", bits)).alias("x"),
        name_bucket(F.col("source"), bucket_starts(counts, "source", bits)).alias("y"))
    cells = cells.withColumn("z", half_octave(F.col("size"), bits))
    # written first: the range exchange of the ranking samples these rows, not the texts
    keyed = frozen(cells.select("doc_id", "size", "text_crc32", hilbert_index([F.col("x"), F.col("y"), F.col("z")], bits).alias("curve")))
    ranked = dense_rank_all(keyed, ["curve", "text_crc32", "doc_id"], "rank")
    total = keyed.count()
    # exact integers: shard s takes ranks from ceil(s * total / shards) on
    first = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    return (ranked.withColumn("shard", F.expr(f"rank * {shards} div {max(total, 1)}L").cast("int"))
                  .withColumn("slot", (F.col("rank") - first).cast("long"))
                  .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"), "curve"))
