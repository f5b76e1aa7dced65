"""Near-duplicate groups: banded MinHash, sequential Bayesian verification.

A document's set is its distinct shingles of ``n`` words. Two documents are
linked when the Jaccard similarity of their full sets is at least 4/5; a group
is what links reach.

1. Documents with equal sets become one representative (the smallest doc_id, or
   a number above all of them where that id has several sets); copies never
   enter the candidate search, however many there are.
2. Representatives get MinHash signatures of BANDS x ROWS values. Those that
   agree on a whole band are candidates; a pair at similarity 0.8 is missed by
   all bands with probability (1 - 0.8**ROWS)**BANDS, about 2e-7.
3. Candidates are verified sequentially: after each batch of signature values
   the posterior probability (uniform prior) that the similarity reaches the
   threshold is bounded, and the pair is dropped as soon as it falls below
   MISS. With the bounds that follow, a pair at similarity 0.8 is dropped with
   probability 8.7e-7 (``prune_rate``). Survivors are confirmed on their full sets.
4. Pairs are never listed per bucket. Round 1 compares each member of a bucket
   with one centre. Buckets whose members still belong to several groups are
   taken up again: their members outside the bucket's main group are compared,
   in blocks of fixed size inside tasks, with all members of other groups; a pair
   is taken up in the first band it shares only (by the 64-bit band keys that make the buckets), and not at all if the sizes of
   its sets rule out the threshold. Round 2 confirms each one's best partners first, which unites large families
   cheaply; round 3 confirms every survivor that is left. So no link between
   different groups is left out, and no more pairs are written than needed.

Groups are found by alternating minimum propagation over the confirmed links
(DataFrames only; nothing is collected).

Defined cases: NULL and empty texts have an empty set and are linked with
nothing; texts with fewer than ``n`` words have one shingle, the whole
sequence; rows that share a doc_id are one document for the grouping (their
texts' groups unite through it, each text being compared by its own set); rows without a doc_id stand alone and stay; an
empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topiary.llm.bloom import bloom_of
from topiary.llm.common import dense_rank_all, frozen
from topiary.llm.textbytes import NON_SPACE, Words, blocks, mixed, shingles
from topiary.session import small_batches

BANDS, ROWS = 29, 4
#: Survivors must reach NUMERATOR / DENOMINATOR.
NUMERATOR, DENOMINATOR = 80, 100
#: Posterior probability of a true link below which a pair is dropped; what it
#: costs a pair at the threshold is ``prune_rate``, which is to stay below 1e-6.
MISS = 2e-7
BATCH = 29  # signature values looked at per step
BLOCK_ROWS = 2048  # members of a bucket per block
BEST = 3  # partners confirmed per member and block in round 2

_SALT = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def set_key(s: np.ndarray) -> bytes:
    """128 bits that name a set of shingles."""
    scattered = mixed(s ^ np.uint64(len(s)))
    return (int(scattered.sum(dtype=np.uint64)).to_bytes(8, "big")
            + int(np.bitwise_xor.reduce(mixed(scattered))).to_bytes(8, "big"))


def doc_shingles(w: Words, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row of the block."""
    runs = shingles(w.hash, n)
    out = []
    for row in range(len(w.first) - 1):
        a, b = int(w.first[row]), int(w.first[row + 1])
        if b - a >= n:
            out.append(np.unique(runs[a:b - n + 1]))
        elif b > a:
            out.append(shingles(w.hash[a:b], b - a))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def minima(s: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the set."""
    least = np.full(len(_SALT), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(s), 512):
        np.minimum(least, (s[i:i + 512, None] * _SALT).min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One bucket id per band; the band's number is part of it."""
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        h = mixed(h ^ column)
    return h


def posterior_bounds(threshold: float, miss: float) -> list[int]:
    """Least agreements after each batch for which P(similarity >= threshold)
    is still at least ``miss``, for a uniform prior: Beta(1 + m, 1 + n - m)."""
    grid = (np.arange(20000) + 0.5) / 20000
    log_s, log_d, above = np.log(grid), np.log1p(-grid), grid >= threshold
    bounds = []
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        for m in range(n + 1):
            log_p = m * log_s + (n - m) * log_d
            p = np.exp(log_p - log_p.max())
            if p[above].sum() / p.sum() >= miss:
                bounds.append(m)
                break
    return bounds


BOUNDS = posterior_bounds(NUMERATOR / DENOMINATOR, MISS)


def prune_rate(similarity: float, bounds: list[int]) -> float:
    """Probability that a pair of that similarity is dropped by the bounds."""
    step = np.array([math.comb(BATCH, k) * similarity ** k * (1 - similarity) ** (BATCH - k) for k in range(BATCH + 1)])
    agree, lost = np.ones(1), 0.0
    for least in bounds:
        agree = np.convolve(agree, step)
        lost += agree[:least].sum()
        agree[:least] = 0
    return float(lost)


def survivors(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Agreements of rows of ``a`` and ``b`` (signatures), -1 once pruned."""
    agree = np.zeros(len(a), dtype=np.int32)
    alive = np.arange(len(a))
    for k, least in enumerate(BOUNDS):
        part = slice(k * BATCH, (k + 1) * BATCH)
        agree[alive] += (a[alive, part] == b[alive, part]).sum(axis=1, dtype=np.int32)
        dead = agree[alive] < least
        agree[alive[dead]] = -1
        alive = alive[~dead]
    return agree


def _sketch(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, n_shingles, key, sig, bands) per row; ``key`` names the set, sig
    holds 16 bits of each minimum (fewer bits can only hide disagreement)."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in blocks(batch.column(1)):
                sets = doc_shingles(Words(data, offsets, NON_SPACE), n)
                key, sig, bands = [], [], []
                for s in sets:
                    if not len(s):
                        key.append(None)
                        sig.append(None)
                        bands.append(None)
                        continue
                    key.append(set_key(s))
                    least = minima(s)
                    sig.append((mixed(least) & np.uint64(0xFFFF)).astype("<u2").tobytes())
                    bands.append(band_keys(least).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(key, pa.binary()), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "key", "sig", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        sketch, "doc_id long, n_shingles long, key binary, sig binary, bands array<long>")


def _sets(docs: DataFrame, n: int, bloom) -> DataFrame:
    """(id, set, key): the shingle hashes of each document whose id the filter
    knows, as bytes, and the set's key."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(bloom.value.knows(batch.column(0))))
            for first, end, data, offsets in blocks(batch.column(1)):
                found = doc_shingles(Words(data, offsets, NON_SPACE), n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array([s.astype("<u8").tobytes() for s in found], pa.binary()),
                     pa.array([set_key(s) if len(s) else None for s in found], pa.binary())], ["id", "set", "key"])

    return docs.mapInArrow(sets, "id long, set binary, key binary")


def _screen(pairs: DataFrame) -> DataFrame:
    """(x, y) of those rows (x, y, sx, sy) whose signatures survive."""
    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype="<u2").reshape(-1, BANDS * ROWS) for k in (2, 3))
            yield batch.filter(pa.array(survivors(a, b) >= 0)).select([0, 1])

    return pairs.select("x", "y", "sx", "sy").mapInArrow(screen, "x long, y long")


def _confirm(pairs: DataFrame) -> DataFrame:
    """(x, y) of those rows (x, y, a, b) whose full sets are similar enough."""
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                a, b = (np.frombuffer(v.as_buffer(), dtype="<u8") for v in (a, b))
                both = len(np.intersect1d(a, b, assume_unique=True))
                good.append(DENOMINATOR * both >= NUMERATOR * (len(a) + len(b) - both))
            yield batch.filter(pa.array(good, pa.bool_())).select([0, 1])

    return pairs.select("x", "y", "a", "b").mapInArrow(confirm, "x long, y long")


def _sets_of(needed: DataFrame, docs: DataFrame, n: int, extra: DataFrame | None) -> DataFrame:
    """(id, set) of the representatives named in ``needed`` (rep).

    A Bloom filter of their doc_ids picks the texts where they are read; sets are
    made of those only, and the exact join moves nothing else. A representative is a doc_id with one set only, or one of ``extra`` (rep,
    doc_id, key): a number for one set of a doc_id that has several."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ids, own = needed.select(F.col("rep").alias("id")), None
    if extra is not None:
        own = frozen(extra.join(needed, "rep", "left_semi"))
        ids = frozen(ids.join(own.select(F.col("rep").alias("id")), "id", "left_anti"))
    # each set once, dealt by id; the same layout serves the exact join
    sets = _sets(texts, n, bloom_of(ids)).groupBy("id").agg(F.min("set").alias("set")).join(ids, "id", "left_semi")
    if own is not None:
        several = _sets(texts, n, bloom_of(frozen(own.select("doc_id").distinct())))
        named = several.withColumnRenamed("id", "doc_id").join(own, ["doc_id", "key"])
        sets = sets.unionByName(named.groupBy(F.col("rep").alias("id")).agg(F.min("set").alias("set")))
    return frozen(sets)


#: Members of a block of the confirmation: their full sets are held together.
BLOCK_SETS = 256


def _confirmed(asked: DataFrame, docs: DataFrame, n: int, extra: DataFrame | None) -> DataFrame:
    """The confirmed ones of the candidate pairs given as (q, partners): x, y.

    The full sets of all members go to blocks, each set once; each query's set
    goes to the blocks of its partners and streams past the members there. So
    what is moved grows with members and queries, not with their pairs."""
    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            new = {*batch.column(0).to_pylist(), *batch.column(1).flatten().to_pylist()} - seen
            seen |= new
            yield pa.RecordBatch.from_arrays([pa.array(sorted(new), pa.int64())], ["rep"])

    needed = frozen(asked.mapInArrow(ids, "rep long").distinct())
    sets, blocks_ = _sets_of(needed, docs, n, extra), -(-needed.count() // BLOCK_SETS) or 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict = {}
            for q, partners in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for p in partners:
                    out.setdefault((p % blocks_, q), []).append(p)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in out], pa.int64()), pa.array([k[1] for k in out], pa.int64()),
                                              pa.array(list(out.values()), pa.list_(pa.int64()))], ["block", "id", "partners"])

    queries = asked.mapInArrow(deal, "block long, id long, partners array<long>").join(sets, "id")
    cols = ["block", "asks", "id", "set", "partners"]
    members = sets.withColumns({"block": F.pmod("id", F.lit(blocks_)), "asks": F.lit(False), "partners": F.lit(None).cast("array<long>")})
    rows = members.select(cols).unionByName(queries.withColumn("asks", F.lit(True)).select(cols))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, {}
        for batch in batches:
            out = []
            for at, asks, i, s, partners in zip(*(batch.column(c) for c in cols), strict=True):
                if block != at.as_py():
                    block, held = at.as_py(), {}
                own = np.frombuffer(s.as_buffer(), dtype="<u8")
                if not asks.as_py():
                    held[i.as_py()] = own.copy()
                    continue
                for p in partners.as_py():
                    other = held[p]
                    both = len(np.intersect1d(own, other, assume_unique=True))
                    if DENOMINATOR * both >= NUMERATOR * (len(own) + len(other) - both):
                        out.append((min(p, i.as_py()), max(p, i.as_py())))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], ["x", "y"])

    dealt = rows.repartition("block").sortWithinPartitions("block", "asks")
    return frozen(dealt.mapInArrow(verify, "x long, y long").distinct())


def _linked(pairs: DataFrame, docs: DataFrame, reps: DataFrame, n: int, extra: DataFrame | None) -> DataFrame:
    """The confirmed ones of candidate pairs (x, y), x < y, each once."""
    sig = reps.select(F.col("rep"), "sig")
    pairs = frozen(_screen(pairs.join(sig.select(F.col("rep").alias("x"), F.col("sig").alias("sx")), "x")
                                .join(sig.select(F.col("rep").alias("y"), F.col("sig").alias("sy")), "y")))
    needed = frozen(pairs.select(F.explode(F.array("x", "y")).alias("rep")).distinct())
    sets = _sets_of(needed, docs, n, extra)
    both = (pairs.join(sets.select(F.col("id").alias("y"), F.col("set").alias("b")), "y")
                 .join(sets.select(F.col("id").alias("x"), F.col("set").alias("a")), "x"))
    return frozen(_confirm(both))


def met_before(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` share a bucket with ``b``: bucket ids of the same earlier bands."""
    return (a == b).any(axis=1)


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """The lists as rows, cut to the shortest (they differ only if buckets of two bands got one id)."""
    ends = np.cumsum(lists.value_lengths().to_numpy())
    size = int(np.diff(ends, prepend=0).min())
    return lists.flatten().to_numpy()[np.concatenate([[0], ends[:-1]])[:, None] + np.arange(size)]


#: Links to a task while groups are found.
TASK_LINKS = 20_000


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id each linked id reaches, by alternating
    large-star and small-star steps (logarithmic in practice). Partitions follow
    the number of links, which is far below that of documents."""
    def state(e: DataFrame) -> tuple:
        both = F.xxhash64("u", "v")
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(both), F.bit_xor(F.xxhash64(both))).first())

    edges = frozen(links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).filter("u <> v").distinct())
    was = state(edges)
    parts = -(-was[0] // TASK_LINKS) or 1  # the steps never add links
    edges = edges.coalesce(parts)
    while True:
        ways = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ways.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        edges = frozen(small.coalesce(parts))
        now = state(edges)
        if now == was:
            return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id")
        was = now


def _compared(rows: DataFrame, best: int | None) -> DataFrame:
    """(q, partners): surviving pairs of each (bucket, block, qblock), its queries
    against its members of other groups; at most ``best`` partners of a query if given."""
    width = BANDS * ROWS

    def group(ids, groups, asks, sigs, sizes, earlier):
        out = []
        members = np.flatnonzero(~asks)
        m, n, of, name, met = sigs[members], sizes[members], groups[members], ids[members], earlier[members]
        for q in np.flatnonzero(asks):
            # another group, and sizes that allow the threshold
            fits = ((of != groups[q]) & (DENOMINATOR * np.minimum(n, sizes[q]) >= NUMERATOR * np.maximum(n, sizes[q])))
            others = np.flatnonzero(fits)
            others = others[~met_before(met[others], earlier[q])]  # those pairs were taken up there
            agree = survivors(np.broadcast_to(sigs[q], (len(others), width)), m[others])
            found = np.flatnonzero(agree >= 0)
            if best is not None and len(found) > best:
                found = found[np.argsort(-agree[found], kind="stable")[:best]]
            if len(found):
                out.append((ids[q], name[others[found]].tolist()))
        return out

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done():
            if not held:
                return []
            whole = pa.Table.from_batches(held)
            sigs = np.frombuffer(b"".join(whole.column("sig").to_pylist()), dtype="<u2").reshape(-1, width)
            return group(*(whole.column(c).to_numpy() for c in ("rep", "component", "asks")), sigs,
                         whole.column("n_shingles").to_numpy(), _matrix(whole.column("earlier").combine_chunks()))

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("bucket", "block", "qblock")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            pairs = []
            for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if a == b:
                    continue
                if key is not None and tuple(keys[a]) != key:
                    pairs += done()
                    held = []
                key = tuple(keys[a])
                held.append(batch.slice(a, b - a))
            yield made(pairs)
        yield made(done())

    def made(pairs):
        return pa.RecordBatch.from_arrays([pa.array([int(p[0]) for p in pairs], pa.int64()),
                                           pa.array([p[1] for p in pairs], pa.list_(pa.int64()))], ["q", "partners"])

    cols = ["bucket", "block", "qblock", "rep", "component", "asks", "n_shingles", "sig", "earlier"]
    return (rows.select(*cols).repartition("bucket", "block", "qblock").sortWithinPartitions("bucket", "block", "qblock")
                .mapInArrow(compared, "q long, partners array<long>"))


def _open_rows(members: DataFrame, labels: DataFrame, reps: DataFrame) -> DataFrame:
    """The rows of buckets of three or more whose members belong to several
    groups, dealt into blocks: members once per block of queries, queries (those
    outside the largest group) once per block of members."""
    at = members.filter("n >= 3").join(labels.withColumnRenamed("id", "rep"), "rep", "left") \
                .withColumn("component", F.coalesce("component", "rep"))
    sizes = at.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("k"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("k", "component")).alias("main"), F.sum("k").alias("n"),
                                       F.count(F.lit(1)).alias("groups")).filter("groups > 1")
    main = main.select("bucket", F.col("main.component").alias("most"),
                       F.ceil(F.col("n") / BLOCK_ROWS).alias("m_blocks"),
                       F.ceil((F.col("n") - F.col("main.k")) / BLOCK_ROWS).alias("q_blocks"))
    rows = at.drop("n", "center").join(main, "bucket").join(reps.select("rep", "n_shingles", "sig", "bands"), "rep") \
             .withColumn("earlier", F.slice("bands", F.lit(1), F.col("band"))).drop("bands")
    spread = F.xxhash64("rep", F.lit(7))
    every = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    members_ = rows.withColumn("block", F.pmod(spread, F.col("m_blocks"))) \
                   .withColumn("qblock", F.explode(every(F.col("q_blocks")))).withColumn("asks", F.lit(False))
    queries_ = rows.filter("component <> most").withColumn("qblock", F.pmod(spread, F.col("q_blocks"))) \
                   .withColumn("block", F.explode(every(F.col("m_blocks")))).withColumn("asks", F.lit(True))
    cols = ["bucket", "block", "qblock", "rep", "component", "asks", "n_shingles", "sig", "earlier"]
    return members_.select(*cols).unionByName(queries_.select(*cols))


def _numbered(known: DataFrame, reps: DataFrame) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """``reps`` with ``rep``; the sets (rep, doc_id, key) that got a number of
    their own, and the links of doc_ids with their sets, both None if no doc_id
    has several sets. The numbers lie above all doc_ids, and each is linked with
    its doc_id, so a group's least id is always a doc_id."""
    several = frozen(known.groupBy("doc_id").agg(F.min("key").alias("a"), F.max("key").alias("b")).filter("a < b").select("doc_id"))
    if several.isEmpty():
        return reps.withColumnRenamed("doc_id", "rep"), None, None
    apart = reps.select("key", "doc_id").join(several, "doc_id", "left_semi")
    top = known.agg(F.max("doc_id")).first()[0]
    extra = frozen(dense_rank_all(apart, ["key"], "number").select("key", "doc_id", (F.col("number") + F.lit(top) + 1).alias("rep")))
    if top + extra.count() >= 1 << 63:
        raise ValueError("no room above the largest doc_id to number the sets of repeated doc_ids")
    reps = frozen(reps.join(extra.select("key", "rep"), "key", "left").withColumn("rep", F.coalesce("rep", "doc_id")).drop("doc_id"))
    pairs = known.select("doc_id", "key").join(several, "doc_id", "left_semi").distinct()
    return reps, extra, frozen(pairs.join(reps.select("key", "rep"), "key").select(F.col("doc_id").alias("x"), F.col("rep").alias("y")))


def near_groups(docs: DataFrame, n: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``."""
    small_batches(docs.sparkSession)
    rows = frozen(_sketch(docs, n))
    known = rows.filter("key is not null and doc_id is not null")
    reps = frozen(known.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.any_value("n_shingles").alias("n_shingles"),
                                           F.any_value("sig").alias("sig"), F.any_value("bands").alias("bands")))
    reps, extra, same = _numbered(known, reps)
    buckets = reps.select("rep", F.posexplode("bands").alias("band", "bucket"))
    centers = buckets.groupBy("bucket").agg(F.min("rep").alias("center"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = frozen(buckets.join(centers, "bucket"))
    star = members.filter("rep <> center").select(F.col("center").alias("x"), F.col("rep").alias("y")).distinct()
    links = _linked(star, docs, reps, n, extra)
    if same is not None:  # rows that share a doc_id are one document
        links = links.unionByName(same)
    labels = frozen(components(links))
    for best in (BEST, None):
        asked = frozen(_compared(_open_rows(members, labels, reps), best))
        if asked.isEmpty():
            break
        links = links.unionByName(_confirmed(asked, docs, n, extra))
        labels = frozen(components(links))
    named = rows.join(reps.select("key", "rep"), "key", "left").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return named.select("doc_id", "n_shingles", component.alias("component_id")) \
                .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def brute_force(docs: list[tuple], n: int = 5) -> dict:
    """{doc_id: (n_shingles, component_id)} for small tables, by all pairs."""
    import re
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for doc, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets[doc] = {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and DENOMINATOR * both >= NUMERATOR * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


def near_dedup(docs: DataFrame, n: int = 5) -> DataFrame:
    """The rows of ``docs`` that stay: one per group (of rows that share a
    doc_id, the one with the least text); rows without a doc_id stay."""
    dropped = frozen(near_groups(docs, n).filter("not kept").select("doc_id").distinct())
    left = docs.join(dropped, "doc_id", "left_anti")
    repeated = frozen(docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("__n"))
                          .filter("__n > 1").select("doc_id"))
    if repeated.isEmpty():
        return left
    first = Window.partitionBy("doc_id").orderBy("text", *[c for c in docs.columns if c not in ("doc_id", "text")])
    once = left.join(repeated, "doc_id", "left_semi").withColumn("__rn", F.row_number().over(first)).filter("__rn = 1").drop("__rn")
    return left.join(repeated, "doc_id", "left_anti").unionByName(once).select(*docs.columns)
