"""Suffix-array dedup: removes every byte inside a string of LENGTH bytes that
also starts anywhere else in the collection.

A text has as many strings of LENGTH bytes as bytes, so only those that can
repeat go into suffix arrays:

1. Each string has an anchor, the left-most K-gram of least hash in it. Equal
   strings have equal anchors at equal places, and neighbouring strings mostly
   share theirs: a text has about one anchor per 50 bytes, each with the run
   of strings that it owns. Anchors that occur at one place only are dropped
   (an aggregate and a join on the hash, both of narrow rows).
2. For the others, the run's bytes (a snippet) are cut from the text; equal
   snippets are kept once, marked as repeated.
3. Snippets are dealt by anchor into shards of bounded size. A shard's suffix
   array is built by recursive induced sorting (``induced_sort``); neighbouring
   owned suffixes whose common prefix is a whole string mark repeated strings.
   An anchor whose snippets are one, or all marked as repeated, needs none.
4. An anchor with very many different snippets (the edge of a passage that very
   many texts share) is split first: its strings are dealt by their common core
   in sub-runs of 16 strings, and if that is still too many, one by one. Equal
   strings have equal cores, so nothing is lost, and no shard grows without bound.
5. Repeated strings are carried back to the places of their snippets; each
   text is cut once.

Exact copies of a whole text count through steps 1-3 as one text; having a copy,
they lose all bytes if they have LENGTH or more.

Defined cases: NULL text is empty; texts shorter than LENGTH keep everything and
match nothing; a repeated row is a copy; rows without a doc_id are treated like
others; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiary.llm.bloom import bloom_of, known_rows
from topiary.llm.common import frozen
from topiary.llm.induced_sort import CAP, Space, suffix_array
from topiary.llm.textbytes import _Powers, blocks, mixed
from topiary.session import work_dir

LENGTH = CAP
K = 96
WIDTH = LENGTH - K + 1  # K-grams in a string
#: Bytes of snippets that make a shard; a shard ends with its last anchor.
SHARD_BYTES = 2 << 20
#: Different snippets of one anchor beyond which it is split.
SPLIT = 256


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first owned string, number of owned strings, anchor's place) of a text's anchors."""
    n = len(data) - K + 1
    m = len(data) - LENGTH + 1
    up, down = _Powers.of(len(data) + 1)
    run = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=run[1:])
    h = mixed((run[K:] - run[:-K]) * down[:n])
    # least value of each window from the least of a block's end and the next block's beginning
    most = np.iinfo(np.uint64).max
    b = np.concatenate([h, np.full((-n) % WIDTH, most)]).reshape(-1, WIDTH)
    place = np.arange(b.size).reshape(b.shape)
    pre = np.minimum.accumulate(b, axis=1)
    new = np.ones(b.shape, dtype=bool)
    new[:, 1:] = b[:, 1:] < pre[:, :-1]
    pre_at = np.maximum.accumulate(np.where(new, place, 0), axis=1).ravel()
    suf = np.minimum.accumulate(b[:, ::-1], axis=1)[:, ::-1]
    new[:, -1] = True
    new[:, :-1] = b[:, :-1] <= suf[:, 1:]
    suf_at = np.minimum.accumulate(np.where(new, place, b.size)[:, ::-1], axis=1)[:, ::-1].ravel()
    pre, suf = pre.ravel(), suf.ravel()
    at = np.where(suf[:m] <= pre[WIDTH - 1:WIDTH - 1 + m], suf_at[:m], pre_at[WIDTH - 1:WIDTH - 1 + m])
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    own = np.diff(np.append(first, m))
    return h[at[first]], first, own, at[first]


def _digest(text) -> F.Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


#: A place is one number: first owned string, number of owned strings, anchor's offset in the first.
_OWN, _AT = 1 << 16, 1 << 8


def _packed(lo, own, at):
    return lo * _OWN + own * _AT + at


def _anchor_lists(docs: DataFrame, copies) -> DataFrame:
    """(d, id, maybe, places: hash, place): the anchors of each text; d names the
    text; ``maybe`` is false where the filter ``copies`` rules out a further copy."""
    kind = pa.list_(pa.struct([("h", pa.int64()), ("p", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in blocks(batch.column(0)):
                parts = [anchors(data[offsets[r]:offsets[r + 1]]) for r in range(end - first)]
                sizes = [len(p[0]) for p in parts]
                fields = [np.concatenate([p[k] for p in parts]) for k in range(4)]
                flat = pa.StructArray.from_arrays(
                    [pa.array(fields[0].view(np.int64)), pa.array(_packed(fields[1], fields[2], fields[3] - fields[1]), pa.int64())], ["h", "p"])
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                own = [batch.column(c).slice(first, end - first) for c in (1, 2)]
                maybe = pa.array(copies.value.knows(own[1]))
                yield pa.RecordBatch.from_arrays([*own, maybe, pa.ListArray.from_arrays(pa.array(ends), flat).cast(kind)], ["d", "id", "maybe", "places"])

    long_ones = docs.filter(F.octet_length("text") >= LENGTH).select("text", "d", "id")
    return long_ones.mapInArrow(find, "d binary, id long, maybe boolean, places array<struct<h: long, p: long>>")


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Smaller batches, where rows become Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _pieces(texts: DataFrame) -> DataFrame:
    """From (d, text, places): (n, lo, key, own, at, sid, bytes), one per place;
    n is the text's number; ``bytes`` only where this task meets the snippet first."""
    schema = "n long, lo long, key long, own int, at int, sid binary, bytes binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in _slices(batches):
            out = []
            for n, text, places in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                for x in places:
                    h, lo, own, at = x["h"], x["p"] // _OWN, x["p"] % _OWN // _AT, x["p"] % _AT
                    piece = data[lo:lo + own + LENGTH - 1]
                    sid = hashlib.blake2b(piece, digest_size=16, key=h.to_bytes(8, "big", signed=True)).digest()
                    fresh = sid not in seen
                    if fresh:
                        if len(seen) > 200_000:
                            seen.clear()
                        seen.add(sid)
                    out.append((n, lo, h, own, at, sid, piece if fresh else None))
            yield _batch(out, ("n", "lo", "key", "own", "at", "sid", "bytes"),
                         (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))

    return texts.select("n", "text", "places").mapInArrow(cut, schema)


def _batch(rows: list, names, kinds) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], list(names))


def _split(snips: DataFrame, run: int) -> DataFrame:
    """Cuts snippets into sub-runs of at most ``run`` strings, keyed by the core
    that the sub-run's strings share: (sid, off, key, own, at, sub, bytes, twice)."""
    schema = "sid binary, off int, key long, own int, at int, sub binary, bytes binary, twice boolean"

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            out = []
            for sid, key, own, at, data, twice in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                for q in range((at - own + 1) // run, at // run + 1):  # strings whose anchor is run*q .. run*q+run-1 bytes in
                    a, b = max(0, at - run * q - run + 1), min(own, at - run * q + 1)
                    core = data[at - run * q:at - run * q - run + 1 + LENGTH]
                    mark = hashlib.blake2b(core, digest_size=8, key=f"{key}:{q}:{run}".encode()).digest()
                    piece = data[a:b + LENGTH - 1]
                    sub = hashlib.blake2b(piece, digest_size=16, key=mark + (at - a).to_bytes(2, "big")).digest()
                    out.append((sid, a, int.from_bytes(mark, "big", signed=True), b - a, at - a, sub, piece, twice))
            yield _batch(out, ("sid", "off", "key", "own", "at", "sub", "bytes", "twice"),
                         (pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.bool_()))

    return snips.select("sid", "key", "own", "at", "bytes", "twice").mapInArrow(split, schema)


def repeated_in_shard(pieces: list[bytes], own: list[int], twice: list[bool], at: list[int], limit: int | None = None) -> list[list[tuple[int, int]]]:
    """For each snippet, the runs (a, b) of its owned strings that repeat within the shard. Every
    owned string holds the whole anchor, ``at`` bytes into the snippet, so the anchor's K bytes are put down as one symbol
    (the same for the same bytes) and a string has WIDTH symbols."""
    anchor: dict[bytes, int] = {}
    marks = np.array([anchor.setdefault(p[i:i + K], len(anchor) + 257) for p, i in zip(pieces, at, strict=True)])
    sizes = np.array([len(p) - K + 1 for p in pieces])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    joined = np.frombuffer(b"\0".join([p[:i] + p[i + K - 1:] for p, i in zip(pieces, at, strict=True)]) + b"\0", dtype=np.uint8)
    text = joined.astype(np.uint16) + np.uint16(1)
    text[starts + sizes] = 0
    text[starts + np.array(at)] = marks
    weight = np.zeros(len(text), dtype=np.uint8)
    for first, n, t in zip(starts, own, twice, strict=True):
        weight[first:first + n] = 2 if t else 1
    with Space() if limit is None else Space(limit) as space:
        order, lcp = suffix_array(text, space)
        group = np.cumsum(lcp < WIDTH)
        total = np.bincount(group, weights=weight[order])
        marked = np.zeros(len(text) + 1, dtype=bool)
        marked[order[(total[group] >= 2) & (weight[order] > 0)]] = True
    # owned runs are never adjacent: each has WIDTH - 1 further symbols behind it
    edges = np.flatnonzero(marked[1:] != marked[:-1]) + 1
    edges = np.append(0, edges) if marked[0] else edges
    which = np.searchsorted(starts, edges[::2], side="right") - 1
    out: list[list[tuple[int, int]]] = [[] for _ in pieces]
    for k, a, b in zip(which.tolist(), (edges[::2] - starts[which]).tolist(), (edges[1::2] - starts[which]).tolist(), strict=True):
        out[k].append((a, b))
    return out


def shard_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sid, a, b) from (key, sid, bytes, own, twice, at) in the order of the keys."""
    held, size, known = [], 0, []

    def done():
        rows = list(known)
        if held:
            found = repeated_in_shard(*([r[k] for r in held] for k in (2, 3, 4, 5)))
            rows += [(r[1], a, b) for r, runs in zip(held, found, strict=True) for a, b in runs]
        return _batch(rows, ("sid", "a", "b"), (pa.binary(), pa.int64(), pa.int64()))

    rows = (row for batch in _slices(batches, 4096) for row in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True))
    for _, own in groupby(rows, key=lambda r: r[0]):
        own = list(own)
        if len(own) == 1 or all(r[4] for r in own):
            # nothing to compare: a string is found under its own anchor only, so those of a single
            # snippet repeat if the snippet does, and those of snippets that all do repeat anyway
            known += [(r[1], 0, r[3]) for r in own if r[4]]
        else:
            held += own
            size += sum(len(r[2]) for r in own)
        if size >= SHARD_BYTES or len(known) >= 1 << 16:
            yield done()
            held, size, known = [], 0, []
    yield done()


def _repeats(snips: DataFrame) -> DataFrame:
    """(sid, a, b): runs of repeated strings of the snippets, by suffix arrays of
    shards; ``snips`` are dealt by key."""
    return snips.select("key", "sid", "bytes", "own", "twice", "at").sortWithinPartitions("key") \
                .mapInArrow(shard_repeats, "sid binary, a long, b long")


def _cut(texts: DataFrame) -> DataFrame:
    """From (d, text, runs): (d, n_removed, n_spans, kept_sha256)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            out = []
            for d, text, runs in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                kept, upto, removed, spans = hashlib.sha256(), 0, 0, 0
                a = b = None
                for r in [*sorted((r["a"], r["b"] + LENGTH - 1) for r in runs), (len(data) + 1, len(data) + 1)]:
                    if a is not None and r[0] > b:
                        kept.update(data[upto:a])
                        upto, removed, spans = b, removed + b - a, spans + 1
                        a = None
                    if a is None:
                        a, b = r
                    else:
                        b = max(b, r[1])
                kept.update(data[upto:])
                out.append((d, removed, spans, kept.hexdigest()))
            yield _batch(out, ("d", "n_removed", "n_spans", "kept_sha256"), (pa.binary(), pa.int64(), pa.int64(), pa.string()))

    return texts.select("d", "text", "runs").mapInArrow(cut, "d binary, n_removed long, n_spans long, kept_sha256 string")


def _picked(docs: DataFrame, one: DataFrame) -> DataFrame:
    """The texts of ``docs`` (id, text) named by (d, id) of ``one``, with its other columns."""
    near = known_rows(docs, "id", bloom_of(one.select("id")))
    return near.withColumn("d", _digest(F.col("text"))).join(one, ["d", "id"])


def suffix_dedup(docs: DataFrame, split: int = SPLIT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = frozen(docs.select("doc_id", "id", _digest(F.col("text")).alias("d"), F.octet_length("text").cast("long").alias("n_bytes")))
    docs = docs.select("id", "text")
    texts = rows.groupBy("d").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))

    # anchors, one list per text; a text's copies are left out from here on
    extra = frozen(rows.join(texts.select("d", F.col("id").alias("first")), "d").filter("id <> first").select("d", "id").distinct())
    path = work_dir(spark, "anchors")
    named = docs.withColumn("d", _digest(F.col("text")))
    _anchor_lists(named, bloom_of(extra.select("id"))).withColumn("n", F.monotonically_increasing_id()).write.parquet(path)
    lists = spark.read.parquet(path)
    first = lists.filter("maybe").join(extra, ["d", "id"], "left_anti").select("n", "places")
    place = lists.filter("not maybe").select("n", "places").unionByName(first).select("n", F.inline("places"))
    # counted and frozen first: the join with nothing else in its stage is one whose large partitions Spark splits
    repeated = frozen(place.groupBy("h").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("h"))
    kept = place.join(repeated, "h").groupBy("n").agg(F.collect_list(F.struct("h", "p")).alias("places"))
    one = frozen(kept.join(lists.select("n", "d", "id"), "n"))
    path = work_dir(spark, "pieces")
    _pieces(_picked(docs, one)).write.parquet(path)
    pieces = spark.read.parquet(path)

    # equal snippets once, dealt by anchor: one shuffle of their bytes
    which = F.xxhash64("n", "lo")
    once = [F.min("own").alias("own"), F.min("at").alias("at"), (F.min(which) != F.max(which)).alias("twice")]
    kinds = frozen(pieces.groupBy("key", "sid").agg(*once))  # without their bytes
    many = frozen(kinds.groupBy("key").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > split).select("key"))
    hot = not many.isEmpty()
    # what is dealt is a row per snippet and the bytes that some tasks hold of it, not a row per place
    bodies = pieces.filter("bytes is not null").select("key", "sid", "bytes")
    cols = ["key", "sid", "own", "at", "twice", "bytes"]
    dealt = kinds.withColumn("bytes", F.lit(None).cast("binary")).select(cols).unionByName(
        bodies.withColumns({"own": F.lit(None).cast("int"), "at": F.lit(None).cast("int"), "twice": F.lit(None).cast("boolean")}).select(cols))
    plain = dealt.join(many, "key", "left_anti") if hot else dealt
    found = [(_repeats(plain.repartition("key").groupBy("key", "sid").agg(*[F.max(c).alias(c) for c in cols[2:]])), None)]
    way = None  # (sid of a whole snippet, offset, sid of the part that stands for it)
    left = None
    if hot:
        left = kinds.join(many, "key").join(bodies.select("sid", "bytes"), "sid").groupBy("sid", "key", "own", "at", "twice").agg(F.max("bytes").alias("bytes"))
    for run in (16, 1):
        if not hot:
            break
        parts = frozen(_split(left, run))
        subs = parts.groupBy("sub").agg(F.min("key").alias("key"), F.min("own").alias("own"), F.min("at").alias("at"),
                                        F.max("bytes").alias("bytes"), (F.max("twice") | (F.min("sid") != F.max("sid"))).alias("twice"))
        shared = subs.groupBy("key").agg(F.min("sub").alias("x"), F.max("sub").alias("y"), F.max("twice").alias("t")) \
                     .filter("t or x <> y").select("key")
        left = frozen(subs.join(shared, "key").withColumnRenamed("sub", "sid"))
        step = parts.select("sid", "off", "sub")
        way = step if way is None else way.withColumnRenamed("sub", "mid").join(
            step.select(F.col("sid").alias("mid"), F.col("off").alias("more"), "sub"), "mid") \
            .select("sid", (F.col("off") + F.col("more")).alias("off"), "sub")
        many = frozen(left.groupBy("key").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > split).select("key"))
        hot = run > 1 and not many.isEmpty()
        found.append((_repeats((left.join(many, "key", "left_anti") if hot else left).repartition("key")), way))
        left = left.join(many, "key") if hot else None

    places = pieces.select("n", "lo", "sid")  # one row each, but for rows given twice, whose text goes whole
    runs = None
    for repeats, how in found:
        if how is not None:
            repeats = repeats.withColumnRenamed("sid", "sub").join(how, "sub") \
                             .select("sid", (F.col("off") + F.col("a")).alias("a"), (F.col("off") + F.col("b")).alias("b"))
        runs = repeats if runs is None else runs.unionByName(repeats)
    runs = frozen(runs.groupBy("sid").agg(F.collect_list(F.struct("a", "b")).alias("runs")))  # of a snippet: as many as its strings at most
    moved = F.transform("runs", lambda r: F.struct((r["a"] + F.col("lo")).alias("a"), (r["b"] + F.col("lo")).alias("b")))
    per = places.join(runs, "sid").select("n", moved.alias("runs")).groupBy("n").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    alone = texts.filter("copies = 1").select("d")  # texts with copies are removed whole
    per = frozen(per.join(lists.select("n", "d", "id"), "n").join(alone, "d", "left_semi"))
    cut = _cut(_picked(docs, per))
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    out = rows.select("doc_id", "d", "n_bytes").join(texts.select("d", "copies"), "d").join(cut, "d", "left")
    return out.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("d")))).alias("kept_sha256"))


def brute_force(texts: list[str | None], length: int = LENGTH) -> list[tuple]:
    """[(n_bytes, n_removed, n_spans, kept_sha256)] straight from the rule."""
    from collections import Counter
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(d, gone, strict=True) if not g)).hexdigest()))
    return out
