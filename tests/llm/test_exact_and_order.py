"""Exact dedup, mixing, sharding: brute force, SQL parity, awkward rows."""
import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from topiary.llm import exact_dedup, mixing, queries, sharding


@pytest.mark.parametrize("name", ["op4_exact_dedup", "op5_source_mix"])
def test_sql_parity(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    df = queries.QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE[name]})").fetchall()
    assert sorted(map(tuple, df.select(cols).collect())) == sorted(want)


@pytest.mark.parametrize("support", [0.5, 0.0005])
def test_exact_dedup_awkward(awkward, support):
    rows = exact_dedup.exact_dedup(awkward, support).collect()
    low = lambda t: (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    data = [(r["doc_id"], low(r["text"])) for r in awkward.collect()]
    groups = defaultdict(list)
    for i, t in data:
        groups[hashlib.sha256(t.encode()).hexdigest()].append(i)
    assert len(rows) == len(data)
    for r in rows:
        ids = groups[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
    kept = Counter(r["text_sha256"] for r in rows if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len(groups)


@pytest.mark.parametrize("first", ["of the table", "of each partition"])
def test_heavy_digests_of_rows_at_the_front(spark, first):
    n = 24_000
    place = F.col("id") if first == "of the table" else F.col("id") % (n // 4)
    hot = place < (n if first == "of the table" else n // 4) // 3
    docs = spark.range(0, n, 1, 4).select(F.col("id").alias("doc_id"), F.when(hot, "Hot text").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    named, seen = [], exact_dedup._winners

    def winners(rows):
        out = seen(rows)
        named.append(out)
        return out

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(exact_dedup, "_winners", winners)
        rows = exact_dedup.exact_dedup(docs)
    sizes = {bytes(r["digest"]).hex(): r["group_size"] for r in named[0].collect()}  # the verified heavy hitters
    assert sizes.get(hashlib.sha256(b"hot text").hexdigest()) == n // 3 and len(sizes) <= 1 / exact_dedup.SUPPORT
    assert rows.filter("group_size > 1").count() == n // 3 and rows.filter("kept").count() == n - n // 3 + 1


def test_exact_dedup_empty(empty):
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_hilbert_is_a_curve(spark):
    axis = lambda c: spark.range(8).select(F.col("id").alias(c))
    cells = axis("x").crossJoin(axis("y")).crossJoin(axis("z"))
    got = cells.withColumn("h", sharding.hilbert_index([F.col(c) for c in "xyz"], 3)).orderBy("h").collect()
    assert [r["h"] for r in got] == list(range(512))
    steps = [sum(abs(a[c] - b[c]) for c in "xyz") for a, b in zip(got, got[1:])]
    assert set(steps) == {1}


def test_shard_law_and_rerun(spark, awkward):
    for df in (spark.read.parquet(f"{SMALL}/documents.parquet"), awkward):
        rows = sharding.shard(df).collect()
        again = sharding.shard(df.repartition(3)).collect()
        key = lambda r: tuple((x is None, x) for x in r)
        assert sorted(rows, key=key) == sorted(again, key=key)
        sizes = Counter(r["shard"] for r in rows)
        counts = [sizes.get(s, 0) for s in range(40)]
        assert max(counts) - min(counts) <= 1 and sum(counts) == df.count()
        for s in sizes:
            assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
    texts = Counter((r["doc_id"], r["text"] or "") for r in awkward.collect())
    want = Counter((i, len(t.encode()) + 16, zlib.crc32(t.encode())) for (i, t), n in texts.items() for _ in range(n))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want


def plain_hilbert(cell: list, bits: int) -> int:
    """One cell's place on the curve, bit plane by bit plane."""
    x, n = list(cell), len(cell)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(n):
            if x[i] >> level & 1:
                x[0] ^= low
            else:
                swap = (x[0] ^ x[i]) & low
                x[0], x[i] = x[0] ^ swap, x[i] ^ swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = 0
    for level in range(bits - 1, 0, -1):
        if x[-1] >> level & 1:
            flip ^= (1 << level) - 1
    x = [v ^ flip for v in x]
    out = 0
    for level in range(bits - 1, -1, -1):
        for v in x:
            out = out * 2 + (v >> level & 1)
    return out


def brute_shards(rows: list, shards: int = 40, bits: int = 5) -> Counter:
    """(doc_id, size, shard, slot, curve) of rows (doc_id, text, lang, source)."""
    buckets = []
    for c in (2, 3):
        names = sorted(r[c] or "" for r in rows)
        buckets.append({v: names.index(v) * (1 << bits) // len(names) for v in set(names)})
    keyed = []
    for i, t, lang, source in rows:
        raw = (t or "").encode()
        half = next((h for h in range(1 << bits) if (len(raw) + 16) ** 2 < 256 * 2 ** (h + 1)), (1 << bits) - 1)
        cell = [buckets[0][lang or ""], buckets[1][source or ""], half]
        keyed.append((plain_hilbert(cell, bits), zlib.crc32(raw), (i is not None, i or 0), i, len(raw) + 16))
    keyed.sort(key=lambda k: k[:3])
    starts = [-(-s * len(rows) // shards) for s in range(shards)]
    at = [r * shards // len(rows) for r in range(len(rows))]
    return Counter((k[3], k[4], s, r - starts[s], k[0]) for r, (k, s) in enumerate(zip(keyed, at)))


def test_shards_are_the_plain_ones(spark, awkward):
    for df in (spark.read.parquet(f"{SMALL}/documents.parquet"), awkward):
        clash = df.withColumns({c: F.lit(None).cast("string") for c in ("x", "curve", "bucket", "name", "size", "n")})
        got = Counter(tuple(r) for r in sharding.shard(clash).select("doc_id", "size", "shard", "slot", "curve").collect())
        rows = [tuple(r) for r in df.select("doc_id", "text", *(F.col(c).cast("string") for c in ("lang", "source"))).collect()]
        assert got == brute_shards(rows)


def test_a_filter_opens_few_shards(spark):
    """By each shard's least and greatest name, as a Parquet reader prunes files."""
    docs = spark.read.parquet(SMALL.replace("0.001", "0.01") + "/documents.parquet")
    rows = sharding.shard(docs).select("doc_id", "shard").join(docs.select("doc_id", "lang", "source"), "doc_id").collect()
    for c in ("lang", "source"):
        names = defaultdict(set)
        for r in rows:
            names[r["shard"]].add(r[c])
        for name in {r[c] for r in rows}:
            held = sum(name in held for held in names.values())
            opened = sum(min(held) <= name <= max(held) for held in names.values())
            assert opened <= 1.5 * held, (c, name)


def test_shard_empty(empty):
    assert sharding.shard(empty).count() == 0


def brute_targets(sizes: dict, most: int = 3) -> dict:
    """Reshares the excess round by round, as the rule says."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    full: set = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        rate = left / sum(weight[s] for s in free) if free else 0
        more = {s for s in free if weight[s] * rate > most * sizes[s]}
        if not more:
            return {s: most * sizes[s] if s in full else weight[s] * rate for s in order}
        full |= more


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 20, "c": 30}, {"a": 1, "b": 1000, "c": 5, None: 2, "é": 900}, {"a": 0, "b": 0}, {"x": 5},
    {f"s{i:02d}": (i * 37) % 50 + (5000 if i == 7 else 0) for i in range(20)}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_mix_takes_about_the_target(spark):
    rows = [(i, "w " * (1 + i * i % 97), "big" if i % 3 else ("mid" if i % 2 else None)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    assert len(got) == 3000 and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    by = defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
    for own in by.values():
        assert sum(r["size"] for r in own) == own[0]["source_size"]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 2 * max(r["size"] for r in own)
    again = mixing.mix(df.repartition(5)).collect()
    pick = lambda rs: sorted((r["doc_id"], r["taken"]) for r in rs)
    assert pick(got) == pick(again)


def test_mix_awkward_and_empty(awkward, empty):
    assert mixing.mix(awkward).count() == awkward.count()
    out = mixing.mixed_rows(awkward)
    assert out.columns == awkward.columns
    assert out.count() == mixing.mix(awkward).agg(F.sum("copies")).first()[0]
    assert mixing.mix(empty).count() == 0
