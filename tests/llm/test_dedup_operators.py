"""MinHash groups, suffix arrays, the pipeline: brute force."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from topiary.llm import induced_sort, minhash, suffix_dedup


def families(seed: int) -> list[tuple]:
    """Hubs with copies that are near the hub but not always near each other, shared passages, odd rows."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))
    docs, shared = [], [word() for _ in range(60)]
    for _ in range(8):
        hub = [word() for _ in range(r.randint(40, 160))]
        for _ in range(r.randint(3, 14)):
            copy = list(hub)
            for _ in range(r.randint(0, 4)):
                copy[r.randrange(len(copy))] = word()
            docs.append(" ".join(copy))
    docs += [" ".join([word() for _ in range(20)] + shared + [word() for _ in range(20)]) for _ in range(25)]
    docs += ["", "  ", "a b", "a  B", "a b c d", docs[0], docs[0].upper(), docs[0].replace(" ", "\n ")]
    r.shuffle(docs)
    return [(i * 3 + 1, t) for i, t in enumerate(docs)] + [(10_000, None)]


@pytest.mark.parametrize("n,seed", [(4, 1), (5, 2)])
def test_minhash_groups(spark, n, seed):
    docs = families(seed)
    want = minhash.brute_force(docs, n)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_groups(df, n).collect()}
    assert got == want


def test_minhash_repeated_ids_with_different_texts(spark):
    r = random.Random(11)
    text = lambda: [f"w{r.randrange(10**6)}" for _ in range(60)]
    near = lambda t: " ".join([*t[:-1], "other"])
    rows, want = [], {}
    for k in range(6):  # either text's set may come first; each is near another document
        a, b, at = text(), text(), 100 + 10 * k
        rows += [(at + 5, " ".join(a)), (at + 5, " ".join(b)), (at + 9, near(b)), (at + 7, near(a))]
        want |= dict.fromkeys((at + 5, at + 7, at + 9), at + 5)
    a, b, c = text(), text(), text()
    rows += [(3, " ".join(a)), (8, " ".join(a).upper()), (8, " ".join(b)), (8, " ".join(c)), (9, near(b)), (6, near(c)), (8, ""), (50, near(text()))]
    want |= dict.fromkeys((3, 6, 8, 9), 3) | {50: 50}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [(x["doc_id"], x["component_id"]) for x in minhash.near_groups(df, 5).filter("n_shingles > 0").collect()]
    assert len(got) == len(rows) - 1 and {i: c for i, c in got} == want and set(got) == set(want.items())
    left = [x["doc_id"] for x in minhash.near_dedup(df.filter("text <> ''")).collect()]
    assert sorted(left) == sorted(set(want.values()))


def test_screen_bounds_and_blocks(monkeypatch):
    assert minhash.BOUNDS == sorted(minhash.BOUNDS) and minhash.BOUNDS[-1] < minhash.BANDS * minhash.ROWS * 0.8
    a = np.zeros((2, minhash.BANDS * minhash.ROWS), dtype=np.uint16)
    b = a.copy()
    b[1, 20:] = 1
    assert minhash.survivors(a, b).tolist() == [minhash.BANDS * minhash.ROWS, -1]


def test_prune_rate():
    assert minhash.prune_rate(0.8, minhash.BOUNDS) < 1e-6


def test_pairs_that_agree_only_by_truncation_are_compared(spark):
    width = minhash.BANDS * minhash.ROWS
    base = np.arange(width, dtype="<u2")
    other = base.copy()
    other[4:20] = 7  # band 0 agrees in all 16-bit values, though the buckets differ
    rows = [(5, 0, 0, rep, rep, asks, 100, bytearray(sig.tobytes()), [rep])
            for rep, asks, sig in ((1, False, base), (2, False, other), (2, True, other))]
    df = spark.createDataFrame(rows, "bucket long, block long, qblock long, rep long, component long, asks boolean, "
                                     "n_shingles long, sig binary, earlier array<long>").withColumn("band", F.lit(1))
    assert [(r["q"], r["partners"]) for r in minhash._compared(df, None).collect()] == [(2, [1])]
    met = df.withColumn("earlier", F.array(F.lit(3).cast("long")))
    assert minhash._compared(met, None).collect() == []


def test_near_dedup_awkward(spark, awkward, empty):
    kept = minhash.near_dedup(awkward).collect()
    ids = [r["doc_id"] for r in kept]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 6, 7] and ids.count(None) == 2
    assert minhash.near_dedup(empty).count() == 0


def test_components(spark):
    r = random.Random(3)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    got = {x["id"]: x["component"] for x in minhash.components(spark.createDataFrame(links, "x long, y long")).collect()}
    parent = {}

    def root(v):
        parent.setdefault(v, v)
        return v if parent[v] == v else root(parent[v])

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert {v: got.get(v, v) for v in parent} == {v: root(v) for v in parent}


@pytest.mark.parametrize("limit", [1 << 26, 16])
def test_suffix_array_and_prefix_values(limit):
    r = random.Random(limit)
    for _ in range(120):
        k = r.choice([1, 2, 3, 20])
        t = [r.randint(1, k) for _ in range(r.randint(1, 70))]
        if r.random() < 0.4:
            t = [0 if r.random() < 0.1 else x for x in t[:-1]] + [t[-1]]
        t.append(0)
        with induced_sort.Space(limit) as space:
            order, lcp = (np.array(x) for x in induced_sort.suffix_array(np.array(t), space))
        want = sorted(range(len(t)), key=lambda i: t[i:])
        assert order.tolist() == want
        for j in range(1, len(t)):
            a, b = t[want[j - 1]:], t[want[j]:]
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert lcp[j] == n


@pytest.mark.parametrize("split", [256, 4])
def test_suffix_dedup(spark, small_docs, split):
    texts = [t for _, t in small_docs if len(t) < 6000][:70]
    passage = (texts[3] + texts[4])[:420]
    docs = [*texts, None, "", "ab" * 400, "x" * 1000, texts[5] * 2, "é" * 150, "é" * 99 + "q" * 30, texts[6], texts[6],
            *[f"{i * 7919 % 997} left {i} {passage} right {i * 31}" for i in range(25)]]
    rows = list(enumerate(docs)) + [(7, docs[7]), (None, "lone " * 80)]
    want = suffix_dedup.brute_force([t for _, t in rows])
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("d", F.lit("clash")).repartition(3)
    got = suffix_dedup.suffix_dedup(df, split).collect()
    assert sorted(((r[0] is None, r[0]), *r[1:]) for r in got) == sorted(((i is None, i), *w) for (i, _), w in zip(rows, want))


def test_suffix_dedup_empty(empty):
    assert suffix_dedup.suffix_dedup(empty).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    first, seen = docs, []
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, SMALL).write.parquet(out)
        docs = spark.read.parquet(out)
        seen.append(docs)
    clean, near, decon, mixed, shards = seen
    assert all(d.columns == first.columns for d in seen[:-1])
    pairs = [(r["doc_id"], r["text"]) for r in clean.collect()]
    groups = minhash.brute_force(pairs, 5)
    assert sorted(r["doc_id"] for r in near.collect()) == sorted({c for _, c in groups.values()})
    from topiary.llm import decontaminate
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    judged = decontaminate.brute_force([(r["doc_id"], r["text"]) for r in near.collect()], items)
    assert sorted(r["doc_id"] for r in decon.collect()) == sorted(i for i, j in judged.items() if not j[4])
    assert set(r["doc_id"] for r in mixed.collect()) <= set(r["doc_id"] for r in decon.collect())
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    assert shards.count() == mixed.count()
    sizes = [r["count"] for r in shards.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1


def test_snippets_without_rivals_are_not_sorted(monkeypatch):
    """An anchor with one snippet, or with repeated ones only, needs no suffix array; the rest goes there with its anchors as one symbol."""
    import pyarrow as pa
    rng = np.random.default_rng(5)
    gram = lambda n: rng.integers(97, 123, n, dtype=np.uint8).tobytes()
    anchor, left, right = gram(suffix_dedup.K), gram(60), gram(104)
    alone, known, rival = gram(230), gram(230), left + anchor + right
    other = gram(20) + left[20:] + anchor + right[:90] + gram(14)
    rows = [(1, b"a", alone, 31, True, 40), (2, b"b", alone, 31, False, 40), (3, b"c", known, 31, True, 40), (3, b"d", known[::-1], 31, True, 40),
            (4, b"e", rival, 61, False, 60), (4, b"f", other, 61, False, 60)]
    sorted_ones, real = [], suffix_dedup.repeated_in_shard
    monkeypatch.setattr(suffix_dedup, "repeated_in_shard", lambda pieces, *more: sorted_ones.extend(pieces) or real(pieces, *more))
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.bool_(), pa.int32())
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["key", "sid", "bytes", "own", "twice", "at"])
    got = sorted(tuple(r.values()) for b in suffix_dedup.shard_repeats(iter([batch])) for r in b.to_pylist())
    same = [i for i in range(61) if rival[i:i + 200] == other[i:i + 200]]
    assert same and got == [(b"a", 0, 31), (b"c", 0, 31), (b"d", 0, 31), (b"e", same[0], same[-1] + 1), (b"f", same[0], same[-1] + 1)]
    assert sorted_ones == [rival, other]
