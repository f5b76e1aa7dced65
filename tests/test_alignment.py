"""Topics paired between models: every permutation, awkward inputs."""
import itertools
import math
import random

import pytest

from topiary.operators import alignment as A


def best(gain):
    """By trying all; rows may not be more than columns."""
    ways = itertools.permutations(range(len(gain[0])), len(gain))
    return list(min(ways, key=lambda w: (-sum(gain[i][j] for i, j in enumerate(w)), w)))


@pytest.mark.parametrize("top", [2, 5, 1_000_000])  # few values: many ties
def test_assignment_equals_all_permutations(top):
    r = random.Random(top)
    for _ in range(150):
        n = r.randint(1, 6)
        m = r.randint(n, 7)
        gain = [[r.randrange(top) for _ in range(m)] for _ in range(n)]
        assert A.assign(gain) == best(gain)


def test_many_topics():
    r = random.Random(1)
    order = r.sample(range(100), 100)
    gain = [[900_000 if order[i] == j else r.randrange(500_000) for j in range(100)] for i in range(100)]
    assert A.assign(gain) == order


def _dist(spark, models):
    rows = [(m, t, w, p) for m, topics in models.items() for t, ws in topics.items() for w, p in ws.items()]
    return spark.createDataFrame(rows, "model_id long, topic_id int, term_id string, p double")


def test_matches_of_small_models(spark):
    r = random.Random(4)
    topics = lambda k: {t: {f"w{i}": r.random() for i in r.sample(range(12), 7)} for t in range(k)}
    models = {1: topics(4), 2: topics(4), 3: topics(6), 4: topics(2)}
    dist = _dist(spark, models)
    pairs = [(1, 2), (1, 3), (3, 1), (3, 4), (2, 2)]
    got = A.match_topics(A.cosines(dist, spark.createDataFrame(pairs + pairs[:1], "model_a long, model_b long"))).collect()
    for a, b in pairs:
        length = lambda v: math.sqrt(sum(x * x for x in v.values()))
        gain = [[round(sum(x * w.get(k, 0) for k, x in v.items()) / length(v) / length(w) * 1e6) for w in models[b].values()] for v in models[a].values()]
        if len(gain) <= len(gain[0]):
            want = {(i, j, gain[i][j]) for i, j in enumerate(best(gain))}
        else:
            want = {(i, j, gain[i][j]) for j, i in enumerate(best([list(c) for c in zip(*gain)]))}
        assert {(x["t1"], x["t2"], x["cosine"]) for x in got if (x["model_a"], x["model_b"]) == (a, b)} == want


def test_awkward_models(spark):
    dist = _dist(spark, {1: {0: {"a": 1.0}, 1: {"b": 2.0, "z": None}, 2: {"c": 0.0}}, 2: {0: {"x": 1.0}, 1: {"b": 5.0}}})
    pairs = spark.createDataFrame([(1, 2)], "model_a long, model_b long")
    assert sorted(map(tuple, A.match_topics(A.cosines(dist, pairs)).collect())) == [(1, 2, 0, 0, 0), (1, 2, 1, 1, 1_000_000)]
    assert A.topic_stability(dist.limit(0), pairs).count() == 0
    stable = A.topic_stability(dist, pairs).collect()
    assert sorted(map(tuple, stable)) == [(1, 0, 1, 0, 0), (1, 1, 1, 1_000_000, 1_000_000), (2, 0, 1, 0, 0), (2, 1, 1, 1_000_000, 1_000_000)]
    twins = _dist(spark, {1: {0: {"a": 1.0, "b": 1.0}, 1: {"a": 2.0, "b": 2.0}, 2: {"c": 1.0}}})
    assert list(map(tuple, A.merge_candidates(twins).collect())) == [(1, 0, 1, 1_000_000)]


def test_fitted_models_are_compressed(spark):
    """Their rows (models x terms x K) were a checkpoint, which is uncompressed."""
    from topiary.plans import q_alignment as Q
    dist = Q.fitted(spark, "/root/testdata/sf0.001")
    assert dist.inputFiles() and all(f.endswith(".zstd.parquet") for f in dist.inputFiles())
    assert {r["model_id"] for r in dist.select("model_id").distinct().collect()} == set(Q.FITTED)
