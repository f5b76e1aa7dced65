import math
import random

from pyspark.sql import functions as F

from topiary.operators import coherence as CO


def brute(texts, top, window):
    """Reference counting: every window of every relevant text."""
    words = {w for _, _, w in top}
    occ, co, nwin = {}, {}, 0
    for toks in texts:
        if not any(t in words for t in toks):
            continue
        n = len(toks)
        starts = range(max(1, n - window + 1)) if n >= window else [0]
        for s in starts:
            win = set(toks[s:s + window]) & words
            nwin += 1
            for w in win:
                occ[w] = occ.get(w, 0) + 1
            for a in win:
                for b in win:
                    if a < b:
                        co[(a, b)] = co.get((a, b), 0) + 1
    return occ, co, nwin


def test_window_counts_equal_brute_force(spark):
    rnd = random.Random(7)
    vocab = [f"w{i}" for i in range(12)]
    texts = [[rnd.choice(vocab) for _ in range(rnd.randint(0, 40))] for _ in range(30)]
    texts.append(["zz"] * 5)  # no top word: not counted
    top = [(0, t, w) for t, ws in enumerate([vocab[0:4], vocab[4:8]]) for w in ws]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, tokens array<string>")
    topdf = spark.createDataFrame(top, "model_id int, topic_id int, word string")
    for window in (3, 7, 110):
        occ, co, nwin = CO.window_counts(df, topdf, window)
        b_occ, b_co, b_nwin = brute(texts, top, window)
        assert {r["word"]: r["occ"] for r in occ.collect()} == b_occ
        assert nwin.first()["num_windows"] == b_nwin
        same_topic = {(a, b) for _, t, a in top for _, u, b in top if t == u and a < b}
        got = {(r["w1"], r["w2"]): r["co"] for r in co.collect()}
        assert got == {k: v for k, v in b_co.items() if k in same_topic}


def test_cv_in_range(spark):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(8)]
    texts = [[rnd.choice(vocab) for _ in range(30)] for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, tokens array<string>")
    top = spark.createDataFrame([(0, 0, w) for w in vocab[:4]] + [(0, 1, w) for w in vocab[4:]],
                                "model_id int, topic_id int, word string")
    c = CO.coherence_cv(df, top, 10).first()["coherence"]
    assert -1.0 <= c <= 1.0 and not math.isnan(c)


def test_windows_over_blocks_and_models(spark):
    """Texts longer than a block of window starts, and pairs that several models share, are counted once each."""
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(9)] + ["zz"] * 8
    texts = [[rnd.choice(vocab) for _ in range(n)] for n in (CO.BLOCK * 2 + 57, CO.BLOCK + 2, 3, 700)]
    top = [(m, t, w) for m in (1, 2) for t, ws in enumerate([vocab[0:4], vocab[4 - m:8]]) for w in ws]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, tokens array<string>").repartition(2)
    occ, co, nwin = CO.window_counts(df, spark.createDataFrame(top, "model_id int, topic_id int, word string"))
    assert "Window" not in co._jdf.queryExecution().executedPlan().toString()
    all_occ, all_co, _ = brute(texts, top, CO.WINDOW)
    assert {r["word"]: r["occ"] for r in occ.collect()} == all_occ
    want = {(m, t, a, b): all_co[a, b] for m, t, a in top for n, u, b in top if (m, t) == (n, u) and a < b and all_co.get((a, b))}
    assert {(r["model_id"], r["topic_id"], r["w1"], r["w2"]): r["co"] for r in co.collect()} == want
    assert {r["model_id"]: r["num_windows"] for r in nwin.collect()} == {m: brute(texts, [x for x in top if x[0] == m], CO.WINDOW)[2] for m in (1, 2)}
