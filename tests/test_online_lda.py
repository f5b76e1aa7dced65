"""M2-M5 on partitioned statistics against numpy on one dense array."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from topiary.operators import incremental as INC
from topiary.operators import model as M
from topiary.operators import online_lda as L

EULER = 0.5772156649015329


def test_digamma_and_trigamma():
    x = np.array([1.0, 2.0, 0.5, 10.0])
    want = [-EULER, 1 - EULER, -EULER - 2 * math.log(2), sum(1 / i for i in range(1, 10)) - EULER]
    assert np.abs(L.digamma(x) - want).max() < 1e-9
    want = [math.pi ** 2 / 6, math.pi ** 2 / 6 - 1, math.pi ** 2 / 2, math.pi ** 2 / 6 - sum(1 / i ** 2 for i in range(1, 10))]
    assert np.abs(L.trigamma(x) - want).max() < 1e-8


def corpus_rows(n_docs=40, n_terms=30, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for d in range(n_docs):
        for t in rng.choice(n_terms, rng.integers(1, 12), replace=False):
            rows.append((d, int(t), int(rng.integers(1, 6))))
    return rows


@pytest.fixture(scope="module")
def small(spark):
    rows = corpus_rows()
    vocab = spark.range(30).select(F.col("id").cast("int").alias("term_id"), F.concat(F.lit("w"), "id").alias("token"))
    return rows, vocab, spark.createDataFrame(rows, "doc_id long, term_id int, tf long")


def dense_newton(prior, n, logs, rho):
    """Minka's step, term by term."""
    g = [n * (float(L.digamma(prior.sum())) - float(L.digamma(p)) + l) for p, l in zip(prior, logs)]
    q = [-n * float(L.trigamma(p)) for p in prior]
    b = sum(a / c for a, c in zip(g, q)) / (1 / (n * float(L.trigamma(prior.sum()))) + sum(1 / c for c in q))
    new = np.array([p - rho * (a - b) / c for p, a, c in zip(prior, g, q)])
    return new if (new > 0).all() else prior


def brute_update(docs, lam, alpha, eta, t, n_all, iterations, threshold, learn):
    """One update with a dense K x V array and loops."""
    k, v = lam.shape
    beta = np.exp(L.digamma(lam) - L.digamma(lam.sum(1))[:, None])
    stats, logs = np.zeros_like(lam), np.zeros(k)
    for words in docs:
        gamma = np.ones(k)
        for _ in range(iterations):
            theta = np.exp(L.digamma(gamma) - L.digamma(gamma.sum()))
            new = alpha.copy()
            for w, n in words:
                phi = theta * beta[:, w]
                new = new + n * phi / phi.sum()
            done = np.abs(new - gamma).mean() < threshold
            gamma = new
            if done:
                break
        theta = np.exp(L.digamma(gamma) - L.digamma(gamma.sum()))
        logs += L.digamma(gamma) - L.digamma(gamma.sum())
        for w, n in words:
            phi = theta * beta[:, w]
            stats[:, w] += n * phi / phi.sum()
    rho = (L.OFFSET + t) ** -L.DECAY
    lam = (1 - rho) * lam + rho * (eta[None, :] + stats * n_all / len(docs))
    if learn:
        alpha = dense_newton(alpha, len(docs), logs / len(docs), rho)
        eta = dense_newton(eta, k, (L.digamma(lam) - L.digamma(lam.sum(1))[:, None]).mean(0), rho)
    return lam, alpha, eta


@pytest.mark.parametrize("prior, iterations", [("auto", 200), ("asymmetric", 3)])
def test_three_updates_equal_dense_arrays(spark, small, prior, iterations):
    rows, vocab, bow = small
    k, batches = 4, 2
    corpus = L.pack(bow, batches, chunk_docs=5)
    model = L.start(vocab, k, 42, prior, "auto" if prior == "auto" else 0.1, iterations)
    of = {r["doc_id"]: r["batch"] for r in corpus.docs.collect()}
    by_doc = {}
    for d, t, n in rows:
        by_doc.setdefault(d, []).append((t, n))
    table = {r["term_id"]: r for r in model.terms.collect()}
    lam = np.array([table[t]["lam"] for t in range(30)]).T
    alpha, eta = model.alpha, np.array([table[t]["eta"] for t in range(30)])
    for t, b in enumerate([0, 1, 0]):
        model = L.update(corpus, model, b)
        docs = [w for d, w in by_doc.items() if of[d] == b]
        lam, alpha, eta = brute_update(docs, lam, alpha, eta, t, len(by_doc), iterations, L.THRESHOLD, prior == "auto")
        got = {r["term_id"]: r for r in model.terms.collect()}
        assert np.abs(np.array([got[t]["lam"] for t in range(30)]).T - lam).max() < 1e-8
        assert np.abs(model.alpha - alpha).max() < 1e-9 and np.abs(np.array([got[t]["eta"] for t in range(30)]) - eta).max() < 1e-9
    assert (eta != eta[0]).any() == (prior == "auto")


def test_any_layout_gives_one_model(spark, small):
    _, vocab, bow = small
    fits = [L.fit(vocab, L.pack(df, 2, 7), 3, 7, 1, batches=2) for df in (bow.coalesce(1), bow.repartition(5, "term_id"))]
    a, b = ({r["term_id"]: r["lam"] for r in m.terms.collect()} for m in fits)
    assert max(abs(x - y) for t in a for x, y in zip(a[t], b[t])) < 1e-9


def test_all_documents_are_taken_a_batch_after_the_other(spark, small, monkeypatch):
    """What an update of all documents sends is on disk for one batch at a time: it was for all."""
    _, vocab, bow = small
    taken, real = [], L.e_step
    monkeypatch.setattr(L, "e_step", lambda c, m, batch=None, **kw: taken.append(batch) or real(c, m, batch, **kw))
    corpus = L.pack(bow, 3, 4)
    many, one = (L.update(c, L.start(vocab, 3, 42)) for c in (corpus, L.pack(bow, 1, 50)))
    assert taken == [0, 1, 2, 0] and many.alpha == pytest.approx(one.alpha, rel=1e-9)
    a, b = ({r["term_id"]: r["lam"] for r in m.terms.collect()} for m in (many, one))
    assert len(a) == 30 and max(abs(x - y) for t in a for x, y in zip(a[t], b[t])) < 1e-9


def test_chunks_ask_blocks_and_not_terms(spark, small):
    """A chunk asked with a row per term, each answered with a row."""
    rows, vocab, bow = small
    corpus = L.pack(bow, 2, 50)
    assert corpus.rows.count() <= 2 * (1 + corpus.n_blocks) and corpus.n_docs == len({d for d, _, _ in rows})
    model = L.start(vocab, 3, 42)
    assert L.sent(corpus, model, 0).count() <= corpus.n_blocks and L.e_step(corpus, model, 0).count() <= corpus.n_blocks + 1


def test_save_load_infer(spark, small, tmp_path):
    _, vocab, bow = small
    docs = spark.range(45).select(F.col("id").alias("doc_id"))  # five without a word
    corpus = L.pack(bow.unionByName(bow.limit(1).selectExpr("99L AS doc_id", "12345 AS term_id", "1L AS tf")), 2, 7)
    model = L.fit(vocab, corpus, 3, 7, 1, batches=2)
    L.save(model, str(tmp_path / "m"))
    again = L.load(spark, str(tmp_path / "m"))
    a, b = ({r["doc_id"]: r["topics"] for r in L.infer_all(docs, corpus, m, ["doc_id"]).collect()} for m in (model, again))
    assert len(a) == 45 and all(abs(sum(t.values()) - 1) < 1e-9 and sorted(t) == [0, 1, 2] for t in a.values())
    assert max(abs(a[d][t] - b[d][t]) for d in a for t in range(3)) < 1e-9
    prior = model.alpha / model.alpha.sum()
    assert all(abs(a[44][t] - prior[t]) < 1e-12 for t in range(3))
    top = L.top_words(model, vocab, 5).collect()
    assert len(top) == 15 and all(r["word"].startswith("w") for r in top)


def test_grid_takes_every_value(spark, small, tmp_path):
    _, vocab, bow = small
    points = INC.grid(spark, ks=(2, 3), priors=("auto", "asymmetric"), seeds=(42,), passes=(1,), iterations=(2, 50))
    fitter = L.grid_fitter(vocab, L.pack(bow, 2, 50), 2)
    done = M.fit_grid(spark, None, points, str(tmp_path), concurrent=2, fitter=fitter)
    assert done.count() == 8
    assert M.fit_grid(spark, None, points, str(tmp_path), fitter=None).count() == 8  # nothing left to fit
    m = L.load(spark, M.model_path(str(tmp_path), 3, "asymmetric", 42, 1, 2))
    assert m.k == 3 and m.options["iterations"] == 2 and m.updates == 2


def test_empty_corpus(spark, small):
    _, vocab, bow = small
    corpus = L.pack(bow.limit(0), 2, 7)
    model = L.fit(vocab, corpus, 3, 7, 1, batches=2)
    assert model.updates == 0 and model.terms.count() == 30 and L.infer(corpus, model).count() == 0


def test_documents_stop_on_their_own():
    """Documents that take their rounds together get what each gets alone, one without terms the prior."""
    rnd = np.random.default_rng(3)
    sizes, alpha = np.array([5, 0, 1, 40, 12]), np.array([0.3, 0.2, 0.9])
    weights, counts = rnd.random((sizes.sum(), 3)) ** 4, rnd.integers(1, 9, sizes.sum()).astype(float)
    gamma, theta = L.shares_of(weights, counts, sizes, alpha, 50, 1e-3)
    assert gamma[1].tolist() == alpha.tolist()
    for i, (a, z) in enumerate(zip(np.cumsum(sizes) - sizes, np.cumsum(sizes))):
        w, n, g = weights[a:z], counts[a:z], np.ones(3)
        for _ in range(50):
            t, before = np.exp(L.digamma(g) - L.digamma(g.sum())), g
            g = alpha + t * ((n / (w @ t + L.TINY)) @ w)
            if np.abs(g - before).mean() < 1e-3:
                break
        assert gamma[i] == pytest.approx(g, rel=1e-9) and theta[i] == pytest.approx(np.exp(L.digamma(g) - L.digamma(g.sum())), rel=1e-9)
