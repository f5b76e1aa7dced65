"""M2-M5, X4 on blocks of terms: against dense arrays, and without the vocabulary on the driver."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_online_lda import brute_update, corpus_rows
from topiary.operators import lda_blocks as LB
from topiary.operators import model as M
from topiary.operators import online_lda as L
from topiary.operators import vocab as V
from topiary.plans import q_model as Q

TERMS = 50


def test_lgamma():
    x = np.array([1e-3, 0.1, 1.0, 2.5, 50.0, 1e6])
    assert L.lgamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-9, abs=1e-9)


@pytest.fixture(scope="module")
def small(spark):
    rows = corpus_rows(n_terms=TERMS)
    counts = spark.createDataFrame([(d, f"w{t}", n) for d, t, n in rows], "doc_id long, token string, n int")
    vocab = spark.range(TERMS).select(F.col("id").cast("int").alias("term_id"), F.concat(F.lit("w"), "id").alias("token"))
    docs = spark.range(45).select(F.col("id").alias("doc_id"), F.lit("j").alias("journal"))  # five without a word
    by_doc = {}
    for d, t, n in rows:
        by_doc.setdefault(d, []).append((t, n))
    return by_doc, vocab, V.bow_entries(docs, vocab, counts).persist()


def dense(model):
    return model.topicsMatrix().toArray().T


def batches_of(spark, docs, batches):
    rows = spark.createDataFrame([(d,) for d in docs], "doc_id long")
    return {r[0]: r[1] for r in rows.select("doc_id", F.expr(f"pmod(xxhash64('batch', doc_id), {batches})")).collect()}


@pytest.mark.parametrize("prior, blocks, chunk_docs", [("auto", 32, 64), ("symmetric", 7, 3)])
def test_updates_equal_dense_arrays(spark, small, tmp_path, monkeypatch, prior, blocks, chunk_docs):
    by_doc, _, vectors = small
    monkeypatch.setattr(LB, "MIN_BLOCKS", blocks)
    monkeypatch.setattr(LB, "MIN_CHUNK_DOCS", chunk_docs)
    k, of = 4, batches_of(spark, by_doc, 2)
    corpus, n_terms = LB.pack(vectors, 2)
    assert n_terms == TERMS and sum(corpus.n_docs.values()) == len(by_doc)
    model = LB.start(spark, n_terms, corpus.n_blocks, k, 42, prior, 200, L.THRESHOLD, str(tmp_path / "0"))
    lam, alpha, eta = dense(model), model.alpha, np.full(TERMS, 1 / k)
    for t, b in enumerate([0, 1, 0]):
        model = LB.update(corpus, model, b, str(tmp_path / str((t + 1) % 2)))
        docs = [w for d, w in by_doc.items() if of[d] == b]
        lam, want, _ = brute_update(docs, lam, alpha, eta, t, len(by_doc), 200, L.THRESHOLD, prior == "auto")
        alpha = want if prior == "auto" else alpha
        assert dense(model) == pytest.approx(lam, rel=1e-5)  # statistics travel as float32
        assert model.alpha == pytest.approx(alpha, rel=1e-5) and model.totals == pytest.approx(lam.sum(1), rel=1e-5)
    corpus.release()


def test_answers_equal_dense_arrays(spark, small, tmp_path):
    by_doc, vocab, vectors = small
    model = M.fit_lda(vectors, 3, 7, 2)
    lam, alpha = dense(model), model.alpha
    beta = np.exp(L.digamma(lam) - L.digamma(lam.sum(1))[:, None])
    score = words = 0.0
    shares = {}
    for d, doc in by_doc.items():
        at, n = np.array([t for t, _ in doc]), np.array([float(c) for _, c in doc])
        gamma, theta = (x[0] for x in L.shares_of(beta.T[at], n, np.array([len(at)]), alpha, 200, L.THRESHOLD))
        shares[d], logs, total = gamma / gamma.sum(), np.log(theta), gamma.sum()
        score += float((n * np.log(beta.T[at] @ theta)).sum() + ((alpha - gamma) * logs).sum()) + math.lgamma(alpha.sum()) - math.lgamma(total)
        score += sum(math.lgamma(g) - math.lgamma(a) for g, a in zip(gamma, alpha))
        words += n.sum()
    eta, log_beta = 1 / 3, np.log(beta)
    score += float(((eta - lam) * log_beta).sum()) + sum(math.lgamma(x) - math.lgamma(eta) for x in lam.ravel())
    score += sum(math.lgamma(eta * TERMS) - math.lgamma(x) for x in lam.sum(1))
    assert model.logLikelihood(vectors) == pytest.approx(score, rel=1e-5)
    assert model.logPerplexity(vectors) == pytest.approx(-score / words, rel=1e-5)
    M.save_model(model, str(tmp_path / "m"))
    for m in (model, M.load_model(str(tmp_path / "m"))):
        got = {r["doc_id"]: r["topics"] for r in M.infer_topics(m, vectors, ["doc_id", "journal"]).collect()}
        assert len(got) == 45 and all([got[d][t] for t in range(3)] == pytest.approx(s, abs=1e-5) for d, s in shares.items())
        assert [got[44][t] for t in range(3)] == pytest.approx(alpha / alpha.sum())
    top = {(r["topic_id"], r["rank"]): (r["word"], r["p"]) for r in M.topic_top_words(model, vocab, 5).collect()}
    p = lam / lam.sum(1)[:, None]
    for t in range(3):
        assert [top[t, r + 1][0] for r in range(5)] == [f"w{i}" for i in np.argsort(-p[t], kind="stable")[:5]]
        assert [top[t, r + 1][1] for r in range(5)] == pytest.approx(np.sort(p[t])[::-1][:5])


def test_terms_that_the_model_does_not_have(spark, small):
    _, _, vectors = small
    model = M.fit_lda(vectors, 3, 7, 1)
    other = spark.createDataFrame([(1, (TERMS * 9, [TERMS, TERMS * 8], [2.0, 1.0])), (2, (TERMS, [3], [0.0]))],
                                  "doc_id long, features struct<size: int, indices: array<int>, values: array<double>>")
    got = [[r["topics"][t] for t in range(3)] for r in M.infer_topics(model, other, ["doc_id"]).collect()]
    assert got == [pytest.approx(model.alpha / model.alpha.sum())] * 2


def test_empty_corpus(spark, small):
    _, _, vectors = small
    none = M.fit_lda(vectors.filter("doc_id < 0"), 3, 7, 1)
    assert none.updates == 0 and none.getK() == 3 and M.infer_topics(none, vectors, ["doc_id"]).count() == 45


def test_no_query_of_a_fit_takes_the_vocabulary_to_the_driver(spark, monkeypatch):
    """A vocabulary beyond DRIVER_MAX_TERMS is fitted: it was refused."""
    monkeypatch.setattr(V, "DRIVER_MAX_TERMS", 1)
    monkeypatch.setattr(LB, "DRIVER_MAX_TERMS", 1)
    monkeypatch.setattr(Q, "PASSES", 1)
    monkeypatch.setattr(Q, "_FITTED", {})
    sf = "/root/testdata/sf0.001"
    assert Q.q_topic_top_words(spark, sf).count() == Q.K * 10
    assert Q.q_save_load_model(spark, sf).first().asDict() == {"n_docs": 200, "n_different": 0}
    row = Q.q_heldout_likelihood(spark, sf).first()
    assert row["log_likelihood"] < 0 < row["log_perplexity"]
    with pytest.raises(ValueError, match="terms"):
        Q.fitted(spark, sf)[0].topicsMatrix()


def test_exp_log_is_that_of_digamma():
    x = np.random.default_rng(1).gamma(0.3, 30, (2000, 7)) + 1e-6
    x[0, 0], x[1] = 1e9, 1e-4
    want = np.exp(L.digamma(x) - L.digamma(x.sum(axis=1, keepdims=True)))
    assert L._exp_log(x) == pytest.approx(want, rel=1e-8, abs=1e-280)
    lam, totals = x.astype(np.float32), x.sum(axis=0)
    lam[5] = 0
    want = np.where(lam > 0, np.exp(L.digamma(np.where(lam > 0, lam, 1).astype(float)) - L.digamma(totals)), 0)
    assert L.exp_log_beta(lam, totals) == pytest.approx(want, rel=1e-8, abs=1e-280)


def test_rounds_are_taken_by_many_documents_at_once(monkeypatch):
    """A hundred documents of 300 terms: four groups took their rounds one after the other."""
    rng, rounds, real = np.random.default_rng(2), [], L._exp_log
    beta, sizes = rng.gamma(1.0, 1.0, (500, 5)), np.full(100, 300)
    at, counts = rng.integers(0, 500, 30_000), np.ones(30_000)
    monkeypatch.setattr(L, "_exp_log", lambda g: rounds.append(1) or real(g))
    gamma, theta = L.shares_at(beta, at, counts, sizes, np.full(5, 0.2), 30, 1e-12)
    assert len(rounds) == 31
    alone = [L.shares_at(beta, at[i:i + 300], counts[:300], sizes[:1], np.full(5, 0.2), 30, 1e-12) for i in range(0, 30_000, 300)]
    assert gamma == pytest.approx(np.concatenate([g for g, _ in alone])) and theta == pytest.approx(np.concatenate([t for _, t in alone]))


def test_chunks_are_spread_over_more_partitions(spark):
    """Chunks that share a partition take their rounds one after the other in its task."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        docs = spark.range(2000).selectExpr("id as doc_id", "named_struct('size', 9, 'indices', array(1, 2), 'values', array(1D, 2D)) as features")
        corpus, _ = LB.pack(docs, 2)
        chunks = [d.count() for d in corpus.docs.values()]
        assert [d.rdd.getNumPartitions() for d in corpus.docs.values()] == [LB.SPREAD * max(chunks)] * 2
        corpus.release()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_coherence_of_a_fit_makes_the_tokens_once(spark, monkeypatch):
    made, real = [], Q.corpus_tokens
    monkeypatch.setattr(Q, "corpus_tokens", lambda *a: made.append(1) or real(*a))
    monkeypatch.setattr(Q, "PASSES", 1)
    monkeypatch.setattr(Q, "_FITTED", {})
    monkeypatch.setattr(Q, "_TEXTS", {}, raising=False)
    scores = Q.q_lda_coherence(spark, "/root/testdata/sf0.001").collect()
    assert len(scores) == Q.K and made == [1]


def test_chunks_have_partitions_of_their_own(spark):
    """Chunks were hashed over four times as many partitions, and some met."""
    for chunks, parts in ((1, 8), (48, 48), (12, 51)):
        found = LB.numbers(spark, chunks, parts)
        rows = spark.createDataFrame([(c,) for c in found], "chunk int").select(F.expr(f"pmod(hash(chunk), {parts})"))
        assert len(found) == chunks == len(set(map(tuple, rows.collect())))
    docs = spark.range(4000).selectExpr("id as doc_id", "named_struct('size', 9, 'indices', array(1, 2), 'values', array(1D, 2D)) as features")
    corpus, _ = LB.pack(docs, 2)
    assert all(max(d.rdd.glom().map(len).collect()) == 1 for d in corpus.docs.values())
    corpus.release()


def test_scaled_single_precision_weights_give_the_shares_and_sums_of_doubles():
    """Weights up to a factor per term: the shares and sums of those in doubles. Documents of more than SINGLE_WORDS take doubles."""
    rng, k = np.random.default_rng(4), 10
    lam, sizes = rng.gamma(0.3, 30, (3000, k)) + 0.1, np.append(rng.integers(0, 200, 300), [0, 2500])
    at, counts = rng.integers(0, 3000, sizes.sum()), rng.integers(1, 4, sizes.sum()).astype(float)
    beta, scaled = L.exp_log_beta(lam, lam.sum(axis=0)), LB._scaled(lam, lam.sum(axis=0))
    assert scaled.dtype == np.float32 and (scaled.max(axis=1) == 1).all() and counts[-2500:].sum() > L.SINGLE_WORDS
    each = np.empty(len(at))
    gamma, theta = L.shares_at(scaled, at, counts, sizes, np.full(k, 0.1), 12, 1e-12, each)
    want, theta_want = L.shares_at(beta, at, counts, sizes, np.full(k, 0.1), 12, 1e-12)
    assert gamma == pytest.approx(want, rel=1e-4, abs=1e-4)
    sums = L.word_sums(scaled, at, counts, sizes, theta, each) * scaled
    assert sums.sum(axis=0) == pytest.approx((L.word_sums(beta, at, counts, sizes, theta_want) * beta).sum(axis=0), rel=1e-4)
    assert sums.sum() == pytest.approx(counts.sum(), rel=1e-5)


def test_many_topics_stay_in_doubles():
    """Eta is 1 / K: weights of terms that a topic never saw would leave the range of float32."""
    lam = np.full((4, 40), 1 / 400)
    lam[:, 0] = 1e6
    assert LB._scaled(lam, lam.sum(axis=0)).dtype == np.float64 and LB._scaled(lam[:, :32], lam[:, :32].sum(axis=0)).dtype == np.float32
