"""M2-M5 without a topics x terms array: online variational LDA on DataFrames.

Spark ML's LDA keeps the topic-word statistics on the driver and offers no cap on
the inner loop and no learned eta. Here a model is a table (term_id, eta, lam),
one row per term with its K statistics, and an update is a job:

* Documents are packed once into chunks of ``CHUNK_PAIRS`` entries or fewer, a row per
  chunk. What a chunk needs of the model is the rows of its own terms: it asks each
  block of terms (term_id mod the number of blocks) once, and a block answers with one
  packed row, so a term's row moves once per chunk that holds it, not once per
  occurrence, and as 8 K bytes and not as a row of a table.
* E step: one task per chunk alternates topic shares and word assignments of each
  document until the mean change falls below ``threshold`` or ``iterations``
  rounds are done, and returns each block one packed row of sums.
* M step: a block adds up its rows in the order of the chunks and blends them into
  ``lam`` with weight (offset + update)^-decay.
* Priors: 'symmetric' is 1/K, 'asymmetric' 1/(topic + sqrt(K)) normalised, 'auto'
  starts symmetric and takes a Newton step on the Dirichlet likelihood after each
  update: alpha from the mean of E[log theta], eta (one value per term, shared by
  the topics) from the mean over topics of E[log beta], by aggregates over the table.

The driver holds K numbers (topic totals, alpha) and a few scalars of the eta
step; the table is frozen after each update, so a lost executor costs one update.
Batches of an epoch are dealt by a hash of the document, each pass in a new order.

Cited: Hoffman, Blei, Bach, "Online learning for latent Dirichlet allocation",
NIPS 2010 (updates); Minka, "Estimating a Dirichlet distribution", 2000 (Newton).

Defined cases: a document without a known term gets the normalised alpha and adds
nothing; an empty corpus leaves the model as it started; repeated documents count
as often as they stand there; a NULL or non-positive count is left out.
"""

from __future__ import annotations

import math
import os
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topiary.functions.arrays import explode_rows
from topiary.session import collect_garbage, frozen, stored

BATCHES = 4
CHUNK_PAIRS, MIN_CHUNKS, MIN_CHUNK_PAIRS = 1_000_000, 12, 32_768
BLOCK_TERMS, MIN_BLOCKS, MAX_BLOCKS = 16_384, 32, 2_048
#: Rows of a bag of words that a task holds before it hands them to their chunks.
ROWS_AT_ONCE = 1 << 19
DECAY, OFFSET, THRESHOLD = 0.5, 1.0, 1e-3
TINY, TINY_SINGLE = 1e-100, 1e-30


# ---- psi and its derivative, for numpy arrays and Columns alike (x > 0)

def digamma(x, log=np.log):
    """Shifted to x + 6, where the asymptotic series is exact to 2e-10 and better above."""
    y = x + 6.0
    r = 1.0 / (y * y)
    series = log(y) - 0.5 / y - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r * (1 / 240 - r * (1 / 132)))))
    return series - (1.0 / x + 1.0 / (x + 1.0) + 1.0 / (x + 2.0) + 1.0 / (x + 3.0) + 1.0 / (x + 4.0) + 1.0 / (x + 5.0))


def trigamma(x):
    y = x + 6.0
    r = 1.0 / (y * y)
    series = 1.0 / y + 0.5 * r + (1.0 / y) * r * (1 / 6 - r * (1 / 30 - r * (1 / 42 - r * (1 / 30))))
    return series + sum((1.0 / ((x + float(i)) * (x + float(i))) for i in range(1, 6)), 1.0 / (x * x))


def lgamma(x):
    """Logarithm of the gamma function for numpy arrays (x > 0), shifted like digamma."""
    x = np.asarray(x, dtype=float)
    y = x + 6.0
    r = 1.0 / (y * y)
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680)))) / y
    return series - np.log(x * (x + 1.0) * (x + 2.0) * (x + 3.0) * (x + 4.0) * (x + 5.0))


def newton(prior: np.ndarray, n: float, mean_log: np.ndarray, rho: float) -> np.ndarray:
    """A step of weight ``rho`` towards the Dirichlet parameter whose expected log
    is ``mean_log``; kept only if it stays positive."""
    total = prior.sum()
    gradient = n * (digamma(total) - digamma(prior) + mean_log)
    c, q = n * trigamma(total), -n * trigamma(prior)
    b = (gradient / q).sum() / (1 / c + (1 / q).sum())
    after = prior - rho * (gradient - b) / q
    return after if (after > 0).all() else prior


def start_prior(name: str, k: int) -> np.ndarray:
    if name in ("auto", "symmetric"):
        return np.full(k, 1.0 / k)
    if name == "asymmetric":
        raw = 1.0 / (np.arange(k) + math.sqrt(k))
        return raw / raw.sum()
    raise ValueError(f"unknown prior {name!r}")


# ---- the corpus


DEALT = "chunk int, docs binary, terms binary, counts binary"
PACKED = "batch int, chunk int, block int, n long, ids binary, sizes binary, terms binary, at binary, counts binary"
MESSAGE = "block int, chunk int, terms binary, v binary"


@dataclass
class Corpus:
    """``rows`` is PACKED: per chunk a row (block -1: ids and sizes of its documents, its terms in ascending
    order, places in these and counts of the entries) and a row per block that it asks (terms); the number
    of documents with a known term by batch."""
    rows: DataFrame
    docs_of: dict
    n_blocks: int

    @property
    def n_docs(self) -> int:
        return sum(self.docs_of.values())

    @property
    def docs(self) -> DataFrame:
        """(chunk, batch, doc_id)."""
        def ids(batches):
            for b in batches:
                for chunk, batch, packed in zip(b.column("chunk").to_pylist(), b.column("batch").to_pylist(), b.column("ids")):
                    own = np.frombuffer(packed.as_buffer(), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), chunk, np.int32)), pa.array(np.full(len(own), batch, np.int32)), pa.array(own)],
                                                     ["chunk", "batch", "doc_id"])
        return self.of(None).select("chunk", "batch", "ids").mapInArrow(ids, "chunk int, batch int, doc_id long")

    def of(self, batch: int | None, asked: bool = False) -> DataFrame:
        """The rows of documents, or what is asked, of a batch (all of them without one)."""
        rows = self.rows.filter((F.col("block") >= 0) if asked else (F.col("block") < 0))
        return rows if batch is None else rows.filter(F.col("batch") == batch)


def _deal(batches):
    """Rows (chunk, doc_id, term_id, n) of a task -> DEALT: a packed row per chunk and ``ROWS_AT_ONCE`` rows."""
    def packed(parts):
        chunk, doc, term, n = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((doc, chunk))
        chunk, doc, term, n = chunk[order], doc[order], term[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], chunk[1:] != chunk[:-1])))
        docs = [np.diff(d, prepend=0).tobytes() for d in np.split(doc, first[1:])]  # mostly 0: it is compressed on its way
        yield pa.record_batch([pa.array(chunk[first]), pa.array(docs, pa.binary()), *(
            pa.array([x.tobytes() for x in np.split(c, first[1:])], pa.binary()) for c in (term, n))], names=["chunk", "docs", "terms", "counts"])

    held, rows = [], 0
    for b in batches:
        held.append([b.column(i).to_numpy(zero_copy_only=False) for i in range(4)])
        rows += b.num_rows
        if rows >= ROWS_AT_ONCE:
            yield from packed(held)
            held, rows = [], 0
    if rows:
        yield from packed(held)


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _pack(n_blocks: int, batches: int):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        chunk = key[0].as_py()
        batch = chunk % batches
        doc = np.concatenate([np.cumsum(np.frombuffer(d.as_buffer(), np.int64)) for d in rows.column("docs")])
        term, n = _joined(rows.column("terms"), np.int32), _joined(rows.column("counts"), np.float64)
        order = np.lexsort((n, term, doc))
        doc, term, n = doc[order], term[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        own, at = np.unique(term, return_inverse=True)
        block = own % n_blocks
        asked = [(int(b), own[block == b].tobytes()) for b in np.unique(block)]
        sizes = np.diff(np.append(first, len(doc))).astype(np.int32)
        none = [None] * len(asked)
        pack = lambda x: [x.tobytes(), *none]
        return pa.table({"batch": pa.array([batch] * (len(asked) + 1), pa.int32()), "chunk": pa.array([chunk] * (len(asked) + 1), pa.int32()),
                         "block": pa.array([-1, *(b for b, _ in asked)], pa.int32()), "n": pa.array([len(first), *none], pa.int64()),
                         "ids": pa.array(pack(doc[first]), pa.binary()), "sizes": pa.array(pack(sizes), pa.binary()),
                         "terms": pa.array([own.tobytes(), *(t for _, t in asked)], pa.binary()),
                         "at": pa.array(pack(at.astype(np.int32)), pa.binary()), "counts": pa.array(pack(n), pa.binary())})
    return run


def pack(bow: DataFrame, batches: int = BATCHES, chunk_docs: int | None = None) -> Corpus:
    """``bow`` is (doc_id, term_id, tf). A batch and a chunk follow from the
    document's id alone, whatever the partitioning; ``chunk_docs``: about so many documents a chunk."""
    spark = bow.sparkSession
    rows = bow.filter("tf > 0").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("term_id").cast("int").alias("term_id"), F.col("tf").cast("double").alias("n"))
    s = rows.agg(F.count(F.lit(1)).alias("pairs"), F.max("term_id").alias("most")).first()
    if chunk_docs is None:
        chunks = max(1, math.ceil(s["pairs"] / batches / CHUNK_PAIRS), min(MIN_CHUNKS, math.ceil(s["pairs"] / batches / MIN_CHUNK_PAIRS)))
    else:
        chunks = max(1, math.ceil(rows.agg(F.approx_count_distinct("doc_id")).first()[0] / batches / chunk_docs))
    n_blocks = min(MAX_BLOCKS, max(MIN_BLOCKS, math.ceil((s["most"] or 0) / BLOCK_TERMS)))
    batch = F.pmod(F.xxhash64(F.lit("batch"), "doc_id"), F.lit(batches)).cast("int")
    chunk = (F.pmod(F.xxhash64(F.lit("chunk"), "doc_id"), F.lit(chunks)) * batches + batch).cast("int")
    dealt = rows.select(chunk.alias("chunk"), "doc_id", "term_id", "n").mapInArrow(_deal, DEALT)
    packed = stored(dealt.groupBy("chunk").applyInArrow(_pack(n_blocks, batches), PACKED), "packed")
    collect_garbage(spark)
    found = packed.filter("block < 0").groupBy("batch").agg(F.sum("n").alias("n")).collect()
    return Corpus(packed, {r["batch"]: r["n"] for r in found}, n_blocks)


# ---- the model


@dataclass
class Model:
    """``terms`` is (term_id, eta, lam array<double>); ``totals`` the sum of lam per topic."""
    terms: DataFrame
    alpha: np.ndarray
    totals: np.ndarray
    updates: int = 0
    eta_total: float = 0.0
    options: dict = field(default_factory=dict)

    @property
    def k(self) -> int:
        return len(self.alpha)


def with_totals(terms: DataFrame, alpha: np.ndarray, updates: int, options: dict) -> Model:
    k = len(alpha)
    sums = terms.agg(*[F.sum(F.col("lam")[i]).alias(f"s{i}") for i in range(k)], F.sum("eta").alias("eta")).first()
    return Model(terms, alpha, np.array([sums[i] or 0.0 for i in range(k)]), updates, sums["eta"] or 0.0, options)


def noise(seed: int, term: Column, topic: Column) -> Column:
    """A number in [0, 1) that depends on seed, term and topic only."""
    text = F.concat_ws(":", F.lit(seed).cast("string"), term.cast("string"), topic.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / float(1 << 32)


def start(vocab: DataFrame, k: int, seed: int, prior: str = "auto", eta: str | float = "auto",
          iterations: int = 200, threshold: float = THRESHOLD) -> Model:
    """The model before any update: statistics scattered around one by a hash of
    seed, term and topic."""
    eta0 = 1.0 / k if eta in ("auto", "symmetric") else float(eta)
    lam = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda t: noise(seed, F.col("term_id"), t) + 0.5)
    terms = frozen(vocab.select(F.col("term_id").cast("int").alias("term_id"), F.lit(eta0).alias("eta"), lam.alias("lam")))
    return with_totals(terms, start_prior(prior, k), 0,
                       {"prior": prior, "eta": eta, "iterations": iterations, "threshold": threshold})


# ---- E step


#: Weights (padding included) of the documents that take their rounds together, in bytes: enough that a round is
#: arithmetic and not numpy calls, and little enough for a core's share of the cache.
GROUP_BYTES = 40 << 15
#: Share of a group's documents below which those that are done leave it.
KEEP = 0.8
#: Entries that are taken at once where no rounds are.
PAIRS = 1 << 15
#: float32 weights are used as such for documents of at most so many words: sums of more would not resolve the threshold.
SINGLE_WORDS = 1000
#: Rows whose digamma is taken at once.
ROWS = 1 << 12


def shares_at(beta: np.ndarray, at: np.ndarray, counts: np.ndarray, sizes: np.ndarray, alpha: np.ndarray, iterations: int, threshold: float,
              each: np.ndarray | None = None):
    """gamma of each document and exp(E[log theta]); ``beta`` is exp(E[log beta]) (terms x K) up to a factor per term, ``at``
    the rows of the documents' terms, document after document, ``sizes`` terms each. Documents of about one size
    take their rounds together, padded with entries of count 0, and each stops on its own. Rounds are in the type of
    ``beta``, those of long documents in doubles. ``each`` receives count / phi of every entry at the end."""
    gamma = np.ones((len(sizes), len(alpha)))
    if iterations:
        gamma[sizes == 0] = alpha
    theta = _exp_log(gamma)
    first = np.cumsum(sizes) - sizes
    words = np.add.reduceat(np.append(counts, 0.0), first) * (sizes > 0) if len(sizes) else sizes
    single = beta.dtype == np.float32
    for kind, mine in ((np.float32, words <= SINGLE_WORDS), (np.float64, words > SINGLE_WORDS)) if single else ((np.float64, np.ones(len(sizes), bool)),):
        order = np.flatnonzero(mine & (sizes > 0))
        order, most = order[np.argsort(sizes[order], kind="stable")], GROUP_BYTES // (len(alpha) * np.dtype(kind).itemsize)
        while len(order):
            widths = sizes[order[:most]]
            fit = max(1, int((np.arange(1, len(widths) + 1) * widths <= most).sum()))
            live, order = order[:fit], order[fit:]
            _rounds(beta, at, counts, sizes, first, alpha, iterations, threshold, live, kind, gamma, theta, each)
    return gamma, theta


def _rounds(beta, at, counts, sizes, first, alpha, iterations, threshold, live, kind, gamma, theta, each) -> None:
    """The rounds of the documents ``live``, which are in the order of their sizes."""
    place = np.arange(sizes[live[-1]])
    real = place < sizes[live][:, None]
    entry = np.where(real, first[live][:, None] + place, first[live][:, None])
    weights = np.ascontiguousarray(beta.take(at.take(entry), axis=0).transpose(0, 2, 1), dtype=kind)  # documents x K x entries
    n = np.where(real, counts.take(entry), 0.0).astype(kind)
    rows, tiny = np.arange(len(live)), kind(TINY if kind is np.float64 else TINY_SINGLE)

    def over_phi(t, weights, n):
        phi = np.matmul(t.astype(kind)[:, None, :], weights)[:, 0, :]
        phi += tiny
        return np.divide(n, phi, out=phi)

    def done(of, g, t, weights, n):
        gamma[live[of]], theta[live[of]] = g, t
        if each is not None:
            own = real[of]
            each[entry[of][own]] = over_phi(t, weights, n)[own]

    g, t, going, kept, left = gamma[live], theta[live], np.ones(len(live), bool), None, len(live)
    for _ in range(iterations):
        after = np.matmul(weights, over_phi(t, weights, n)[:, :, None])[:, :, 0] * t
        after += alpha
        moved = np.abs(np.subtract(after, g, out=g), out=g).sum(axis=1) >= threshold * len(alpha)
        if left < len(rows):  # documents that are done stay as they are
            stay = ~going
            after[stay] = kept[stay]
        g, t = after, _exp_log(after)
        going &= moved
        left = int(np.count_nonzero(going))
        if not left:
            break
        if left < KEEP * len(rows):  # drop the documents that are done
            over = ~going
            done(rows[over], g[over], t[over], weights[over], n[over])
            rows, g, t, weights, n = rows[going], g[going], t[going], weights[going], n[going]
            going = np.ones(left, bool)
        kept = g.copy() if left < len(rows) else None
    done(rows, g, t, weights, n)


def shares_of(weights: np.ndarray, counts: np.ndarray, sizes: np.ndarray, alpha: np.ndarray, iterations: int, threshold: float):
    """The same with a row of ``weights`` per entry."""
    return shares_at(weights, np.arange(len(weights)), counts, sizes, alpha, iterations, threshold)


def word_sums(beta: np.ndarray, at: np.ndarray, counts: np.ndarray, sizes: np.ndarray, theta: np.ndarray, each: np.ndarray | None = None) -> np.ndarray:
    """Per row of ``beta`` the sum of count / phi * theta over its entries; ``each`` is count / phi, if ``shares_at`` was asked for it."""
    shares, at = np.ascontiguousarray(theta.T), at.astype(np.int64)
    if each is None:
        each = np.full(len(at), TINY)
        for b, t in zip(np.ascontiguousarray(beta.T), shares):
            each += b.take(at) * np.repeat(t, sizes)
        np.divide(counts, each, out=each)
    sums = np.empty((len(shares), len(beta)))
    for k, t in enumerate(shares):
        sums[k] = np.bincount(at, np.repeat(t, sizes) * each, len(beta))
    return np.ascontiguousarray(sums.T)


def _psi_parts(x: np.ndarray):
    """(a, b) with digamma(x) = log(a) - 2 b to 1e-9: exp(digamma(y)) is a series in z = y - 1/2, used at y = x + 6; the
    six 1 / (x + i) in between are one fraction in u = x (x + 5)."""
    u = (x + 5.0) * x
    b = ((u * 3.0 + 20.0) * u + 24.0) / (((u + 10.0) * u + 24.0) * u) * (x + 2.5)
    z = x + 5.5
    q = 1.0 / z
    r = q * q
    return z + q * (1 / 24 - r * (37 / 5760 - r * (10313 / 2903040 - r * (5509121 / 1393459200)))), b


def _exp_log(gamma: np.ndarray) -> np.ndarray:
    """exp(digamma(x) - digamma(the row's sum)), in few passes: it is taken every round."""
    a, b = _psi_parts(np.concatenate((gamma, gamma.sum(axis=1, keepdims=True)), axis=1))
    return np.exp(2.0 * (b[:, -1:] - b[:, :-1])) * (a[:, :-1] / a[:, -1:])


def exp_log_beta(lam: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """exp(digamma(lam) - digamma(totals)) of many rows, as doubles, a few at a time in the cache; 0 where lam is 0."""
    out, (a0, b0) = np.empty(lam.shape), _psi_parts(np.asarray(totals, float))
    for i in range(0, len(lam), ROWS):
        x = lam[i:i + ROWS].astype(float)
        known = x > 0
        x[~known] = 1.0
        a, b = _psi_parts(x)
        out[i:i + ROWS] = np.exp(2.0 * (b0 - b)) * (a / a0) * known
    return out


def _flat_sizes(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _table(**columns) -> pa.Table:
    return pa.table({name: pa.array(values, t) for name, (values, t) in columns.items()})


def _messages(block=(), chunk=(), terms=(), v=()) -> pa.Table:
    return _table(block=(block, pa.int32()), chunk=(chunk, pa.int32()), terms=(terms, pa.binary()), v=(v, pa.binary()))


def _lists(values: np.ndarray) -> pa.ListArray:
    """A list per row of a matrix."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)), pa.array(np.ascontiguousarray(values).ravel()))


def _in_blocks(model: Model, n_blocks: int) -> DataFrame:
    return model.terms.select(F.pmod("term_id", F.lit(n_blocks)).cast("int").alias("block"), "term_id", "eta", "lam").groupBy("block")


def sent(corpus: Corpus, model: Model, batch: int | None) -> DataFrame:
    """MESSAGE rows: the statistics of the terms that each chunk asks of a block, those that the model has."""
    k = model.k

    def send(block: pa.Table, asked: pa.Table) -> pa.Table:
        if not block.num_rows or not asked.num_rows:
            return _messages()
        terms = block.column("term_id").to_numpy()
        order = np.argsort(terms)
        terms, lam, out = terms[order], _flat(block.column("lam")).reshape(-1, k)[order], []
        for a in asked.column("terms"):
            wanted = np.frombuffer(a.as_buffer(), np.int32)
            at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
            known = terms[at] == wanted
            out.append((wanted[known].tobytes(), lam[at[known]].tobytes()))
        return _messages(asked.column("block").to_pylist(), asked.column("chunk").to_pylist(), *zip(*out))

    asked = corpus.of(batch, asked=True).select("block", "chunk", "terms")
    return _in_blocks(model, corpus.n_blocks).cogroup(asked.groupBy("block")).applyInArrow(send, MESSAGE)


def _shares(model: Model, docs: pa.Table, stats: pa.Table):
    """(ids, sizes, terms of the model with their blocks, beta, entries' places and counts, gamma, theta) of a chunk."""
    stats = stats.sort_by("block")
    terms = _joined(stats.column("terms"), np.int32)
    block = np.repeat(stats.column("block").to_numpy(), [len(t.as_buffer()) // 4 for t in stats.column("terms")])
    beta = np.exp(digamma(_joined(stats.column("v"), float).reshape(-1, model.k)) - digamma(model.totals))
    ids, sizes, own, at, n = (_joined(docs.column(c), t) for c, t in (("ids", np.int64), ("sizes", np.int32), ("terms", np.int32), ("at", np.int32), ("counts", float)))
    place = np.full(len(own), -1)
    place[np.searchsorted(own, terms)] = np.arange(len(terms))
    at, of = place[at], np.repeat(np.arange(len(sizes)), sizes)
    known = at >= 0
    at, n, of = at[known], n[known], of[known]
    sizes = np.bincount(of, minlength=len(sizes))
    gamma, theta = shares_at(beta, at, n, sizes, model.alpha, model.options["iterations"], model.options["threshold"])
    return ids, sizes, terms, block, beta, at, n, gamma, theta


def _bare(model: Model) -> Model:
    """What tasks need of a model: its numbers, and no table."""
    return Model(None, model.alpha, model.totals, model.updates, model.eta_total, model.options)


def e_step(corpus: Corpus, model: Model, batch: int | None = None, want_shares: bool = False) -> DataFrame:
    """MESSAGE rows of sums, and per chunk one (block -1) of its documents' E[log theta]; with
    ``want_shares`` (id, v): gamma of each document."""
    bare = _bare(model)

    def sums(docs: pa.Table, stats: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _messages()
        ids, sizes, terms, block, beta, at, n, gamma, theta = _shares(bare, docs, stats)
        found = word_sums(beta, at, n, sizes, theta) * beta
        logs = (digamma(gamma) - digamma(gamma.sum(axis=1, keepdims=True))).sum(axis=0)
        blocks, first = np.unique(block, return_index=True)
        return _messages([*blocks.tolist(), -1], [docs.column("chunk")[0].as_py()] * (len(blocks) + 1),
                         [*(t.tobytes() for t in np.split(terms, first[1:]) if len(t)), b""], [*(v.tobytes() for v in np.split(found, first[1:]) if len(v)), logs.tobytes()])

    def shares(docs: pa.Table, stats: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "v": pa.array([], pa.list_(pa.float64()))})
        ids, *_, gamma, _ = _shares(bare, docs, stats)
        return pa.table({"id": pa.array(ids), "v": _lists(gamma)})

    docs = corpus.of(batch).select("chunk", "ids", "sizes", "terms", "at", "counts").groupBy("chunk")
    messages = sent(corpus, model, batch).groupBy("chunk")
    return docs.cogroup(messages).applyInArrow(*((shares, "id long, v array<double>") if want_shares else (sums, MESSAGE)))


# ---- M step


def _added(k: int):
    """The sums of a block's chunks, in their order, as one row."""
    def run(key: tuple[pa.Scalar, ...], sums: pa.Table) -> pa.Table:
        sums = sums.sort_by("chunk")
        if key[0].as_py() < 0:  # of E[log theta]
            terms, total = b"", sum((np.frombuffer(v.as_buffer()) for v in sums.column("v")), np.zeros(k))
        else:
            own = np.unique(_joined(sums.column("terms"), np.int32))
            terms, total = own.tobytes(), np.zeros((len(own), k))
            for t, v in zip(sums.column("terms"), sums.column("v")):
                total[np.searchsorted(own, np.frombuffer(t.as_buffer(), np.int32))] += np.frombuffer(v.as_buffer()).reshape(-1, k)
        return _messages([key[0].as_py()], [sums.column("chunk")[0].as_py()], [terms], [total.tobytes()])
    return run


def _sums(corpus: Corpus, model: Model, batch: int | None) -> DataFrame:
    """MESSAGE rows of an update's sums. All documents are taken a batch after the other: what is
    sent both ways is on disk for one of them at a time, and a batch leaves a row per block."""
    if batch is not None:
        return e_step(corpus, model, batch)
    parts = None
    for b in sorted(corpus.docs_of):
        part = frozen(e_step(corpus, model, b).groupBy("block").applyInArrow(_added(model.k), MESSAGE))
        parts = part if parts is None else parts.unionByName(part)
        collect_garbage(model.terms.sparkSession)
    return parts


def update(corpus: Corpus, model: Model, batch: int | None = None) -> Model:
    """One update from the documents of a batch (all of them without one)."""
    k, opts = model.k, model.options
    n = corpus.n_docs if batch is None else corpus.docs_of.get(batch, 0)
    if not n:
        return model
    rho, scale = (OFFSET + model.updates) ** -DECAY, corpus.n_docs / n

    def m_step(block: pa.Table, sums: pa.Table) -> pa.Table:
        sums = sums.sort_by("chunk")
        if not block.num_rows:  # the sums of E[log theta]
            logs = sum((np.frombuffer(v.as_buffer()) for v in sums.column("v")), np.zeros(k))
            return pa.table({"term_id": pa.array([None], pa.int32()), "eta": pa.array([0.0]), "lam": _lists(logs[None])})
        terms, eta, lam = block.column("term_id").to_numpy(), block.column("eta").to_numpy(), _flat(block.column("lam")).reshape(-1, k)
        order = np.argsort(terms)
        gained = np.zeros((len(terms), k))
        for t, v in zip(sums.column("terms"), sums.column("v")):
            at = order[np.searchsorted(terms, np.frombuffer(t.as_buffer(), np.int32), sorter=order)]
            gained[at] += np.frombuffer(v.as_buffer()).reshape(-1, k)
        lam = lam * (1 - rho) + (eta[:, None] + gained * scale) * rho
        return pa.table({"term_id": pa.array(terms, pa.int32()), "eta": pa.array(eta), "lam": _lists(lam)})

    sums = _sums(corpus, model, batch).groupBy("block")
    step = frozen(_in_blocks(model, corpus.n_blocks).cogroup(sums).applyInArrow(m_step, "term_id int, eta double, lam array<double>"))
    collect_garbage(model.terms.sparkSession)
    alpha = model.alpha
    if opts["prior"] == "auto":
        logs = step.filter("term_id is null").first()["lam"]
        alpha = newton(alpha, n, np.array(logs) / n, rho)
    after = with_totals(step.filter("term_id is not null"), alpha, model.updates + 1, opts)
    return with_eta(after, rho) if opts["eta"] == "auto" else after


def with_eta(model: Model, rho: float) -> Model:
    """The Newton step on eta: per term a gradient, over all terms two sums."""
    k, total, log = model.k, model.eta_total, F.log
    mean_log = F.aggregate(F.transform("lam", lambda x: digamma(x, log)), F.lit(0.0), lambda a, x: a + x) / k - float(digamma(model.totals).mean())
    gradient = k * (float(digamma(total)) - digamma(F.col("eta"), log) + mean_log)
    rows = model.terms.select("term_id", "eta", "lam", gradient.alias("g"), (-k * trigamma(F.col("eta"))).alias("q"))
    sums = rows.agg(F.sum(F.col("g") / F.col("q")).alias("gq"), F.sum(1 / F.col("q")).alias("iq")).first()
    b = sums["gq"] / (1 / (k * trigamma(total)) + sums["iq"])
    after = rows.select("term_id", (F.col("eta") - rho * (F.col("g") - b) / F.col("q")).alias("eta"), "lam")
    if after.agg(F.min("eta")).first()[0] <= 0:
        return model
    return with_totals(frozen(after), model.alpha, model.updates, model.options)


def fit(vocab: DataFrame, corpus: Corpus, k: int, seed: int = 42, passes: int = 15, prior: str = "auto",
        iterations: int = 200, eta: str | float = "auto", threshold: float = THRESHOLD, batches: int = BATCHES) -> Model:
    """M2: ``passes`` over the corpus, ``batches`` (as packed) updates each."""
    model = start(vocab, k, seed, prior, eta, iterations, threshold)
    for p in range(passes):
        for b in range(batches):
            model = update(corpus, model, (b + p) % batches)
    return model


# ---- what a model answers


def infer(corpus: Corpus, model: Model) -> DataFrame:
    """M4: (doc_id, topics map<int, double>) of every packed document."""
    v = F.col("v")
    total = F.aggregate(v, F.lit(0.0), lambda a, x: a + x)
    shares = F.transform(v, lambda x: x / total)
    gammas = e_step(corpus, model, want_shares=True)
    return gammas.select(F.col("id").alias("doc_id"), F.map_from_arrays(F.sequence(F.lit(0), F.lit(model.k - 1)), shares).alias("topics"))


def infer_all(docs: DataFrame, corpus: Corpus, model: Model, keep=("doc_id", "journal", "year", "title")) -> DataFrame:
    """M4 for every row of ``docs``: those without a known term get the normalised alpha."""
    prior = model.alpha / model.alpha.sum()
    none = F.map_from_arrays(F.sequence(F.lit(0), F.lit(model.k - 1)), F.array(*[F.lit(float(a)) for a in prior]))
    return docs.select(*keep).join(infer(corpus, model), "doc_id", "left").select(*keep, F.coalesce("topics", none).alias("topics"))


def top_words(model: Model, vocab: DataFrame, n: int = 10) -> DataFrame:
    """M5: (topic_id, rank, word, p), ties by word."""
    from topiary.operators.ranking import top_n_per_group
    rows = explode_rows(model.terms.select("term_id", "lam"), ["term_id"], F.col("lam"), ["topic_id", "lam_kw"], with_pos=True)
    total = F.array(*[F.lit(float(t)) for t in model.totals])
    rows = rows.join(vocab.select("term_id", F.col("token").alias("word")), "term_id") \
               .select(F.col("topic_id").cast("int").alias("topic_id"), "word", (F.col("lam_kw") / F.get(total, F.col("topic_id"))).alias("p"))
    return top_n_per_group(rows, ["topic_id"], [F.desc("p"), F.asc("word")], n).select("topic_id", "rank", "word", "p")


def save(model: Model, path: str) -> None:
    """The table, and a row with everything else."""
    spark = model.terms.sparkSession
    model.terms.write.mode("overwrite").parquet(os.path.join(path, "terms"))
    o = model.options
    spark.createDataFrame([(model.alpha.tolist(), model.updates, o["prior"], str(o["eta"]), o["iterations"], o["threshold"])],
                          "alpha array<double>, updates int, prior string, eta string, iterations int, threshold double") \
         .coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "state"))


def load(spark: SparkSession, path: str) -> Model:
    s = spark.read.parquet(os.path.join(path, "state")).first()
    eta = s["eta"] if s["eta"] in ("auto", "symmetric") else float(s["eta"])
    return with_totals(spark.read.parquet(os.path.join(path, "terms")), np.array(s["alpha"]), s["updates"],
                       {"prior": s["prior"], "eta": eta, "iterations": s["iterations"], "threshold": s["threshold"]})


def grid_fitter(vocab: DataFrame, corpus: Corpus, batches: int = BATCHES) -> Callable:
    """M3: what ``model.fit_grid`` calls to fit and save one grid point; every value
    of the grid is taken, the inner iteration cap included."""
    def one(point, path: str) -> None:
        save(fit(vocab, corpus, point["k"], point["random_state"], point["num_pass"], point["dir_prior"], point["iteration"], batches=batches), path)
    return one
