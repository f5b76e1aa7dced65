"""c_v topic coherence (Roeder, Both, Hinneburg, WSDM 2015).

Probabilities come from boolean sliding windows of ``window`` tokens over
each text (a text shorter than the window is one window; only texts holding
at least one of a model's top words count towards that model's total).
NPMI(i, j) = log((P_ij + e) / (P_i P_j)) / -log(P_ij + e), e = 1e-12; every
top word gets the vector of its NPMI with all top words of its topic; the
topic vector is their sum; c_v is the mean cosine of word vector and topic
vector, averaged over topics.

Spark plan, all counting exact:
1. The top words (models x K x top_n rows, bounded) and the pairs of words that
   share a topic of some model go to every task. Whether a window holds a word
   does not depend on the model, so a pair is counted once, however many models
   have it.
2. The windows of a batch of texts lie on one axis, text after text, cut into
   blocks of ``BLOCK`` window starts. A hit at position p covers the starts
   [max(0, p-W+1), min(p, max(0, n-W))]; in a block each word present is a row
   of BLOCK bits, the union of its hits. occ(w) is the bits set; co(w1, w2) those
   set in both rows, for the wanted pairs that are present.
3. A task adds these up over its texts and hands on one row per word, pair and
   model that it saw; the sums over tasks are the only shuffle. A text of any
   length is a run of blocks, so memory does not grow with it beyond its own tokens.
4. NPMI, vectors and cosines run on the top-word grid (models x K x top_n^2
   rows).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiary.functions import batches as B
from topiary.session import frozen

EPSILON = 1e-12
WINDOW = 110
TOP_N = 20
#: Window starts of a block, and pairs whose bits are compared at once.
BLOCK = 1024
PAIRS_AT_ONCE = 16_384
OCC, CO, NWIN = 0, 1, 2


def _counter(words: list, pairs: np.ndarray, models: list, of_model: np.ndarray, window: int):
    """(tokens) -> (kind, model_id, w1, w2, n) of a task: sums of its texts. ``pairs``
    are indices into ``words``, ``of_model`` says which words a model has."""
    known, block = pa.array(words, pa.string()), max(BLOCK, window)
    first, second = pairs.T
    masks = np.packbits(of_model, axis=1)
    ones = np.packbits(np.tri(block + 1, block, -1, dtype=bool), axis=1, bitorder="little")  # row i: the first i bits
    ones = np.ascontiguousarray(np.pad(ones, ((0, 0), (0, -ones.shape[1] % 8)))).view(np.uint64)

    def run(batches):
        occ, co, nwin = np.zeros(len(words), np.int64), np.zeros(len(pairs), np.int64), np.zeros(len(models), np.int64)
        for batch in B.pieces(batches, 0):
            n, codes, found = B.coded(batch.column(0))
            word = np.append(pc.fill_null(pc.index_in(found, value_set=known), -1).to_numpy(zero_copy_only=False), -1)[codes]
            hit = np.flatnonzero(word >= 0)
            if not len(hit):
                continue
            word, row = word[hit], np.repeat(np.arange(len(n)), n)[hit]
            starts = np.maximum(n - window, 0) + 1  # windows of a text
            seen = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            has = np.unpackbits(np.bitwise_or.reduceat(masks[word], seen, axis=0), axis=1, count=len(models))
            nwin += starts[row[seen]] @ has.astype(np.int64)
            pos, base = hit - (np.cumsum(n) - n)[row], (np.cumsum(starts) - starts)[row]
            lo, hi = base + np.maximum(pos - (window - 1), 0), base + np.minimum(pos, starts[row] - 1)
            over = np.flatnonzero(hi // block > lo // block)  # reaches into the next block
            at = np.concatenate((lo // block, hi[over] // block))
            word = np.concatenate((word, word[over]))
            hi = np.concatenate((np.minimum(hi, (lo // block + 1) * block - 1), hi[over])) % block
            lo = np.concatenate((lo % block, np.zeros(len(over), np.int64)))
            key = at * len(words) + word
            order = np.argsort(key, kind="stable")
            key, lo, hi = key[order], lo[order], hi[order]
            run_at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            at, word = key[run_at] // len(words), key[run_at] % len(words)
            block_at = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            place = np.full(len(words), -1)
            for i, j in zip(block_at, np.append(block_at[1:], len(at))):
                a, z = run_at[i], run_at[j] if j < len(run_at) else len(key)
                bits = np.bitwise_or.reduceat(ones[hi[a:z] + 1] & ~ones[lo[a:z]], run_at[i:j] - a, axis=0)
                here = word[i:j]
                occ[here] += np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
                place[here] = np.arange(j - i)
                both = np.flatnonzero((place[first] >= 0) & (place[second] >= 0))
                for c in range(0, len(both), PAIRS_AT_ONCE):
                    p = both[c:c + PAIRS_AT_ONCE]
                    co[p] += np.bitwise_count(bits[place[first[p]]] & bits[place[second[p]]]).sum(axis=1, dtype=np.int64)
                place[here] = -1
        w, p, m = np.flatnonzero(occ), np.flatnonzero(co), np.flatnonzero(nwin)
        for kind, n, columns in ((OCC, occ[w], {"w1": known.take(pa.array(w))}),
                                 (CO, co[p], {"w1": known.take(pa.array(first[p])), "w2": known.take(pa.array(second[p]))}),
                                 (NWIN, nwin[m], {"model_id": pa.array([models[i] for i in m], pa.int64())})):
            rows = {"kind": pa.array(np.full(len(n), kind, np.int32)), "model_id": pa.nulls(len(n), pa.int64()),
                    "w1": pa.nulls(len(n), pa.string()), "w2": pa.nulls(len(n), pa.string()), "n": pa.array(n)}
            yield from pa.table(rows | columns).to_batches()
    return run


def window_counts(texts: DataFrame, top: DataFrame, window: int = WINDOW, tokens_col: str = "tokens"):
    """E1. ``top`` = (model_id, topic_id, word); a row of ``texts`` is a text. Returns three DataFrames:
    occ(word, occ), co(model_id, topic_id, w1, w2, co) with w1 < w2 and
    co > 0, nwin(model_id, num_windows)."""
    tw = frozen(top.select("model_id", "topic_id", "word").filter("word is not null").distinct())
    wanted = frozen(pair_grid(tw).filter("wi < wj").withColumnsRenamed({"wi": "w1", "wj": "w2"}))
    # bounded by models x K x top_n (pairs: x top_n / 2), whatever the texts
    has = [(r["model_id"], r["word"]) for r in tw.select("model_id", "word").distinct().collect()]
    words, models = sorted({w for _, w in has}), sorted({m for m, _ in has})
    at, of = {w: i for i, w in enumerate(words)}, {m: i for i, m in enumerate(models)}
    pairs = np.array([(at[r["w1"]], at[r["w2"]]) for r in wanted.select("w1", "w2").distinct().collect()], np.int64).reshape(-1, 2)
    of_model = np.zeros((len(words), len(models)), bool)
    for m, w in has:
        of_model[at[w], of[m]] = True
    counts = texts.select(tokens_col).mapInArrow(_counter(words, pairs, models, of_model, window), "kind int, model_id long, w1 string, w2 string, n long")
    counts = frozen(counts.groupBy("kind", "model_id", "w1", "w2").agg(F.sum("n").alias("n")))
    occ = counts.filter(F.col("kind") == OCC).select(F.col("w1").alias("word"), F.col("n").alias("occ"))
    co = wanted.join(counts.filter(F.col("kind") == CO).select("w1", "w2", F.col("n").alias("co")), ["w1", "w2"])
    nwin = counts.filter(F.col("kind") == NWIN).select(F.col("model_id").cast(top.schema["model_id"].dataType).alias("model_id"), F.col("n").alias("num_windows"))
    return occ, co.select("model_id", "topic_id", "w1", "w2", "co"), nwin


def pair_grid(top: DataFrame) -> DataFrame:
    """(model_id, topic_id, wi, wj) for all ordered pairs of a topic's top
    words, diagonal included: top_n^2 rows per topic (bounded)."""
    a = top.select("model_id", "topic_id", F.col("word").alias("wi"))
    b = top.select("model_id", "topic_id", F.col("word").alias("wj"))
    return a.join(b, ["model_id", "topic_id"])


def npmi(top: DataFrame, occ: DataFrame, co: DataFrame, nwin: DataFrame, eps: float = EPSILON) -> DataFrame:
    """(model_id, topic_id, wi, wj, npmi, co_ij) over the top-word grid.
    ``occ`` holds a row per word, or per model and word."""
    g = pair_grid(top)
    by = [c for c in occ.columns if c == "model_id"]
    g = (g.join(F.broadcast(occ.select(*by, F.col("word").alias("wi"), F.col("occ").alias("occ_i"))), [*by, "wi"], "left")
          .join(F.broadcast(occ.select(*by, F.col("word").alias("wj"), F.col("occ").alias("occ_j"))), [*by, "wj"], "left"))
    c = co.select("model_id", "topic_id", "w1", "w2", "co")
    g = g.join(c, (g.model_id == c.model_id) & (g.topic_id == c.topic_id)
               & (F.least(g.wi, g.wj) == c.w1) & (F.greatest(g.wi, g.wj) == c.w2), "left") \
         .select(g["*"], c.co.alias("__co"))
    g = g.join(F.broadcast(nwin), "model_id")
    occ_i = F.coalesce(F.col("occ_i"), F.lit(0)).cast("double")
    occ_j = F.coalesce(F.col("occ_j"), F.lit(0)).cast("double")
    co_ij = F.when(F.col("wi") == F.col("wj"), occ_i).otherwise(F.coalesce(F.col("__co"), F.lit(0)).cast("double"))
    n = F.col("num_windows").cast("double")
    p_ij = co_ij / n
    ratio = F.try_divide(p_ij + F.lit(eps), (occ_i / n) * (occ_j / n))
    val = F.log(ratio) / (-F.log(p_ij + F.lit(eps)))
    return g.select("model_id", "topic_id", "wi", "wj", val.alias("npmi"), co_ij.alias("co_ij"), "num_windows")


def cv_by_topic(nm: DataFrame) -> DataFrame:
    """E3 per topic: mean over top words of cos(word vector, topic vector)."""
    v = nm.groupBy("model_id", "topic_id", "wj").agg(F.sum("npmi").alias("vj"))
    vnorm = v.groupBy("model_id", "topic_id").agg(F.sqrt(F.sum(F.col("vj") * F.col("vj"))).alias("vnorm"))
    per_word = (nm.join(v, ["model_id", "topic_id", "wj"])
                  .groupBy("model_id", "topic_id", "wi")
                  .agg(F.sum(F.col("npmi") * F.col("vj")).alias("dot"),
                       F.sqrt(F.sum(F.col("npmi") * F.col("npmi"))).alias("norm")))
    per_word = per_word.join(vnorm, ["model_id", "topic_id"])
    cos = F.try_divide(F.col("dot"), F.col("norm") * F.col("vnorm"))
    return per_word.groupBy("model_id", "topic_id").agg(F.avg(cos).alias("coherence"))


def coherence_cv(texts: DataFrame, top: DataFrame, window: int = WINDOW,
                 tokens_col: str = "tokens") -> DataFrame:
    """(model_id, coherence) — mean of topic coherences."""
    top = frozen(top)  # the top-word table (models x K x top_n rows) feeds five branches
    occ, co, nwin = window_counts(texts, top, window, tokens_col)
    per_topic = cv_by_topic(npmi(top, occ, co, nwin))
    return per_topic.groupBy("model_id").agg(F.avg("coherence").alias("coherence"))
