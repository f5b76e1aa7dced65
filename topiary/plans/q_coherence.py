"""Queries for E1-E8 (c_v coherence and topic tables) on the stand-in model.

Texts are the full T8 tokens of the cleaned documents; the model is the hash
stand-in (FIXTURES.md), one model (K=10) for E1-E3/E7/E8 and a grid of
stand-in models (K 2..20 x seeds 42/99, the seed salting the hash) for
E4-E6. The stand-in has no passes/iterations, so grid points that differ
only there share one assignment and one score.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from topiary.operators import coherence as CO
from topiary.operators import incremental as INC
from topiary.operators import tables as TB
from topiary.operators import topics as TP
from topiary.plans import sql as S
from topiary.plans.catalog import register
from topiary.plans.q_views import K, standin_texts, topic_terms
from topiary.session import frozen
from topiary.sources.corpus import read_table

W = CO.WINDOW


def terms_sql(top_n: int, k: int = K, salt: str | None = None, name: str = "top") -> str:
    """CTEs words/wt/tot/ranked/<name>(topic_id, rank, word, p) of a stand-in model."""
    salt_sql = None if salt is None else S.lit(salt)
    return f"""words AS (SELECT w AS word, count(*) AS cf FROM (SELECT unnest(tokens) AS w FROM texts) GROUP BY w),
wt AS (SELECT word, cf, CAST({S.word_topic('word', k, salt_sql)} AS INTEGER) AS topic_id FROM words),
tot AS (SELECT topic_id, sum(cf) AS tot FROM wt GROUP BY topic_id),
ranked AS (
  SELECT topic_id, word, cf / tot AS p,
         row_number() OVER (PARTITION BY topic_id ORDER BY cf / tot DESC, word) AS rank
  FROM wt JOIN tot USING (topic_id)),
{name} AS (SELECT topic_id, rank, word, p FROM ranked WHERE rank <= {top_n})"""


CV_SQL = f"""WITH {S.TEXTS}, {terms_sql(CO.TOP_N)},
tk AS (SELECT doc_id, len(tokens) AS n, unnest(tokens) AS w, generate_subscripts(tokens, 1) - 1 AS pos FROM texts),
hits AS (SELECT doc_id, n, w, pos FROM tk WHERE w IN (SELECT word FROM top)),
starts AS (
  SELECT DISTINCT doc_id, w, s FROM (
    SELECT doc_id, w, unnest(range(greatest(pos - {W - 1}, 0), least(pos, greatest(n - {W}, 0)) + 1)) AS s FROM hits)),
occ AS (SELECT w AS word, count(*) AS occ FROM starts GROUP BY w),
nwin AS (SELECT sum(greatest(n - {W} + 1, 1)) AS num_windows FROM (SELECT DISTINCT doc_id, n FROM hits)),
st AS (SELECT s.doc_id, s.s, s.w, t.topic_id FROM starts s JOIN top t ON t.word = s.w),
co AS (
  SELECT a.topic_id, a.w AS w1, b.w AS w2, count(*) AS co
  FROM st a JOIN st b ON a.doc_id = b.doc_id AND a.s = b.s AND a.topic_id = b.topic_id AND a.w < b.w
  GROUP BY ALL),
grid AS (SELECT a.topic_id, a.word AS wi, b.word AS wj FROM top a JOIN top b USING (topic_id)),
g AS (
  SELECT grid.topic_id, wi, wj, oi.occ AS occ_i, oj.occ AS occ_j,
         CASE WHEN wi = wj THEN oi.occ ELSE coalesce(co.co, 0) END AS co_ij, nwin.num_windows AS nw
  FROM grid LEFT JOIN occ oi ON oi.word = wi LEFT JOIN occ oj ON oj.word = wj
  LEFT JOIN co ON co.topic_id = grid.topic_id AND co.w1 = least(wi, wj) AND co.w2 = greatest(wi, wj)
  CROSS JOIN nwin),
nm AS (
  SELECT topic_id, wi, wj, co_ij, nw,
         ln((co_ij / nw + 1e-12) / ((occ_i / nw) * (occ_j / nw))) / (-ln(co_ij / nw + 1e-12)) AS npmi
  FROM g),
v AS (SELECT topic_id, wj, sum(npmi) AS vj FROM nm GROUP BY ALL),
vn AS (SELECT topic_id, sqrt(sum(vj * vj)) AS vnorm FROM v GROUP BY ALL),
pw AS (
  SELECT nm.topic_id, wi, sum(npmi * vj) AS dot, sqrt(sum(npmi * npmi)) AS norm
  FROM nm JOIN v USING (topic_id, wj) GROUP BY ALL),
cv AS (SELECT topic_id, avg(dot / (norm * vnorm)) AS coherence FROM pw JOIN vn USING (topic_id) GROUP BY ALL)"""


def _top(spark, sf, top_n=CO.TOP_N):
    texts = standin_texts(spark, sf)
    top = TP.standin_topic_terms(texts, K, top_n).withColumn("model_id", F.lit(0))
    return texts, frozen(top)


def _npmi(spark, sf):
    texts, top = _top(spark, sf)
    occ, co, nwin = CO.window_counts(texts, top)
    return CO.npmi(top, occ, co, nwin)


@register("window_occurrence", f"""{CV_SQL}
SELECT topic_id, wi AS w1, wj AS w2, co_ij AS n_windows, nw AS num_windows FROM nm WHERE wi <= wj""")
def q_window_occurrence(spark, sf):
    nm = _npmi(spark, sf).filter(F.col("wi") <= F.col("wj"))
    return nm.select("topic_id", F.col("wi").alias("w1"), F.col("wj").alias("w2"),
                     F.col("co_ij").cast("bigint").alias("n_windows"), "num_windows")


@register("npmi", f"{CV_SQL} SELECT topic_id, wi, wj, round(npmi, 6) AS npmi FROM nm")
def q_npmi(spark, sf):
    return _npmi(spark, sf).select("topic_id", "wi", "wj", F.round("npmi", 6).alias("npmi"))


@register("coherence_cv", f"{CV_SQL} SELECT topic_id, round(coherence, 6) AS coherence FROM cv")
def q_coherence_cv(spark, sf):
    per_topic = CO.cv_by_topic(_npmi(spark, sf))
    return per_topic.select("topic_id", F.round("coherence", 6).alias("coherence"))


# --- E7 / E8 topic list and topic table (top 10 words) --------------------------------

TABLE_SQL = f"WITH {S.TEXTS}, {terms_sql(10)}"


@register("topic_list", f"""{TABLE_SQL}
SELECT CAST(topic_id + 1 AS INTEGER) AS topic_no, string_agg(word, ', ' ORDER BY rank) AS words
FROM top GROUP BY topic_id""")
def q_topic_list(spark, sf):
    return TB.topic_list(topic_terms(spark, sf))


@register("topic_table", f"""{TABLE_SQL}
SELECT CAST(topic_id AS INTEGER) AS topic_id, 0 AS section, 0 AS rank,
       'TOPIC ' || CAST(topic_id AS VARCHAR) AS c1, CAST(NULL AS VARCHAR) AS c2
FROM (SELECT DISTINCT topic_id FROM top)
UNION ALL SELECT DISTINCT topic_id, 1, 0, 'word', 'prob.' FROM top
UNION ALL SELECT topic_id, 2, CAST(rank AS INTEGER), upper(word), replace(printf('%.3f', p), '0.', '.') FROM top
UNION ALL SELECT DISTINCT topic_id, 3, 0, '', NULL FROM top""")
def q_topic_table(spark, sf):
    return TB.topic_table(frozen(topic_terms(spark, sf)))  # K x 10 rows, read by each section


# --- E4-E6, S16, X5 over a grid of stand-in models ------------------------------------

GRID_SEEDS = INC.GRID_SEEDS
GRID_K = INC.GRID_K


def grid_scores(spark, sf, digits=6):
    """(k, dir_prior, random_state, num_pass, iteration, coherence_score),
    rounded to ``digits`` (None: as computed)."""
    texts = standin_texts(spark, sf)
    models = [(k * 1000 + seed, k, f"{seed}/") for seed in GRID_SEEDS for k in GRID_K]
    tops = TP.standin_topic_terms_grid(TP.word_counts(texts), models, CO.TOP_N)
    scores = CO.coherence_cv(texts, tops)
    pts = INC.grid(spark).withColumn("model_id", F.col("k") * 1000 + F.col("random_state"))
    score = F.col("coherence") if digits is None else F.round("coherence", digits)
    return pts.join(F.broadcast(scores), "model_id").select(*INC.GRID_KEY, score.alias("coherence_score"))


def q_coherence_table(spark, sf):
    return grid_scores(spark, sf)


def q_coherence_pivot(spark, sf):
    return TB.coherence_pivot(grid_scores(spark, sf), min(GRID_K), max(GRID_K))


def q_best_model(spark, sf):
    return TB.best_model(grid_scores(spark, sf))


def q_skip_scored_models(spark, sf):
    """Grid points without a score; each row of ``labels`` stands for one score stored before."""
    lab = read_table(spark, sf, "labels")
    scored = lab.select((F.lit(2) + F.col("doc_id") % 19).cast("int").alias("k"), F.lit("auto").alias("dir_prior"),
                        F.when(F.col("toxic") == 1, 42).otherwise(99).alias("random_state"),
                        F.when(F.col("quality") == 1, 5).otherwise(10).alias("num_pass"), F.lit(200).alias("iteration"))
    return INC.skip_scored_models(INC.grid(spark), scored)


#: Window counts and c_v of the topics of ``top``(model_id, topic_id, word), to ``cvt``.
COUNT_CTES = f"""tk AS (SELECT doc_id, len(tokens) AS n, unnest(tokens) AS w, generate_subscripts(tokens, 1) - 1 AS pos FROM texts),
hits AS (SELECT doc_id, n, w, pos FROM tk WHERE w IN (SELECT word FROM top)),
starts AS (
  SELECT DISTINCT doc_id, w, s FROM (
    SELECT doc_id, w, unnest(range(greatest(pos - {W - 1}, 0), least(pos, greatest(n - {W}, 0)) + 1)) AS s FROM hits)),
occ AS (SELECT w AS word, count(*) AS occ FROM starts GROUP BY w),
nwin AS (
  SELECT model_id, sum(greatest(n - {W} + 1, 1)) AS nw
  FROM (SELECT DISTINCT t.model_id, h.doc_id, h.n FROM hits h JOIN top t ON t.word = h.w) GROUP BY model_id),
st AS (SELECT s.doc_id, s.s, s.w, t.model_id, t.topic_id FROM starts s JOIN top t ON t.word = s.w),
co AS (
  SELECT a.model_id, a.topic_id, a.w AS w1, b.w AS w2, count(*) AS co
  FROM st a JOIN st b ON a.doc_id = b.doc_id AND a.s = b.s AND a.model_id = b.model_id
                      AND a.topic_id = b.topic_id AND a.w < b.w
  GROUP BY ALL),
grid AS (SELECT a.model_id, a.topic_id, a.word AS wi, b.word AS wj FROM top a JOIN top b USING (model_id, topic_id)),
g AS (
  SELECT grid.model_id, grid.topic_id, wi, wj, oi.occ AS occ_i, oj.occ AS occ_j,
         CASE WHEN wi = wj THEN oi.occ ELSE coalesce(co.co, 0) END AS co_ij, nwin.nw
  FROM grid LEFT JOIN occ oi ON oi.word = wi LEFT JOIN occ oj ON oj.word = wj
  LEFT JOIN co ON co.model_id = grid.model_id AND co.topic_id = grid.topic_id
              AND co.w1 = least(wi, wj) AND co.w2 = greatest(wi, wj)
  JOIN nwin ON nwin.model_id = grid.model_id),
nm AS (
  SELECT model_id, topic_id, wi, wj,
         ln((co_ij / nw + 1e-12) / ((occ_i / nw) * (occ_j / nw))) / (-ln(co_ij / nw + 1e-12)) AS npmi
  FROM g),
v AS (SELECT model_id, topic_id, wj, sum(npmi) AS vj FROM nm GROUP BY ALL),
vn AS (SELECT model_id, topic_id, sqrt(sum(vj * vj)) AS vnorm FROM v GROUP BY ALL),
pw AS (
  SELECT nm.model_id, nm.topic_id, wi, sum(npmi * vj) AS dot, sqrt(sum(npmi * npmi)) AS norm
  FROM nm JOIN v USING (model_id, topic_id, wj) GROUP BY ALL),
cvt AS (SELECT model_id, topic_id, avg(dot / (norm * vnorm)) AS coherence FROM pw JOIN vn USING (model_id, topic_id) GROUP BY ALL),"""

GRID_SQL = f"""WITH {S.TEXTS},
models AS (
  SELECT k * 1000 + seed AS model_id, k, CAST(seed AS VARCHAR) || '/' AS salt
  FROM range({min(GRID_K)}, {max(GRID_K) + 1}) r(k), (VALUES {', '.join(f'({s})' for s in GRID_SEEDS)}) s(seed)),
words AS (SELECT w AS word, count(*) AS cf FROM (SELECT unnest(tokens) AS w FROM texts) GROUP BY w),
wt AS (SELECT model_id, word, cf, CAST({S.word_topic('word', 'k', 'salt')} AS INTEGER) AS topic_id FROM words, models),
tot AS (SELECT model_id, topic_id, sum(cf) AS tot FROM wt GROUP BY ALL),
ranked AS (
  SELECT model_id, topic_id, word,
         row_number() OVER (PARTITION BY model_id, topic_id ORDER BY cf / tot DESC, word) AS rank
  FROM wt JOIN tot USING (model_id, topic_id)),
top AS (SELECT model_id, topic_id, word FROM ranked WHERE rank <= {CO.TOP_N}),
{COUNT_CTES}
cvm AS (SELECT model_id, avg(coherence) AS coherence FROM cvt GROUP BY model_id),
pts AS (
  SELECT k, 'auto' AS dir_prior, seed AS random_state, p AS num_pass, 200 AS iteration, k * 1000 + seed AS model_id
  FROM range({min(GRID_K)}, {max(GRID_K) + 1}) r(k), (VALUES {', '.join(f'({s})' for s in GRID_SEEDS)}) s(seed),
       (VALUES {', '.join(f'({p})' for p in INC.GRID_PASSES)}) q(p)),
scores AS (
  SELECT CAST(k AS INTEGER) AS k, dir_prior, CAST(random_state AS INTEGER) AS random_state,
         CAST(num_pass AS INTEGER) AS num_pass, CAST(iteration AS INTEGER) AS iteration,
         round(coherence, 6) AS coherence_score, coherence
  FROM pts JOIN cvm USING (model_id))"""


_KEY = "k, dir_prior, random_state, num_pass, iteration"
_PIVOT_COLS = ", ".join(f'max(CASE WHEN k = {k} THEN coherence_score END) AS "{k}"' for k in GRID_K)

register("coherence_table", f"{GRID_SQL} SELECT {_KEY}, coherence_score FROM scores")(q_coherence_table)
register("coherence_pivot", f"""{GRID_SQL}
SELECT dir_prior || '-' || CAST(random_state AS VARCHAR) || '-' || CAST(num_pass AS VARCHAR) || '-'
       || CAST(iteration AS VARCHAR) AS config, {_PIVOT_COLS}
FROM scores GROUP BY ALL""")(q_coherence_pivot)
register("best_model", f"""{GRID_SQL}
SELECT {_KEY}, coherence_score FROM scores
ORDER BY coherence_score DESC, k, random_state, num_pass, iteration LIMIT 1""")(q_best_model)
register("skip_scored_models", """
WITH pts AS (
  SELECT k, seed, p FROM range(2, 21) r(k), (VALUES (42), (99)) s(seed), (VALUES (5), (10), (15), (20)) q(p))
SELECT CAST(k AS INTEGER) AS k, 'auto' AS dir_prior, CAST(seed AS INTEGER) AS random_state,
       CAST(p AS INTEGER) AS num_pass, CAST(200 AS INTEGER) AS iteration FROM pts
WHERE NOT EXISTS (
  SELECT 1 FROM labels l WHERE 2 + l.doc_id % 19 = pts.k AND CASE WHEN l.toxic = 1 THEN 42 ELSE 99 END = pts.seed
    AND CASE WHEN l.quality = 1 THEN 5 ELSE 10 END = pts.p)""")(q_skip_scored_models)


@register("seed_stability", f"""{GRID_SQL}
SELECT k, dir_prior, num_pass, iteration, round(avg(coherence), 6) AS mean_score,
       round(stddev_samp(coherence), 6) AS std_score, count(*) AS n_seeds
FROM scores GROUP BY k, dir_prior, num_pass, iteration""")
def q_seed_stability(spark, sf):
    """Scores are averaged as computed and rounded once: the mean of two rounded
    scores lies on a half of the last place for every second pair."""
    st = TB.seed_stability(grid_scores(spark, sf, digits=None))
    return st.select("k", "dir_prior", "num_pass", "iteration", F.round("mean_score", 6).alias("mean_score"),
                     F.round("std_score", 6).alias("std_score"), "n_seeds")



def _q(expr):
    return f"""CASE WHEN strpos({expr}, ',') > 0 OR strpos({expr}, '"') > 0
          THEN '"' || replace({expr}, '"', '""') || '"' ELSE {expr} END"""


@register("topic_table_csv", f"""{TABLE_SQL},
heads AS (SELECT DISTINCT topic_id, '(' || CAST(topic_id + 1 AS VARCHAR) || ') ' || upper({S.label_of('topic_id')}) AS h FROM top)
SELECT {_q('h')} AS line FROM heads
UNION ALL SELECT 'word,prob.' FROM heads
UNION ALL SELECT upper(word) || ',' || replace(printf('%.3f', p), '0.', '.') FROM top
UNION ALL SELECT '""' FROM heads""")
def q_topic_table_csv(spark, sf):
    """E8 written like the reference's sample file ('(1) CONVERGENCE', '""'
    blank rows, quoted headers with commas) and read back line by line."""
    from topiary.session import work_dir
    table = TB.topic_table(frozen(topic_terms(spark, sf)), labels_available=True, numbered=True)
    path = work_dir(spark, "topic_table_csv")
    TB.write_table_csv(table, path)
    return spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("line"))
