"""The E and M step of the online model in SQL, for a small K and a fixed number
of inner rounds. ``bow`` is (doc_id, term_id, n), ``vocab`` (term_id, token, ...)."""

from __future__ import annotations


def psi(x: str) -> str:
    """The library's series for digamma."""
    y, r = f"(({x}) + 6.0::DOUBLE)", f"(1 / ((({x}) + 6.0::DOUBLE) * (({x}) + 6.0::DOUBLE)))"
    tail = "1/132::DOUBLE"
    for c in ("1/240::DOUBLE", "1/252::DOUBLE", "1/120::DOUBLE", "1/12::DOUBLE"):
        tail = f"({c} - {r} * ({tail}))"
    steps = " + ".join(f"1 / (({x}) + {i}.0::DOUBLE)" for i in range(6))
    return f"(ln({y}) - 0.5::DOUBLE / {y} - {r} * {tail} - ({steps}))"


def start_ctes(k: int, seed: int) -> str:
    """lam(term_id, k, lam) of the start, and beta(term_id, k, b) = exp(E[log beta])."""
    return f"""lam AS MATERIALIZED (
  SELECT term_id, CAST(k AS INTEGER) AS k,
         ('0x' || substr(md5('{seed}:' || term_id || ':' || k), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE + 0.5 AS lam
  FROM vocab, range({k}) r(k)),
{beta_ctes()}"""


def beta_ctes(lam: str = "lam", name: str = "beta") -> str:
    return f"""{name}_tot AS MATERIALIZED (SELECT k, {psi('sum(lam)')} AS psi_total FROM {lam} GROUP BY k),
{name} AS MATERIALIZED (SELECT term_id, k, exp({psi('lam')} - psi_total) AS b FROM {lam} JOIN {name}_tot USING (k))"""


def e_ctes(rounds: int, alpha: float, beta: str = "beta", at: str = "e") -> str:
    """<at>_g(doc_id, k, gamma), <at>_th(doc_id, k, th) and <at>_w(doc_id, term_id, n, k, b) after ``rounds`` inner rounds."""
    out = [f"{at}_w AS MATERIALIZED (SELECT doc_id, term_id, n, k, b FROM bow JOIN {beta} USING (term_id))",
           f"{at}_g0 AS MATERIALIZED (SELECT DISTINCT doc_id, k, 1.0::DOUBLE AS gamma FROM {at}_w)"]
    theta = "exp({} - {})".format(psi("gamma"), psi("total"))
    for i in range(rounds + 1):
        out.append(f"""{at}_th{i} AS MATERIALIZED (
  SELECT doc_id, k, {theta} AS th FROM (SELECT *, sum(gamma) OVER (PARTITION BY doc_id) AS total FROM {at}_g{i}) x)""")
        out.append(f"""{at}_phi{i} AS MATERIALIZED (
  SELECT doc_id, term_id, sum(b * th) + 1e-100 AS phi FROM {at}_w JOIN {at}_th{i} USING (doc_id, k) GROUP BY doc_id, term_id)""")
        if i < rounds:
            out.append(f"""{at}_g{i + 1} AS MATERIALIZED (
  SELECT doc_id, k, {alpha!r}::DOUBLE + any_value(th) * sum(n / phi * b) AS gamma
  FROM {at}_w JOIN {at}_phi{i} USING (doc_id, term_id) JOIN {at}_th{i} USING (doc_id, k) GROUP BY doc_id, k)""")
    out.append(f"{at}_g AS (SELECT * FROM {at}_g{rounds})")
    out.append(f"{at}_th AS (SELECT * FROM {at}_th{rounds})")
    out.append(f"{at}_phi AS (SELECT * FROM {at}_phi{rounds})")
    return ",\n".join(out)


def m_ctes(eta: float, rho: float, lam: str = "lam", at: str = "e", name: str = "lam1") -> str:
    """<name>(term_id, k, lam) after the update."""
    return f"""{name} AS MATERIALIZED (
  SELECT l.term_id, l.k, l.lam * (1 - {rho!r}::DOUBLE) + ({eta!r}::DOUBLE + coalesce(s.s, 0)) * {rho!r}::DOUBLE AS lam
  FROM {lam} l LEFT JOIN (
    SELECT term_id, k, sum(n / phi * th * b) AS s
    FROM {at}_w JOIN {at}_phi USING (doc_id, term_id) JOIN {at}_th USING (doc_id, k) GROUP BY term_id, k) s
  ON s.term_id = l.term_id AND s.k = l.k)"""
