"""Small builders for the DuckDB oracle statements."""

from __future__ import annotations


def ema_cte(name: str, base: str, key: str, specs: dict[str, tuple[str, float]],
            carry: tuple[str, ...] = ()) -> str:
    """Recursive CTE ``name`` with columns key, rn, <carry>, <outputs>.

    ``base`` must have columns key, rn (1-based, consecutive) and the inputs.
    y_1 = x_1; y_t = (1-a) y_{t-1} + a x_t (adjust=False)."""
    outs = list(specs)
    first = ", ".join(f"{src} AS {o}" for o, (src, _) in specs.items())
    nxt = ", ".join(f"{1.0 - a!r}::DOUBLE * r.{o} + {a!r}::DOUBLE * b.{src} AS {o}"
                    for o, (src, a) in specs.items())
    cs = "".join(f", {c}" for c in carry)
    bcs = "".join(f", b.{c}" for c in carry)
    return f"""{name} AS (
  SELECT {key}, rn{cs}, {first} FROM {base} WHERE rn = 1
  UNION ALL
  SELECT b.{key}, b.rn{bcs}, {nxt}
  FROM {name} r JOIN {base} b ON b.{key} = r.{key} AND b.rn = r.rn + 1)"""


def r6(expr: str, alias: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) AS {alias}"


def unsign(sql: str, cols) -> str:
    """Wrap ``sql`` so the listed DOUBLE columns turn -0.0 into 0.0 (as Spark's
    ``round(x) + 0.0`` does on the engine side)."""
    rep = ", ".join(f"{c} + 0.0 AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS q"


def robust_sql(src: str, cols: list[str], passes: int = 4, keep: float = 0.75, contamination: float = 0.01) -> str:
    """CTEs ending in ``robust``: the rows of ``src`` with ``mahalanobis`` and ``outlier``, for three columns.

    Every pass takes mean and covariance of the kept rows (all at first), measures
    all rows with the inverse by cofactors, and keeps the closest share."""
    a, b, c = (f"coalesce(CAST({x} AS DOUBLE), 0.0)" for x in cols)
    out = [f"rb0 AS (SELECT *, {a} AS r1, {b} AS r2, {c} AS r3, true AS rk FROM {src})"]
    for p in range(passes):
        pairs = ", ".join(f"covar_samp(r{i}, r{j}) AS s{i}{j}" for i in (1, 2, 3) for j in range(i, 4))
        out.append(f"""rm{p} AS (SELECT *, s11 * (s22 * s33 - s23 * s23) - s12 * (s12 * s33 - s23 * s13) + s13 * (s12 * s23 - s22 * s13) AS det
  FROM (SELECT avg(r1) AS m1, avg(r2) AS m2, avg(r3) AS m3, {pairs} FROM rb{p} WHERE rk)),
rd{p} AS (SELECT rb{p}.* EXCLUDE (rk{', mahalanobis' if p else ''}), (
    (r1 - m1) ** 2 * (s22 * s33 - s23 * s23) + (r2 - m2) ** 2 * (s11 * s33 - s13 * s13) + (r3 - m3) ** 2 * (s11 * s22 - s12 * s12)
    + 2 * (r1 - m1) * (r2 - m2) * (s13 * s23 - s12 * s33) + 2 * (r1 - m1) * (r3 - m3) * (s12 * s23 - s13 * s22)
    + 2 * (r2 - m2) * (r3 - m3) * (s12 * s13 - s11 * s23)) / det AS mahalanobis FROM rb{p}, rm{p}),
rb{p + 1} AS (SELECT *, mahalanobis <= (SELECT quantile_cont(mahalanobis, {keep}) FROM rd{p}) AS rk FROM rd{p})""")
    out.append(f"""robust AS (SELECT * EXCLUDE (r1, r2, r3, rk),
  mahalanobis > (SELECT quantile_cont(mahalanobis, {1 - contamination!r}) FROM rb{passes}) AS outlier FROM rb{passes})""")
    return ",\n".join(out)
