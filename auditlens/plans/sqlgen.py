"""Small text helpers for the DuckDB oracle (the oracle's own SQL)."""

from __future__ import annotations


def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def bin_sql(col: str, n_bins: int = 10) -> str:
    step = 1.0 / n_bins
    return "(" + " + ".join(f"CAST({col} > {dbl(i * step)} AS INTEGER)" for i in range(1, n_bins)) + ")"


def union_long(src: str, attrs: dict[str, str], cols: list[str]) -> str:
    sel = ", ".join(cols)
    parts = [f"SELECT {sel}{', ' if sel else ''}'{name}' AS attribute, CAST({c} AS VARCHAR) AS grp FROM {src}"
             for name, c in attrs.items()]
    return "\nUNION ALL\n".join(parts)


def values(rows: list[tuple], names: list[str]) -> str:
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        if isinstance(v, float):
            return dbl(v)
        if v is None:
            return "NULL"
        return str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) v({', '.join(names)}))"


def norm_cdf_sql(z: str) -> str:
    """Same A&S 26.2.17 approximation as the Spark column expression."""
    x = f"abs({z})"
    t = f"(1.0::DOUBLE / (1.0::DOUBLE + 0.2316419::DOUBLE * {x}))"
    poly = (f"({t} * (0.319381530::DOUBLE + {t} * (-0.356563782::DOUBLE + {t} * (1.781477937::DOUBLE + "
            f"{t} * (-1.821255978::DOUBLE + {t} * 1.330274429::DOUBLE)))))")
    upper = f"(exp(-{x} * {x} / 2.0::DOUBLE) / 2.5066282746310002::DOUBLE * {poly})"
    return f"(CASE WHEN {z} IS NULL THEN NULL WHEN {z} >= 0 THEN 1.0::DOUBLE - {upper} ELSE {upper} END)"


def fairness_sql(src_sql: str, attrs: dict[str, str], refs: dict[str, str], thresholds: list[float],
                 keys: list[str] = (), y: str = "y", p: str = "y_prob", n_bins: int = 10,
                 detail: bool = False) -> str:
    """Whole fairness table (one row per keys × attribute × group × threshold)."""
    k = list(keys)
    kc = "".join(f"{c}, " for c in k)
    kg = "".join(f"g.{c}, " for c in k)
    kj = "".join(f" AND g.{c} IS NOT DISTINCT FROM {{o}}.{c}" for c in k)
    long = union_long("s", attrs, k + [f"CAST({y} AS INTEGER) AS y", f"CAST({p} AS DOUBLE) AS p"])
    ts = values([(float(t),) for t in thresholds], ["threshold"])
    rf = values([(a, v) for a, v in refs.items()], ["attribute", "ref_group"])
    extra = ", CAST(g.pos AS BIGINT) AS pos, CAST(g.pp AS BIGINT) AS pred_pos, CAST(g.tp AS BIGINT) AS tp" if detail else ""
    return f"""
WITH s AS ({src_sql}),
long AS ({long}),
g0 AS (SELECT {kc}attribute, grp, threshold, count(*) AS n, sum(y) AS pos,
         sum(CASE WHEN p >= threshold THEN 1 ELSE 0 END) AS pp,
         sum(CASE WHEN p >= threshold THEN y ELSE 0 END) AS tp
       FROM long CROSS JOIN {ts} t WHERE grp IS NOT NULL GROUP BY ALL),
g AS (SELECT *, CAST(pp AS DOUBLE) / n AS rate FROM g0),
bins AS (SELECT {kc}attribute, grp, {bin_sql('p', n_bins)} AS b, count(*) AS nb, sum(y) AS pb, sum(p) AS sb
         FROM long WHERE grp IS NOT NULL GROUP BY ALL),
e AS (SELECT {kc}attribute, grp, sum(nb) AS ne,
             avg(abs(CAST(pb AS DOUBLE) / nb - sb / nb)) AS ece FROM bins GROUP BY ALL),
rf AS {rf},
r AS (SELECT {kg}g.attribute, g.threshold, g.rate AS ref_rate FROM g JOIN rf
      ON g.attribute = rf.attribute AND g.grp = rf.ref_group)
SELECT {kg}g.attribute, g.grp AS "group", coalesce(g.grp = rf.ref_group, false) AS is_reference,
  CAST(g.n AS BIGINT) AS n, g.threshold,
  round(g.rate, 4) AS approval_rate,
  round(CASE WHEN g.grp = rf.ref_group THEN 1.0::DOUBLE WHEN r.ref_rate > 0 THEN g.rate / r.ref_rate END, 4) AS air,
  round(CASE WHEN g.n - g.pos > 0 THEN CAST(g.pp - g.tp AS DOUBLE) / (g.n - g.pos) END, 4) AS fpr,
  round(CASE WHEN g.pos > 0 THEN CAST(g.pos - g.tp AS DOUBLE) / g.pos END, 4) AS fnr,
  round(CASE WHEN g.pp > 0 THEN CAST(g.tp AS DOUBLE) / g.pp ELSE 0.0::DOUBLE END, 4) AS "precision",
  round(CASE WHEN g.pos > 0 THEN CAST(g.tp AS DOUBLE) / g.pos ELSE 0.0::DOUBLE END, 4) AS recall,
  round(CASE WHEN e.ne >= 20 THEN e.ece END, 4) AS ece{extra}
FROM g LEFT JOIN rf ON g.attribute = rf.attribute
LEFT JOIN r ON g.attribute = r.attribute AND g.threshold = r.threshold{kj.format(o='r')}
LEFT JOIN e ON g.attribute = e.attribute AND g.grp = e.grp{kj.format(o='e')}"""
