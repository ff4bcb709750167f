"""Column-expression helpers shared by every operator.

Decisions made once here (see SURVEY §1.1):

* SQL null is the only missing value; NaN is turned into null on input.
* Text → number goes through a guarded ``try_cast`` so ANSI mode never raises
  and Java-only literal suffixes (``1.0d``, ``1f``) are not accepted.
* Division never raises: ``try_divide`` gives null on a zero denominator.
* Rounding happens once, in the outermost projection.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strings that count as missing when text is read (the default
# missing-value list of the pandas CSV reader, which the reference relies on).
NA_STRINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# A plain decimal or scientific literal; anything else is not a number.
_NUMERIC_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c) -> Column:
    """Text or number → DOUBLE; unparsable, missing and NaN → null (no text
    that the pattern takes is NaN)."""
    col = _c(c)
    s = F.trim(col.cast("string"))
    return F.when(s.rlike(_NUMERIC_RE), s.try_cast("double"))


def column_to_double(df, c: str) -> Column:
    """``to_double`` of a column, without the way over text where its type
    holds whole numbers or doubles (of which NaN and infinities become null)."""
    kind, col = df.schema[c].dataType.typeName(), F.col(c)
    if kind in ("byte", "short", "integer", "long"):
        return col.cast("double")
    return F.when(F.abs(col) < F.lit(float("inf")), col) if kind == "double" else to_double(col)


def safe_div(num, den) -> Column:
    """num / den as DOUBLE, null when den is 0 or null."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def ratio(num, den, zero: float | None = None) -> Column:
    """safe_div with an optional value for an undefined ratio."""
    r = safe_div(num, den)
    return r if zero is None else F.coalesce(r, F.lit(float(zero)))


def rnd(c, digits: int = 4) -> Column:
    return F.round(_c(c), digits)


def norm_cdf(z) -> Column:
    """Standard normal CDF as a pure column expression.

    Uses the Abramowitz & Stegun 26.2.17 rational approximation
    (absolute error < 7.5e-8), so the result stays inside whole-stage codegen.
    """
    z = _c(z).cast("double")
    x = F.abs(z)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.2316419) * x)
    poly = t * (F.lit(0.319381530) + t * (F.lit(-0.356563782) + t * (
        F.lit(1.781477937) + t * (F.lit(-1.821255978) + t * F.lit(1.330274429)))))
    pdf = F.exp(-x * x / F.lit(2.0)) / F.lit(2.5066282746310002)
    upper = pdf * poly  # P(Z > |z|)
    return F.when(z.isNull(), None).when(z >= 0, F.lit(1.0) - upper).otherwise(upper)


def uniform_bin(p, n_bins: int = 10) -> Column:
    """Index of the uniform [0,1] bin holding p: the number of interior edges
    ``i/n_bins`` (computed as ``i * (1/n_bins)`` in binary) strictly below p."""
    p = _c(p)
    step = 1.0 / n_bins
    terms = [(p > F.lit(i * step)).cast("int") for i in range(1, n_bins)]
    return reduce(lambda a, b: a + b, terms)


def when_chain(pairs, otherwise=None) -> Column:
    """Build ``CASE WHEN c1 THEN v1 WHEN c2 THEN v2 … ELSE otherwise END``."""
    expr = None
    for cond, val in pairs:
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr if otherwise is None else expr.otherwise(otherwise)
