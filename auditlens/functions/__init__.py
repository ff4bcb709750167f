from auditlens.functions.columns import (  # noqa: F401
    NA_STRINGS, to_double, safe_div, ratio, rnd, norm_cdf, uniform_bin, when_chain,
)
