"""Exact quantiles of groups, in one piece and in ranges."""

import numpy as np
import pytest

from auditlens.functions import ordered as O


@pytest.mark.parametrize("whole, buckets", [(O.WHOLE_GROUP, 1), (10, 8)])
def test_small_groups_are_not_cut_into_ranges(spark, monkeypatch, whole, buckets):
    """Counts by group and range were as many rows as the values themselves."""
    rows = [(g, float((i * 7919 + g) % 41) / 8) for g in range(60) for i in range(5 + g % 30)] + [(None, 1.0), (7, None)]
    seen, real = [], O.range_edges
    monkeypatch.setattr(O, "WHOLE_GROUP", whole)
    monkeypatch.setattr(O, "range_edges", lambda df, col, n, *a: seen.append(n) or real(df, col, n, *a))
    out = O.exact_quantiles(spark.createDataFrame(rows, "g INT, v DOUBLE"), "v", [0.5, 0.9], ["g"])
    got = {(r.g, r.p): r.q for r in out.collect() if r.g is not None}
    assert seen == [buckets]
    for g in range(60):
        values = [v for k, v in rows if k == g and v is not None]
        for p in (0.5, 0.9):
            assert got.pop((g, p)) == pytest.approx(np.percentile(values, p * 100), abs=1e-12)
    assert not got
