"""Every registered query runs on the sf0.001 tables; the flagship too."""

import pytest

import __spark_entry__ as E
from auditlens.plans import QUERIES, load_all
from tests.conftest import SF

load_all()

# fitted in tests/test_models.py with fewer trees
SKIP_SLOW = {"logreg_scores", "gbt_scores", "feature_importance", "model_registry", "proxy_ablation",
             "gbt_early_stopping"}


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:4] == ["attribute", "group", "is_reference", "n"]


def test_oracle_keys_subset():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if k not in SKIP_SLOW))
def test_query_runs(spark, name):
    df = E.queries()[name](spark, SF)
    df.collect()
