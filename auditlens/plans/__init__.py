"""Query registry: every registered callable takes (spark, sf_dir) and returns
a DataFrame; ORACLE holds the DuckDB text for the same result where SQL can
express it."""

from auditlens.plans.registry import ORACLE, QUERIES, load_all  # noqa: F401
