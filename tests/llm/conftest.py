import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture
def table(spark):
    """documents from (doc_id, text) or (doc_id, text, lang) tuples."""

    def make(rows, extra=None):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        for name in extra or []:
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make


@pytest.fixture(scope="session")
def words():
    """Deterministic invented words."""
    import random

    rng = random.Random(5)
    syllables = ["ba", "co", "di", "fu", "ge", "hy", "jo", "ka", "lu", "me", "no", "pi", "qua", "ri", "so", "tu"]
    return ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(3000)]
