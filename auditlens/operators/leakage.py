"""Family C: post-decision columns, proxy-risk dictionary and annotation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Columns only known after the decision, and identifiers.
POST_DECISION_FEATURES = [
    "interest_rate", "rate_spread", "total_loan_costs", "total_points_and_fees",
    "origination_charges", "discount_points", "lender_credits", "loan_costs",
    "prepayment_penalty_term", "intro_rate_period",
    "denial_reason_1", "denial_reason_2", "denial_reason_3", "denial_reason_4",
]
IDENTIFIER_FEATURES = ["lei", "activity_year"]

# Proxy-risk dictionary (feature, risk level), in order.
PROXY_LEVELS = [
    ("census_tract", "High"), ("tract_minority_population_percent", "High"), ("derived_msa_md", "Medium"),
    ("ffiec_msa_md_median_family_income", "Medium"), ("tract_to_msa_income_percentage", "Medium"), ("income", "Medium"),
    ("applicant_age", "Low"), ("state_code", "Medium"), ("county_code", "Medium"),
]
#: Why a feature is on the list; callers may pass rows with their own wording.
PROXY_REASONS = {
    "census_tract": "place of residence at street level",
    "tract_minority_population_percent": "states the make-up of the neighbourhood",
    "derived_msa_md": "place of residence at city level",
    "ffiec_msa_md_median_family_income": "income of the surroundings",
    "tract_to_msa_income_percentage": "wealth of the neighbourhood against the city",
    "income": "needed for the decision, unequal between groups",
    "applicant_age": "protected itself; watch how much the model uses it",
    "state_code": "place of residence at state level",
    "county_code": "place of residence at county level",
}
PROXY_RISK = [(feature, level, PROXY_REASONS[feature]) for feature, level in PROXY_LEVELS]


def leakage_names(extra: list[str] | None = None) -> list[str]:
    return POST_DECISION_FEATURES + IDENTIFIER_FEATURES + list(extra or [])


def remove_leakage(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Drop post-decision and identifier columns that are present."""
    present = [c for c in leakage_names(extra) if c in df.columns]
    return df.drop(*present)


def leakage_report(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """(feature, removed) for every deny-listed name."""
    spark = df.sparkSession
    names = leakage_names(extra)
    return spark.createDataFrame([(i, c, c in df.columns) for i, c in enumerate(names)],
                                 "position INT, feature STRING, removed BOOLEAN")


def proxy_risk_table(spark: SparkSession, rows=None) -> DataFrame:
    """The proxy-risk dictionary as a broadcastable dimension (user-suppliable)."""
    rows = rows or PROXY_RISK
    return spark.createDataFrame([(i, f, r, j) for i, (f, r, j) in enumerate(rows)],
                                 "dict_order INT, feature STRING, risk_level STRING, justification STRING")


def proxy_annotate(features: DataFrame, proxy: DataFrame, feature_col: str = "feature",
                   default_level: str = "Low", default_justification: str = "") -> DataFrame:
    """Exact dictionary match first, else the first key (dictionary order)
    that prefixes the feature name, else the default level."""
    d = F.broadcast(proxy.select(F.col("feature").alias("_key"), "dict_order", "risk_level", "justification"))
    f = F.col(feature_col)
    cand = features.join(d, (f == F.col("_key")) | f.startswith(F.col("_key")), "left")
    exact = F.coalesce(f == F.col("_key"), F.lit(False))
    w = Window.partitionBy(feature_col).orderBy(exact.desc(), F.col("dict_order").asc_nulls_last())
    best = cand.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    keep = [c for c in features.columns]
    return best.select(*keep, F.coalesce("risk_level", F.lit(default_level)).alias("proxy_risk_level"),
                       F.coalesce("justification", F.lit(default_justification)).alias("proxy_justification"))
