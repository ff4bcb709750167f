"""Family F (splits) and A2 (development sample): hash-based, repeatable and
independent of partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlens.functions.brackets import order_statistics
from auditlens.functions.ordered import join_small, materialize

KEY_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def hash_unit(keys: list[str], seed: int = 42):
    """Uniform [0,1) value from the first 52 bits of md5(seed|keys)."""
    k = F.concat_ws("|", *[F.col(c).cast("string") for c in keys])
    return (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), k)), 1, 13), 16, 10).cast("double")
            / F.lit(float(2 ** 52)))


def dev_sample(df: DataFrame, frac: float, keys: list[str], seed: int = 42) -> DataFrame:
    """A2: repeatable sample of about ``frac`` of the rows (no shuffle)."""
    return df.where(hash_unit(keys, seed) < F.lit(float(frac)))


def geo_holdout(df: DataFrame, states: list[str], state_col: str = "state_code") -> DataFrame:
    """rows of the listed states go to the holdout."""
    return df.withColumn("split", F.when(F.col(state_col).isin(*states), F.lit("geo_holdout"))
                         .otherwise(F.lit("model")))


def hash_split(df: DataFrame, keys: list[str], test: float = 0.15, val: float = 0.15, seed: int = 42,
               out: str = "split") -> DataFrame:
    """Scalable split: thresholds on a per-row hash, no sort or shuffle."""
    u = hash_unit(keys, seed)
    return df.withColumn(out, F.when(u < F.lit(float(test)), F.lit("test"))
                         .when(u < F.lit(float(test + val)), F.lit("val")).otherwise(F.lit("train")))


def split_cuts(df: DataFrame, label: str, keys: list[str], test: float = 0.15, val: float = 0.15, seed: int = 42) -> DataFrame:
    """The first row that is no longer in the test and in the validation part
    of each stratum, as (hash, keys): one row a stratum, written.

    The wanted places of the hash come from sketch brackets.  Only where rows
    share the hash at a cut are their distinct keys ranked."""
    rows = df.select(F.coalesce(F.col(label).cast("string"), F.lit("")).alias("_stratum"), hash_unit(keys, seed).alias("_u"), F.struct(*keys).alias("_k"))
    q_test = F.ceil(F.lit(float(test)) * F.col("n"))
    q_val = q_test + F.ceil(F.lit(float(val) / (1.0 - float(test))) * (F.col("n") - q_test))
    hashes = materialize(rows.select("_stratum", "_u"))  # the hash is made once, the keys are read again only for ties
    at = materialize(order_statistics(hashes, "_u", [("test", test, q_test), ("val", min(1.0, test + val), q_val)], ["_stratum"]).where("q is not null"))
    shared = at.where("below < pos")
    if shared.limit(1).count():
        ties = (rows.join(F.broadcast(shared.select("_stratum", "name", "q", (F.col("pos") - F.col("below")).alias("_in"))), "_stratum").where("_u = q")  # two rows a stratum at most
                .groupBy("_stratum", "name", "_in", "_k").agg(F.count(F.lit(1)).alias("_c")))
        upto = F.sum("_c").over(Window.partitionBy("_stratum", "name").orderBy("_k"))
        first_out = ties.withColumn("_upto", upto).where("_upto > _in").groupBy("_stratum", "name").agg(F.min("_k").alias("_key"))
        at = at.join(first_out, ["_stratum", "name"], "left")
    else:
        at = at.withColumn("_key", F.lit(None).cast(rows.schema["_k"].dataType))
    cut = F.struct(F.col("q").alias("u"), F.col("_key").alias("key"))
    return materialize(at.groupBy("_stratum").agg(*[F.max(F.when(F.col("name") == n, cut)).alias(f"_{n}") for n in ("test", "val")]))


def split_by_cuts(df: DataFrame, cuts: DataFrame, label: str, keys: list[str], seed: int = 42, out: str = "split") -> DataFrame:
    """Rows with their part by the learned cut points: one projection."""
    j = join_small(df.withColumns({"_stratum": F.coalesce(F.col(label).cast("string"), F.lit("")), "_u": hash_unit(keys, seed)}), cuts, "_stratum", "left")
    key = F.struct(*keys)

    def before(c: str):
        return F.col(c).isNull() | (F.col("_u") < F.col(f"{c}.u")) | ((F.col("_u") == F.col(f"{c}.u")) & F.coalesce(key < F.col(f"{c}.key"), F.lit(False)))

    split = F.when(before("_test"), F.lit("test")).when(before("_val"), F.lit("val")).otherwise(F.lit("train"))
    return j.withColumn(out, split).select(*[c for c in df.columns if c != out], out)


def stratified_split(df: DataFrame, label: str, keys: list[str], test: float = 0.15, val: float = 0.15,
                     seed: int = 42, out: str = "split") -> DataFrame:
    """F2 with exact quotas per stratum (nulls are one): test = ceil(test·N),
    then val = ceil(val/(1-test) · rest), in the order of a seeded hash and,
    where hashes are equal, of the keys.  Rows with equal keys stay together.

    Only the cut points are learned; no row is shuffled."""
    return split_by_cuts(df, split_cuts(df, label, keys, test, val, seed), label, keys, seed, out)


def split_check(df: DataFrame, split_col: str = "split", y: str = "y") -> DataFrame:
    """rows and positive rate per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"),
                                     F.round(F.avg(F.col(y).cast("double")), 4).alias("positive_rate"))
