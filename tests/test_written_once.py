"""What is written for a step is deleted as soon as nothing reads it."""

import glob
import os
import time

from pyspark.sql import functions as F

from auditlens.functions.ordered import forget, materialize, written_spread
from auditlens.operators import boost as B
from auditlens.operators import ml as ML
from tests.test_fits import rows


def folders(spark):
    from auditlens.session import ensure_checkpoint_dir
    return set(glob.glob(ensure_checkpoint_dir(spark).removeprefix("file:") + "/mat-*"))


def test_shuffle_files_go_with_the_write(spark):
    files = lambda: {str(f) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").split() if "shuffle_" in f}
    before = files()
    kept = materialize(spark.range(20_000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(40):
        if not files() - before:
            break
        time.sleep(0.25)
    assert not files() - before and kept.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_few_files_are_dealt_and_many_left(spark):
    before = folders(spark)
    few, many = written_spread(spark.range(1000).coalesce(1)), written_spread(spark.range(1000).repartition(40))
    assert len(few.inputFiles()) >= 2 * spark.sparkContext.defaultParallelism and len(many.inputFiles()) == 40
    assert few.count() == many.count() == 1000 and len(folders(spark) - before) == 2
    forget(few)
    assert len(folders(spark) - before) == 1


def test_a_fit_leaves_its_levels_alone(spark):
    train = materialize(rows(spark))
    before = folders(spark)
    pipe = ML.logistic_pipeline(ML.preprocessing_stages(["income"], ["kind"], ["income"], 5), 600, max_iter=5)
    model = ML.fit_on_vectors(pipe, train)
    left = folders(spark) - before
    assert train.count() == 600 and not [f for f in left if any(c.startswith(("n_", "features")) for c in spark.read.parquet(f).columns)]
    ML.fit_on_vectors(pipe, train, keep_rows=False)
    assert len(before - folders(spark)) == 1  # the rows
    assert ML.score(model, rows(spark)).count() == 600


def test_checkpoints_of_margins_are_deleted(spark, monkeypatch):
    from auditlens.session import ensure_checkpoint_dir
    monkeypatch.setattr(B, "CUT", 2)
    top = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(top + "/rdd-*"))
    model = ML.fit_boosted(ML.gbt_pipeline(ML.preprocessing_stages(["income"], ["kind"]), max_iter=7), rows(spark))
    assert model.stages[-1].getNumTrees == 7 and set(glob.glob(top + "/rdd-*")) == before


def test_landed_text_is_compressed_and_short(spark, tmp_path, monkeypatch):
    from auditlens.sources import raw as R
    monkeypatch.setattr(R, "FILE_ROWS", 30)
    path = str(tmp_path / "t")
    R.write_raw_pipe(spark.range(100).selectExpr("id", "'NA' AS x").coalesce(1), path, "gzip")
    files = [f for f in os.listdir(path) if f.endswith(".csv.gz")]
    assert len(files) == 4 and R.read_raw_pipe(spark, path, ["id", "x"]).agg(F.countDistinct("id"), F.count("x")).first()[:] == (100, 0)
