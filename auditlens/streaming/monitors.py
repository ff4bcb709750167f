"""Streaming monitors over scored decision events.

Pattern: ``readStream`` over a landing folder → event-time watermark →
windowed aggregate in *update* mode → ``foreachBatch`` appends each batch's
updated rows (tagged with the batch id) to a Parquet folder in the shared
checkpoint area → the latest version per key is the result.  Update mode
lets state for closed windows be evicted by the watermark while the final
windows are still reported when an ``availableNow`` run ends; ratios across
groups (AIR) are formed on the small per-window result, not in the stream.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.functions.columns import rnd
from auditlens.session import scratch_path

EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def new_area(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"stream-{name}-{uuid.uuid4().hex[:12]}")


def utc_instant(ntz) -> Column:
    """Wall-clock time as the instant it would be in UTC, whatever the session
    zone: watermarks need TIMESTAMP, results must not depend on the zone."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ntz))


def wall_clock(instant) -> Column:
    """The inverse of ``utc_instant`` as text."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("string")


def scored_stream(spark: SparkSession, folder: str, schema: str = EVENT_SCHEMA, max_files: int | None = None,
                  pattern: str | None = None) -> DataFrame:
    """Scored events from the Parquet files of ``folder`` (only names that
    match ``pattern``, if given); nothing is copied."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    ev = r.parquet(folder)
    return ev.select("event_id", utc_instant(F.col("ts")).alias("ts"), "user_id", F.col("event_type").alias("group"),
                     (F.col("value") / (F.col("value") + F.lit(50.0))).alias("y_prob"))


def run_upsert(agg: DataFrame, area: str, keys: list[str], values: list[str], checkpoint: str | None = None) -> DataFrame:
    """Run an aggregate stream to completion (availableNow) and return the
    latest row per key (no rows if nothing was emitted)."""
    out = f"{area}/out"
    ckpt = checkpoint or f"{area}/checkpoint"
    spark = agg.sparkSession
    schema = T.StructType([*agg.schema.fields, T.StructField("_batch", T.LongType())])
    spark.createDataFrame([], schema).write.mode("append").parquet(out)

    def write(batch: DataFrame, batch_id: int):
        batch.withColumn("_batch", F.lit(batch_id).cast("long")).write.mode("append").parquet(out)

    q = (agg.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    latest = spark.read.schema(schema).parquet(out).groupBy(*keys).agg(F.max_by(F.struct(*values), "_batch").alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values])


def window_air(stream: DataFrame, area: str, reference: str, window: str = "1 day", watermark: str = "2 days",
               threshold: float = 0.5, checkpoint: str | None = None) -> DataFrame:
    """M1: tumbling-window approval rate per group and AIR vs the reference group."""
    pred = (F.col("y_prob") >= F.lit(float(threshold))).cast("long")
    agg = (stream.withWatermark("ts", watermark).groupBy(F.window("ts", window).alias("w"), "group")
           .agg(F.count(F.lit(1)).alias("n"), F.sum(pred).alias("approved"))
           .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "group", "n", "approved"))
    res = run_upsert(agg, area, ["window_start", "window_end", "group"], ["n", "approved"], checkpoint)
    rate = F.col("approved") / F.col("n")
    ref = res.where(F.col("group") == reference).select("window_start", (F.col("approved") / F.col("n")).alias("_ref"))
    j = res.join(ref, "window_start", "left")
    return j.select(wall_clock(F.col("window_start")).alias("window_start"), wall_clock(F.col("window_end")).alias("window_end"),
                    "group", F.col("n").cast("long").alias("n"), F.col("approved").cast("long").alias("approved"),
                    rnd(rate).alias("approval_rate"),
                    rnd(F.when(F.col("group") == reference, F.lit(1.0)).when(F.col("_ref") > 0, rate / F.col("_ref"))).alias("air"))


def volume_anomaly(stream: DataFrame, area: str, limit: int = 2, window: str = "1 hour", slide: str = "10 minutes",
                   watermark: str = "2 hours") -> DataFrame:
    """M2: sliding-window query volume per submitter; windows above ``limit``."""
    agg = (stream.withWatermark("ts", watermark).groupBy(F.window("ts", window, slide).alias("w"), "user_id")
           .agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), "user_id", "n"))
    res = run_upsert(agg, area, ["window_start", "user_id"], ["n"])
    return res.where(F.col("n") > limit).select(wall_clock(F.col("window_start")).alias("window_start"), "user_id",
                                                F.col("n").cast("long").alias("n"))


def window_psi(stream: DataFrame, area: str, edges: list[float], expected: dict[int, float], window: str = "1 day",
               watermark: str = "2 days", eps: float = 1e-4) -> DataFrame:
    """M3: PSI of the score per window against fixed reference edges and
    expected bin shares (both small, computed in batch and passed as literals)."""
    last = F.lit(float(edges[-1]))
    idx = F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]), lambda x: x <= F.col("y_prob"))) - 1
    inside = (F.col("y_prob") >= F.lit(float(edges[0]))) & (F.col("y_prob") <= last)
    b = F.when(~inside, F.lit(-1)).when(F.col("y_prob") == last, F.lit(len(edges) - 2)).otherwise(idx)
    agg = (stream.withWatermark("ts", watermark).groupBy(F.window("ts", window).alias("w"), b.alias("bin"))
           .agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), "bin", "n"))
    res = run_upsert(agg, area, ["window_start", "bin"], ["n"])
    spark = stream.sparkSession
    exp = F.broadcast(spark.createDataFrame([(int(k), float(v)) for k, v in expected.items()], "bin INT, pe DOUBLE"))
    tot = res.groupBy("window_start").agg(F.sum("n").alias("_t"))
    wins = tot.select("window_start")
    full = (wins.crossJoin(exp).join(res, ["window_start", "bin"], "left").join(tot, "window_start")
            .withColumn("pa", F.coalesce(F.col("n"), F.lit(0)) / F.col("_t")))
    pa = F.when(F.col("pa") == 0, F.lit(eps)).otherwise(F.col("pa"))
    pe = F.when(F.col("pe") == 0, F.lit(eps)).otherwise(F.col("pe"))
    psi = full.groupBy("window_start").agg(F.sum((pa - pe) * F.log(pa / pe)).alias("psi"), F.first("_t").alias("n"))
    return psi.select(wall_clock(F.col("window_start")).alias("window_start"), F.col("n").cast("long").alias("n"),
                      rnd("psi").alias("psi"))


def late_rows(make_stream, area: str, window: str = "1 day", watermark: str = "2 days") -> DataFrame:
    """M5: rows behind the watermark, per window: ``n_rows`` that arrived,
    ``n_counted`` in the watermarked aggregate and ``n_late`` by a second,
    stateless count.

    ``make_stream`` gives the same stream (column ``ts``) each time it is
    called.  The stateless run counts each batch's rows by window and keeps the
    batch's latest time; a row is late where its window ended by the watermark
    that held for its batch, which Spark takes from the batches before the
    previous one.  Only counts per (batch, window) are written."""
    w = F.window("ts", window)
    counted = run_upsert(make_stream().withWatermark("ts", watermark).groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), "n"),
                         f"{area}/counted", ["window_start"], ["n"])
    spark, out = counted.sparkSession, f"{area}/batches"
    schema = "batch LONG, window_start TIMESTAMP, window_end TIMESTAMP, n LONG, latest TIMESTAMP"
    spark.createDataFrame([], schema).write.mode("append").parquet(out)

    def count(batch: DataFrame, batch_id: int):
        rows = batch.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("latest"))
        rows.select(F.lit(batch_id).cast("long").alias("batch"), F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "latest").write.mode("append").parquet(out)

    make_stream().writeStream.foreachBatch(count).option("checkpointLocation", f"{area}/batches-checkpoint").trigger(availableNow=True).start().awaitTermination()
    arrived = spark.read.schema(schema).parquet(out)
    before = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, -2)
    marks = arrived.groupBy("batch").agg(F.max("latest").alias("latest")).select(  # one row a batch
        "batch", (F.date_trunc("millisecond", F.max("latest").over(before)) - F.expr(f"INTERVAL {watermark}")).alias("mark"))
    late = F.coalesce(F.col("window_end") <= F.col("mark"), F.lit(False))
    sides = arrived.join(F.broadcast(marks), "batch").groupBy("window_start").agg(F.sum("n").alias("n_rows"), F.sum(F.when(late, F.col("n")).otherwise(0)).alias("n_late"))
    return sides.join(counted, "window_start", "left").select(wall_clock(F.col("window_start")).alias("window_start"), "n_rows", F.coalesce("n", F.lit(0)).alias("n_counted"), "n_late")


def breach_judge(limit: float, min_run: int, keep_days: int):
    """The state function of ``consecutive_breach_stream``: a group's last days
    and the run of low days that ended before them."""

    def judge(key, frames, state):
        import json

        import pandas as pd

        if state.hasTimedOut:
            state.remove()
            return
        held = json.loads(state.get[0]) if state.exists else {"days": {}, "from": None, "run": 0}
        days = {int(d): v for d, v in held["days"].items()}
        new = []
        for frame in frames:
            for day, start, air in zip(frame["day"], frame["window_start"], frame["air"], strict=True):
                if held["from"] is None or day >= held["from"]:  # older ones have been judged for good
                    days[int(day)] = [start, None if pd.isna(air) else float(air)]
                    new.append(int(day))
        out, run, last = [], held["run"], None if held["from"] is None else held["from"] - 1
        ended: dict[int, int] = {}
        for day in sorted(days):
            start, air = days[day]
            low = air is not None and air < limit
            run = (run + 1 if last == day - 1 else 1) if low else 0
            last, ended[day] = day, run
            if new and day >= min(new):
                out.append((key[0], day, start, air, run if run >= min_run else None))
        gone_by = state.getCurrentWatermarkMs() // 86_400_000
        old = [d for d in sorted(days) if d < gone_by]
        if old:  # what is left of them is the run up to the first day kept
            held["from"], held["run"] = old[-1] + 1, ended[old[-1]]
        kept = {d: v for d, v in days.items() if d >= gone_by}
        state.update((json.dumps({"days": kept, "from": held["from"], "run": held["run"]}),))
        if days:
            state.setTimeoutTimestamp(max((max(days) + keep_days + 1) * 86_400_000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["group", "day", "window_start", "air", "run_length"]).astype({"run_length": "Int32", "air": "float64"})

    return judge


def consecutive_breach_stream(spark: SparkSession, air_landing: str, area: str, limit: float = 0.80,
                              max_files: int | None = None, keep_days: int = 60, min_run: int = 2) -> DataFrame:
    """M4: consecutive-breach alerts per group over a stream of per-window AIR
    rows.  A group's state is its days of the last ``keep_days`` before the
    latest one (by the watermark) and the length of the run before them, so a
    batch reads and writes the state of the groups it touches and nothing
    else; a group without new days for that long is forgotten.  Within those
    days windows may arrive in any order: a day that arrives late judges the
    days after it again, and the latest judgement of a day counts.  Older days
    that arrive later still change nothing."""
    reader = spark.readStream.schema("window_start STRING, group STRING, air DOUBLE")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    date = F.to_date(F.substring("window_start", 1, 10))
    day = F.datediff(date, F.lit("1970-01-01").cast("date")).cast("long")
    src = reader.parquet(air_landing).select("group", day.alias("day"), "window_start", "air", F.timestamp_seconds(day * 86400).alias("ts"))
    judged = src.withWatermark("ts", f"{keep_days} days").groupBy("group").applyInPandasWithState(
        breach_judge(limit, min_run, keep_days), "group STRING, day LONG, window_start STRING, air DOUBLE, run_length INT", "held STRING", "update", "EventTimeTimeout")
    latest = run_upsert(judged, area, ["group", "day"], ["window_start", "air", "run_length"])
    return latest.where("run_length IS NOT NULL").select("group", "window_start", "air", "run_length")
