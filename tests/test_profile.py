from __future__ import annotations

import math
from uuid import uuid4

from pyspark.sql import functions as F

from acreage.operators import profile, profile_run

SHARES = [0.0, 0.01, 1 / 3, 0.5, 0.99, 1.0]


def most_read(spark, run):
    """(what run returns, most bytes of a shuffle that one of its tasks read)."""
    sc = spark.sparkContext
    sc.setJobGroup(group := str(uuid4()), "")
    got, store, most = run(), sc._jsc.sc().statusStore(), 0
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    for job in sc.statusTracker().getJobIdsForGroup(group):
        for stage in sc.statusTracker().getJobInfo(job).stageIds:
            tasks = store.taskList(stage, 0, 10_000)
            for k in range(tasks.size()):
                if tasks.apply(k).taskMetrics().isDefined():
                    read = tasks.apply(k).taskMetrics().get().shuffleReadMetrics()
                    most = max(most, read.localBytesRead() + read.remoteBytesRead())
    sc.setLocalProperty("spark.jobGroup.id", None)
    return got, most


def test_percentiles_no_task_reads_all_values(spark):
    df = spark.range(0, 200_000, 1, 8).select((1000 + F.rand(3) * 1000).alias("v"))
    got, most = most_read(spark, lambda: profile.percentiles(df, ["v"], SHARES).collect())
    assert [r.value for r in sorted(got, key=lambda r: r.share)] == df.agg(F.percentile("v", SHARES)).first()[0]
    assert 0 < most < 200_000


def test_percentiles_of_odd_values(spark):
    inf, nan = math.inf, math.nan
    odd = [(nan, inf), (inf, 1.0), (5e-324, 1e308), (1.0, 1.7e308), (0.0, -0.0), (-1.0, None), (1e-300, 3.0)] * 3
    narrow = [(1 + (k * 7919 % 1000) * 1e-13, 1e9 + k % 10) for k in range(1000)] + [(1e12, 1e-12)]
    for rows in ([(3.5, None)], odd, narrow, [(7.0, 1.0)] * 500 + [(8.0, 2.0)]):
        df = spark.createDataFrame(rows, "a double, b double").repartition(3)
        got = {(r.column, r.share): repr(r.value) for r in profile.percentiles(df, ["a", "b"], SHARES).collect()}
        want = {c: df.where(f"{c} > 0").agg(F.percentile(c, SHARES)).first()[0] or [] for c in ("a", "b")}
        assert got == {(c, s): repr(v) for c, vs in want.items() for s, v in zip(SHARES, vs, strict=False)}


def test_land_areas_no_task_reads_all_values(spark):
    kind = F.element_at(F.array(F.lit("land"), F.lit("house"), F.lit(None)), (F.col("id") % 3 + 1).cast("int"))
    df = spark.range(0, 200_000, 1, 8).select(kind.alias("type"), (1000 + F.rand(3) * 1000).alias("v"))
    df = df.unionByName(spark.createDataFrame([("none", None), ("none", -1.0)], "type string, v double"))
    got, most = most_read(spark, lambda: profile_run.land_areas(df).collect())
    want = df.groupBy("type").agg(F.count("*"), F.count_if(F.col("v") > 0), F.median(F.when(F.col("v") > 0, F.col("v"))))
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert 0 < most < 500_000
