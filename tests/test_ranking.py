import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.operators.ranking import numbered, percent_rank_of, percent_ranks, running_share


def _data(spark, seed, n=400, nulls=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # heavy ties: few distinct values, one value holding a third of the rows
        v = Decimal(rng.choice([5, 5, 5, 7, 11, 13, 100, rng.randint(0, 50)])) / Decimal(4)
        if nulls and i % 37 == 0:
            v = None
        rows.append((i, v))
    return spark.createDataFrame(rows, "id long, v decimal(18,2)")


@pytest.mark.parametrize("seed,buckets", [(1, 3), (2, 5), (3, 16)])
def test_percent_rank_matches_window(spark, seed, buckets):
    df = _data(spark, seed)
    got = {r["id"]: r["pr"] for r in percent_rank_of(df, "v", "pr", buckets=buckets).collect()}
    want = {r["id"]: r["pr"] for r in df.select("id", F.percent_rank().over(Window.orderBy("v")).alias("pr")).collect()}
    assert got == want


def test_percent_rank_single_row_is_zero(spark):
    df = spark.createDataFrame([(1, 3.0)], "id long, v double")
    assert percent_rank_of(df, "v", "pr", buckets=4).first()["pr"] == 0.0


@pytest.mark.parametrize("seed,buckets,nulls", [(4, 3, False), (5, 7, True), (6, 1, True)])
def test_running_share_matches_range_window(spark, seed, buckets, nulls):
    df = _data(spark, seed, nulls=nulls)
    got = {r["id"]: r["cum"] for r in running_share(df, "v", "cum", buckets=buckets).collect()}
    total = float(df.agg(F.sum("v")).first()[0])
    w = Window.orderBy(F.col("v").desc_nulls_last())  # default RANGE frame: ties share
    want = {
        r["id"]: r["cum"]
        for r in df.select("id", (F.sum("v").over(w).cast("double") / F.lit(total)).alias("cum")).collect()
    }
    assert got == want


def test_bucketed_equals_plain(spark):
    df = _data(spark, 9, n=1000)
    a = {r["id"]: r["cum"] for r in running_share(df, "v", "cum", buckets=8).collect()}
    b = {r["id"]: r["cum"] for r in running_share(df, "v", "cum", plain=True).collect()}
    assert a == b


def test_no_single_partition_exchange(spark):
    df = _data(spark, 10)
    plan = running_share(df, "v", "cum", buckets=4)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("descending", [False, True])
def test_nan_and_null_keys(spark, descending):
    from mercato.operators.ranking import N_UPTO, ordered_prefix

    vals = [1.0, float("nan"), None, 2.0, float("nan"), 3.0, 2.0, None] * 5 + [float(i) for i in range(40)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
    want = {
        (r["v"] if r["v"] is None or r["v"] == r["v"] else "nan"): r["n"]
        for r in df.groupBy("v").count().select(
            "v", F.sum("count").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)).alias("n")
        ).collect()
    }
    p = ordered_prefix(df, "v", descending=descending, buckets=4)
    got = {(r["v"] if r["v"] is None or r["v"] == r["v"] else "nan"): r[N_UPTO] for r in p.frame.collect()}
    assert got == want


def _keys(spark, n, seed):
    r = random.Random(seed)
    doubles = [None, float("nan"), 0.0, -0.0, 1.5, 1.5, 1.5, float("inf"), -float("inf")]
    longs = [None, 0, 5, 5, 5, 2**53, 2**53 + 1, 2**60 + 1, 2**60, -(2**60)]  # some share a double
    rows = [(i, r.choice([*doubles, r.random(), r.random() * 1e300]), r.choice([*longs, r.randint(-100, 100)]),
             r.choice([0, 0, 0, 1, r.randint(0, 99), None])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, d double, l long, m long").repartition(5)


@pytest.mark.parametrize("n,buckets", [(0, 3), (1, 3), (2, 1), (60, 2), (500, 7)])
def test_prefix_scan_matches_plain_windows(spark, n, buckets):
    df = _keys(spark, n, n)
    got = percent_ranks(df, {"d": "pd", "l": "pl"}, buckets=buckets)
    assert got.columns == ["id", "d", "l", "m", "pd", "pl"]
    want = df.select("id", *[F.percent_rank().over(Window.orderBy(F.col(k).asc_nulls_last())).alias("p" + k) for k in "dl"])
    assert {r["id"]: (r["pd"], r["pl"]) for r in got.collect()} == {r["id"]: (r["pd"], r["pl"]) for r in want.collect()}
    total = df.agg(F.sum("m")).first()[0]
    whole = F.lit(float(total) if total else None)
    want = df.select("id", (F.sum("m").over(Window.orderBy(F.col("m").desc_nulls_last())).cast("double") / whole).alias("c"))
    got = running_share(df, "m", "c", buckets=buckets)
    assert {r["id"]: r["c"] for r in got.collect()} == {r["id"]: r["c"] for r in want.collect()}


def test_a_value_on_a_third_of_the_rows_is_dealt_over_tasks(spark):
    df = spark.range(9_000).select("id", F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(3)).alias("v"),
                                   F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("w")).repartition(12)
    ranked = percent_ranks(df, {"v": "p"}, buckets=24)
    shared = running_share(df, "w", "c", buckets=24)
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for out in (ranked, shared):
            held = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
            assert sum(held) == 9_000 and max(held) < 2_000  # 3,000 rows hold the value
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("n", [0, 1, 700])
def test_numbered_rows_follow_the_order(spark, n):
    df = spark.range(n).select("id", (F.col("id") * 7919 % 101).alias("k"), F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id")).alias("v"))
    order = [F.col("k").desc(), F.col("v").asc_nulls_last(), F.col("id")]
    got = numbered(df.repartition(6), *order, name="place")
    want = df.withColumn("place", F.row_number().over(Window.orderBy(*order)))
    assert got.columns == [*df.columns, "place"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
