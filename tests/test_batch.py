import glob
import os
import random
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, money, ts
from mercato.params import Params
from mercato.plans.batch import run_batch
from mercato.sources import sinks
from mercato.sources.tables import Tables


def test_run_writes_outputs_and_reports_failed_checks(spark):
    out = tempfile.mkdtemp(prefix="mercato-run-")
    t = Tables.from_tpch(spark, SF_SMALL)
    res = run_batch(t, out)
    assert not res.errors
    assert res.checks_passed is False  # order_payments, geolocation absent in the mapping
    missing = {r["table_name"] for r in res.failed_checks if r["check_name"] == "table_present"}
    assert missing == {"order_payments", "geolocation"}
    assert res.written["summary.csv"] and res.written["detail.parquet"]
    summary = spark.read.option("header", True).csv(f"{out}/summary.csv")
    assert summary.count() == min(50, t["sellers"].count())
    assert len(glob.glob(f"{out}/summary.csv/*.csv")) == 1
    detail = spark.read.parquet(f"{out}/detail.parquet")
    assert detail.count() > 0 and "abc_class" in detail.columns
    for name in ("abc_tier_summary", "cohort_retention", "delivery_by_state", "monthly_series", "seller_scorecard",
                 "top_sellers_10", "cohort_retention_long", "delivery_days_early"):
        assert os.path.isdir(f"{out}/report/{name}"), name
    # tier summary from the rounded detail equals the one computed from exact sums
    from mercato.operators import abc

    from_file = {r["abc_class"]: r.asDict() for r in spark.read.parquet(f"{out}/report/abc_tier_summary").collect()}
    exact = {r["abc_class"]: r.asDict() for r in abc.abc_tier_summary(t).collect()}
    assert from_file == exact


def test_one_failed_analysis_does_not_stop_the_rest(spark):
    out = tempfile.mkdtemp(prefix="mercato-run-")
    t = Tables.from_tpch(spark, SF_SMALL).without("order_reviews")
    res = run_batch(t, out)
    assert "seller_scorecard" in res.errors or "summary.csv" in res.errors
    assert res.written["detail.parquet"] and res.written["monthly_series"]


def test_empty_result_is_not_written(spark):
    from mercato.params import Params

    out = tempfile.mkdtemp(prefix="mercato-run-")
    t = Tables.from_tpch(spark, SF_SMALL)
    res = run_batch(t, out, Params(seller_state="NO_SUCH_STATE"))
    assert res.written["summary.csv"] is False and not os.path.exists(f"{out}/summary.csv")


def _files(path):
    return {f: open(f, "rb").read() for f in sorted(glob.glob(f"{path}/part-*"))}


@pytest.mark.parametrize("write", [sinks.write_parquet, sinks.write_csv], ids=["parquet", "csv"])
def test_a_result_replaces_the_earlier_output_whole_or_not_at_all(spark, write):
    out = tempfile.mkdtemp(prefix="mercato-sink-")
    path = f"{out}/detail"
    full = spark.range(100).repartition(3)
    assert write(full, path) is True and len(_files(path)) == 3
    before = _files(path)
    assert write(full.limit(0), path) is False  # empty after full: the earlier output stays
    assert _files(path) == before
    bad = full.select(F.when(F.col("id") == 70, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken row"):
        write(bad, path)
    assert _files(path) == before
    assert write(spark.range(5).coalesce(1), path) is True and len(_files(path)) == 1  # replaced, not added to
    assert os.listdir(out) == ["detail"]  # nothing is left beside it
    assert write(full.limit(0), f"{out}/none") is False and not os.path.exists(f"{out}/none")


def test_an_output_comes_back_when_the_new_one_cannot_take_its_place(spark, monkeypatch):
    out = tempfile.mkdtemp(prefix="mercato-sink-")
    sinks.write_parquet(spark.range(3), f"{out}/detail")
    files = sinks._Files(spark.range(1))
    with pytest.raises(Exception, match="no-such-folder"):
        files.replace(f"{out}/detail", f"{out}/no-such-folder", f"{out}/_aside")
    assert spark.read.parquet(f"{out}/detail").count() == 3 and os.listdir(out) == ["detail"]


def test_a_run_with_empty_results_leaves_the_earlier_outputs(spark):
    out = tempfile.mkdtemp(prefix="mercato-run-")
    t = Tables.from_tpch(spark, SF_SMALL)
    assert run_batch(t, out).written["detail.parquet"]
    before = _files(f"{out}/detail.parquet"), _files(f"{out}/summary.csv"), _files(f"{out}/report/abc_tier_summary")
    again = run_batch(t, out, Params(seller_state="NO_SUCH_STATE"))
    assert again.written["detail.parquet"] is False and again.written["summary.csv"] is False
    assert before == (_files(f"{out}/detail.parquet"), _files(f"{out}/summary.csv"), _files(f"{out}/report/abc_tier_summary"))


def test_outputs_are_written_in_report_order(spark):
    out = tempfile.mkdtemp(prefix="mercato-run-")
    run_batch(Tables.from_tpch(spark, SF_SMALL), out)
    import pyarrow.parquet as pq

    def in_file_order(path, column):  # part files by name, as a downstream reader would
        files = sorted(glob.glob(f"{path}/part-*.parquet"))
        return [v for f in files for v in pq.read_table(f, columns=[column]).column(column).to_pylist()]

    revenue = in_file_order(f"{out}/detail.parquet", "revenue")
    assert revenue == sorted(revenue, reverse=True)
    for name, column in (("monthly_growth", "month"), ("monthly_series", "month_label"), ("cohort_retention", "cohort_month")):
        values = in_file_order(f"{out}/report/{name}", column)
        assert len(values) > 2 and values == sorted(values)
    early = in_file_order(f"{out}/report/delivery_by_state", "avg_days_early")
    assert len(early) > 2 and early == sorted(early, reverse=True)
    score = in_file_order(f"{out}/report/seller_scorecard", "composite_score")
    assert score == sorted(score, reverse=True)


def test_parquet_and_catalog_sources_give_the_same_answers(spark):
    from mercato.operators import monthly, scorecard

    folder = tempfile.mkdtemp(prefix="mercato-src-")
    mapped = Tables.from_tpch(spark, SF_SMALL)
    for name, df in mapped.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    from_files = Tables.from_parquet(spark, folder)
    assert set(from_files) == set(mapped)  # order_payments, geolocation absent
    for name, df in mapped.items():
        df.createOrReplaceTempView(name)
    from_catalog = Tables.from_catalog(spark)
    assert set(mapped) <= set(from_catalog)
    want = sorted(tuple(r) for r in monthly.monthly_growth(mapped).collect())
    assert sorted(tuple(r) for r in monthly.monthly_growth(from_files).collect()) == want
    assert sorted(tuple(r) for r in monthly.monthly_growth(from_catalog).collect()) == want
    a = sorted(tuple(r) for r in scorecard.seller_scorecard(from_files).collect())
    assert a == sorted(tuple(r) for r in scorecard.seller_scorecard(mapped).collect())
    for name in mapped:
        spark.catalog.dropTempView(name)


def test_command_line_run(spark):
    from mercato.__main__ import main

    out = tempfile.mkdtemp(prefix="mercato-cli-")
    assert main(["--tpch", SF_SMALL, "--output", out, "--start-date", "1996-01-01"]) == 0
    assert os.path.isdir(f"{out}/detail.parquet") and os.path.isdir(f"{out}/summary.csv")
    assert main(["--tpch", SF_SMALL, "--output", out, "--end-date", "1999-02-30"]) == 1  # bad date
    empty = tempfile.mkdtemp(prefix="mercato-cli-empty-")
    assert main(["--input", empty, "--output", out]) == 1  # no table found


def test_csv_source_conforms_by_name(spark):
    from mercato.operators import monthly

    folder = tempfile.mkdtemp(prefix="mercato-csv-")
    mapped = Tables.from_tpch(spark, SF_SMALL)
    for name, df in mapped.items():
        # reversed column order: conform matches by name, not position
        df.select(*reversed(df.columns)).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")
    from_csv = Tables.from_files(spark, folder, "csv")
    assert set(from_csv) == set(mapped)
    assert dict(from_csv["orders"].dtypes)["order_purchase_timestamp"] == "timestamp_ntz"
    want = sorted(tuple(r) for r in monthly.monthly_growth(mapped).collect())
    assert sorted(tuple(r) for r in monthly.monthly_growth(from_csv).collect()) == want


def test_reference_named_api(spark):
    from mercato import api

    t = Tables.from_tpch(spark, SF_SMALL)
    sc = api.get_seller_scorecard(t, "", "", "")
    scores = [r["composite_score"] for r in sc.collect()]
    assert scores == sorted(scores, reverse=True)
    months = [r["month"] for r in api.get_monthly_revenue(t, "1996-01-01", "1999-12-31").collect()]
    assert months == sorted(months) and len(months) == 48
    assert api.get_abc_classification(t, seller_state="NATION_3").count() > 0
    assert api.get_cohort_retention(t).count() > 0 and api.get_delivery_analysis(t).count() > 0
    assert api.validate(t) is False  # two of the nine tables have no counterpart in the mapping
    assert api.validate(t.without()) is False


def test_batch_outputs_equal_standalone_operators(spark):
    from mercato.operators import abc, monthly, scorecard
    from mercato.params import Params

    p = Params(start_date="1996-01-01", seller_state="NATION_3")
    out = tempfile.mkdtemp(prefix="mercato-run-")
    t = Tables.from_tpch(spark, SF_SMALL)
    res = run_batch(t, out, p)
    assert not res.errors

    def same(path, df):
        a = sorted(tuple(r) for r in spark.read.parquet(path).select(*df.columns).collect())
        return a == sorted(tuple(r) for r in df.collect())

    assert same(f"{out}/report/seller_scorecard", scorecard.seller_scorecard(t, p))
    assert same(f"{out}/detail.parquet", abc.abc_classification(t, p))
    assert same(f"{out}/report/monthly_growth", monthly.monthly_growth(t, p))
    assert same(f"{out}/report/monthly_series", monthly.monthly_series(t, p))
    written = spark.read.parquet(f"{out}/report/monthly_series").columns
    assert written == monthly.monthly_series(t, p).columns


def _as_files(spark, mapped):
    folder = tempfile.mkdtemp(prefix="mercato-src-")
    for name, df in mapped.items():
        df.write.parquet(f"{folder}/{name}")
    return Tables.from_parquet(spark, folder)


@pytest.mark.parametrize("params", [Params(), Params(start_date="1996-01-01", seller_state="NATION_3")], ids=["all", "by state"])
def test_the_analyses_read_and_join_the_items_once_a_run(spark, monkeypatch, params):
    from mercato.operators import checks
    from mercato.plans.jobs import recorded

    monkeypatch.setattr(checks, "run_checks", lambda t, now: [])
    t = _as_files(spark, Tables.from_tpch(spark, SF_SMALL))
    with recorded() as jobs:
        assert not run_batch(t, tempfile.mkdtemp(prefix="mercato-run-"), params).errors
    reading = [plan for _, plan in jobs if "/order_items" in plan]
    # the lines; with a state also the in-state orders of the cohort and delivery analyses (two columns)
    whole = [plan for plan in reading if "price" in plan]
    assert len(whole) == 1 and whole[0].count("/order_items") == 1
    assert len(re.findall(r"Join \[order_id#\d+L?\], \[order_id#\d+L?\], Inner", whole[0])) == 1
    narrow = [plan for plan in reading if "price" not in plan]
    assert len(narrow) == (0 if not params.state else 2)


def test_shared_lines_give_what_the_analyses_give_alone(spark, make_tables):
    from mercato.operators import abc, monthly, scorecard
    from mercato.operators.order_lines import order_lines

    rnd = random.Random(8)
    orders = [(o, o, rnd.choice(["delivered"] * 5 + ["shipped", None]), ts(f"2020-0{1 + o % 4}-10"), rnd.choice([None, ts("2020-06-01")]),
               rnd.choice([None, ts("2020-06-03")])) for o in range(40)] + [(40, 40, "delivered", None, None, None)]
    items = [(rnd.randrange(42), rnd.choice([None, 10, 11, 12]), rnd.choice([None, 1, 2, 3]), rnd.choice([None, money(rnd.randint(0, 99))]),
              rnd.choice([None, money(1)])) for _ in range(160)]
    items += [(7, 10, 1, money(3), money(1))] * 30  # repeated rows of one order
    t = make_tables(orders=orders, order_items=items, sellers=[(1, "S", "a"), (2, "S", "b"), (3, "R", "c"), (None, "S", "d")],
                    order_reviews=[(o % 30, o % 6) for o in range(50)] + [(7, None)])
    for params in (Params(), Params(seller_state="S"), Params(start_date="2020-02-01", end_date="2020-04-01", seller_state="R")):
        lines = order_lines(t, params)
        for alone, shared in (
            (scorecard.seller_scorecard(t, params), scorecard.seller_scorecard(t, params, lines=lines)),
            (abc.abc_classification(t, params), abc.abc_classification(t, params, lines=lines)),
            (abc.abc_classification(t, params, fanout=False), abc.abc_classification(t, params, fanout=False, lines=lines)),
            (monthly.monthly_growth(t, params), monthly.monthly_growth(t, params, lines=lines)),
        ):
            assert alone.columns == shared.columns and alone.dtypes == shared.dtypes
            a, b = (sorted(map(tuple, df.collect()), key=str) for df in (alone, shared))
            assert a == b and len(a) > 0


SIDE_BY_SIDE = """
import sys
from pyspark.sql import SparkSession
from mercato.plans import batch
from mercato.sources.tables import Tables
log, out, sf = sys.argv[1:]
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log).config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false")
         .config("spark.scheduler.mode", "FAIR").config("spark.checkpoint.dir", out + "/ckpt").getOrCreate())
real = batch.cohort.cohort_retention
batch.cohort.cohort_retention = lambda t, p: real(t, p).withColumn("x", batch.F.raise_error(batch.F.lit("on purpose")))
res = batch.run_batch(Tables.from_tpch(spark, sf), out + "/out")
assert set(res.errors) == {"cohort_retention"} and "on purpose" in res.errors["cohort_retention"], res.errors
bad = {k for k, ok in res.written.items() if not ok}
assert bad == {"cohort_retention", "cohort_retention_long"} and len(res.written) == 11, res.written
spark.stop()
"""


def test_analyses_run_side_by_side_in_pools_of_their_own(tmp_path):
    """From the event log: jobs of different analyses overlap, and each runs in its analysis' pool; one failure is one analysis'."""
    import json
    import subprocess
    import sys

    (tmp_path / "log").mkdir()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-c", SIDE_BY_SIDE, str(tmp_path / "log"), str(tmp_path), SF_SMALL], cwd=root,
                         capture_output=True, text=True, timeout=600)
    assert run.returncode == 0, run.stderr[-3000:]
    began, spans = {}, {}
    for line in open(next((tmp_path / "log").iterdir())):
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart":
            began[e["Job ID"]] = e["Submission Time"], e.get("Properties", {}).get("spark.scheduler.pool")
        elif e["Event"] == "SparkListenerJobEnd":
            start, pool = began[e["Job ID"]]
            spans.setdefault(pool, []).append((start, e["Completion Time"]))
    pools = {"checks", "seller_scorecard", "abc_classification", "cohort_retention", "delivery_by_state", "monthly_growth"}
    assert pools <= set(spans) <= pools | {None}  # None: the shared lines
    meets = lambda a, b: any(x < v and u < y for x, y in spans[a] for u, v in spans[b])
    assert meets("seller_scorecard", "abc_classification") and meets("cohort_retention", None)


def test_one_at_a_time_gives_the_same(spark):
    outs = [tempfile.mkdtemp(prefix="mercato-run-") for _ in range(2)]
    t = Tables.from_tpch(spark, SF_SMALL)
    results = [run_batch(t, out, parallel=n) for out, n in zip(outs, (1, 6))]
    assert results[0].written == results[1].written and not results[0].errors
    for name in ("detail.parquet", "report/seller_scorecard", "report/monthly_series"):
        a, b = (sorted(map(str, spark.read.parquet(f"{out}/{name}").collect())) for out in outs)
        assert a == b
    with pytest.raises(ValueError, match="at least one"):
        run_batch(t, outs[0], parallel=0)
