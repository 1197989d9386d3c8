"""Orders stored by month: the same answers from fewer files."""

import datetime as dt
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from mercato.operators import abc, cohort, delivery, monthly
from mercato.operators.filters import in_date_range
from mercato.params import Params
from mercato.plans.jobs import plan_of
from mercato.sources.layout import write_orders_by_month
from mercato.sources.schema import PURCHASE_MONTH
from mercato.sources.tables import Tables

RANGE = Params(start_date="1995-03-15", end_date="1996-02-01")


@pytest.fixture(scope="module")
def by_month(spark):
    """The tables as files, and the same with orders by month."""
    plain, months = tempfile.mkdtemp(prefix="mercato-src-"), tempfile.mkdtemp(prefix="mercato-src-")
    for name, df in Tables.from_tpch(spark, SF_SMALL).items():
        df.write.mode("overwrite").parquet(f"{plain}/{name}")
        if name != "orders":
            df.write.mode("overwrite").parquet(f"{months}/{name}")
    t = Tables.from_parquet(spark, plain)
    assert write_orders_by_month(t["orders"], f"{months}/orders")
    return t, Tables.from_parquet(spark, months)


def test_a_range_reads_its_months_alone(by_month):
    _, t = by_month
    ranged = in_date_range(t["orders"], RANGE)
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan_of(ranged)).group(1)
    assert "199503" in filters and "199602" in filters
    files = t["orders"].select(PURCHASE_MONTH, F.input_file_name().alias("f")).distinct()
    held = {r["f"]: r[PURCHASE_MONTH] for r in files.collect()}
    rows = ranged.select(F.input_file_name().alias("f")).distinct().collect()
    assert {held[r["f"]] for r in rows} <= {m for m in held.values() if 199503 <= m <= 199602}
    assert len(set(held.values())) > 24


@pytest.mark.parametrize("build", [abc.abc_classification, cohort.cohort_retention, delivery.delivery_by_state, monthly.monthly_growth])
@pytest.mark.parametrize("params", [RANGE, Params(start_date="1995-12-31"), Params(end_date="1995-12-01", seller_state="NATION_3")],
                         ids=["range", "start", "end"])
def test_the_same_answers(by_month, build, params):
    plain, months = by_month
    rows = lambda t: sorted(map(str, build(t, params).collect()))
    assert rows(months) == rows(plain)


def test_edges(spark, make_tables):
    """Orders without an instant have a folder; the ends of months count; an empty table leaves the earlier output."""
    at = dt.datetime
    orders = [(1, 1, "delivered", at(2018, 1, 31, 23, 59, 59), None, None), (2, 2, "delivered", at(2018, 2, 1), None, None),
              (3, 3, None, None, None, None), (4, 4, "shipped", at(2018, 2, 28, 0, 0, 1), None, None), (4, 4, "shipped", None, None, None)]
    t, path = make_tables(orders=orders), f"{tempfile.mkdtemp(prefix='mercato-src-')}/orders"
    assert write_orders_by_month(t["orders"].withColumn(PURCHASE_MONTH, F.lit(1)), path)
    assert not write_orders_by_month(make_tables()["orders"], path)
    got = Tables.conformed({"orders": spark.read.parquet(path)})["orders"]
    assert {(r["order_id"], r[PURCHASE_MONTH]) for r in got.collect()} == {(1, 201801), (2, 201802), (3, None), (4, 201802), (4, None)}
    ids = lambda p: sorted(r["order_id"] for r in in_date_range(got, p).collect())
    assert ids(Params()) == [1, 2, 3, 4, 4] and ids(Params(start_date="2018-02-01")) == [2, 4]
    assert ids(Params(end_date="2018-02-01")) == [1, 2] and ids(Params("2018-01-31", "2018-02-28")) == [1, 2]
    # a column of that name that holds no number is not the month
    other = t["orders"].withColumn(PURCHASE_MONTH, F.lit("May"))
    assert PURCHASE_MONTH not in Tables.conformed({"orders": other})["orders"].columns


def test_plans_show_whole_filters(spark, by_month):
    """However long the columns' numbers make them."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "30")
    try:
        plan = plan_of(in_date_range(by_month[1]["orders"], RANGE))
        assert spark.conf.get("spark.sql.maxMetadataStringLength") == "30"
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "199503" in plan and "199602" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
