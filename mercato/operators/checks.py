"""Data-quality checks, run before the analyses; failures warn, never stop.

Every check yields rows ``check_name, table_name, column_name, observed,
threshold, passed`` (``observed``/``threshold`` as text, so all checks share
one schema). A missing table or column is a failed row, not an exception, and
:func:`run_checks` turns an error while a table is read into failed rows of that
table alone. Each table is scanned once: row count, non-NULL counts of its key
columns and, for ``orders``, the purchase-date range come from one aggregate;
stored amounts with more than two decimals are counted in a second one, only
where the stored type allows them.
"""

from __future__ import annotations

import datetime as _dt
import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions import ts_literal
from mercato.sources.schema import altered_money
from mercato.sources.tables import EXPECTED_TABLES

log = logging.getLogger("mercato")

# Key columns that must hold at least one non-NULL value.
KEY_COLUMNS: dict[str, tuple[str, ...]] = {
    "orders": ("order_id", "customer_id"),
    "order_items": ("order_id", "seller_id", "product_id"),
    "customers": ("customer_id",),
    "sellers": ("seller_id",),
    "products": ("product_id",),
}

# Minimum row counts of the core tables.
MIN_ROW_COUNTS: dict[str, int] = {
    "orders": 1_000,
    "order_items": 1_000,
    "customers": 1_000,
}

DATE_TABLE, DATE_COLUMN = "orders", "order_purchase_timestamp"
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

CHECK_SCHEMA = T.StructType(
    [
        T.StructField("check_name", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("column_name", T.StringType(), True),
        T.StructField("observed", T.StringType(), True),
        T.StructField("threshold", T.StringType(), True),
        T.StructField("passed", T.BooleanType(), False),
    ]
)


def _row(check: str, table: str, column: str | None, observed: Column, threshold: str | None, passed: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.lit(column).cast("string").alias("column_name"),
        observed.cast("string").alias("observed"),
        F.lit(threshold).cast("string").alias("threshold"),
        passed.alias("passed"),
    )


def _fixed(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, CHECK_SCHEMA)


def _utc_now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)


def _table_checks(
    t, table: str, keys: bool, rows: bool, dates: bool, now: _dt.datetime | None, minimums: dict | None = None
) -> DataFrame | None:
    """One aggregate over ``table`` producing the requested check rows."""
    df = t[table]
    key_cols = KEY_COLUMNS.get(table, ()) if keys else ()
    minimum = (MIN_ROW_COUNTS if minimums is None else minimums).get(table) if rows else None
    absent = [c for c in key_cols if c not in df.columns]
    key_cols = [c for c in key_cols if c in df.columns]
    want_dates = dates and table == DATE_TABLE
    if want_dates and DATE_COLUMN not in df.columns:
        want_dates = False
        absent.append(DATE_COLUMN)
    lost = None
    if absent:
        lost = _fixed(df.sparkSession, [
            ("date_range" if c == DATE_COLUMN else "key_column_non_null", table, c, "column missing", None if c == DATE_COLUMN else "1", False)
            for c in absent])
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count(c).alias(f"_nn_{c}") for c in key_cols]
    if want_dates:
        aggs += [F.min(DATE_COLUMN).alias("_min_ts"), F.max(DATE_COLUMN).alias("_max_ts")]
    if not key_cols and minimum is None and not want_dates:
        return lost
    prof = df.agg(*aggs)
    structs = [
        _row("key_column_non_null", table, c, F.col(f"_nn_{c}"), "1", F.col(f"_nn_{c}") >= 1) for c in key_cols
    ]
    if minimum is not None:
        structs.append(_row("min_row_count", table, None, F.col("_rows"), str(minimum), F.col("_rows") >= minimum))
    if want_dates:
        when = now or _utc_now()
        low = F.col("_min_ts")
        structs.append(
            _row(
                "date_range",
                table,
                DATE_COLUMN,
                F.date_format(low, TS_FORMAT),
                when.strftime("%Y-%m-%d %H:%M:%S"),
                F.coalesce(low <= ts_literal(when), F.lit(False)),
            )
        )
    out = prof.select(F.inline(F.array(*structs)))
    return out if lost is None else out.unionByName(lost)


def _missing_rows(t, tables, check: str, columns: dict | None = None, thresholds: dict | None = None) -> list[tuple]:
    rows = []
    for table in tables:
        if table in t:
            continue
        for column in (columns or {}).get(table, (None,)):
            threshold = (thresholds or {}).get(table)
            rows.append((check, table, column, None, None if threshold is None else str(threshold), False))
    return rows


def _union(spark: SparkSession, parts: list[DataFrame | None], fixed_rows: list[tuple]) -> DataFrame:
    out = _fixed(spark, fixed_rows)
    for p in parts:
        if p is not None:
            out = out.unionByName(p)
    return out


def check_tables(t, spark: SparkSession | None = None) -> DataFrame:
    """One row per expected table: present or missing."""
    return _fixed(spark or t.spark, _presence_rows(t))


def _presence_rows(t) -> list[tuple]:
    return [("table_present", n, None, "present" if n in t else "missing", "present", n in t) for n in EXPECTED_TABLES]


def check_key_columns(t) -> DataFrame:
    parts = [_table_checks(t, n, True, False, False, None) for n in KEY_COLUMNS if n in t]
    return _union(t.spark, parts, _missing_rows(t, KEY_COLUMNS, "key_column_non_null", KEY_COLUMNS, {n: 1 for n in KEY_COLUMNS}))


def check_row_counts(t, minimums: dict[str, int] | None = None) -> DataFrame:
    """Core tables hold at least their minimum number of rows (default :data:`MIN_ROW_COUNTS`)."""
    limits = MIN_ROW_COUNTS if minimums is None else minimums
    parts = [_table_checks(t, n, False, True, False, None, limits) for n in limits if n in t]
    return _union(t.spark, parts, _missing_rows(t, limits, "min_row_count", None, limits))


def check_date_range(t, now: _dt.datetime | None = None) -> DataFrame:
    """Passes when the earliest purchase exists and is not after ``now`` (UTC)."""
    parts = [_table_checks(t, DATE_TABLE, False, False, True, now)] if DATE_TABLE in t else []
    missing = [] if DATE_TABLE in t else [("date_range", DATE_TABLE, DATE_COLUMN, None, None, False)]
    return _union(t.spark, parts, missing)


def all_checks(t, now: _dt.datetime | None = None) -> DataFrame:
    """Every check, one scan per table."""
    names = list(dict.fromkeys([*KEY_COLUMNS, *MIN_ROW_COUNTS, DATE_TABLE]))
    parts = [_table_checks(t, n, True, True, True, now) for n in names if n in t]
    return _union(t.spark, parts + money_checks(t), _fixed_rows(t))


def _fixed_rows(t) -> list[tuple]:
    """Rows that need no table: presence, and the checks of missing tables."""
    fixed = _presence_rows(t)
    fixed += _missing_rows(t, KEY_COLUMNS, "key_column_non_null", KEY_COLUMNS, {n: 1 for n in KEY_COLUMNS})
    fixed += _missing_rows(t, MIN_ROW_COUNTS, "min_row_count", None, MIN_ROW_COUNTS)
    if DATE_TABLE not in t:
        fixed.append(("date_range", DATE_TABLE, DATE_COLUMN, None, None, False))
    return fixed


def money_checks(t) -> list[DataFrame]:
    """Per table: how many stored amounts are rounded on load (none may be)."""
    out = []
    for table, df in getattr(t, "stored", {}).items():
        bad = altered_money(df, table)
        if table not in t or not bad:
            continue
        counts = df.agg(*[F.count(F.when(cond, 1)).alias(c) for c, cond in bad.items()])
        rows = [_row("money_two_decimals", table, c, F.col(c), "0", F.col(c) == 0) for c in bad]
        out.append(counts.select(F.inline(F.array(*rows))))
    return out


def run_checks(t, now: _dt.datetime | None = None) -> list[dict]:
    """Every check's row, each table run on its own: an error fails that table's checks and no others."""
    names = [n for n in dict.fromkeys([*KEY_COLUMNS, *MIN_ROW_COUNTS, DATE_TABLE]) if n in t]
    parts = [(n, lambda n=n: _table_checks(t, n, True, True, True, now)) for n in names]
    parts += [("money", lambda p=p: p) for p in money_checks(t)]
    rows = [dict(zip(CHECK_SCHEMA.names, r)) for r in _fixed_rows(t)]
    for name, build in parts:
        try:
            rows += [r.asDict() for r in build().collect()]  # a handful of rows
        except Exception as exc:  # noqa: BLE001 - reported as a failed check
            log.error("checks of %s failed: %s", name, exc)
            rows.append(dict(zip(CHECK_SCHEMA.names, ("readable", name, None, f"{type(exc).__name__}: {exc}"[:500], None, False))))
    return rows


def check_summary(t, now: _dt.datetime | None = None) -> DataFrame:
    """One row: ``checks, failed, passed`` (AND of all checks)."""
    c = all_checks(t, now)
    return c.agg(
        F.count(F.lit(1)).alias("checks"),
        F.sum(F.when(F.col("passed"), 0).otherwise(1)).cast("long").alias("failed"),
        F.bool_and("passed").alias("passed"),
    )
