"""Declared columns of the marketplace tables.

The analyses only need the columns below. Keys and review scores keep the
type they are stored in (integers, text, ...); text scores (CSV) become
``double``. Money is ``decimal(18,2)`` at the table boundary so sums are exact
and do not depend on the order in which a cluster adds partial results; it
becomes ``double`` only in final projections. A stored amount with more than two
decimals is rounded there, and the money check reports how many were
(:func:`mercato.operators.checks.all_checks`). Timestamps carry no zone
(``timestamp_ntz``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
TS = T.TimestampNTZType()
TEXT = T.StringType()


class Stored:
    """Marks a column that keeps its stored type; ``fallback`` replaces text, and is used for empty test tables."""

    def __init__(self, fallback: T.DataType, text_as: T.DataType | None = None):
        self.fallback, self.text_as = fallback, text_as


#: Integer column of orders stored by month (:mod:`mercato.sources.layout`): 201803 for March 2018.
PURCHASE_MONTH = "purchase_month"

KEY = Stored(T.LongType())
SCORE = Stored(T.IntegerType(), text_as=T.DoubleType())

#: Columns that are joined with each other; their stored types must agree.
JOINED_KEYS = (
    (("orders", "order_id"), ("order_items", "order_id")),
    (("orders", "order_id"), ("order_reviews", "order_id")),
    (("orders", "customer_id"), ("customers", "customer_id")),
    (("order_items", "seller_id"), ("sellers", "seller_id")),
    (("order_items", "product_id"), ("products", "product_id")),
    (("products", "product_category_name"), ("category_translation", "product_category_name")),
)

_COLUMNS: dict[str, tuple] = {
    "orders": (
        ("order_id", KEY),
        ("customer_id", KEY),
        ("order_status", TEXT),
        ("order_purchase_timestamp", TS),
        ("order_delivered_customer_date", TS),
        ("order_estimated_delivery_date", TS),
    ),
    "order_items": (
        ("order_id", KEY),
        ("product_id", KEY),
        ("seller_id", KEY),
        ("price", MONEY),
        ("freight_value", MONEY),
    ),
    "order_reviews": (("order_id", KEY), ("review_score", SCORE)),
    "customers": (("customer_id", KEY), ("customer_unique_id", KEY), ("customer_state", TEXT)),
    "sellers": (("seller_id", KEY), ("seller_state", TEXT), ("seller_city", TEXT)),
    "products": (("product_id", KEY), ("product_category_name", TEXT)),
    "category_translation": (("product_category_name", TEXT), ("product_category_name_english", TEXT)),
}

#: The columns with the types used where nothing is stored yet (integer keys).
SCHEMAS: dict[str, T.StructType] = {
    name: T.StructType([T.StructField(c, k.fallback if isinstance(k, Stored) else k) for c, k in columns])
    for name, columns in _COLUMNS.items()
}


def _as_declared(field: T.StructField, kind) -> Column:
    col = F.col(f"`{field.name}`")
    if isinstance(kind, Stored):
        kind = kind.text_as if kind.text_as is not None and isinstance(field.dataType, T.StringType) else None
    return col if kind is None else col.cast(kind)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Project ``df`` onto the declared columns of table ``name`` that it has.

    A projection over the scan: Catalyst still prunes the other columns and
    pushes filters below it. A column that is not there stays away: the checks
    report it and only the analyses that use it fail. Tables without declared
    columns (present only for the table check) pass through unchanged.
    Orders stored by month keep the month's column.
    """
    columns = _COLUMNS.get(name)
    if columns is None:
        return df
    stored = {f.name.lower(): f for f in df.schema.fields}
    month = stored.get(PURCHASE_MONTH) if name == "orders" else None
    by_month = [F.col(PURCHASE_MONTH)] if month is not None and isinstance(month.dataType, T.IntegralType) else []
    return df.select([_as_declared(stored[c], kind).alias(c) for c, kind in columns if c in stored] + by_month)


def altered_money(df: DataFrame, name: str) -> dict[str, Column]:
    """Conditions that tell amounts of the *stored* table that ``conform`` changes; only for types that can."""
    out = {}
    for c, kind in _COLUMNS.get(name, ()):
        field = next((f for f in df.schema.fields if f.name.lower() == c), None)
        if kind is not MONEY or field is None or isinstance(field.dataType, T.IntegralType):
            continue
        if isinstance(field.dataType, T.DecimalType) and field.dataType.scale <= MONEY.scale:
            continue
        col = F.col(f"`{field.name}`")
        # a double that is the nearest one to an amount of two decimals is that amount
        out[c] = col.cast("double") != col.cast(MONEY).cast("double")
    return out


def check_joined_keys(frames: dict[str, DataFrame]) -> None:
    """Raise if two tables store one key in types that do not compare."""
    for (t1, c1), (t2, c2) in JOINED_KEYS:
        if t1 not in frames or t2 not in frames or c1 not in frames[t1].columns or c2 not in frames[t2].columns:
            continue
        k1, k2 = frames[t1].schema[c1].dataType, frames[t2].schema[c2].dataType
        if k1 != k2 and not (isinstance(k1, T.IntegralType) and isinstance(k2, T.IntegralType)):
            raise TypeError(f"{t1}.{c1} is {k1.simpleString()} but {t2}.{c2} is {k2.simpleString()}: store the key in one type")
