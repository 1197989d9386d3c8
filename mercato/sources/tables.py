"""The ``Tables`` mapping: table name -> lazy DataFrame.

Three ways to build one:

* :meth:`Tables.from_parquet` / :meth:`Tables.from_files` - a folder (local,
  HDFS, object store) with one dataset per table, e.g. ``orders/`` or
  ``orders.parquet`` (parquet, CSV, ORC, JSON);
* :meth:`Tables.from_catalog` - tables registered in a Spark catalog;
* :meth:`Tables.from_tpch` - the test mapping that derives the marketplace
  tables from the TPC-H-like test data by fixed arithmetic on keys (views
  only, nothing is written).
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.sources.schema import SCHEMAS, check_joined_keys, conform

# The nine tables the marketplace database is expected to hold.
EXPECTED_TABLES = (
    "orders",
    "order_items",
    "order_payments",
    "order_reviews",
    "customers",
    "sellers",
    "products",
    "category_translation",
    "geolocation",
)


class Tables(Mapping[str, DataFrame]):
    """Immutable mapping of table name to DataFrame; missing tables are absent.

    ``stored`` holds tables as they were read, before :func:`conform`; only the
    money check looks at them.
    """

    def __init__(self, frames: Mapping[str, DataFrame], stored: Mapping[str, DataFrame] | None = None):
        self._frames = dict(frames)
        self.stored = dict(stored or {})
        check_joined_keys(self._frames)

    @classmethod
    def conformed(cls, read: Mapping[str, DataFrame]) -> "Tables":
        """Tables of frames as read."""
        return cls({n: conform(df, n) for n, df in read.items()}, read)

    def __getitem__(self, name: str) -> DataFrame:
        try:
            return self._frames[name]
        except KeyError:
            raise KeyError(f"table {name!r} is not available; present: {sorted(self._frames)}") from None

    def __iter__(self) -> Iterator[str]:
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)

    @property
    def spark(self) -> SparkSession:
        return next(iter(self._frames.values())).sparkSession

    def without(self, *names: str) -> "Tables":
        keep = lambda frames: {k: v for k, v in frames.items() if k not in names}
        return Tables(keep(self._frames), keep(self.stored))

    # -- builders ---------------------------------------------------------
    @classmethod
    def from_files(
        cls, spark: SparkSession, folder: str, fmt: str = "parquet", names=EXPECTED_TABLES, **options
    ) -> "Tables":
        """Read each table present under ``folder`` as ``<name>`` or ``<name>.<fmt>``.

        Declared tables are conformed by column name, so text formats need no
        schema inference: CSV is read with a header and every column as text;
        amounts, scores and timestamps are cast, keys stay text. A path that
        does not exist leaves its table out (the table check reports it); any
        other error is raised with the table's name.
        """
        if fmt == "csv":
            options = {"header": "true", "inferSchema": "false", **options}
        read = {}
        for name in names:
            for candidate in (f"{folder.rstrip('/')}/{name}", f"{folder.rstrip('/')}/{name}.{fmt}"):
                try:
                    read[name] = spark.read.format(fmt).options(**options).load(candidate)
                    break
                except Exception as exc:
                    if not (isinstance(exc, AnalysisException) and exc.getCondition() == "PATH_NOT_FOUND"):
                        raise RuntimeError(f"table {name!r} at {candidate} can't be read: {exc}") from exc
        return cls.conformed(read)

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str, names=EXPECTED_TABLES) -> "Tables":
        """Parquet datasets under ``folder`` (e.g. a database exported to parquet)."""
        return cls.from_files(spark, folder, "parquet", names)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str | None = None, names=EXPECTED_TABLES) -> "Tables":
        """Use tables of a Spark catalog database (the default database if ``None``)."""
        present = {t.name for t in spark.catalog.listTables(database)}
        prefix = f"{database}." if database else ""
        return cls.conformed({n: spark.table(prefix + n) for n in names if n in present})

    @classmethod
    def from_tpch(cls, spark: SparkSession, sf_dir: str) -> "Tables":
        """Derive the seven queried marketplace tables from the TPC-H-like test data.

        ``order_payments`` and ``geolocation`` have no counterpart, so the
        table check reports them missing.
        """
        def read(name: str) -> DataFrame:
            return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))

        frames = tpch_mapping(read("orders"), read("lineitem"), read("customer"), read("supplier"),
                              read("part"), read("nation"))
        return cls.conformed(frames)


def _seconds(n):
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n.cast("decimal(18,6)"))


def tpch_mapping(orders, lineitem, customer, supplier, part, nation) -> dict[str, DataFrame]:
    """The test mapping (fixed arithmetic on keys), as lazy projections."""
    k = F.col("o_orderkey")
    purchase = F.col("o_orderdate") + _seconds((k * 7919) % 86400)
    m_orders = orders.select(
        k.alias("order_id"),
        k.alias("customer_id"),
        F.when(k % 97 == 3, F.lit(None))
        .when(k % 20 == 0, "canceled")
        .when(k % 20 == 1, "unavailable")
        .when(k % 20 == 2, "shipped")
        .otherwise("delivered")
        .alias("order_status"),
        purchase.alias("order_purchase_timestamp"),
        F.when(k % 31 == 0, F.lit(None))
        .otherwise(purchase + _seconds(86400 * (1 + (k * 13) % 29) + (k * 104729) % 86400))
        .alias("order_delivered_customer_date"),
        F.when(k % 53 == 0, F.lit(None))
        .otherwise(F.col("o_orderdate") + _seconds(86400 * (8 + (k * 7) % 19)))
        .alias("order_estimated_delivery_date"),
    )
    m_items = lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        (F.col("l_quantity") * 1.25).cast("decimal(18,2)").alias("freight_value"),
    )
    m_reviews = orders.where(k % 9 != 0).select(
        k.alias("order_id"), (1 + (k * 11) % 5).cast("int").alias("review_score")
    ).unionByName(
        orders.where(k % 50 == 7).select(k.alias("order_id"), (1 + (k * 3) % 5).cast("int").alias("review_score"))
    )
    nations = nation.select("n_nationkey", "n_name")
    m_customers = (
        orders.select("o_orderkey", "o_custkey")
        .join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("customer_id"),
            F.col("o_custkey").alias("customer_unique_id"),
            F.col("n_name").alias("customer_state"),
        )
    )
    m_sellers = supplier.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("n_name").alias("seller_state"),
        F.col("s_name").alias("seller_city"),
    )
    m_products = part.select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 17 == 0, F.lit(None)).otherwise(F.col("p_type")).alias("product_category_name"),
    )
    m_translation = (
        part.where(F.col("p_type") != "PROMO")
        .select(F.col("p_type").alias("product_category_name"))
        .distinct()
        .select("product_category_name",
                F.concat(F.lit("en_"), F.lower("product_category_name")).alias("product_category_name_english"))
    )
    out = {
        "orders": m_orders,
        "order_items": m_items,
        "order_reviews": m_reviews,
        "customers": m_customers,
        "sellers": m_sellers,
        "products": m_products,
        "category_translation": m_translation,
    }
    assert set(out) <= set(SCHEMAS)
    return out
