"""Independent DuckDB SQL for each registered query (the correctness oracle).

Every statement starts with the test mapping as CTEs over the driver's
TPC-H-like views, then states the analysis in plain SQL. Money is summed
as DECIMAL and cast to DOUBLE at the end; ratios use DOUBLE.
"""

from __future__ import annotations

from mercato.plans.settings import END, NOW, START, STATE

MAPPING = """WITH
m_orders AS (
  SELECT order_id, customer_id, order_status, p AS order_purchase_timestamp,
    CASE WHEN order_id % 31 = 0 THEN NULL
         ELSE p + to_seconds(86400 * (1 + (order_id * 13) % 29) + (order_id * 104729) % 86400) END
      AS order_delivered_customer_date,
    CASE WHEN order_id % 53 = 0 THEN NULL
         ELSE o_orderdate + to_seconds(86400 * (8 + (order_id * 7) % 19)) END
      AS order_estimated_delivery_date
  FROM (
    SELECT o_orderkey AS order_id, o_orderkey AS customer_id, o_orderdate,
      CASE WHEN o_orderkey % 97 = 3 THEN NULL
           WHEN o_orderkey % 20 = 0 THEN 'canceled'
           WHEN o_orderkey % 20 = 1 THEN 'unavailable'
           WHEN o_orderkey % 20 = 2 THEN 'shipped'
           ELSE 'delivered' END AS order_status,
      o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS p
    FROM orders)
),
m_items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS seller_id,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
    CAST(l_quantity * 1.25 AS DECIMAL(18,2)) AS freight_value
  FROM lineitem
),
m_reviews AS (
  SELECT o_orderkey AS order_id, CAST(1 + (o_orderkey * 11) % 5 AS INTEGER) AS review_score
  FROM orders WHERE o_orderkey % 9 <> 0
  UNION ALL
  SELECT o_orderkey, CAST(1 + (o_orderkey * 3) % 5 AS INTEGER) FROM orders WHERE o_orderkey % 50 = 7
),
m_customers AS (
  SELECT o_orderkey AS customer_id, o_custkey AS customer_unique_id, n_name AS customer_state
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
m_sellers AS (
  SELECT s_suppkey AS seller_id, n_name AS seller_state, s_name AS seller_city
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
m_products AS (
  SELECT p_partkey AS product_id,
    CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_type END AS product_category_name
  FROM part
),
m_translation AS (
  SELECT DISTINCT p_type AS product_category_name, concat('en_', lower(p_type)) AS product_category_name_english
  FROM part WHERE p_type <> 'PROMO'
)"""


def _dates(col: str, start: str | None, end: str | None) -> str:
    out = ""
    if start:
        out += f" AND {col} >= TIMESTAMP '{start} 00:00:00'"
    if end:
        out += f" AND {col} <= TIMESTAMP '{end} 00:00:00'"
    return out


def _holds_item_of(alias: str, state: str | None) -> str:
    """Condition: the order of ``alias`` holds an item of a seller in the state."""
    if not state:
        return ""
    return (f" AND EXISTS (SELECT 1 FROM m_items x, m_sellers y WHERE x.order_id = {alias}.order_id "
            f"AND x.seller_id = y.seller_id AND y.seller_state = '{state}')")


ORDER_COLS = ("order_id, customer_id, order_status, order_purchase_timestamp, "
              "order_delivered_customer_date, order_estimated_delivery_date")


def orders_where(condition: str) -> str:
    return MAPPING + f"\nSELECT {ORDER_COLS} FROM m_orders z WHERE {condition}"


# -- monthly revenue: lines to months, then each month beside the one numbered before it ------------
def monthly(select: str, start=None, end=None, state=None) -> str:
    return MAPPING + f""",
lines AS (
  SELECT CAST(date_trunc('month', z.order_purchase_timestamp) AS TIMESTAMP) AS month, i.order_id, i.seller_id,
    i.price + i.freight_value AS paid
  FROM m_items i, m_orders z
  WHERE i.order_id = z.order_id AND z.order_status = 'delivered'
    {_dates('z.order_purchase_timestamp', start, end)}{_holds_item_of('z', state)}
),
months AS (
  SELECT m.month, m.paid, o.n AS orders, v.n AS sellers, row_number() OVER (ORDER BY m.month NULLS LAST) AS k
  FROM (SELECT month, SUM(paid) AS paid FROM lines GROUP BY month) m
  JOIN (SELECT month, COUNT(*) AS n FROM (SELECT DISTINCT month, order_id FROM lines) GROUP BY month) o
    ON m.month IS NOT DISTINCT FROM o.month
  JOIN (SELECT month, COUNT(*) AS n FROM (SELECT DISTINCT month, seller_id FROM lines) GROUP BY month) v
    ON m.month IS NOT DISTINCT FROM v.month
),
trend AS (
  SELECT a.month, CAST(a.paid AS DOUBLE) AS revenue, a.orders AS order_count, a.sellers AS active_sellers,
    ROUND(CAST(a.paid - b.paid AS DOUBLE) / NULLIF(CAST(b.paid AS DOUBLE), 0) * 100, 1) AS mom_growth_pct
  FROM months a LEFT JOIN months b ON b.k = a.k - 1
)
{select}"""


TREND = "SELECT * FROM trend"


# -- seller scorecard: facts of an order, then of a seller, then places among the sellers -------------
def sellers(select: str, start=None, end=None, state=None) -> str:
    only = f"WHERE who.seller_state = '{state}'" if state else ""
    place = lambda c: f"COALESCE(CAST(rank() OVER (ORDER BY {c}) - 1 AS DOUBLE) / NULLIF(COUNT(*) OVER () - 1, 0), 0)"
    return MAPPING + f""",
scores AS (
  SELECT order_id, SUM(review_score) AS points, COUNT(review_score) AS scored, COUNT(*) AS written
  FROM m_reviews GROUP BY order_id
),
facts AS (
  SELECT z.order_id, s.points, s.scored, s.written,
    datediff('day', z.order_delivered_customer_date, z.order_estimated_delivery_date) AS early,
    COALESCE(CAST(z.order_delivered_customer_date <= z.order_estimated_delivery_date AS INTEGER), 0) AS punctual
  FROM m_orders z LEFT JOIN scores s ON s.order_id = z.order_id
  WHERE z.order_status = 'delivered'{_dates('z.order_purchase_timestamp', start, end)}
),
measures AS (
  SELECT i.seller_id AS id, SUM(i.price) + SUM(i.freight_value) AS money, COUNT(DISTINCT f.order_id) AS orders,
    CAST(SUM(f.early) AS DOUBLE) / NULLIF(COUNT(f.early), 0) AS early,
    CAST(SUM(f.punctual) AS DOUBLE) / COUNT(*) AS punctual,
    CAST(SUM(f.points) AS DOUBLE) / NULLIF(SUM(f.scored), 0) AS stars, COALESCE(SUM(f.written), 0) AS written
  FROM m_items i JOIN facts f ON f.order_id = i.order_id GROUP BY i.seller_id
),
known AS (
  SELECT who.seller_id, who.seller_state, who.seller_city, m.money, m.orders, m.punctual,
    COALESCE(m.early, 0) AS early, COALESCE(m.stars, 0) AS stars
  FROM measures m JOIN m_sellers who ON who.seller_id = m.id {only}
),
placed AS (
  SELECT *, {place('money')} AS p_money, {place('punctual')} AS p_punctual, {place('stars')} AS p_stars FROM known
),
board AS (
  SELECT seller_id, seller_state, seller_city, CAST(money AS DOUBLE) AS total_revenue, orders AS total_orders,
    ROUND(punctual * 100, 1) AS on_time_pct, ROUND(early, 1) AS avg_days_early, ROUND(stars, 2) AS avg_review_score,
    ROUND((p_money * 0.40 + p_punctual * 0.30 + p_stars * 0.30) * 100, 1) AS composite_score
  FROM placed
)
{select}"""


BOARD = "SELECT * FROM board"
TOP = "SELECT * FROM board ORDER BY composite_score DESC, seller_id LIMIT {n}"


# -- ABC: every item weighs as many times as its order has items; tied products are one step -----------
def products(select: str, start=None, end=None, state=None, fanout=True) -> str:
    weight = "(SELECT order_id, COUNT(*) AS times FROM m_items GROUP BY order_id)" if fanout else "(SELECT DISTINCT order_id, 1 AS times FROM m_items)"
    sold_by = f" AND i.seller_id IN (SELECT seller_id FROM m_sellers WHERE seller_state = '{state}')" if state else ""
    return MAPPING + f""",
sums AS (
  SELECT i.product_id AS id, SUM(i.price * q.times) AS money, CAST(SUM(q.times) AS BIGINT) AS units
  FROM m_items i JOIN {weight} q ON q.order_id = i.order_id JOIN m_orders z ON z.order_id = i.order_id
  WHERE z.order_status = 'delivered'{_dates('z.order_purchase_timestamp', start, end)}{sold_by}
  GROUP BY i.product_id
),
steps AS (
  SELECT money, SUM(SUM(money)) OVER (ORDER BY money DESC ROWS UNBOUNDED PRECEDING) AS upto, SUM(SUM(money)) OVER () AS whole
  FROM sums GROUP BY money
),
shares AS (
  SELECT a.id AS product_id, a.money, a.units, CAST(a.money AS DOUBLE) / CAST(b.whole AS DOUBLE) AS part,
    CAST(b.upto AS DOUBLE) / CAST(b.whole AS DOUBLE) AS so_far
  FROM sums a JOIN steps b ON a.money = b.money
),
graded AS (
  SELECT h.*, COALESCE(e.product_category_name_english, c.product_category_name, 'Unknown') AS category,
    CASE WHEN so_far > 0.95 THEN 'C' WHEN so_far > 0.80 THEN 'B' ELSE 'A' END AS grade
  FROM shares h LEFT JOIN m_products c ON c.product_id = h.product_id
  LEFT JOIN m_translation e ON e.product_category_name = c.product_category_name
),
listed AS (
  SELECT product_id, category, CAST(money AS DOUBLE) AS revenue, units AS units_sold,
    ROUND(part * 100, 4) AS revenue_share_pct, ROUND(so_far * 100, 2) AS cumulative_share_pct, grade AS abc_class
  FROM graded
)
{select}"""


LISTED = "SELECT * FROM listed"
TIER_SUMMARY = """SELECT g.grade AS abc_class, COUNT(*) AS product_count, CAST(SUM(g.money) AS DOUBLE) AS revenue,
  CAST(SUM(g.units) AS BIGINT) AS units_sold,
  ROUND(CAST(SUM(g.money) AS DOUBLE) / CAST((SELECT SUM(money) FROM sums) AS DOUBLE) * 100, 2) AS revenue_share_pct
FROM graded g GROUP BY g.grade"""


# -- cohorts: a person's different purchase instants in order, the first two side by side --------------
def cohorts(select: str, start=None, end=None, state=None) -> str:
    back = ",\n    ".join(
        f"CAST(COUNT(*) FILTER (WHERE again - started <= INTERVAL {d} DAY) AS BIGINT) AS back_{d}" for d in WINDOWS)
    shown = ", ".join([f"back_{d} AS returned_{d}d" for d in WINDOWS]
                      + [f"ROUND(CAST(back_{d} AS DOUBLE) / people * 100, 2) AS retention_{d}d_pct" for d in WINDOWS])
    return MAPPING + f""",
instants AS (
  SELECT DISTINCT c.customer_unique_id AS person, z.order_purchase_timestamp AS moment
  FROM m_orders z, m_customers c
  WHERE c.customer_id = z.customer_id AND z.order_status IS NOT NULL AND z.order_status <> 'canceled'
    AND z.order_status <> 'unavailable'{_dates('z.order_purchase_timestamp', start, end)}{_holds_item_of('z', state)}
),
visits AS (
  SELECT person, moment, row_number() OVER (PARTITION BY person ORDER BY moment) AS nth
  FROM instants WHERE person IS NOT NULL AND moment IS NOT NULL
),
people AS (
  SELECT a.person, CAST(date_trunc('month', a.moment) AS TIMESTAMP) AS month, a.moment AS started, b.moment AS again
  FROM visits a LEFT JOIN visits b ON b.person = a.person AND b.nth = 2 WHERE a.nth = 1
),
sizes AS (
  SELECT month, COUNT(*) AS people,
    {back}
  FROM people GROUP BY month
),
kept AS (SELECT month AS cohort_month, people AS cohort_size, {shown} FROM sizes)
{select}"""


WINDOWS = (30, 60, 90)  # fixed values: days
KEPT = "SELECT * FROM kept"
KEPT_LONG = " UNION ALL ".join(
    f"SELECT cohort_month, {d} AS window_days, returned_{d}d AS returned, retention_{d}d_pct AS retention_pct FROM kept"
    for d in WINDOWS
)


# -- delivery: days of each trip, then whole sums per state -----------------------------------------------
def trips(select: str, start=None, end=None, state=None) -> str:
    return MAPPING + f""",
trip AS (
  SELECT z.*, datediff('day', z.order_purchase_timestamp, z.order_delivered_customer_date) AS took,
    datediff('day', z.order_purchase_timestamp, z.order_estimated_delivery_date) AS promised,
    datediff('day', z.order_delivered_customer_date, z.order_estimated_delivery_date) AS spare
  FROM m_orders z
  WHERE z.order_status = 'delivered' AND z.order_delivered_customer_date IS NOT NULL
    AND z.order_estimated_delivery_date IS NOT NULL
    {_dates('z.order_purchase_timestamp', start, end)}{_holds_item_of('z', state)}
),
totals AS (
  SELECT c.customer_state AS state, COUNT(*) AS n, SUM(took) AS took, SUM(took * took) AS took2, SUM(promised) AS promised,
    SUM(spare) AS spare, COUNT(*) FILTER (WHERE spare >= 0) AS good, MIN(took) AS low, MAX(took) AS high
  FROM trip JOIN m_customers c ON c.customer_id = trip.customer_id GROUP BY c.customer_state
),
states AS (
  SELECT state, n AS order_count, ROUND(CAST(took AS DOUBLE) / n, 1) AS avg_actual_days,
    ROUND(CAST(promised AS DOUBLE) / n, 1) AS avg_estimated_days, ROUND(CAST(spare AS DOUBLE) / n, 1) AS avg_days_early,
    ROUND(SQRT(CAST(n * took2 - took * took AS DOUBLE) / (CAST(n AS DOUBLE) * (n - 1))), 1) AS stddev_actual_days,
    CAST(good AS DOUBLE) / n * 100 AS on_time_pct, CAST(low AS BIGINT) AS min_actual_days, CAST(high AS BIGINT) AS max_actual_days
  FROM totals WHERE n >= 10
)
{select}"""


STATES = "SELECT * FROM states"


# -- checks ---------------------------------------------------------------------
# Key columns and minimum row counts of the checks.
KEY_COLUMNS = [
    ("orders", "m_orders", "order_id"),
    ("orders", "m_orders", "customer_id"),
    ("order_items", "m_items", "order_id"),
    ("order_items", "m_items", "seller_id"),
    ("order_items", "m_items", "product_id"),
    ("customers", "m_customers", "customer_id"),
    ("sellers", "m_sellers", "seller_id"),
    ("products", "m_products", "product_id"),
]
MIN_ROWS = [("orders", "m_orders", 1000), ("order_items", "m_items", 1000), ("customers", "m_customers", 1000)]
PRESENT = [("orders", "m_orders"), ("order_items", "m_items"), ("order_reviews", "m_reviews"), ("customers", "m_customers"),
           ("sellers", "m_sellers"), ("products", "m_products"), ("category_translation", "m_translation")]
ABSENT = ["order_payments", "geolocation"]

KEY_SQL = "\nUNION ALL\n".join(
    f"SELECT 'key_column_non_null' AS check_name, '{t}' AS table_name, '{c}' AS column_name, "
    f"CAST(COUNT({c}) AS VARCHAR) AS observed, '1' AS threshold, COUNT({c}) >= 1 AS passed FROM {v}"
    for t, v, c in KEY_COLUMNS
)
ROWS_SQL = "\nUNION ALL\n".join(
    f"SELECT 'min_row_count' AS check_name, '{t}' AS table_name, CAST(NULL AS VARCHAR) AS column_name, "
    f"CAST(COUNT(*) AS VARCHAR) AS observed, '{m}' AS threshold, COUNT(*) >= {m} AS passed FROM {v}"
    for t, v, m in MIN_ROWS
)
DATE_SQL = (
    "SELECT 'date_range' AS check_name, 'orders' AS table_name, 'order_purchase_timestamp' AS column_name, "
    "strftime(MIN(order_purchase_timestamp), '%Y-%m-%d %H:%M:%S') AS observed, "
    f"'{NOW}' AS threshold, COALESCE(MIN(order_purchase_timestamp) <= TIMESTAMP '{NOW}', FALSE) AS passed "
    "FROM m_orders"
)
# a mapped table is there if its view can be read; the two others have no view
PRESENCE_SQL = "\nUNION ALL\n".join(
    [f"SELECT 'table_present' AS check_name, '{n}' AS table_name, CAST(NULL AS VARCHAR) AS column_name, "
     f"CASE WHEN COUNT(*) >= 0 THEN 'present' END AS observed, 'present' AS threshold, COUNT(*) >= 0 AS passed FROM {v}"
     for n, v in PRESENT]
    + [f"SELECT 'table_present', '{n}', CAST(NULL AS VARCHAR), 'missing', 'present', FALSE" for n in ABSENT]
)
SUMMARY_SQL = f""",
all_checks AS (
{PRESENCE_SQL}
UNION ALL
{KEY_SQL}
UNION ALL
{ROWS_SQL}
UNION ALL
{DATE_SQL}
)
SELECT COUNT(*) AS checks, CAST(SUM(CASE WHEN passed THEN 0 ELSE 1 END) AS BIGINT) AS failed,
  bool_and(passed) AS passed
FROM all_checks"""


ORACLES: dict[str, str] = {
    "delivered_orders": orders_where("order_status = 'delivered'"),
    "active_orders": orders_where("order_status <> 'canceled' AND order_status <> 'unavailable'"),
    "orders_date_range": orders_where("TRUE" + _dates("order_purchase_timestamp", START, END)),
    "orders_by_seller_state": orders_where("TRUE" + _holds_item_of("z", STATE)),
    "seller_revenue": sellers("SELECT id AS seller_id, CAST(money AS DOUBLE) AS total_revenue, orders AS total_orders FROM measures"),
    "seller_delivery": sellers("SELECT id AS seller_id, early AS avg_days_early, punctual AS on_time_rate FROM measures"),
    "seller_reviews": sellers("SELECT id AS seller_id, stars AS avg_review_score FROM measures WHERE written > 0"),
    "seller_percent_ranks": sellers(
        "SELECT seller_id, CAST(money AS DOUBLE) AS total_revenue, punctual AS on_time_rate, stars AS avg_review_score, "
        "p_money AS pr_revenue, p_punctual AS pr_on_time, p_stars AS pr_review FROM placed"),
    "seller_scorecard": sellers(BOARD),
    "seller_scorecard_by_state": sellers(BOARD, state=STATE),
    "seller_scorecard_date_range": sellers(BOARD, start=START, end=END),
    "top_sellers": sellers(TOP.format(n=50)),
    "top_sellers_10": sellers(TOP.format(n=10)),
    "product_categories": MAPPING + """
SELECT c.product_id, COALESCE(e.product_category_name_english, c.product_category_name, 'Unknown') AS category
FROM m_products c LEFT JOIN m_translation e USING (product_category_name)""",
    "product_revenue": products(
        "SELECT id AS product_id, CAST(money AS DOUBLE) AS revenue, units AS units_sold FROM sums", fanout=False),
    "product_revenue_fanout": products("SELECT id AS product_id, CAST(money AS DOUBLE) AS revenue, units AS units_sold FROM sums"),
    "product_revenue_share": products(
        "SELECT product_id, CAST(money AS DOUBLE) AS revenue, part AS revenue_share FROM shares"),
    "product_cumulative_share": products(
        "SELECT product_id, CAST(money AS DOUBLE) AS revenue, so_far AS cumulative_share FROM shares"),
    "abc_classification": products(LISTED),
    "abc_classification_plain": products(LISTED, fanout=False),
    "abc_classification_by_state": products(LISTED, state=STATE),
    "abc_classification_date_range": products(LISTED, start=START, end=END),
    "abc_tier_summary": products(TIER_SUMMARY),
    "customer_first_purchase": cohorts(
        "SELECT person AS customer_unique_id, started AS first_purchase_ts, month AS cohort_month FROM people"),
    "second_purchase": cohorts(
        "SELECT person AS customer_unique_id, month AS cohort_month, started AS first_purchase_ts, "
        "again AS second_purchase_ts FROM people"),
    "cohort_retention": cohorts(KEPT),
    "cohort_retention_by_state": cohorts(KEPT, state=STATE),
    "cohort_retention_date_range": cohorts(KEPT, start=START, end=END),
    "cohort_retention_long": cohorts(KEPT_LONG),
    "order_lead_times": trips(
        "SELECT order_id, customer_id, order_purchase_timestamp, order_delivered_customer_date, "
        "order_estimated_delivery_date, took AS actual_days, promised AS estimated_days, spare AS days_early FROM trip"),
    "delivery_by_state": trips(STATES),
    "delivery_in_seller_state": trips(STATES, state=STATE),
    "delivery_date_range": trips(STATES, start=START, end=END),
    "delivery_days_early": trips("SELECT state, avg_days_early FROM states"),
    "check_key_columns": MAPPING + "\n" + KEY_SQL,
    "check_row_counts": MAPPING + "\n" + ROWS_SQL,
    "check_date_range": MAPPING + "\n" + DATE_SQL,
    "check_summary": MAPPING + SUMMARY_SQL,
    "monthly_revenue": monthly("SELECT month, revenue, order_count, active_sellers FROM trend"),
    "monthly_growth": monthly(TREND),
    "monthly_growth_by_state": monthly(TREND, state=STATE),
    "monthly_growth_date_range": monthly(TREND, start=START, end=END),
    "monthly_series": monthly(
        "SELECT strftime(month, '%Y-%m') AS month_label, revenue, order_count, mom_growth_pct FROM trend"),
}

# Output orders, as text: the analysis' own ORDER BY and a tie-break.
OUTPUT_ORDERS = {
    "seller_scorecard": "composite_score DESC NULLS LAST, seller_id",
    "abc_classification": "revenue DESC NULLS LAST, product_id NULLS LAST",
    "cohort_retention": "cohort_month NULLS LAST",
    "delivery_by_state": "avg_days_early DESC NULLS LAST, state NULLS LAST",
    "monthly_growth": "month NULLS LAST",
}
ORACLES |= {
    f"{name}_ordered": f"SELECT *, ROW_NUMBER() OVER (ORDER BY {order}) AS position FROM ({ORACLES[name]})"
    for name, order in OUTPUT_ORDERS.items()
}
