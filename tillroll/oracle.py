"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL re-states each rule in plain SQL over the pre-registered test views (lineitem,
orders, customer, nation, part): a chain of CTEs from the raw adapter to the filtered
dashboard view, and one SELECT per key. Output names and types are aligned with the Spark
side (counts BIGINT, money DOUBLE from exact DECIMAL sums, calendar parts INTEGER).
"""

from __future__ import annotations

from tillroll.plans.view import DEFAULT_SPEC, FilterSpec


def _pad(expr: str, width: int) -> str:
    s = f"CAST({expr} AS VARCHAR)"
    return f"CASE WHEN length({s}) >= {width} THEN {s} ELSE lpad({s}, {width}, '0') END"


def _money(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18,2))"


def msum(expr: str) -> str:
    return f"CAST(sum({_money(expr)}) AS DOUBLE)"


def mavg(expr: str) -> str:
    return f"(CAST(sum({_money(expr)}) AS DOUBLE) / count({expr}))"


RAW = f"""
SELECT
  'TXN-' || {_pad('l_orderkey', 7)} || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
  substr(CAST(o_orderdate AS VARCHAR), 1, 10) AS "date",
  CAST(7 + (l_orderkey * 3 + l_linenumber) % 16 AS INTEGER) AS "hour",
  CASE WHEN (l_orderkey * 7 + l_partkey) % 67 = 0 THEN NULL
       ELSE 'CUST-' || {_pad('o_custkey', 5)} END AS customer_id,
  'STORE-' || {_pad('l_suppkey % 50', 3)} AS store_id,
  CASE WHEN l_suppkey % 50 = 7 OR (l_orderkey * 11 + l_partkey) % 100 = 0 THEN NULL
       ELSE n_name END AS city,
  p_name AS product_name,
  p_type AS category,
  CAST(CAST(l_quantity AS INTEGER)
       + CASE WHEN (l_orderkey * 13 + l_partkey) % 200 = 0 THEN 150 ELSE 0 END AS INTEGER) AS quantity,
  CAST(p_retailprice / 10 AS DOUBLE) AS unit_price,
  CASE WHEN (l_orderkey * 17 + l_partkey) % 200 = 1 THEN NULL
       ELSE CAST(CAST(round(l_discount * 100) AS INTEGER) AS DOUBLE) END AS discount_pct,
  CAST(l_extendedprice AS DOUBLE) AS total_amount,
  CASE WHEN (l_orderkey * 19 + l_partkey) % 125 = 0 THEN NULL
       ELSE o_orderpriority END AS payment_method
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN part ON l_partkey = p_partkey
"""

_REST = [
    "date", "hour", "customer_id", "store_id", "city", "product_name", "category",
    "quantity", "unit_price", "discount_pct", "total_amount", "payment_method",
]
DEDUP = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY transaction_id
    ORDER BY {', '.join(f'"{c}" ASC NULLS FIRST' for c in _REST)}) AS rn
  FROM raw) WHERE rn = 1
"""

PARSED = """
SELECT * REPLACE (CAST(try_strptime("date", '%Y-%m-%d') AS DATE) AS "date") FROM dedup
"""

MODES = """
SELECT store_id, city AS city_mode FROM (
  SELECT store_id, city,
         row_number() OVER (PARTITION BY store_id ORDER BY count(*) DESC, city ASC) AS rn
  FROM parsed WHERE city IS NOT NULL GROUP BY store_id, city) WHERE rn = 1
"""

CITY_FILLED = """
SELECT p.* REPLACE (coalesce(p.city, m.city_mode, 'Unknown') AS city)
FROM parsed p LEFT JOIN modes m ON p.store_id = m.store_id
"""

IMPUTED = """
SELECT * REPLACE (
  coalesce(customer_id, 'GUEST') AS customer_id,
  coalesce(payment_method, 'Unknown') AS payment_method,
  coalesce(discount_pct, CAST(0 AS DOUBLE)) AS discount_pct)
FROM city_filled
"""

CAPV = """
SELECT percentile_disc(0.99) WITHIN GROUP (ORDER BY quantity) AS cap FROM imputed
"""

CAPPED = """
SELECT i.*, CAST(CASE WHEN i.quantity > (SELECT cap FROM capv) THEN (SELECT cap FROM capv)
                      ELSE i.quantity END AS INTEGER) AS quantity_capped
FROM imputed i
"""

CLEANED = """
SELECT *, CAST(CAST(unit_price AS DECIMAL(16,6)) * CAST(quantity_capped AS DECIMAL(10,0))
               * CAST((100 - discount_pct) / 100 AS DECIMAL(9,6))
          AS DECIMAL(18,2)) AS total_amount_clean
FROM capped
"""

FEAT = """
SELECT *,
  CAST(year("date") AS INTEGER) AS year,
  CAST(month("date") AS INTEGER) AS month,
  CAST(dayofweek("date") + 1 AS INTEGER) AS day_of_week,
  dayname("date") AS day_name,
  CAST(weekofyear("date") AS INTEGER) AS week_of_year,
  CAST(quarter("date") AS INTEGER) AS quarter,
  CAST(CASE WHEN dayofweek("date") IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
  monthname("date") AS month_name,
  strftime("date", '%Y-%m') AS year_month,
  CASE WHEN total_amount_clean < 100 THEN 'Low'
       WHEN total_amount_clean < 500 THEN 'Medium'
       WHEN total_amount_clean < 2000 THEN 'High'
       ELSE 'Premium' END AS revenue_bucket
FROM cleaned
"""

EXPORT = """
SELECT transaction_id, "date", "hour", customer_id, store_id, city, product_name, category,
       quantity_capped AS quantity, unit_price, discount_pct,
       CAST(total_amount_clean AS DOUBLE) AS total_amount, payment_method,
       year, month, day_of_week, day_name, quarter, is_weekend, year_month, revenue_bucket
FROM feat
"""


def _in_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def view_sql(spec: FilterSpec = DEFAULT_SPEC) -> str:
    preds = []
    if spec.date_from is not None:
        preds.append(f"\"date\" >= DATE '{spec.date_from.isoformat()}'")
    if spec.date_to is not None:
        preds.append(f"\"date\" <= DATE '{spec.date_to.isoformat()}'")
    for col, values in (
        ("category", spec.categories),
        ("city", spec.cities),
        ("payment_method", spec.payments),
    ):
        if values is not None:
            preds.append(f"{col} IN ({_in_list(values)})" if values else "FALSE")
    if spec.date_from is None and spec.date_to is None:
        preds.append('"date" IS NOT NULL')  # the data's own bounds hold, no undated row is within them
    return f"SELECT * FROM export WHERE {' AND '.join(preds)}"


CHAIN = [
    ("raw", RAW),
    ("dedup", DEDUP),
    ("parsed", PARSED),
    ("modes", MODES),
    ("city_filled", CITY_FILLED),
    ("imputed", IMPUTED),
    ("capv", CAPV),
    ("capped", CAPPED),
    ("cleaned", CLEANED),
    ("feat", FEAT),
    ("export", EXPORT),
    ("v", view_sql()),
]
_ORDER = [name for name, _ in CHAIN]


def q(upto: str, body: str) -> str:
    """``WITH`` every CTE of the chain up to ``upto``, then ``body``."""
    ctes = CHAIN[: _ORDER.index(upto) + 1]
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes) + "\n" + body


def pred_sql(spec: FilterSpec) -> str:
    return view_sql(spec).split(" WHERE ", 1)[1]


_CLEANED_COLS = (
    'transaction_id, "date", "hour", customer_id, store_id, city, product_name, category, '
    "quantity, unit_price, discount_pct, total_amount, payment_method, quantity_capped, "
    "CAST(total_amount_clean AS DOUBLE) AS total_amount_clean"
)
_NULL_TOTAL = " + ".join(
    f'CAST(count_if("{c}" IS NULL) AS BIGINT)'
    for c in [
        "transaction_id", "date", "hour", "customer_id", "store_id", "city", "product_name",
        "category", "quantity", "unit_price", "discount_pct", "total_amount", "payment_method",
        "quantity_capped", "total_amount_clean",
    ]
)
_RAW_COLS = ["transaction_id"] + _REST
_P99 = "(SELECT percentile_disc(0.99) WITHIN GROUP (ORDER BY quantity) FROM dedup)"


def _describe(cols, digits=6, quartiles=False) -> str:
    parts = []
    for c in cols:
        x = f'CAST("{c}" AS DOUBLE)'
        sel = [
            f"'{c}' AS \"column\"",
            f"count({x}) AS \"count\"",
            f"round(avg({x}), {digits}) AS mean",
            f"round(stddev_samp({x}), {digits}) AS {'std' if quartiles else 'stddev'}",
            f"min({x}) AS \"min\"",
        ]
        if quartiles:
            sel += [f"round(quantile_cont({x}, {p}), {digits}) AS q{int(p * 100)}" for p in (0.25, 0.5, 0.75)]
        sel.append(f"max({x}) AS \"max\"")
        parts.append("SELECT " + ", ".join(sel) + " FROM raw")
    return "\nUNION ALL\n".join(parts)


def _filter_sql() -> dict[str, str]:
    from tillroll.registry import FILTER_STATES, ONE_DATE, SINGLE_FILTERS

    out = {name: q("export", view_sql(spec)) for name, spec in SINGLE_FILTERS.items()}
    out["filtered_view"] = q("v", "SELECT * FROM v")
    out["filter_one_date"] = q("export", view_sql(ONE_DATE))
    states = [
        f"SELECT '{name}' AS state, count(*) = 0 AS is_empty FROM export WHERE {pred_sql(spec)}"
        for name, spec in FILTER_STATES.items()
    ]
    out["filter_states"] = q("export", "\nUNION ALL\n".join(states))
    return out


# summary -> its key columns and measures
_PUBLISHED = {
    "summary_category": (["category"], ["total_revenue", "num_transactions", "avg_order_value", "total_quantity"]),
    "summary_monthly": (["year_month"], ["monthly_revenue", "monthly_orders", "unique_customers"]),
    "summary_city": (["city"], ["revenue", "orders", "unique_customers"]),
    "summary_top_products": (["product_name", "category"], ["revenue", "qty_sold"]),
    "summary_hourly": (['"hour"'], ["txn_count"]),
    "summary_payment": (["payment_method"], ["txn_count", "revenue"]),
}


def _published(sql: dict[str, str]) -> str:
    """The six summaries stacked to (summary, key, measure, value)."""
    ctes, parts = [], []
    for name, (keys, measures) in _PUBLISHED.items():
        ctes.append(f"{name} AS ({sql[name].split(q('feat', ''), 1)[1]})")
        key = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
        parts += [
            f"SELECT '{name}' AS summary, {key} AS \"key\", '{m}' AS measure, CAST({m} AS DOUBLE) AS \"value\" FROM {name}"
            for m in measures
        ]
    chain = q("feat", "").rstrip()
    return chain + ",\n" + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(parts)


# panel -> its key columns and measures
_PANELS = {
    "dash_monthly_trend": (["year_month"], ["revenue", "orders"]),
    "dash_category_revenue": (["category"], ["revenue"]),
    "dash_category_share": (["category"], ["count", "share"]),
    "dash_city_revenue": (["city"], ["revenue", "orders"]),
    "dash_payment_share": (["method"], ["count", "share"]),
    "dash_heatmap_wide": (["day_name"], [f"hour_{h}" for h in range(24)]),
    "dash_heatmap_long": (["day_name", "hour"], ["revenue"]),
    "dash_quarterly": (["year", "quarter"], ["revenue"]),
    "dash_discount_impact": (["discount_pct"], ["revenue", "orders"]),
    "dash_weekend": (["is_weekend"], ["revenue", "orders", "avg_val"]),
    "dash_top10_products": (["product_name"], ["revenue"]),
    "kpis": (
        [],
        ["total_revenue", "total_orders", "avg_order_value", "unique_customers", "total_quantity", "avg_discount"],
    ),
}


def _stacked_panels(sql: dict[str, str]) -> str:
    """The panels stacked to (panel, key, measure, value)."""
    ctes, parts = [], []
    for name, (keys, measures) in _PANELS.items():
        ctes.append(f"{name} AS ({sql[name].split(q('v', ''), 1)[1]})")
        key = " || '|' || ".join(f"coalesce(CAST(\"{k}\" AS VARCHAR), '')" for k in keys) or "''"
        parts += [
            f"SELECT '{name}' AS panel, {key} AS \"key\", '{m}' AS measure, CAST(\"{m}\" AS DOUBLE) AS \"value\" FROM {name}"
            for m in measures
        ]
    return q("v", "").rstrip() + ",\n" + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(parts)


_HOURS = list(range(24))
_DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def oracle_sql() -> dict[str, str]:
    F = "feat"
    sql = {
        # sources / sinks
        "csv_scan": q("raw", "SELECT * FROM raw"),
        "csv_scan_by_name": q("raw", "SELECT * FROM raw"),
        "summary_availability": q(
            F,
            "SELECT * FROM (VALUES "
            + ", ".join(f"('{n}', FALSE, CAST(NULL AS BIGINT))" for n in [*_PUBLISHED, "cleaned"] if n not in ("summary_category", "summary_payment"))
            + ") AS t(name, available, num_rows)\n"
            "UNION ALL SELECT 'summary_category', TRUE, (SELECT count(*) FROM (SELECT DISTINCT category FROM feat))\n"
            "UNION ALL SELECT 'summary_payment', TRUE, (SELECT count(*) FROM (SELECT DISTINCT payment_method FROM feat))",
        ),
        "cleaned_scan": q("export", "SELECT * FROM export"),
        "summary_scan": None,  # filled below (same as summary_category)
        "export_cleaned": q("export", "SELECT * FROM export"),
        "project_cleaned": q("export", "SELECT * FROM export"),
        # profile
        "row_count": q("raw", "SELECT count(*) AS num_rows FROM raw"),
        "null_counts": q("raw", "SELECT " + ", ".join(f'CAST(count_if("{c}" IS NULL) AS BIGINT) AS "{c}"' for c in _RAW_COLS) + " FROM raw"),
        "duplicate_count": q(
            "raw",
            "SELECT num_rows, distinct_ids, num_rows - distinct_ids AS duplicates FROM ("
            "SELECT count(*) AS num_rows, CAST(count(DISTINCT transaction_id) + "
            "CASE WHEN CAST(count_if(transaction_id IS NULL) AS BIGINT) > 0 THEN 1 ELSE 0 END AS BIGINT) AS distinct_ids FROM raw)",
        ),
        "describe_numeric": q("raw", _describe(["quantity", "unit_price", "discount_pct", "total_amount"])),
        "describe_quartiles": q(
            "raw", _describe(["hour", "quantity", "unit_price", "discount_pct", "total_amount"], quartiles=True)
        ),
        "dataset_summary": q(
            "raw",
            "SELECT count(*) AS num_rows, 13 AS num_columns, min(\"date\") AS min_date, max(\"date\") AS max_date, "
            "count(DISTINCT category) AS categories, count(DISTINCT product_name) AS products, "
            "count(DISTINCT city) AS cities, count(DISTINCT customer_id) AS customers, "
            "(" + " + ".join(f'CAST(count_if("{c}" IS NULL) AS BIGINT)' for c in _RAW_COLS) + ") AS null_values FROM raw",
        ),
        # cleaning
        "dedup_transactions": q("dedup", "SELECT * FROM dedup"),
        "parse_date": q("parsed", 'SELECT transaction_id, "date" FROM parsed'),
        "store_city_mode": q("modes", "SELECT * FROM modes"),
        "impute_city_mode": q("city_filled", "SELECT transaction_id, store_id, city FROM city_filled"),
        "impute_defaults": q(
            "dedup",
            "SELECT * REPLACE (coalesce(customer_id, 'GUEST') AS customer_id, "
            "coalesce(payment_method, 'Unknown') AS payment_method, "
            "coalesce(discount_pct, CAST(0 AS DOUBLE)) AS discount_pct) FROM dedup",
        ),
        "quantity_p99": q("dedup", f"SELECT CAST({_P99} AS INTEGER) AS p99"),
        "outlier_count": q("dedup", f"SELECT count(*) AS outliers FROM dedup WHERE quantity > {_P99}"),
        "outlier_rows": q("dedup", f"SELECT * FROM dedup WHERE quantity > {_P99}"),
        "cap_outliers": q(
            "dedup",
            f"SELECT transaction_id, quantity, CAST(CASE WHEN quantity > {_P99} THEN {_P99} ELSE quantity END "
            "AS INTEGER) AS quantity_capped FROM dedup",
        ),
        "recompute_amount": q(
            "cleaned",
            "SELECT transaction_id, unit_price, quantity_capped, discount_pct, "
            "CAST(total_amount_clean AS DOUBLE) AS total_amount_clean FROM cleaned",
        ),
        "clean_transactions": q("cleaned", f"SELECT {_CLEANED_COLS} FROM cleaned"),
        "remaining_nulls": q("cleaned", f"SELECT {_NULL_TOTAL} AS remaining_nulls FROM cleaned"),
        # features
        "feature_columns": q(
            "feat",
            "SELECT transaction_id, year, month, day_of_week, day_name, week_of_year, quarter, "
            "is_weekend, month_name, year_month FROM feat",
        ),
        "revenue_bucket": q(
            "feat",
            "SELECT transaction_id, CAST(total_amount_clean AS DOUBLE) AS total_amount_clean, revenue_bucket FROM feat",
        ),
        "customer_txn_rank": q(
            "feat",
            'SELECT customer_id, "date", transaction_id, CAST(row_number() OVER (PARTITION BY customer_id '
            'ORDER BY "date" ASC NULLS FIRST, transaction_id ASC NULLS FIRST) AS INTEGER) AS cust_txn_rank FROM feat',
        ),
        "features_with_rank": q(
            F,
            'SELECT transaction_id, customer_id, "date", revenue_bucket, CAST(row_number() OVER (PARTITION BY customer_id '
            'ORDER BY "date" ASC NULLS FIRST, transaction_id ASC NULLS FIRST) AS INTEGER) AS cust_txn_rank FROM feat',
        ),
        # analyses
        "revenue_by_category": q(
            F,
            f"SELECT category, {msum('total_amount_clean')} AS total_revenue, count(*) AS num_transactions, "
            f"{mavg('total_amount_clean')} AS avg_order_value FROM feat GROUP BY category",
        ),
        "top15_products": q(
            F,
            f"SELECT product_name, category, {msum('total_amount_clean')} AS revenue FROM feat "
            "GROUP BY product_name, category ORDER BY revenue DESC, product_name, category LIMIT 15",
        ),
        "monthly_revenue": q(
            F, f"SELECT year_month, {msum('total_amount_clean')} AS monthly_revenue FROM feat GROUP BY year_month"
        ),
        "city_performance": q(
            F,
            f"SELECT city, {msum('total_amount_clean')} AS revenue, count(DISTINCT customer_id) AS unique_customers "
            "FROM feat GROUP BY city",
        ),
        "customers_by_level": q(
            F,
            "SELECT CASE grouping(\"year\", \"month\", city) WHEN 0 THEN 'month_city' WHEN 1 THEN 'month' WHEN 6 THEN 'city' "
            "ELSE 'all' END AS level, \"year\", \"month\", city, count(DISTINCT customer_id) AS unique_customers FROM feat "
            "GROUP BY GROUPING SETS ((\"year\", \"month\", city), (\"year\", \"month\"), (city), ())",
        ),
        "payment_distribution": q(F, "SELECT payment_method, count(*) AS txn_count FROM feat GROUP BY payment_method"),
        "weekend_vs_weekday": q(
            F,
            f"SELECT is_weekend, {msum('total_amount_clean')} AS total_revenue, "
            f"{mavg('total_amount_clean')} AS avg_order_value, count(*) AS num_orders FROM feat GROUP BY is_weekend",
        ),
        "peak_hours": q(F, 'SELECT "hour", count(*) AS txn_count FROM feat GROUP BY "hour"'),
        # summaries
        "summary_category": q(
            F,
            f"SELECT category, {msum('total_amount_clean')} AS total_revenue, count(*) AS num_transactions, "
            f"{mavg('total_amount_clean')} AS avg_order_value, CAST(sum(quantity_capped) AS BIGINT) AS total_quantity "
            "FROM feat GROUP BY category",
        ),
        "summary_monthly": q(
            F,
            f"SELECT year_month, {msum('total_amount_clean')} AS monthly_revenue, count(*) AS monthly_orders, "
            "count(DISTINCT customer_id) AS unique_customers FROM feat GROUP BY year_month",
        ),
        "summary_city": q(
            F,
            f"SELECT city, {msum('total_amount_clean')} AS revenue, count(*) AS orders, "
            "count(DISTINCT customer_id) AS unique_customers FROM feat GROUP BY city",
        ),
        "summary_top_products": q(
            F,
            f"SELECT product_name, category, {msum('total_amount_clean')} AS revenue, "
            "CAST(sum(quantity_capped) AS BIGINT) AS qty_sold FROM feat GROUP BY product_name, category "
            "ORDER BY revenue DESC, product_name, category LIMIT 20",
        ),
        "summary_hourly": q(F, 'SELECT "hour", count(*) AS txn_count FROM feat GROUP BY "hour"'),
        "summary_payment": q(
            F,
            f"SELECT payment_method, count(*) AS txn_count, {msum('total_amount_clean')} AS revenue "
            "FROM feat GROUP BY payment_method",
        ),
        # dashboard
        **_filter_sql(),
        "filter_date_bounds": q("export", 'SELECT min("date") AS min_date, max("date") AS max_date FROM export'),
        "filter_coverage": q(
            "export", f"SELECT CAST(count_if({pred_sql(DEFAULT_SPEC)}) AS BIGINT) AS shown, count(*) AS total FROM export"
        ),
        "filter_options": q(
            "export",
            "SELECT DISTINCT field, value FROM ("
            "SELECT 'category' AS field, category AS value FROM export UNION ALL "
            "SELECT 'city', city FROM export UNION ALL "
            "SELECT 'payment_method', payment_method FROM export)",
        ),
        "kpis": q(
            "v",
            f"SELECT {msum('total_amount')} AS total_revenue, count(*) AS total_orders, "
            f"{mavg('total_amount')} AS avg_order_value, count(DISTINCT customer_id) AS unique_customers, "
            "CAST(sum(quantity) AS BIGINT) AS total_quantity, avg(discount_pct) AS avg_discount FROM v",
        ),
        "dash_monthly_trend": q(
            "v", f"SELECT year_month, {msum('total_amount')} AS revenue, count(total_amount) AS orders FROM v GROUP BY year_month"
        ),
        "dash_category_revenue": q("v", f"SELECT category, {msum('total_amount')} AS revenue FROM v GROUP BY category"),
        "dash_category_share": q(
            "v",
            'SELECT category, count(*) AS "count", CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) '
            "AS share FROM v WHERE category IS NOT NULL GROUP BY category",
        ),
        "dash_top10_products": q(
            "v",
            f"SELECT product_name, {msum('total_amount')} AS revenue FROM v GROUP BY product_name "
            "ORDER BY revenue DESC, product_name LIMIT 10",
        ),
        "dash_city_revenue": q(
            "v", f"SELECT city, {msum('total_amount')} AS revenue, count(total_amount) AS orders FROM v GROUP BY city"
        ),
        "dash_payment_share": q(
            "v",
            'SELECT payment_method AS method, count(*) AS "count", '
            "CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share "
            "FROM v WHERE payment_method IS NOT NULL GROUP BY payment_method",
        ),
        "dash_heatmap_wide": q(
            "v",
            "SELECT d.day_name, "
            + ", ".join(f"coalesce(h.hour_{x}, CAST(0 AS DOUBLE)) AS hour_{x}" for x in _HOURS)
            + " FROM (VALUES "
            + ", ".join(f"('{d}')" for d in _DAYS)
            + ") d(day_name) LEFT JOIN (SELECT day_name, "
            + ", ".join(
                f'CAST(sum(CASE WHEN "hour" = {x} THEN CAST(total_amount AS DECIMAL(18,2)) END) AS DOUBLE) AS hour_{x}'
                for x in _HOURS
            )
            + " FROM v GROUP BY day_name) h ON d.day_name = h.day_name",
        ),
        "dash_heatmap_long": q(
            "v", f'SELECT day_name, "hour", {msum("total_amount")} AS revenue FROM v GROUP BY day_name, "hour"'
        ),
        "dash_quarterly": q(
            "v",
            f"SELECT year, quarter, {msum('total_amount')} AS revenue, "
            "CAST(year AS VARCHAR) || '-Q' || CAST(quarter AS VARCHAR) AS period FROM v GROUP BY year, quarter",
        ),
        "dash_discount_impact": q(
            "v",
            f"SELECT discount_pct, {msum('total_amount')} AS revenue, count(total_amount) AS orders FROM v GROUP BY discount_pct",
        ),
        "dash_weekend": q(
            "v",
            f"SELECT is_weekend, {msum('total_amount')} AS revenue, count(total_amount) AS orders, "
            f"{mavg('total_amount')} AS avg_val, CASE is_weekend WHEN 0 THEN 'Weekday' WHEN 1 THEN 'Weekend' END AS type "
            "FROM v GROUP BY is_weekend",
        ),
        "preview_rows": q("v", "SELECT * FROM v ORDER BY transaction_id LIMIT 500"),
    }
    sql["summary_scan"] = sql["summary_category"]
    sql["pipeline_summaries"] = _published(sql)
    sql["dash_panels"] = _stacked_panels(sql)
    return sql
