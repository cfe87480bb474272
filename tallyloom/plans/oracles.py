"""The same questions in plain SQL over the source tables, for checking results in another engine.

Nothing here is used by the operators.
"""

from __future__ import annotations

from tallyloom.operators.complaints import COMPLAINT_STOPS, COMPLAINT_THEMES, theme_column
from tallyloom.operators.regression import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from tallyloom.operators.text import COMPETITOR_SEEDS, PAIN_POINT_SEEDS
from tallyloom.plans import queries as N
from tallyloom.plans.inputs import ROLLUPS

ORDER_LINES = """
order_lines0 AS (
SELECT 'O' || CAST(l.l_orderkey AS VARCHAR) AS order_id,
       CAST(o.o_orderdate AS DATE) AS order_date,
       CAST(l.l_shipdate AS DATE) AS ship_date,
       l.l_linenumber AS line_number,
       CASE WHEN l.l_returnflag = 'A' THEN 'First Class'
            WHEN l.l_returnflag = 'N' THEN 'Standard Class'
            WHEN l.l_linestatus = 'F' THEN 'Second Class'
            ELSE 'Same Day' END AS ship_mode,
       c.c_name AS customer_name,
       c.c_mktsegment AS segment,
       n.n_name || '-' || CAST(c.c_custkey % 4 AS VARCHAR) AS state,
       n.n_name AS country,
       'M' || CAST(n.n_nationkey % 7 AS VARCHAR) AS market,
       r.r_name AS region,
       'P' || CAST(p.p_partkey AS VARCHAR) AS product_id,
       CASE WHEN p.p_type IN ('ECONOMY', 'STANDARD') THEN 'Office Supplies'
            WHEN p.p_type IN ('SMALL', 'MEDIUM') THEN 'Furniture'
            ELSE 'Technology' END AS category,
       p.p_type || '-' || CAST(p.p_size % 3 AS VARCHAR) AS sub_category,
       p.p_name || ' ' || p.p_brand AS product_name,
       CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(15,4)) AS sales,
       CAST(l.l_quantity AS INT) AS quantity,
       CAST(CAST(l.l_discount AS DECIMAL(4,2)) * 10 AS DECIMAL(15,4)) AS discount,
       CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))
            - CAST(l.l_quantity AS DECIMAL(4,0)) * CAST(p.p_retailprice AS DECIMAL(8,2)) AS DECIMAL(15,4)) AS profit,
       CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_tax AS DECIMAL(4,2)) AS DECIMAL(15,4)) AS shipping_cost,
       o.o_orderpriority AS order_priority
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN part p ON l.l_partkey = p.p_partkey
),
lines AS (
SELECT *, CAST(year(order_date) AS INT) AS year,
       date_diff('day', order_date, ship_date) AS ship_days,
       CASE WHEN sales > 0 THEN CAST(profit AS DOUBLE) / CAST(sales AS DOUBLE) ELSE 0 END AS profit_margin,
       CASE WHEN discount <= -0.001 THEN NULL WHEN discount <= 0 THEN 'No discount' WHEN discount <= 0.2 THEN 'Low discount'
            WHEN discount <= 0.4 THEN 'Medium discount' WHEN discount <= 1 THEN 'High discount' END AS discount_band,
       profit < 0 AS is_loss
FROM order_lines0
)"""

REVIEWS = """
reviews AS (
SELECT d.doc_id AS review_id, d.text AS review_text,
       CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive' WHEN l.doc_id IS NOT NULL THEN 'neutral' END AS sentiment,
       CAST(1 + d.doc_id % 5 AS INT) AS customer_rating,
       CAST(d.n_chars % 97 AS DOUBLE) AS response_time_hours,
       CASE WHEN d.doc_id % 3 = 0 THEN 'yes' ELSE 'no' END AS issue_resolved
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
),
labelled AS (SELECT * FROM reviews WHERE sentiment IS NOT NULL)"""


def lines(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([ORDER_LINES, *ctes]) + "\n" + body


def texts(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([REVIEWS, *ctes]) + "\n" + body


def r(expression: str, digits: int = 6) -> str:
    """Rounded double without a negative zero."""
    return f"(round(CAST({expression} AS DOUBLE), {digits}) + 0.0)"


def d(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def day(expression: str) -> str:
    return f"CAST(CAST({expression} AS DATE) AS VARCHAR)"


def listed(values) -> str:
    return "(" + ", ".join(str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'" for v in values) + ")"


def keyed(*columns: str) -> str:
    """Number of a natural key in hash order."""
    return f"row_number() OVER (ORDER BY md5(concat_ws('|', {', '.join(columns)})))"


FIRST = "order_id, line_number, order_date, ship_date, product_id, sales, quantity, shipping_cost"


# --- modelling ---------------------------------------------------------------------------------------------------

TIME = "time_dim AS (SELECT row_number() OVER (ORDER BY date) AS date_id, date FROM (SELECT order_date AS date FROM lines UNION SELECT ship_date FROM lines))"


def numbered(table: str, id_name: str, *columns: str) -> str:
    names = ", ".join(columns)
    return f"{table} AS (SELECT {keyed(*columns)} AS {id_name}, {names} FROM (SELECT DISTINCT {names} FROM lines))"


CUSTOMER = numbered("customer_dim", "customer_id", "customer_name", "segment")
LOCATION = numbered("location_dim", "location_id", "country", "state", "market", "region")
SHIPPING = numbered("shipping_dim", "ship_mode_id", "ship_mode", "order_priority")
STATE = numbered("state_dim", "state_id", "state", "market", "region", "country")
MODE = numbered("ship_mode_dim", "ship_mode_id", "ship_mode")
PRIORITY = numbered("order_priority_dim", "order_priority_id", "order_priority")
PRODUCT = f"""product_dim AS (SELECT product_id, product_name, category, sub_category FROM lines
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY {FIRST}) = 1)"""


def dim(cte: str, table: str, columns: str) -> str:
    return lines(f"SELECT {columns} FROM {table}", cte)


SALES_MEASURES = (
    "CAST(CAST(sales AS DECIMAL(15,2)) AS DOUBLE) AS sales, quantity, "
    "CAST(discount AS DOUBLE) AS discount, CAST(CAST(profit AS DECIMAL(15,5)) AS DOUBLE) AS profit"
)
SHIP_MEASURE = "CAST(CAST(shipping_cost AS DECIMAL(15,3)) AS DOUBLE) AS shipping_cost"
JOIN_CUSTOMER = "JOIN customer_dim USING (customer_name, segment)"
JOIN_LOCATION = "JOIN location_dim USING (country, state, market, region)"
JOIN_STATE = "JOIN state_dim USING (country, state, market, region)"

# Facts in warehouse types, before joins: what the marts sum.
FACTS = """f AS (SELECT * REPLACE (CAST(sales AS DECIMAL(15,2)) AS sales, CAST(shipping_cost AS DECIMAL(15,3)) AS shipping_cost) FROM lines),
p AS (SELECT product_id, product_name, category, sub_category FROM lines
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY """ + FIRST + """) = 1)"""
SELECTED = (
    f"f.year IN {listed(N.YEARS)} AND f.category IN {listed(N.CATEGORIES)} AND f.region IN {listed(N.REGIONS)}"
)

O: dict[str, str] = {}

LINE_SELECT = """SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, CAST(ship_date AS VARCHAR) AS ship_date, line_number,
ship_mode, customer_name, segment, state, country, market, region, product_id, category, sub_category, product_name,
CAST(sales AS DOUBLE) AS sales, quantity, CAST(discount AS DOUBLE) AS discount, CAST(profit AS DOUBLE) AS profit,
CAST(shipping_cost AS DOUBLE) AS shipping_cost, order_priority"""

O["load_order_lines"] = lines(
    f"{LINE_SELECT}, ship_days, {r('profit_margin')} AS profit_margin, discount_band, is_loss FROM lines"
)
O["derive_order_line_columns"] = lines(
    f"SELECT order_id, line_number, product_id, ship_days, {r('profit_margin')} AS profit_margin, discount_band, is_loss FROM lines"
)
O["load_reviews"] = texts(
    """SELECT review_id, trim(review_text, chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||' '
||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)
||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)) AS review_text, sentiment,
CAST(customer_rating AS DOUBLE) AS customer_rating, response_time_hours, issue_resolved FROM reviews"""
)
_SIZES = {
    "time_dim": "SELECT order_date AS a FROM lines UNION SELECT ship_date FROM lines",
    "segment_dim": "SELECT DISTINCT segment FROM lines",
    "customer_dim": "SELECT DISTINCT customer_name, segment FROM lines",
    "category_dim": "SELECT DISTINCT category FROM lines",
    "sub_category_dim": "SELECT DISTINCT sub_category, category FROM lines",
    "product_dim": "SELECT DISTINCT product_id FROM lines",
    "country_dim": "SELECT DISTINCT country FROM lines",
    "region_dim": "SELECT DISTINCT region, country FROM lines",
    "market_dim": "SELECT DISTINCT market, region, country FROM lines",
    "state_dim": "SELECT DISTINCT state, market, region, country FROM lines",
    "ship_mode_dim": "SELECT DISTINCT ship_mode FROM lines",
    "order_priority_dim": "SELECT DISTINCT order_priority FROM lines",
    "fact_sales": "SELECT * FROM lines",
    "fact_shipping": "SELECT * FROM lines",
}
O["read_marts"] = lines(
    "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM ({q})" for t, q in _SIZES.items())
)
_STAR_SIZES = {
    "time_dim": _SIZES["time_dim"],
    "customer_dim": _SIZES["customer_dim"],
    "product_dim": _SIZES["product_dim"],
    "location_dim": _SIZES["state_dim"],
    "shipping_dim": "SELECT DISTINCT ship_mode, order_priority FROM lines",
}
O["write_warehouse"] = lines(
    "\nUNION ALL ".join(
        f"SELECT '{s}' AS schema_name, '{t}' AS table_name, count(*) AS row_count FROM ({q})"
        for s, facts in (("star", ["fact_table"]), ("galaxy", ["fact_sales", "fact_shipping"]))
        for t, q in {**_STAR_SIZES, **{f: "SELECT * FROM lines" for f in facts}}.items()
    )
)
O["load_batches"] = lines(
    "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM ({q})"
        for t, q in {**_STAR_SIZES, **{f: "SELECT * FROM lines" for f in ("fact_sales", "fact_shipping")}}.items()
    )
)
O["load_batches_sales"] = lines(
    """SELECT region, segment, CAST(sum(CAST(sales AS DECIMAL(15,2))) AS DOUBLE) AS total_sales, count(*) AS sold_lines
FROM lines GROUP BY region, segment"""
)
_REGION = "SELECT region, CAST(sum(sales) AS DOUBLE) AS total_sales, CAST(sum(profit) AS DOUBLE) AS total_profit FROM lines GROUP BY region"
for _name in ("region_totals", "write_result", "write_result_csv"):
    O[_name] = lines(_REGION)

O["dim_time"] = lines("SELECT date_id, CAST(date AS VARCHAR) AS date FROM time_dim", TIME)
O["dim_customer"] = dim(CUSTOMER, "customer_dim", "*")
O["dim_product"] = dim(PRODUCT, "product_dim", "*")
O["dim_location"] = dim(LOCATION, "location_dim", "*")
O["dim_shipping"] = dim(SHIPPING, "shipping_dim", "*")
O |= {f"galaxy_{kind}": O[f"dim_{kind}"] for kind in N.STAR_DIMENSIONS}  # the galaxy shares the star's dimensions
O["snow_segment"] = dim(numbered("t", "segment_id", "segment"), "t", "*")
O["snow_customer"] = dim(CUSTOMER, "customer_dim", "*")
O["snow_category"] = dim(numbered("t", "category_id", "category"), "t", "*")
O["snow_sub_category"] = dim(numbered("t", "sub_category_id", "sub_category", "category"), "t", "*")
O["snow_product"] = dim(PRODUCT, "product_dim", "product_id, product_name, sub_category, category")
O["snow_country"] = dim(numbered("t", "country_id", "country"), "t", "*")
O["snow_region"] = dim(numbered("t", "region_id", "region", "country"), "t", "*")
O["snow_market"] = dim(numbered("t", "market_id", "market", "region", "country"), "t", "*")
O["snow_state"] = dim(STATE, "state_dim", "*")
O["snow_ship_mode"] = dim(MODE, "ship_mode_dim", "*")
O["snow_order_priority"] = dim(PRIORITY, "order_priority_dim", "*")
O["surrogate_key"] = dim(numbered("t", "name_id", "product_name", "category"), "t", "*")
O["insert_new_only"] = lines(
    f"""SELECT customer_id, customer_name, segment FROM old UNION ALL
SELECT (SELECT max(customer_id) FROM old) + {keyed("customer_name", "segment")}, customer_name, segment
FROM (SELECT DISTINCT customer_name, segment FROM lines EXCEPT SELECT customer_name, segment FROM old)""",
    f"""old AS (SELECT {keyed("customer_name", "segment")} AS customer_id, customer_name, segment
FROM (SELECT DISTINCT customer_name, segment FROM lines WHERE year < {N.SEEN_BEFORE}))""",
)
O["union_distinct_dates"] = lines(
    "SELECT CAST(date AS VARCHAR) AS date FROM (SELECT order_date AS date FROM lines UNION SELECT ship_date FROM lines)"
)
O["fact_star"] = lines(
    f"""SELECT date_id, customer_id, location_id, ship_mode_id, product_id, {SALES_MEASURES}, {SHIP_MEASURE}, year
FROM lines JOIN time_dim ON order_date = date {JOIN_CUSTOMER} {JOIN_LOCATION} JOIN shipping_dim USING (ship_mode, order_priority)""",
    TIME, CUSTOMER, LOCATION, SHIPPING,
)
O["fact_sales_galaxy"] = lines(
    f"""SELECT date_id, customer_id, location_id, product_id, {SALES_MEASURES}, year
FROM lines JOIN time_dim ON order_date = date {JOIN_CUSTOMER} {JOIN_LOCATION}""",
    TIME, CUSTOMER, LOCATION,
)
O["fact_shipping_galaxy"] = lines(
    f"""SELECT date_id, location_id, ship_mode_id, product_id, {SHIP_MEASURE}, CAST(year(date) AS INT) AS year
FROM lines JOIN time_dim ON coalesce(ship_date, order_date) = date {JOIN_LOCATION}
JOIN shipping_dim USING (ship_mode, order_priority)""",
    TIME, LOCATION, SHIPPING,
)
O["fact_sales_snow"] = lines(
    f"""SELECT date_id AS order_date_id, customer_id, state_id, product_id, {SALES_MEASURES}, year
FROM lines JOIN time_dim ON order_date = date {JOIN_CUSTOMER} {JOIN_STATE}""",
    TIME, CUSTOMER, STATE,
)
O["fact_shipping_snow"] = lines(
    f"""SELECT date_id AS ship_date_id, state_id, ship_mode_id, order_priority_id, product_id, {SHIP_MEASURE},
CAST(year(date) AS INT) AS year
FROM lines JOIN time_dim ON coalesce(ship_date, order_date) = date {JOIN_STATE}
JOIN ship_mode_dim USING (ship_mode) JOIN order_priority_dim USING (order_priority)""",
    TIME, STATE, MODE, PRIORITY,
)
O["flat_sales"] = lines(
    """SELECT CAST(f.order_date AS VARCHAR) AS order_date, f.customer_name, f.segment, f.product_id, p.product_name, p.sub_category,
p.category, f.state, f.market, f.region, f.country, CAST(f.sales AS DOUBLE) AS sales, f.quantity,
CAST(f.discount AS DOUBLE) AS discount, CAST(f.profit AS DOUBLE) AS profit FROM f JOIN p USING (product_id)""",
    FACTS,
)
O["flat_shipping"] = lines(
    """SELECT CAST(f.ship_date AS VARCHAR) AS ship_date, f.product_id, p.product_name, p.sub_category, p.category, f.state, f.market,
f.region, f.country, f.ship_mode, f.order_priority, CAST(f.shipping_cost AS DOUBLE) AS shipping_cost
FROM f JOIN p USING (product_id)""",
    FACTS,
)
O["check_unique"] = lines(
    "SELECT order_id, line_number, count(*) AS copies FROM lines GROUP BY ALL HAVING count(*) > 1"
)
O["check_foreign_key"] = lines(
    f"""SELECT customer_name, product_id, count(*) AS orphan_rows FROM lines l WHERE NOT EXISTS
(SELECT 1 FROM lines k WHERE k.year < {N.SEEN_BEFORE} AND k.customer_name = l.customer_name AND k.product_id = l.product_id)
GROUP BY ALL"""
)
_RULES = {"customer_name": 255, "segment": 8, "product_name": 12, "order_date": None, "discount_band": None, "state": 9}
O["check_not_null_len"] = lines(
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing, "
        + (f"count(*) FILTER (length({c}) > {n})" if n else "CAST(0 AS BIGINT)")
        + " AS too_long FROM lines"
        for c, n in _RULES.items()
    )
)

# --- OLAP --------------------------------------------------------------------------------------------------------

O["olap_slice"] = lines(
    f"""SELECT f.year, f.segment, CAST(sum(f.sales) AS DOUBLE) AS total_sales FROM f
WHERE f.segment = '{N.SEGMENT}' AND f.year = {N.YEAR} GROUP BY ALL""",
    FACTS,
)
O["olap_dice"] = lines(
    f"""SELECT f.category, f.country, CAST(sum(f.sales) AS DOUBLE) AS total_sales FROM f
WHERE f.category = '{N.CATEGORY}' AND f.country = '{N.COUNTRY}' GROUP BY ALL""",
    FACTS,
)
O["olap_pivot"] = lines(
    "SELECT region, "
    + ", ".join(
        f"CAST(sum(CASE WHEN ship_mode = '{m}' THEN shipping_cost ELSE 0 END) AS DOUBLE) AS {m.lower().replace(' ', '_')}"
        for m in N.SHIP_MODES
    )
    + " FROM f GROUP BY region",
    FACTS,
)
O["olap_drill_down"] = lines(
    """SELECT category, sub_category, CAST(sum(sales) AS DOUBLE) AS total_sales FROM f GROUP BY ALL
ORDER BY category, total_sales DESC, sub_category LIMIT 10""",
    FACTS,
)
O["olap_roll_up"] = lines(
    "SELECT country, CAST(sum(sales) AS DOUBLE) AS total_sales FROM f GROUP BY ALL ORDER BY total_sales DESC, country LIMIT 10",
    FACTS,
)
O["rollup_groupings"] = lines(
    "\nUNION ALL ".join(
        f"""SELECT '{name}' AS grouping_name, count(*) AS cells, CAST(sum(n) AS BIGINT) AS lines, CAST(sum(s) AS DOUBLE) AS total_sales
FROM (SELECT count(*) AS n, sum(sales) AS s FROM f GROUP BY {", ".join(grouping.columns)})"""
        for name, grouping in ROLLUPS.items()
    ),
    FACTS,
)
O["rollup_answer"] = lines(
    f"""SELECT region, segment, count(*) AS lines, {d("sum(sales)")} AS total_sales, {r("CAST(sum(profit) AS DOUBLE) / count(profit)")} AS mean_profit,
{d("min(sales)")} AS least_sale, {d("max(sales)")} AS largest_sale, CAST(sum(quantity) AS BIGINT) AS total_quantity
FROM f WHERE year IN {listed(N.YEARS)} GROUP BY ALL""",
    FACTS,
)
O["rollup_quantiles"] = lines(
    f"""SELECT category, count(sales) AS lines, CAST(share AS DOUBLE) AS share, TRUE AS within
FROM f, (SELECT unnest([{", ".join(map(str, N.SHARES))}]) AS share) GROUP BY ALL""",
    FACTS,
)
O["olap_drill_across"] = lines(
    """SELECT state, CAST(sum(a.sales) AS DOUBLE) AS total_sales, CAST(sum(b.shipping_cost) AS DOUBLE) AS total_shipping
FROM f a JOIN f b USING (state, market, region, country, product_id) GROUP BY state ORDER BY total_sales DESC, state LIMIT 10""",
    FACTS,
)
O["olap_drill_across_safe"] = lines(
    """SELECT state, CAST(sum(sales) AS DOUBLE) AS total_sales, CAST(sum(shipping_cost) AS DOUBLE) AS total_shipping
FROM f GROUP BY state ORDER BY total_sales DESC, state LIMIT 10""",
    FACTS,
)
O["olap_drill_through"] = lines(
    f"""SELECT customer_name, segment, product_id, CAST(sales AS DOUBLE) AS sales, CAST(profit AS DOUBLE) AS profit
FROM f WHERE sales > {N.LARGE_SALE} ORDER BY f.sales DESC, customer_name, product_id, f.profit LIMIT 10""",
    FACTS,
)
O["filter_in_lists"] = lines(
    f"""SELECT year, category, region, product_id, CAST(sales AS DOUBLE) AS sales, CAST(profit AS DOUBLE) AS profit
FROM f WHERE {SELECTED}""",
    FACTS,
)
O["filter_options"] = lines(
    """SELECT DISTINCT 'year' AS filter, CAST(year(date) AS VARCHAR) AS option FROM time_dim
UNION ALL SELECT DISTINCT 'category', category FROM lines
UNION ALL SELECT DISTINCT 'region', region FROM lines
UNION ALL SELECT * FROM (SELECT DISTINCT 'sample_country', country FROM lines ORDER BY country LIMIT 5)""",
    TIME,
)


def _kpi(source: str, where: str, extra: str) -> str:
    margin = "round(100 * CAST(sum(profit) AS DOUBLE) / CAST(sum(sales) AS DOUBLE), 2)"
    return f"""SELECT *, round(margin_pct - 15, 2) + 0.0 AS margin_vs_target,
CASE WHEN margin_pct < -10 THEN 'below range' WHEN margin_pct < 0 THEN '-10 to 0' WHEN margin_pct < 10 THEN '0 to 10'
     WHEN margin_pct < 20 THEN '10 to 20' WHEN margin_pct <= 40 THEN '20 to 40' ELSE 'above range' END AS margin_band
FROM (SELECT CAST(sum(sales) AS DOUBLE) AS total_sales, CAST(sum(profit) AS DOUBLE) AS total_profit,
CAST(sum(quantity) AS BIGINT) AS total_quantity, {r("avg(CAST(discount AS DOUBLE))")} AS avg_discount,
count(*) AS total_lines, {extra} {margin} + 0.0 AS margin_pct FROM {source} f {where})"""


O["kpi_summary"] = lines(_kpi("f", "", ""), FACTS)
O["kpi_summary_filtered"] = lines(_kpi("f", f"WHERE {SELECTED}", ""), FACTS)
O["kpi_summary_orders"] = lines(_kpi("lines", "", "count(DISTINCT order_id) AS total_orders,"))
O["monthly_category_sales"] = lines(
    f"""SELECT CAST(month AS VARCHAR) AS month, category, CAST(s AS DOUBLE) AS total_sales,
{r("(SELECT avg(CAST(m AS DOUBLE)) FROM (SELECT sum(s) AS m FROM t GROUP BY month))")} AS mean_month_sales FROM t""",
    FACTS,
    f"t AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, category, sum(sales) AS s FROM f GROUP BY ALL)",
)
_METRICS = f"""m AS (SELECT a.*, b.total_shipping FROM
(SELECT region, sum(sales) AS total_sales, sum(profit) AS total_profit, avg(CAST(discount AS DOUBLE)) AS avg_discount,
CAST(sum(quantity) AS BIGINT) AS total_quantity FROM f GROUP BY region) a
JOIN (SELECT region, sum(shipping_cost) AS total_shipping FROM f GROUP BY region) b USING (region))"""
O["join_cte_metrics"] = lines(
    f"""SELECT region, {d("total_sales")} AS total_sales, {d("total_profit")} AS total_profit, {r("avg_discount")} AS avg_discount,
total_quantity, {d("total_shipping")} AS total_shipping FROM m""",
    FACTS,
    _METRICS,
)


def _pearson(a: str, b: str) -> str:
    x, y = d(a), d(b)
    return r(f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)")


O["metric_correlation"] = lines(
    "\nUNION ALL ".join(
        f"SELECT '{a}' AS metric, " + ", ".join(f"{_pearson(a, b)} AS {b}" for b in N.METRICS) + " FROM m" for a in N.METRICS
    ),
    FACTS,
    _METRICS,
)
O["region_segment_bubble"] = lines(
    f"""SELECT region, segment, {d("sum(sales)")} AS total_sales, {d("sum(profit)")} AS total_profit,
CAST(sum(quantity) AS BIGINT) AS total_quantity FROM f GROUP BY ALL""",
    FACTS,
)
O["yearly_category_sales"] = lines(
    f"SELECT year, category, {d('sum(sales)')} AS total_sales FROM f GROUP BY ALL", FACTS
)
O["shipping_mode_priority"] = lines(
    f"""SELECT ship_mode, order_priority, {d("sum(shipping_cost)")} AS total_shipping_cost FROM f
GROUP BY ALL ORDER BY total_shipping_cost DESC, ship_mode, order_priority""",
    FACTS,
)
O["product_hierarchy"] = lines(
    f"""SELECT p.category, p.sub_category, p.product_name, {d("sum(f.sales)")} AS total_sales,
CAST(3 - bit_count(GROUPING_ID(p.category, p.sub_category, p.product_name)) AS INT) AS depth
FROM f JOIN p USING (product_id) GROUP BY ROLLUP (p.category, p.sub_category, p.product_name)
HAVING bit_count(GROUPING_ID(p.category, p.sub_category, p.product_name)) < 3""",
    FACTS,
)
O["country_sales"] = lines(
    f"SELECT country, {d('sum(sales)')} AS total_sales FROM f GROUP BY ALL ORDER BY total_sales DESC, country", FACTS
)

# --- preparation -------------------------------------------------------------------------------------------------

_ID = "order_id, line_number, product_id"
O["impute_median"] = lines(
    f"SELECT {_ID}, {r('coalesce(v, (SELECT quantile_cont(v, 0.5) FROM g))')} AS profit FROM g",
    f"g AS (SELECT {_ID}, CASE WHEN NOT (quantity % 2 = 1 AND discount > 0.8) THEN CAST(profit AS DOUBLE) END AS v FROM lines)",
)
O["smooth_by_bin_mean"] = lines(
    f"""SELECT {_ID}, CAST(sales AS DOUBLE) AS sales, sales_bin,
{r("CAST(sum(sales) OVER (PARTITION BY sales_bin) AS DOUBLE) / count(*) OVER (PARTITION BY sales_bin)", 4)} AS sales_smoothed FROM b""",
    "q AS (SELECT quantile_cont(CAST(sales AS DOUBLE), [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM lines)",
    f"b AS (SELECT {_ID}, sales, CAST(len(list_filter(e, lambda x: x < CAST(sales AS DOUBLE))) AS INT) AS sales_bin FROM lines, q)",
)
_LINE = "k AS (SELECT regr_slope(CAST(profit AS DOUBLE), CAST(sales AS DOUBLE)) AS s, regr_intercept(CAST(profit AS DOUBLE), CAST(sales AS DOUBLE)) AS i FROM lines)"
O["smooth_by_regression"] = lines(f"SELECT {_ID}, {r('s * CAST(sales AS DOUBLE) + i', 4)} AS profit_fitted FROM lines, k", _LINE)
O["regression_metrics"] = lines(
    f"""SELECT unnest(['test_orders', 'rmse_profit', 'mae_profit', 'r2', 'profitability_accuracy']) AS metric,
unnest([{r("count(*)", 4)}, {r("sqrt(avg((y - p) * (y - p)))", 4)}, {r("avg(abs(y - p))", 4)},
{r("1 - avg((y - p) * (y - p)) / var_pop(y)", 4)}, {r("avg(CASE WHEN (y > 0) = (p > 0) THEN 1.0 ELSE 0.0 END)", 4)}]) AS value FROM v""",
    _LINE,
    "v AS (SELECT CAST(profit AS DOUBLE) AS y, s * CAST(sales AS DOUBLE) + i AS p FROM lines, k)",
)
_SCALE = "(CAST({c} AS DOUBLE) - lo_{c}) / (hi_{c} - lo_{c})"
O["min_max_scale"] = lines(
    f"SELECT {_ID}, {r(_SCALE.format(c='sales'))} AS sales_scaled, {r(_SCALE.format(c='profit'))} AS profit_scaled FROM lines, e",
    """e AS (SELECT CAST(min(sales) AS DOUBLE) AS lo_sales, CAST(max(sales) AS DOUBLE) AS hi_sales,
CAST(min(profit) AS DOUBLE) AS lo_profit, CAST(max(profit) AS DOUBLE) AS hi_profit FROM lines)""",
)
O["discretise"] = lines(
    f"""SELECT {_ID}, quantity, CASE WHEN quantity <= 0 THEN NULL WHEN quantity <= 5 THEN 'Low' WHEN quantity <= 10 THEN 'Medium'
WHEN quantity <= 100 THEN 'High' END AS quantity_group FROM lines"""
)
O["zscore"] = lines(
    f"SELECT {_ID}, "
    + ", ".join(
        r(f"(CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) / stddev_pop(CAST({c} AS DOUBLE)) OVER ()") + f" AS {c}"
        for c in ("sales", "quantity", "discount")
    )
    + " FROM lines"
)
O["signed_log"] = lines(
    f"SELECT {_ID}, CAST(sales AS DOUBLE) AS sales, CAST(profit AS DOUBLE) AS profit, "
    + ", ".join(r(f"sign({c}) * ln(1 + abs(CAST({c} AS DOUBLE)))") + f" AS {c}_log" for c in ("sales", "profit"))
    + " FROM lines"
)


def _dummies(column: str, levels: list[str]) -> str:
    return ", ".join(f"CASE WHEN {column} = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"{column}_{v}\"" for v in levels)


O["one_hot_drop_first"] = lines(
    f"SELECT {_ID}, {_dummies('ship_mode', ['Same Day', 'Second Class', 'Standard Class'])}, "
    f"{_dummies('segment', ['BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'])} FROM lines"
)
O["label_encode"] = texts(
    "SELECT review_id, sentiment, CASE sentiment WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 ELSE 2 END AS code FROM labelled"
)
O["hash_sample"] = lines(
    f"""{LINE_SELECT} FROM (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', {FIRST}))) AS k, count(*) OVER () AS n FROM lines)
WHERE k <= round(n * 0.05)"""
)
O["chronological_split"] = lines(
    """SELECT order_id, CAST(order_date AS VARCHAR) AS order_date,
row_number() OVER (ORDER BY order_date, md5(order_id)) <= floor(count(*) OVER () * 0.8) AS is_train
FROM (SELECT order_id, min(order_date) AS order_date FROM lines GROUP BY order_id)"""
)
O["stratified_split"] = texts(
    """SELECT review_id, sentiment, row_number() OVER (PARTITION BY sentiment ORDER BY md5(CAST(review_id AS VARCHAR)))
<= round(count(*) OVER (PARTITION BY sentiment) * 0.2) AS is_test FROM labelled"""
)

O["sentiment_by_order_support"] = texts(
    """SELECT sentiment, round(count(*) * 0.2)::BIGINT AS reviews, round(count(*) * 0.2)::BIGINT AS scored FROM labelled GROUP BY sentiment"""
)

# --- mining ------------------------------------------------------------------------------------------------------

_FIRSTS = ", ".join(
    f"arg_min({c}, (order_id, line_number, order_date, ship_date, product_id, sales, quantity, shipping_cost)) AS {c}"
    for c in ("ship_mode", "segment", "market", "region", "country", "order_priority")
)
O["order_level"] = lines(
    f"""SELECT order_id, CAST(min(order_date) AS VARCHAR) AS order_date, max(ship_days) AS ship_days, {d("sum(sales)")} AS sales,
CAST(sum(quantity) AS BIGINT) AS quantity, {r("avg(CAST(discount AS DOUBLE))")} AS discount, {d("sum(profit)")} AS profit,
{d("sum(shipping_cost)")} AS shipping_cost, {_FIRSTS},
count(DISTINCT product_id) AS unique_products, count(DISTINCT sub_category) AS unique_sub_categories,
count(*) FILTER (category = 'Furniture') AS "Furniture", count(*) FILTER (category = 'Office Supplies') AS "Office Supplies",
count(*) FILTER (category = 'Technology') AS "Technology",
{r("CASE WHEN sum(sales) > 0 THEN CAST(sum(profit) AS DOUBLE) / CAST(sum(sales) AS DOUBLE) ELSE 0 END")} AS profit_margin,
CASE WHEN sum(profit) > 0 THEN 1 ELSE 0 END AS profitable FROM lines GROUP BY order_id"""
)
_TRAIN = f"""o AS (SELECT order_id, min(order_date) AS order_date, max(ship_days) AS ship_days, sum(sales) AS sales,
sum(quantity) AS quantity, avg(CAST(discount AS DOUBLE)) AS discount, sum(profit) AS profit, sum(shipping_cost) AS shipping_cost,
{_FIRSTS}, count(DISTINCT product_id) AS unique_products, count(DISTINCT sub_category) AS unique_sub_categories,
count(*) FILTER (category = 'Furniture') AS "Furniture", count(*) FILTER (category = 'Office Supplies') AS "Office Supplies",
count(*) FILTER (category = 'Technology') AS "Technology" FROM lines GROUP BY order_id),
t AS (SELECT *, CAST(profit AS DOUBLE) AS y FROM o QUALIFY row_number() OVER (ORDER BY order_date, md5(order_id)) <= floor(count(*) OVER () * 0.8))"""
_EQUATIONS = " UNION ALL ".join(
    [f"SELECT '{c}' AS feature, CAST(\"{c}\" AS DOUBLE) AS x, y FROM t" for c in NUMERIC_FEATURES]
    + [f"SELECT '{c}_' || {c}, 1.0, y FROM t WHERE {c} > (SELECT min({c}) FROM o)" for c in CATEGORICAL_FEATURES]
    + ["SELECT 'intercept', 1.0, y FROM t"]
)
O["profit_regression_equations"] = lines(
    f"SELECT feature, {r('sum(x * y) / sqrt(sum(x * x) * (SELECT sum(y * y) FROM t))')} AS cosine FROM ({_EQUATIONS}) GROUP BY feature",
    _TRAIN,
)
O["first_per_key"] = lines(
    f"""SELECT customer_name, product_name, ship_mode, CAST(sales AS DOUBLE) AS sales FROM lines
QUALIFY row_number() OVER (PARTITION BY customer_name ORDER BY {FIRST}) = 1"""
)


def _baskets(item: str) -> str:
    return f"""b AS (SELECT order_id, item, basket_size FROM (SELECT *, count(*) OVER (PARTITION BY order_id) AS basket_size
FROM (SELECT DISTINCT order_id, {item} AS item FROM lines)) WHERE basket_size >= 2),
n AS (SELECT count(DISTINCT order_id) AS n FROM b),
s AS (SELECT item, count(*) AS c FROM b GROUP BY item)"""


def _least(support: float) -> str:
    return f"(SELECT greatest(2, CAST(floor(n * {support}) AS BIGINT)) FROM n)"


def _pairs(support: float) -> str:
    return f"""pairs AS (SELECT item_a, item_b, orders_together, {r("orders_together / n")} AS support,
{r("orders_together / a.c")} AS confidence_a_to_b, {r("orders_together / z.c")} AS confidence_b_to_a,
{r("orders_together * n / (a.c * z.c)")} AS lift
FROM (SELECT x.item AS item_a, y.item AS item_b, count(*) AS orders_together FROM b x JOIN b y ON x.order_id = y.order_id AND x.item < y.item
GROUP BY ALL HAVING count(*) >= {_least(support)}) JOIN s a ON a.item = item_a JOIN s z ON z.item = item_b, n)"""


def _triples(support: float) -> str:
    return f"""SELECT x.item AS item_1, y.item AS item_2, z.item AS item_3, count(*) AS orders_together,
{r("count(*) / (SELECT n FROM n)")} AS support
FROM b x JOIN b y ON x.order_id = y.order_id AND x.item < y.item JOIN b z ON y.order_id = z.order_id AND y.item < z.item
GROUP BY ALL HAVING count(*) >= {_least(support)}"""


O["baskets"] = lines("SELECT * FROM b", _baskets("sub_category"))
O["frequent_pairs"] = lines("SELECT * FROM pairs", _baskets("product_name"), _pairs(N.NAME_SUPPORT))
O["frequent_pairs_sub_category"] = lines("SELECT * FROM pairs", _baskets("sub_category"), _pairs(N.KIND_SUPPORT))
O["frequent_triples"] = lines(_triples(N.NAME_SUPPORT), _baskets("product_name"))
O["frequent_triples_sub_category"] = lines(_triples(N.KIND_SUPPORT), _baskets("sub_category"))
O["top_n"] = lines(
    "SELECT * FROM pairs ORDER BY orders_together DESC, item_a, item_b LIMIT 100", _baskets("sub_category"), _pairs(N.KIND_SUPPORT)
)
O["min_support_filter"] = lines(f"SELECT item, c AS item_orders FROM s WHERE c >= {_least(0.002)}", _baskets("product_name"))


def _decide(rate: str, base: str) -> dict[str, str]:
    review = f"{rate} > {base} * 1.35"
    return {
        "then_decision": f"CASE WHEN {review} THEN 'Review pricing/discounts' ELSE 'Good candidate to promote' END",
        "confidence": r(f"CASE WHEN {review} THEN {rate} ELSE 1 - {rate} END"),
        "lift": r(f"CASE WHEN {review} THEN {rate} / {base} ELSE (1 - {rate}) / (1 - {base}) END"),
    }


_RULE = _decide("loss_rate", "(SELECT avg(CASE WHEN is_loss THEN 1.0 ELSE 0.0 END) FROM lines)")
_SETS = [
    ["category"], ["sub_category"], ["market"], ["region"], ["discount_band"], ["category", "discount_band"],
    ["sub_category", "discount_band"], ["market", "category"], ["ship_mode", "order_priority"],
]
O["decision_rules"] = lines(
    f"""SELECT if_condition, {_RULE["then_decision"]} AS then_decision, rows AS support_rows,
{r("rows / (SELECT count(*) FROM lines)")} AS support_pct, {_RULE["confidence"]} AS confidence, {_RULE["lift"]} AS lift_vs_baseline,
{d("sales")} AS sales, {d("profit")} AS profit, {r("avg_discount")} AS avg_discount, {r("avg_margin")} AS avg_margin FROM g""",
    "g AS ("
    + "\nUNION ALL ".join(
        "SELECT "
        + " || ' AND ' || ".join(f"'{c} = ' || {c}" for c in dims)
        + """ AS if_condition, count(*) AS rows, sum(sales) AS sales, sum(profit) AS profit,
avg(CASE WHEN is_loss THEN 1.0 ELSE 0.0 END) AS loss_rate, avg(CAST(discount AS DOUBLE)) AS avg_discount, avg(profit_margin) AS avg_margin
FROM lines WHERE """
        + " AND ".join(f"{c} IS NOT NULL" for c in dims)
        + f" GROUP BY {', '.join(dims)} HAVING count(*) >= 50"
        for dims in _SETS
    )
    + ")",
)
_RATE = _decide("loss_rate", "baseline")
O["rule_decision"] = lines(
    f"""SELECT product_id, {r("loss_rate")} AS loss_rate, {r("baseline")} AS baseline, {_RATE["then_decision"]} AS then_decision,
{_RATE["confidence"]} AS confidence, {_RATE["lift"]} AS lift FROM
(SELECT product_id, avg(CASE WHEN is_loss THEN 1.0 ELSE 0.0 END) AS loss_rate,
(SELECT avg(CASE WHEN is_loss THEN 1.0 ELSE 0.0 END) FROM lines) AS baseline FROM lines GROUP BY product_id)"""
)
_STATES = """q AS (SELECT customer_name, order_id, order_date, array_to_string(list_sort(list(DISTINCT sub_category))[1:3], ' + ') AS state
FROM lines GROUP BY customer_name, order_id, order_date),
steps AS (SELECT customer_name, order_date, order_id, state AS step_1, lead(state, 1) OVER w AS step_2, lead(state, 2) OVER w AS step_3
FROM q WINDOW w AS (PARTITION BY customer_name ORDER BY order_date, order_id))"""
O["order_sequences"] = lines("SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date) FROM q", _STATES)
O["next_step"] = lines("SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date) FROM steps", _STATES)
O["transitions"] = lines(
    f"""SELECT "from", "to", times_seen, {r('times_seen / sum(times_seen) OVER (PARTITION BY "from")')} AS probability_next FROM
(SELECT step_1 AS "from", step_2 AS "to", count(*) AS times_seen FROM steps WHERE step_2 IS NOT NULL GROUP BY ALL)""",
    _STATES,
)
O["three_step_patterns"] = lines(
    "SELECT step_1, step_2, step_3, count(*) AS times_seen FROM steps WHERE step_3 IS NOT NULL GROUP BY ALL", _STATES
)
O["transition_probability"] = lines(
    f"""SELECT category, ship_mode, n AS times_seen, {r("n / sum(n) OVER (PARTITION BY category)")} AS probability_next
FROM (SELECT category, ship_mode, count(*) AS n FROM lines GROUP BY ALL)"""
)
_RFM = """rfm AS (SELECT customer_name, max(order_date) AS last_order, min(order_date) AS first_order, count(DISTINCT order_id) AS orders,
sum(sales) AS sales, sum(profit) AS profit, CAST(sum(quantity) AS BIGINT) AS quantity,
CAST(sum(discount) AS DOUBLE) / count(discount) AS avg_discount, count(DISTINCT market) AS markets, count(DISTINCT category) AS categories,
date_diff('day', max(order_date), (SELECT max(order_date) FROM lines)) AS recency_days,
CASE WHEN sum(sales) > 0 THEN CAST(sum(profit) AS DOUBLE) / CAST(sum(sales) AS DOUBLE) ELSE 0 END AS profit_margin,
CAST(sum(sales) AS DOUBLE) / count(DISTINCT order_id) AS avg_order_value FROM lines GROUP BY customer_name),
cs AS (SELECT CAST(orders % 4 AS INT) AS cluster, count(*) AS customers, avg(recency_days) AS avg_recency_days, avg(orders) AS avg_orders,
sum(sales) AS total_sales, sum(profit) AS total_profit, avg(profit_margin) AS avg_profit_margin, avg(avg_discount) AS avg_discount,
avg(avg_order_value) AS avg_order_value FROM rfm GROUP BY ALL)"""
O["customer_rfm"] = lines(
    f"""SELECT customer_name, CAST(last_order AS VARCHAR) AS last_order, CAST(first_order AS VARCHAR) AS first_order, orders,
{d("sales")} AS sales, {d("profit")} AS profit, quantity, {r("avg_discount", 8)} AS avg_discount, markets, categories, recency_days,
{r("profit_margin", 8)} AS profit_margin, {r("avg_order_value", 8)} AS avg_order_value FROM rfm""",
    _RFM,
)
O["cluster_summary"] = lines(
    f"""SELECT cluster, customers, {r("avg_recency_days", 4)} AS avg_recency_days, {r("avg_orders", 4)} AS avg_orders,
{d("total_sales")} AS total_sales, {d("total_profit")} AS total_profit, {r("avg_profit_margin", 4)} AS avg_profit_margin,
{r("avg_discount", 4)} AS avg_discount, {r("avg_order_value", 4)} AS avg_order_value FROM cs""",
    _RFM,
)
O["cluster_label"] = lines(
    """SELECT customer_name, cluster, CASE WHEN avg_profit_margin < 0 THEN 'Loss-making / discount-sensitive customers'
WHEN avg_orders >= 8 AND avg_recency_days <= 180 THEN 'Loyal active high-frequency customers'
WHEN cs.avg_order_value >= 800 THEN 'High-value occasional customers'
ELSE 'Standard customers with growth potential' END AS business_label FROM rfm JOIN cs ON cs.cluster = rfm.orders % 4""",
    _RFM,
)

# --- series ------------------------------------------------------------------------------------------------------


def _series(*keys: str) -> str:
    names = "".join(f"{k}, " for k in keys)
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    using = ", ".join([*keys, "month"])
    on = " AND ".join(f"m.{k} = e.{k}" for k in keys) or "true"
    return f"""m0 AS (SELECT {names}CAST(date_trunc('month', order_date) AS DATE) AS month, sum(sales) AS sales, sum(profit) AS profit,
count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS quantity, avg(CAST(discount AS DOUBLE)) AS avg_discount
FROM lines GROUP BY ALL),
spine AS (SELECT {names}CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM m0
{"GROUP BY " + ", ".join(keys) if keys else ""}),
m AS (SELECT {names}month, coalesce(sales, 0) AS sales, coalesce(profit, 0) AS profit, coalesce(orders, 0) AS orders,
coalesce(quantity, 0) AS quantity, avg_discount, row_number() OVER ({part}ORDER BY month) AS i FROM spine LEFT JOIN m0 USING ({using})),
e AS (SELECT {names}month, i, CAST(sales AS DOUBLE) AS y, CAST(sales AS DOUBLE) AS fit FROM m WHERE i = 1
UNION ALL SELECT {"".join(f"m.{k}, " for k in keys)}m.month, m.i, CAST(m.sales AS DOUBLE), 0.35 * e.y + 0.65 * e.fit
FROM e JOIN m ON m.i = e.i + 1 AND {on}),
season AS (SELECT {names}month(month) AS calendar_month, avg(CAST(sales AS DOUBLE)) AS avg_sales, avg(CAST(profit AS DOUBLE)) AS avg_profit,
avg(CAST(orders AS DOUBLE)) AS avg_orders FROM m GROUP BY ALL),
season_i AS (SELECT *, avg_sales / avg(avg_sales) OVER ({part}) AS seasonality_index FROM season),
trend AS (SELECT {names}regr_slope(CAST(sales AS DOUBLE), i - 1) AS slope, regr_intercept(CAST(sales AS DOUBLE), i - 1) AS intercept,
count(*) AS months, max(month) AS last_month FROM m {"GROUP BY " + ", ".join(keys) if keys else ""}),
fc AS (SELECT {"".join(f"t.{k}, " for k in keys)}CAST(last_month + to_months(CAST(h AS INT)) AS DATE) AS forecast_month,
0.55 * (slope * (months + h - 1) + intercept) * seasonality_index + 0.45 * e.fit AS forecast_sales
FROM trend t CROSS JOIN (SELECT unnest(range(1, 7)) AS h) hh
JOIN e ON e.i = t.months {"".join(f"AND e.{k} = t.{k} " for k in keys)}
LEFT JOIN season_i s ON s.calendar_month = month(CAST(last_month + to_months(CAST(h AS INT)) AS DATE))
{"".join(f"AND s.{k} = t.{k} " for k in keys)})"""


def series(body: str, *keys: str) -> str:
    return "WITH RECURSIVE " + ORDER_LINES + ",\n" + _series(*keys) + "\n" + body


O["monthly_rollup"] = series(
    f"""SELECT CAST(month AS VARCHAR) AS month, {d("sales")} AS sales, {d("profit")} AS profit, orders, quantity,
{r("avg_discount")} AS avg_discount, {r("CASE WHEN sales > 0 THEN CAST(profit AS DOUBLE) / CAST(sales AS DOUBLE) ELSE 0 END")} AS profit_margin FROM m"""
)
_GROWTH = "CAST({c} AS DOUBLE) / nullif(lag(CAST({c} AS DOUBLE)) OVER (ORDER BY month), 0) - 1"
O["mom_growth"] = series(
    f"""SELECT CAST(month AS VARCHAR) AS month, {r(_GROWTH.format(c="sales"))} AS sales_mom_growth,
{r(_GROWTH.format(c="profit"))} AS profit_mom_growth FROM m"""
)
_MOVING = "CASE WHEN i >= 3 THEN avg(CAST({c} AS DOUBLE)) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) END"
O["moving_avg_3"] = series(
    f"""SELECT CAST(month AS VARCHAR) AS month, {r(_MOVING.format(c="sales"), 4)} AS sales_3m_moving_avg,
{r(_MOVING.format(c="profit"), 4)} AS profit_3m_moving_avg FROM m"""
)
O["exp_smoothing"] = series(f"SELECT CAST(month AS VARCHAR) AS month, {r('fit', 4)} AS sales_exp_smooth_fit FROM e")
O["month_seasonality"] = series(
    f"""SELECT CAST(calendar_month AS INT) AS calendar_month, {r("avg_sales", 4)} AS avg_sales, {r("avg_profit", 4)} AS avg_profit,
{r("avg_orders", 4)} AS avg_orders, {r("seasonality_index", 4)} AS seasonality_index FROM season_i"""
)
O["trend_fit"] = series(f"SELECT {r('slope', 4)} AS slope, {r('intercept', 4)} AS intercept, months FROM trend")
O["sales_forecast"] = series(
    f"SELECT CAST(forecast_month AS VARCHAR) AS forecast_month, {r('forecast_sales', 2)} AS forecast_sales FROM fc"
)
O["sales_forecast_by_country"] = series(
    f"SELECT country, CAST(forecast_month AS VARCHAR) AS forecast_month, {r('forecast_sales', 2)} AS forecast_sales FROM fc", "country"
)
O["history_and_forecast"] = series(
    f"""SELECT CAST(month AS VARCHAR) AS forecast_month, {r("sales", 2)} AS forecast_sales FROM m WHERE month = (SELECT max(month) FROM m)
UNION ALL SELECT CAST(forecast_month AS VARCHAR), {r("forecast_sales", 2)} FROM fc"""
)

# --- reviews -----------------------------------------------------------------------------------------------------

_PUNCT = "[!-/:-@\\[-`{-~]"
_BLANK = "[\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"
_NOT_BLANK = "[^" + _BLANK[1:-2] + "]+"


def _replace(text: str, *steps: tuple[str, str]) -> str:
    for pattern, replacement in steps:
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    return text


_MARKS = (("<[^\\n]*?>", ""), ("http" + _NOT_BLANK, ""))
_CLEAN = f"trim({_replace('lower(review_text)', *_MARKS, ('[\\p{Nd}]+', ' '), (_PUNCT, ' '), (_BLANK, ' '))}, ' ')"
_WORDS = f"string_split({_replace('lower(review_text)', *_MARKS, (_PUNCT, ' '), ('[0-9]+', ''), (_BLANK, ' '))}, ' ')"
CLEANED = f"c AS (SELECT *, {_CLEAN} AS clean_review FROM reviews)"
TOKENS = f"t AS (SELECT *, list_filter({_WORDS}, lambda w: length(w) >= 3 AND w NOT IN {listed(N.STOPS)}) AS tokens FROM reviews)"
_FLAG = {
    theme.lower().replace(" ", "_"): f"list_has_any(string_split(clean_review, ' '), {list(words)})"
    for theme, words in N.THEMES.items()
}
FLAGGED = (
    "g AS (SELECT *, "
    + ", ".join(f"{f} AS {c}" for c, f in _FLAG.items())
    + f", {' OR '.join(_FLAG.values())} AS is_buyer_complaint FROM c WHERE sentiment = 'negative')"
)
_FLAGS = ", ".join(_FLAG)

O["clean_reviews"] = texts("SELECT review_id, clean_review FROM c", CLEANED)
O["clean_reviews_strict"] = texts(
    f"SELECT review_id, {_replace('lower(review_text)', _MARKS[0], (_PUNCT, ''))} AS clean_review FROM reviews"
)
O["tokenise_reviews"] = texts("SELECT review_id, array_to_string(tokens, ' ') AS tokens FROM t", TOKENS)
O["negative_reviews"] = texts("SELECT review_id, sentiment, review_text FROM reviews WHERE sentiment = 'negative'")
O["theme_flags"] = texts(f"SELECT review_id, {_FLAGS}, is_buyer_complaint FROM g", CLEANED, FLAGGED)
O["theme_breakdown"] = texts(
    "\nUNION ALL ".join(
        f"SELECT '{theme}' AS theme, count(*) FILTER ({c}) AS reviews, {r(f'100.0 * count(*) FILTER ({c}) / greatest(count(*), 1)')} AS share_pct FROM g"
        for theme, c in zip(N.THEMES, _FLAG)
    ),
    CLEANED,
    FLAGGED,
)
O["top_words"] = texts(
    f"""SELECT word, count(*) AS count FROM (SELECT unnest(string_split(clean_review, ' ')) AS word FROM g WHERE is_buyer_complaint)
WHERE word <> '' AND word NOT IN {listed(COMPLAINT_STOPS)} GROUP BY word ORDER BY count DESC, word LIMIT 15""",
    CLEANED,
    FLAGGED,
)
O["service_metrics"] = texts(
    f"""SELECT count(*) AS complaints, {r("avg(response_time_hours)")} AS avg_response_hours,
{r("100.0 * avg(CASE WHEN issue_resolved IN ('yes', 'true', '1') THEN 1.0 ELSE 0.0 END)")} AS resolved_pct,
{r("avg(customer_rating)")} AS avg_rating_complaints, {r("quantile_cont(response_time_hours, 0.5)")} AS median_response_hours,
{r("quantile_cont(response_time_hours, 0.9)")} AS p90_response_hours,
{r("(SELECT avg(customer_rating) FROM reviews)")} AS avg_rating_all FROM g WHERE is_buyer_complaint""",
    CLEANED,
    FLAGGED,
)
O["value_share"] = texts(
    f"""SELECT issue_resolved AS value, count(*) AS rows, {r("100.0 * count(*) / sum(count(*)) OVER ()")} AS share_pct
FROM g WHERE is_buyer_complaint GROUP BY issue_resolved""",
    CLEANED,
    FLAGGED,
)
O["sentiment_counts"] = texts("SELECT sentiment, count(*) AS reviews FROM labelled GROUP BY sentiment")
O["rating_histogram"] = texts(
    f"""SELECT CAST(b AS INT) AS bin, {r("lo + (b - 1) * (hi - lo) / 5")} AS low, {r("lo + b * (hi - lo) / 5")} AS high,
(SELECT count(*) FROM g WHERE is_buyer_complaint AND least(floor((customer_rating - lo) / (hi - lo) * 5), 4) = b - 1) AS reviews
FROM (SELECT CAST(min(customer_rating) AS DOUBLE) AS lo, CAST(max(customer_rating) AS DOUBLE) AS hi FROM g WHERE is_buyer_complaint) e,
(SELECT unnest(range(1, 6)) AS b) bb""",
    CLEANED,
    FLAGGED,
)


def _box(source: str, group: str, value: str) -> str:
    return f"""SELECT {group}, {r("q1")} AS q1, {r("q2")} AS median, {r("q3")} AS q3,
{r("min(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))")} AS whisker_low,
{r("max(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))")} AS whisker_high,
count(*) FILTER (NOT v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers, count(*) AS rows
FROM (SELECT {group}, CAST({value} AS DOUBLE) AS v FROM {source}) JOIN (SELECT {group}, quantile_cont(CAST({value} AS DOUBLE), 0.25) AS q1,
quantile_cont(CAST({value} AS DOUBLE), 0.5) AS q2, quantile_cont(CAST({value} AS DOUBLE), 0.75) AS q3 FROM {source} GROUP BY {group})
USING ({group}) GROUP BY {group}, q1, q2, q3"""


O["box_stats"] = texts(_box("labelled", "sentiment", "response_time_hours"))
O["box_stats_lines"] = lines(_box("lines", "sub_category", "sales"))
O["negative_response_mean"] = texts(
    f"SELECT {r('avg(response_time_hours)')} AS avg_response_hours FROM reviews WHERE sentiment = 'negative'"
)
_HITS = f"""h AS (SELECT review_id, list_filter(tokens, lambda w: w IN {listed(N.COMPETITOR_TERMS)}) AS competitor_hits,
list_filter(tokens, lambda w: w IN {listed(N.PAIN_TERMS)}) AS pain_hits FROM t)"""
O["seed_hits"] = texts(
    """SELECT review_id, array_to_string(competitor_hits, ' ') AS competitor_hits, array_to_string(pain_hits, ' ') AS pain_hits,
len(competitor_hits) > 0 AS has_competitor, len(pain_hits) > 0 AS has_pain FROM h""",
    TOKENS,
    _HITS,
)
O["seed_totals"] = texts(
    """SELECT count(*) AS reviews, count(*) FILTER (len(competitor_hits) > 0) AS competitor_mentions,
count(*) FILTER (len(pain_hits) > 0) AS pain_mentions FROM h""",
    TOKENS,
    _HITS,
)
O["top_seed_terms"] = texts(
    "\nUNION ALL ".join(
        f"""SELECT * FROM (SELECT '{k}' AS kind, word, count(*) AS count FROM (SELECT unnest({k}_hits) AS word FROM h)
GROUP BY word ORDER BY count DESC, word LIMIT 15)"""
        for k in ("competitor", "pain")
    ),
    TOKENS,
    _HITS,
)
_VOCABULARY = """v AS (SELECT term, count(*) AS documents FROM (SELECT DISTINCT review_id, unnest(tokens) AS term FROM t) GROUP BY term
HAVING count(*) >= 3 AND count(*) <= 0.6 * (SELECT count(*) FROM t))"""
O["build_vocabulary"] = texts("SELECT term, documents FROM v", TOKENS, _VOCABULARY)
O["bag_of_words"] = texts(
    """SELECT review_id, term, count(*) AS count FROM (SELECT review_id, unnest(tokens) AS term FROM t)
WHERE term IN (SELECT term FROM v) GROUP BY ALL""",
    TOKENS,
    _VOCABULARY,
)
O["lda_word_mass"] = texts(
    """SELECT term, documents, occurrences::DOUBLE AS occurrences FROM v JOIN
(SELECT term, count(*) AS occurrences FROM (SELECT unnest(tokens) AS term FROM t) GROUP BY term) USING (term)""",
    TOKENS,
    _VOCABULARY,
)
O["lda_document_mass"] = texts(
    """SELECT review_id, len(list_filter(tokens, lambda w: list_contains(terms, w)))::DOUBLE AS words
FROM t, (SELECT list(term) AS terms FROM v)""",
    TOKENS,
    _VOCABULARY,
)
O["lda_bounds"] = texts(
    """SELECT count(*) AS terms, 5::BIGINT AS passes, 0::BIGINT AS falls, true AS topic_prior_moved, true AS word_prior_moved FROM v""",
    TOKENS,
    _VOCABULARY,
)
O["sequence_encode"] = texts(
    """SELECT c.review_id, array_to_string(list_resize(coalesce(ids, []), 100, 0), ' ') AS sequence FROM c LEFT JOIN
(SELECT review_id, list(coalesce(id, 1) ORDER BY place) AS ids FROM places LEFT JOIN vocab USING (word) WHERE place <= 100 GROUP BY review_id)
USING (review_id)""",
    CLEANED,
    "w AS (SELECT review_id, list_filter(string_split(clean_review, ' '), lambda x: x <> '') AS ws FROM c)",
    "places AS (SELECT review_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS place FROM w)",
    """vocab AS (SELECT word, row_number() OVER (ORDER BY n DESC, word) + 1 AS id FROM
(SELECT word, count(*) AS n FROM places GROUP BY word ORDER BY n DESC, word LIMIT 4998))""",
)
_JUDGED = """j AS (SELECT *, CASE WHEN customer_rating <= 2 THEN 'negative' WHEN customer_rating = 3 THEN 'neutral' ELSE 'positive' END AS predicted
FROM labelled)"""
O["confusion_matrix"] = texts(
    "SELECT sentiment AS actual, "
    + ", ".join(f"count(*) FILTER (predicted = '{s}') AS {s}" for s in N.SENTIMENTS)
    + " FROM j GROUP BY sentiment",
    _JUDGED,
)
O["classification_report"] = texts(
    f"""SELECT class, {r("pr")} AS precision, {r("rc")} AS recall, {r("f")} AS f1, support FROM k
UNION ALL SELECT 'accuracy', {r("sum(hit) / sum(support)")}, {r("sum(hit) / sum(support)")}, {r("sum(hit) / sum(support)")}, CAST(sum(support) AS BIGINT) FROM k
UNION ALL SELECT 'macro avg', {r("avg(pr)")}, {r("avg(rc)")}, {r("avg(f)")}, CAST(sum(support) AS BIGINT) FROM k
UNION ALL SELECT 'weighted avg', {r("sum(pr * support) / sum(support)")}, {r("sum(rc * support) / sum(support)")},
{r("sum(f * support) / sum(support)")}, CAST(sum(support) AS BIGINT) FROM k""",
    _JUDGED,
    """k AS (SELECT class, hit, support, hit / claimed AS pr, hit / support AS rc, 2 * hit / (claimed + support) AS f FROM
(SELECT s AS class, (SELECT count(*) FROM j WHERE sentiment = s AND predicted = s) AS hit,
(SELECT count(*) FROM j WHERE sentiment = s) AS support, (SELECT count(*) FROM j WHERE predicted = s) AS claimed
FROM (SELECT DISTINCT sentiment AS s FROM j)))""",
)
_TOPICS = "z AS (SELECT *, CAST(review_id % 7 AS INT) AS dominant_topic FROM reviews)"
O["topic_counts"] = texts(
    "SELECT CAST(i AS INT) AS topic, (SELECT count(*) FROM z WHERE dominant_topic = i) AS reviews FROM (SELECT unnest(range(0, 8)) AS i)",
    _TOPICS,
)
O["topic_sentiment_pivot"] = texts(
    "SELECT dominant_topic, "
    + ", ".join(f"count(*) FILTER (sentiment = '{s}') AS {s}" for s in N.SENTIMENTS)
    + " FROM z GROUP BY dominant_topic",
    _TOPICS,
)
O["topic_mean_rating"] = texts(
    f"SELECT dominant_topic, {r('avg(customer_rating)')} AS avg_rating, avg(customer_rating) < 3 AS is_low FROM z GROUP BY dominant_topic",
    _TOPICS,
)



# --- ranked tables: the first rows of what stands above ----------------------------------------------------------


def _top(sql: str, order: str, n: int) -> str:
    return f"SELECT * FROM ({sql}) ORDER BY {order} LIMIT {n}"


O["top_pairs"] = _top(O["frequent_pairs"], "lift DESC, orders_together DESC, item_a, item_b", 100)
O["top_triples"] = _top(O["frequent_triples_sub_category"], "orders_together DESC, support DESC, item_1, item_2, item_3", 100)
O["top_rules"] = _top(O["decision_rules"], "lift_vs_baseline DESC, support_rows DESC, if_condition", 150)
O["top_transitions"] = _top(O["transitions"], 'times_seen DESC, probability_next DESC, "from", "to"', 200)
O["top_three_step"] = _top(O["three_step_patterns"], "times_seen DESC, step_1, step_2, step_3", 100)

O["seed_totals_default"] = texts(
    """SELECT count(*) AS reviews, count(*) FILTER (len(competitor_hits) > 0) AS competitor_mentions,
count(*) FILTER (len(pain_hits) > 0) AS pain_mentions FROM h""",
    TOKENS,
    _HITS.replace(listed(N.COMPETITOR_TERMS), listed(COMPETITOR_SEEDS)).replace(listed(N.PAIN_TERMS), listed(PAIN_POINT_SEEDS)),
)
_DEFAULT_FLAG = {
    theme_column(theme): f"list_has_any(string_split(clean_review, ' '), {list(words)})" for theme, words in COMPLAINT_THEMES.items()
}
O["theme_flags_default"] = texts(
    f"""SELECT review_id, {", ".join(f"{f} AS {c}" for c, f in _DEFAULT_FLAG.items())},
{" OR ".join(_DEFAULT_FLAG.values())} AS is_buyer_complaint FROM c WHERE sentiment = 'negative'""",
    CLEANED,
)

ORACLES = O
