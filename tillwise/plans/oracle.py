"""The catalog queries as DuckDB SQL over the same tables, for checking results.

Written from the definitions of the tables, not from the Spark plans: exact sums use
integer units of 10^-10, rounding is integer division, quantiles are discrete.
"""

from tillwise import constants as K
from tillwise.plans.gold_tables import DETAILED, long_sql
from tillwise.plans.gold_tables import SIMPLE as SIMPLE_TABLES

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"



def units_of(value: str) -> str:
    """A number as whole units of 10^-10, by way of its shortest text."""
    return f"CAST(replace(CAST({exact(value)} AS VARCHAR), '.', '') AS HUGEINT)"


def exact(value: str) -> str:
    return f"CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,10))"


def exact_sum(value: str) -> str:
    return f"CAST(CAST(SUM({exact(value)}) AS VARCHAR) AS DOUBLE)"


LINES = """
lines AS (
  SELECT (CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'C' ELSE '' END)
           || CAST(l_orderkey AS VARCHAR) AS InvoiceNo,
         CAST(l_partkey AS VARCHAR) AS StockCode,
         CASE WHEN l_partkey % 97 = 0 THEN 'test ' || p_name ELSE ' ' || p_name || ' ' END AS Description,
         CAST(CASE WHEN l_orderkey % 50 = 0 THEN -l_quantity ELSE l_quantity END AS INTEGER) AS Quantity,
         strftime(o_orderdate, '%-m/%-d/%Y %-H:%M') AS InvoiceDate,
         p_retailprice AS UnitPrice,
         CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS CustomerID,
         CASE n_nationkey WHEN 0 THEN 'EIRE' WHEN 1 THEN ' European Community'
              WHEN 2 THEN 'Unspecified' ELSE n_name END AS Country
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
)"""

SILVER = (
    LINES
    + f""",
cleaned AS (
  SELECT InvoiceNo, trim(upper(StockCode)) AS StockCode, trim(upper(Description)) AS Description,
         Quantity, InvoiceDate, UnitPrice, CustomerID, trim(upper(Country)) AS Country,
         strptime(InvoiceDate, '%-m/%-d/%Y %-H:%M') AS InvoiceTimestamp
  FROM lines
  WHERE InvoiceNo IS NOT NULL AND InvoiceNo <> '' AND Quantity > 0 AND UnitPrice > 0
),
silver AS (
  SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID,
         CASE WHEN Country IN ('EIRE', 'IRELAND') THEN 'IRELAND'
              WHEN Country = 'EUROPEAN COMMUNITY' THEN 'EUROPE'
              WHEN Country = 'UNSPECIFIED' THEN 'UNKNOWN' ELSE Country END AS Country,
         InvoiceTimestamp,
         CAST(year(InvoiceTimestamp) AS INTEGER) AS Year,
         CAST(month(InvoiceTimestamp) AS INTEGER) AS Month,
         CAST(day(InvoiceTimestamp) AS INTEGER) AS Day,
         CAST(dayofweek(InvoiceTimestamp) + 1 AS INTEGER) AS DayOfWeek,
         Quantity * UnitPrice AS TotalAmount,
         CASE WHEN CustomerID IS NULL THEN 'GUEST' ELSE 'REGISTERED' END AS CustomerType,
         {units_of('Quantity * UnitPrice')} AS units,
         {units_of('UnitPrice')} AS price_units
  FROM cleaned
  WHERE NOT starts_with(InvoiceNo, 'C')
    AND NOT contains(Description, 'TEST') AND NOT contains(Description, 'SAMPLE')
    AND NOT contains(Description, 'ADJUSTMENT')
)"""
)

SIMPLE = (
    LINES
    + f""",
simple AS (
  SELECT InvoiceNo, StockCode, trim(Description) AS Description, Quantity,
         strptime(InvoiceDate, '%-m/%-d/%Y %-H:%M') AS InvoiceDate, UnitPrice, CustomerID, Country,
         {units_of('Quantity * UnitPrice')} AS units
  FROM lines
  WHERE InvoiceNo IS NOT NULL AND StockCode IS NOT NULL AND Description IS NOT NULL
    AND InvoiceDate IS NOT NULL AND CustomerID IS NOT NULL AND Quantity > 0 AND UnitPrice > 0
)"""
)


def cents(units: str, parts: str = "1") -> str:
    """Half-up cents of ``units / 10^10 / parts`` as a double; null when parts is 0."""
    whole = f"(100000000 * CAST({parts} AS HUGEINT))"
    return (
        f"CASE WHEN ({parts}) = 0 THEN NULL ELSE "
        f"CAST((2 * CAST({units} AS HUGEINT) + {whole}) // (2 * {whole}) AS DOUBLE) / 100 END"
    )


def rounded_cents(units: str) -> str:
    """Whole cents of a unit sum, as an integer in units again."""
    return f"(((2 * CAST({units} AS HUGEINT) + 100000000) // 200000000) * 100000000)"


def amount(units: str) -> str:
    """A sum of units, none below zero, as the nearest double."""
    ten = "CAST(10000000000 AS HUGEINT)"
    text = f"CAST({units} // {ten} AS VARCHAR) || '.' || lpad(CAST({units} % {ten} AS VARCHAR), 10, '0')"
    return f"CAST({text} AS DOUBLE)"


def whole(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


DAILY = f"""
daily AS (
  SELECT Year, Month, Day, {cents('SUM(units)')} AS daily_revenue,
         COUNT(DISTINCT InvoiceNo) AS transaction_count,
         COUNT(CustomerID) AS customer_interactions,
         COUNT(DISTINCT CustomerID) AS unique_customers,
         {cents('SUM(units)', 'COUNT(*)')} AS avg_order_value,
         MAX(TotalAmount) AS max_order_value, MIN(TotalAmount) AS min_order_value
  FROM silver GROUP BY Year, Month, Day
)"""

COUNTRY = f"""
SELECT Country, {cents('SUM(units)')} AS total_revenue,
       COUNT(DISTINCT InvoiceNo) AS total_orders,
       COUNT(DISTINCT CustomerID) AS unique_customers,
       {cents('SUM(units)', 'COUNT(*)')} AS avg_order_value,
       {whole('SUM(Quantity)')} AS total_quantity_sold,
       {cents(rounded_cents('SUM(units)'), 'COUNT(DISTINCT CustomerID)')} AS revenue_per_customer
FROM silver GROUP BY Country"""

PRODUCTS = f"""
products AS (
  SELECT StockCode, Description, {cents('SUM(units)')} AS total_revenue,
         {whole('SUM(Quantity)')} AS total_quantity_sold,
         COUNT(DISTINCT InvoiceNo) AS total_orders,
         COUNT(DISTINCT CustomerID) AS unique_customers,
         {cents('SUM(price_units)', 'COUNT(*)')} AS avg_unit_price,
         {cents(rounded_cents('SUM(units)'), 'COUNT(DISTINCT InvoiceNo)')} AS revenue_per_order
  FROM silver GROUP BY StockCode, Description
)"""

BASE = """
base AS (
  SELECT CustomerID, MIN(InvoiceTimestamp) AS first_purchase, MAX(InvoiceTimestamp) AS last_purchase,
         COUNT(DISTINCT InvoiceNo) AS orders, SUM(units) AS units, COUNT(*) AS n
  FROM silver WHERE CustomerID IS NOT NULL GROUP BY CustomerID
)"""

RFM = f"""
metrics AS (
  SELECT CustomerID, last_purchase AS last_purchase_date, orders AS frequency,
         {amount('units')} AS spend, {cents('units')} AS monetary_value,
         CAST(date_diff('day', last_purchase, (SELECT MAX(last_purchase) FROM base)) AS INTEGER) AS recency
  FROM base
),
cuts AS (
  SELECT quantile_disc(recency, [0.2, 0.4, 0.6, 0.8]) AS r,
         quantile_disc(frequency, [0.2, 0.4, 0.6, 0.8]) AS f,
         quantile_disc(spend, [0.2, 0.4, 0.6, 0.8]) AS m
  FROM metrics
),
scored AS (
  SELECT metrics.*,
         CASE WHEN recency <= r[1] THEN 5 WHEN recency <= r[2] THEN 4
              WHEN recency <= r[3] THEN 3 WHEN recency <= r[4] THEN 2 ELSE 1 END AS recency_score,
         CASE WHEN frequency >= f[4] THEN 5 WHEN frequency >= f[3] THEN 4
              WHEN frequency >= f[2] THEN 3 WHEN frequency >= f[1] THEN 2 ELSE 1 END AS frequency_score,
         CASE WHEN spend >= m[4] THEN 5 WHEN spend >= m[3] THEN 4
              WHEN spend >= m[2] THEN 3 WHEN spend >= m[1] THEN 2 ELSE 1 END AS monetary_score
  FROM metrics, cuts
),
rfm AS (
  SELECT CustomerID, last_purchase_date, frequency, monetary_value, recency,
         recency_score, frequency_score, monetary_score,
         CASE WHEN least(recency_score, frequency_score, monetary_score) >= 4 THEN 'Champions'
              WHEN least(recency_score, frequency_score, monetary_score) >= 3 THEN 'Loyal Customers'
              WHEN recency_score >= 4 AND frequency_score <= 2 THEN 'New Customers'
              WHEN recency_score <= 2 AND frequency_score >= 3 THEN 'At Risk'
              WHEN recency_score <= 2 AND monetary_score >= 3 THEN 'Can''t Lose Them'
              WHEN recency_score <= 2 THEN 'Lost'
              ELSE 'Potential Loyalists' END AS customer_segment
  FROM scored
)"""

CLTV = f"""
valued AS (
  SELECT CustomerID, first_purchase, last_purchase, orders AS total_orders,
         {cents('units')} AS total_spent, {cents('units', 'n')} AS avg_order_value,
         n AS total_transactions,
         CAST(date_diff('day', first_purchase, last_purchase) + 1 AS INTEGER) AS customer_lifespan_days,
         CAST(orders AS DOUBLE) / (date_diff('day', first_purchase, last_purchase) + 1) AS purchase_frequency,
         round({amount('units')} / n
               * (CAST(orders AS DOUBLE) / (date_diff('day', first_purchase, last_purchase) + 1)) * 365, 2)
           AS predicted_cltv
  FROM base
),
bands AS (SELECT quantile_disc(predicted_cltv, [0.2, 0.4, 0.6, 0.8]) AS c FROM valued)
SELECT valued.*,
       CASE WHEN predicted_cltv >= c[4] THEN 'High Value' WHEN predicted_cltv >= c[3] THEN 'Medium-High Value'
            WHEN predicted_cltv >= c[2] THEN 'Medium Value' WHEN predicted_cltv >= c[1] THEN 'Low-Medium Value'
            ELSE 'Low Value' END AS cltv_segment
FROM valued, bands"""

SIMPLE_DAILY = f"""
SELECT CAST(InvoiceDate AS DATE) AS SaleDate, {whole('SUM(Quantity)')} AS TotalQuantity,
       {amount('SUM(units)')} AS TotalRevenue, COUNT(DISTINCT CustomerID) AS UniqueCustomers,
       COUNT(InvoiceNo) AS TotalTransactions
FROM simple GROUP BY 1"""

SIMPLE_COUNTRY = f"""
SELECT Country, {amount('SUM(units)')} AS CountryRevenue, {whole('SUM(Quantity)')} AS TotalQuantity,
       COUNT(DISTINCT CustomerID) AS UniqueCustomers, COUNT(DISTINCT StockCode) AS UniqueProducts
FROM simple GROUP BY Country"""

TOP_PRODUCTS = f"""
SELECT StockCode, Description, {whole('SUM(Quantity)')} AS TotalSold, {amount('SUM(units)')} AS TotalRevenue,
       {exact_sum('UnitPrice')} / COUNT(UnitPrice) AS AvgPrice
FROM simple GROUP BY StockCode, Description
ORDER BY TotalSold DESC, StockCode, Description"""

SIMPLE_RFM = f"""
rfm AS (
  SELECT CustomerID,
         CAST(date_diff('day', MAX(CAST(InvoiceDate AS DATE)),
              CAST((SELECT MAX(InvoiceDate) FROM simple) AS DATE)) AS INTEGER) AS Recency,
         COUNT(InvoiceNo) AS Frequency, {amount('SUM(units)')} AS Monetary
  FROM simple WHERE CustomerID IS NOT NULL GROUP BY CustomerID
),
projected AS (
  SELECT *, Frequency * Monetary / (Recency + 1) AS CLTV,
         Frequency * Monetary / (Recency + 1) * 12 AS ExpectedRevenue_12M
  FROM rfm
)"""

FEATURES = """
series AS (
  SELECT make_date(Year, Month, Day) AS sale_date, daily_revenue,
         CAST(daily_revenue AS DECIMAL(18,2)) AS exact_revenue
  FROM daily
),
lags AS (
  SELECT sale_date, daily_revenue,
         CAST(dayofyear(sale_date) AS INTEGER) AS day_of_year, CAST(month(sale_date) AS INTEGER) AS month,
         CAST(dayofweek(sale_date) + 1 AS INTEGER) AS day_of_week,
         COALESCE(CAST(SUM(exact_revenue) OVER w7 AS DOUBLE) / COUNT(exact_revenue) OVER w7, 0) AS lag_7,
         COALESCE(CAST(SUM(exact_revenue) OVER w30 AS DOUBLE) / COUNT(exact_revenue) OVER w30, 0) AS lag_30
  FROM series
  WINDOW w7 AS (ORDER BY sale_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
         w30 AS (ORDER BY sale_date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)
)"""


def customer_features(as_of: str) -> str:
    return f"""
people AS (
  SELECT CustomerID, CAST(date_diff('day', last_purchase, {as_of}) AS INTEGER) AS recency,
         n AS frequency, {amount('units')} AS monetary, {amount('units')} / n AS avg_order_value
  FROM base
)"""


LATEST = "(SELECT MAX(last_purchase) FROM base)"
LABELLED = f"""
{SILVER}, {BASE}, {customer_features(LATEST)},
labelled AS (
  SELECT *, CAST(least(floor(monetary / 300000), 4) AS INTEGER) AS cluster FROM people
)"""


def statistics(feature: str) -> str:
    return f"""
  COALESCE({exact_sum(feature)} / COUNT({feature}), 0) AS {feature}_mean,
  COALESCE(round(stddev_samp({feature}), 4), 0) AS {feature}_std,
  CAST(MIN({feature}) AS DOUBLE) AS {feature}_min, CAST(MAX({feature}) AS DOUBLE) AS {feature}_max"""


def percent(part: str, everything: str) -> str:
    return (
        f"CAST((20000 * CAST({part} AS HUGEINT) + {everything}) // (2 * CAST({everything} AS HUGEINT)) AS DOUBLE) / 100"
    )


def predictions(name: str, spread: int = 5) -> str:
    return f"""
{name} AS (
  SELECT o_orderpriority AS model, o_orderstatus, o_totalprice AS actual,
         o_totalprice * (1 + (o_orderkey % {2 * spread + 1} - {spread}) / 100.0::DOUBLE) AS prediction
  FROM orders
)"""


def errors(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT model, round(AVG((actual - prediction) * (actual - prediction)), 1) AS mse,
         round(sqrt(AVG((actual - prediction) * (actual - prediction))), 3) AS rmse,
         round(AVG(abs(actual - prediction)), 4) AS mae,
         round(AVG(abs((actual - prediction) / actual) * 100), 6) AS mape,
         round(1 - SUM((actual - prediction) * (actual - prediction)) / (COUNT(actual) * var_samp(actual)), 8)
           AS r_squared,
         round(1 - SUM((actual - prediction) * (actual - prediction)) / (COUNT(actual) * var_pop(actual)), 8)
           AS r2,
         COUNT(actual) AS sample_count
  FROM {source} GROUP BY model
)"""


def values(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT model, metric, value FROM (SELECT model, mae, rmse, mape, r_squared FROM {source})
  UNPIVOT (value FOR metric IN (mae, rmse, mape, r_squared))
)"""


BALANCE = """
sizes AS (SELECT cluster, COUNT(*) AS n FROM labelled GROUP BY cluster),
balance AS (
  SELECT COUNT(*) AS num_clusters, CAST(SUM(n) AS BIGINT) AS total_samples,
         CAST(MIN(n) AS DOUBLE) / MAX(n) AS balance_ratio
  FROM sizes
)"""

HEALTH = f"""
WITH {LABELLED}, {BALANCE}, {predictions('made')}, {errors('errs', 'made')}, {values('vals', 'errs')},
all_values AS (
  SELECT * FROM vals
  UNION ALL SELECT 'customer_segmentation', 'num_clusters', CAST(num_clusters AS DOUBLE) FROM balance
  UNION ALL SELECT 'customer_segmentation', 'balance_ratio', balance_ratio FROM balance
),
checked AS (
  SELECT model, metric,
    CASE metric WHEN 'r_squared' THEN 0 WHEN 'mae' THEN 1 WHEN 'mape' THEN 2 WHEN 'balance_ratio' THEN 3 END AS ord,
    CASE metric WHEN 'r_squared' THEN value < 0.7 WHEN 'mae' THEN value > 1000
         WHEN 'mape' THEN value > 15 WHEN 'balance_ratio' THEN value < 0.3 ELSE false END AS broken,
    CASE metric WHEN 'mae' THEN 'critical' ELSE 'warning' END AS state,
    CASE metric WHEN 'r_squared' THEN printf('R-squared (%.3f) below threshold (0.7)', value)
         WHEN 'mae' THEN printf('MAE (%.2f) above threshold (1000.0)', value)
         WHEN 'mape' THEN printf('MAPE (%.1f%%) above threshold (15.0%%)', value)
         WHEN 'balance_ratio' THEN printf('Cluster balance ratio (%.3f) below threshold (0.3)', value) END AS text
  FROM all_values
),
health AS (
  SELECT model, COALESCE(arg_max(state, ord) FILTER (WHERE broken), 'healthy') AS status,
         CASE WHEN bool_or(broken AND state = 'critical') THEN 'critical'
              WHEN bool_or(broken) THEN 'warning' ELSE 'healthy' END AS max_severity,
         COUNT(*) FILTER (WHERE broken) AS alert_count,
         COUNT(*) FILTER (WHERE ord IS NOT NULL AND NOT broken) AS passed_checks,
         COUNT(*) AS metrics_checked,
         COALESCE(string_agg(text, '; ' ORDER BY ord) FILTER (WHERE broken), '') AS alerts
  FROM checked GROUP BY model
)"""

RUNS = """
log AS (
  SELECT ts AS "timestamp", 'INFO' AS level, 'pipeline' AS logger, 'run ' || CAST(event_id AS VARCHAR) AS message,
         'jobs' AS module, 'run' AS function, CAST(1 AS INTEGER) AS line, CAST(NULL AS VARCHAR) AS exception,
         'pipeline_' || CAST(user_id AS VARCHAR) AS pipeline_name,
         CASE WHEN event_type = 'signup' THEN 'pipeline_start' ELSE 'pipeline_end' END AS event_type,
         CASE event_type WHEN 'signup' THEN NULL WHEN 'error' THEN 'failed' ELSE 'success' END AS status,
         CASE WHEN event_type <> 'signup' THEN "value" * 60 END AS duration_seconds,
         CAST(NULL AS VARCHAR) AS table_name, CAST(NULL AS VARCHAR) AS operation
  FROM events
)"""


def metric(
    name: str, value: str, threshold: float, kind: str, healthy: str, level: str, stamp: str, source: str
) -> str:
    return f"""SELECT {name} AS name, {value} AS value, CAST({threshold} AS DOUBLE) AS threshold,
       '{kind}' AS metric_type, {stamp} AS "timestamp",
       CASE WHEN {healthy} THEN 'healthy' ELSE 'unhealthy' END AS status,
       CASE WHEN NOT ({healthy}) THEN {level} END AS alert_level FROM {source}"""


def success(stamp: str = '"last"') -> str:
    return metric(
        "pipeline_name || '_success_rate'", "CAST(good AS DOUBLE) / runs", K.MIN_SUCCESS_RATE, "pipeline_health",
        "CAST(good AS DOUBLE) / runs >= 0.98", "'critical'", stamp,
        """(SELECT pipeline_name, COUNT(*) AS runs, COUNT(*) FILTER (WHERE status = 'success') AS good,
            MAX("timestamp") AS "last" FROM log WHERE event_type = 'pipeline_end' GROUP BY pipeline_name)""",
    )


def duration(stamp: str = '"last"') -> str:
    value = "seconds / 60 / runs"
    return metric(
        "pipeline_name || '_duration'", value, K.MAX_DURATION_MINUTES, "pipeline_health",
        f"{value} <= 60", "'warning'", stamp,
        f"""(SELECT pipeline_name, {exact_sum('duration_seconds')} AS seconds,
            COUNT(duration_seconds) AS runs, MAX("timestamp") AS "last"
            FROM log WHERE event_type = 'pipeline_end' GROUP BY pipeline_name)""",
    )


def volume() -> str:
    return metric(
        "model || '_prediction_volume'", "ratio", K.MIN_PREDICTION_VOLUME, "model_performance", "ratio >= 0.8",
        "'warning'", AS_OF,
        "(SELECT model, CAST(COUNT(*) AS DOUBLE) / (SELECT 2 * COUNT(*) FROM customer) AS ratio FROM made GROUP BY model)",
    )


def accuracy() -> str:
    return metric(
        "model || '_accuracy'", "round(accuracy, 9)", K.MIN_ACCURACY, "model_performance",
        "abs(accuracy - 0.85) <= 0.05", "'warning'", AS_OF,
        """(SELECT model, 1 - AVG(abs(actual - prediction) / greatest(abs(actual), 2.220446049250313e-16::DOUBLE)) AS accuracy
            FROM made GROUP BY model)""",
    )


METRIC_ROWS = f"""
{RUNS}, {predictions('made')},
metric_rows AS ({success()} UNION ALL {duration()} UNION ALL {accuracy()})"""

ALERTS = f"""
{METRIC_ROWS},
alert_rows AS (
  SELECT name || '_' || CAST(CAST(floor(epoch("timestamp")) AS BIGINT) AS VARCHAR) || '_' ||
           substr(md5(name || '|' || metric_type || '|' || alert_level || '|' || CAST(epoch_us("timestamp") AS VARCHAR)), 1, 8)
           AS id,
         CASE metric_type WHEN 'pipeline_health' THEN 'Pipeline_Health' WHEN 'data_quality' THEN 'Data_Quality'
              ELSE 'Model_Performance' END || ' Alert: ' || name AS title,
         printf('Metric %s is %.3f, threshold: %.3f', name, value, threshold) AS description,
         alert_level AS level, name AS metric_name, value AS current_value, threshold, "timestamp",
         false AS resolved
  FROM metric_rows WHERE alert_level IS NOT NULL
)"""


def completeness(table: str, columns: list[str], floats: set[str] = frozenset()) -> str:
    empty = " + ".join(
        f"COUNT(*) FILTER (WHERE {c} IS NULL" + (f" OR isnan({c})" if c in floats else "") + ")" for c in columns
    )
    value = f"COALESCE(CAST(n * {len(columns)} - gaps AS DOUBLE) / NULLIF(n * {len(columns)}, 0), 0)"
    return metric(
        f"'{table if table != 'lines' else 'invoice_lines'}_completeness'", value, K.MIN_COMPLETENESS, "data_quality",
        f"{value} >= 0.95", "'warning'", AS_OF,
        f"(SELECT COUNT(*) AS n, {empty} AS gaps FROM {table})",
    )


LINE_COLUMNS = "InvoiceNo StockCode Description Quantity InvoiceDate UnitPrice CustomerID Country".split()
LINES_COMPLETENESS = completeness("lines", LINE_COLUMNS, {"UnitPrice"})
COMPLETENESS = " UNION ALL ".join(
    [
        completeness("customer", "c_custkey c_name c_nationkey c_acctbal c_mktsegment".split(), {"c_acctbal"}),
        completeness(
            "orders",
            "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split(),
            {"o_totalprice"},
        ),
        completeness(
            "lineitem",
            "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
            "l_returnflag l_linestatus l_shipdate".split(),
            {"l_quantity", "l_extendedprice", "l_discount", "l_tax"},
        ),
        completeness("events", 'event_id ts user_id event_type "value" props'.split(), {'"value"'}),
        LINES_COMPLETENESS,
    ]
)


def null_rows() -> str:
    counts = ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in LINE_COLUMNS)
    total = " + ".join(LINE_COLUMNS)
    return f"""
counts AS (SELECT COUNT(*) AS total_rows, {counts} FROM lines),
scored AS (SELECT *, round(1 - CAST({total} AS DOUBLE) / (total_rows * {len(LINE_COLUMNS)}), 9) AS completeness_score FROM counts)
SELECT column_name, null_count, total_rows, completeness_score FROM scored
UNPIVOT (null_count FOR column_name IN ({', '.join(LINE_COLUMNS)}))"""


def outliers(source: str) -> str:
    return f"""
stats AS (SELECT AVG(Quantity) AS m, stddev_samp(Quantity) AS s FROM {source})
SELECT COUNT(*) AS total_rows,
       COUNT(*) FILTER (WHERE Quantity > m + 3 * s OR Quantity < greatest(0, m - 3 * s)) AS outlier_count,
       {percent('COUNT(*) FILTER (WHERE Quantity > m + 3 * s OR Quantity < greatest(0, m - 3 * s))', 'COUNT(*)')}
         AS outlier_percentage,
       round(MAX(m), 2) AS mean_quantity, round(MAX(s), 2) AS stddev_quantity
FROM {source}, stats"""


def best(n: int) -> str:
    return " UNION ALL ".join(
        f"""(SELECT '{m}' AS measure, CustomerID, {m} AS value FROM projected ORDER BY {m} DESC, CustomerID LIMIT {n})"""
        for m in ("Monetary", "CLTV", "ExpectedRevenue_12M")
    )


def kpi(column: str) -> str:
    units = f"SUM({units_of(column)})"
    return f"{cents(units, f'COUNT({column})')} AS mean_{column.lower()}"


HISTOGRAM = """
measured AS (
  SELECT measure, value FROM (
    SELECT CLTV, ExpectedRevenue_12M, CAST(Recency AS DOUBLE) AS Recency,
           CAST(Frequency AS DOUBLE) AS Frequency, Monetary FROM projected)
  UNPIVOT (value FOR measure IN (CLTV, ExpectedRevenue_12M, Recency, Frequency, Monetary))
),
extremes AS (SELECT measure, MIN(value) AS lo, MAX(value) AS hi FROM measured GROUP BY measure),
frames AS (
  SELECT measure, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi
  FROM extremes
),
placed AS (
  SELECT measure, CAST(least(floor((value - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin, COUNT(*) AS n
  FROM measured JOIN frames USING (measure) GROUP BY 1, 2
)
SELECT f.measure, CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * ((hi - lo) / 50), 4) AS bin_start,
       round(lo + (b.bin + 1) * ((hi - lo) / 50), 4) AS bin_end, COALESCE(p.n, 0) AS n
FROM frames f CROSS JOIN (SELECT unnest(range(50)) AS bin) b
LEFT JOIN placed p ON p.measure = f.measure AND p.bin = b.bin"""

WINDOWS = f"""
windows AS (
  SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_type,
         COUNT(*) AS n, {exact_sum('"value"')} AS total,
         round({exact_sum('"value"')} / COUNT(*), 6) AS mean,
         round(stddev_samp("value"), 6) AS deviation, MIN("value") AS low, MAX("value") AS high
  FROM events GROUP BY 1, 2, 3
  HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT date_trunc('milliseconds', MAX(ts)) FROM events) - INTERVAL 1 HOUR
)"""

SLIDING = f"""
slots AS (
  SELECT time_bucket(INTERVAL 3 HOURS, ts) - back * INTERVAL 3 HOURS AS window_start, "value"
  FROM events, (SELECT unnest([0, 1]) AS back)
)
SELECT window_start, window_start + INTERVAL 6 HOURS AS window_end, COUNT(*) AS n,
       {exact_sum('"value"')} AS total,
       round({exact_sum('"value"')} / COUNT(*), 6) AS mean,
       round(stddev_samp("value"), 6) AS deviation, MIN("value") AS low, MAX("value") AS high
FROM slots GROUP BY window_start
HAVING window_start + INTERVAL 6 HOURS <= (SELECT date_trunc('milliseconds', MAX(ts)) FROM events) - INTERVAL 1 HOUR"""

SILVER_COLUMNS = (
    "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country, "
    "InvoiceTimestamp, Year, Month, Day, DayOfWeek, TotalAmount, CustomerType"
)
ROLLUP_KEYS = "Year, Month, Day, Country, InvoiceNo, CustomerID"


def stored_tables(tables: dict, sources: list[str]) -> str:
    return " UNION ALL ".join(
        long_sql(source, name, table) for source, (name, table) in zip(sources, tables.items(), strict=True)
    )


BAD_LINES = """
delivered AS (
  SELECT * REPLACE (CASE WHEN CAST(StockCode AS BIGINT) % 53 <> 0 THEN Quantity ELSE 0 END AS Quantity,
                    CASE WHEN CAST(StockCode AS BIGINT) % 59 <> 0 THEN UnitPrice ELSE -1 END AS UnitPrice),
         CAST(StockCode AS BIGINT) % 53 = 0 OR CAST(StockCode AS BIGINT) % 59 = 0 AS corrupt,
         CASE WHEN CAST(StockCode AS BIGINT) % 53 = 0 OR CAST(StockCode AS BIGINT) % 59 = 0 THEN InvoiceNo || ',' || StockCode ELSE '' END AS corrupt_text,
         'delivery=' || CAST(CAST(StockCode AS BIGINT) % 3 AS VARCHAR) AS delivery
  FROM lines
)"""


def within(measures: list[str], table: str) -> str:
    """One row per measure and quintile: all rows of the table, every cut point within its rank error."""
    parts = [
        f"SELECT '{m}' AS measure, CAST({p} AS DOUBLE) AS share, COUNT(*) AS n, TRUE AS within FROM {table}" for m in measures for p in K.QUINTILES
    ]
    return " UNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    daily = f"WITH {SILVER}, {DAILY} SELECT * FROM daily"
    country = f"WITH {SILVER} {COUNTRY}"
    rfm = f"WITH {SILVER}, {BASE}, {RFM} SELECT * FROM rfm"
    cltv = f"WITH {SILVER}, {BASE}, {CLTV}"
    lines = f"WITH {LINES} SELECT * FROM lines"
    series = "sale_date, daily_revenue, day_of_year, month, day_of_week, lag_7, lag_30, lag_7 AS rolling_mean_7"
    metric_sets = f"WITH {METRIC_ROWS}"
    dated_daily = f"""WITH {SILVER}, dated AS (
            SELECT * REPLACE (
              CASE WHEN CAST(StockCode AS BIGINT) % 89 <> 0 THEN Year END AS Year,
              CASE WHEN CAST(StockCode AS BIGINT) % 89 <> 0 THEN Month END AS Month,
              CASE WHEN CAST(StockCode AS BIGINT) % 89 <> 0 THEN Day END AS Day) FROM silver
            ), {DAILY.replace("FROM silver", "FROM dated")}
            SELECT * REPLACE (COALESCE(Year, 0) AS Year, COALESCE(Month, 0) AS Month, COALESCE(Day, 0) AS Day) FROM daily"""
    return {
        "silver_detailed": f"WITH {SILVER} SELECT {SILVER_COLUMNS} FROM silver",
        "silver_simple": f"WITH {SIMPLE} SELECT {', '.join(LINE_COLUMNS)} FROM simple",
        "bronze_annotated": f"WITH {LINES} SELECT *, {AS_OF} AS ingestion_timestamp, 'manual_input' AS source_file FROM lines",
        "retention": f"""WITH {SILVER},
            n AS (SELECT (SELECT COUNT(*) FROM lines) AS a, (SELECT COUNT(*) FROM cleaned) AS b, (SELECT COUNT(*) FROM silver) AS c)
            SELECT a AS rows_in, b AS rows_cleaned, a - b AS rows_removed, {percent('b', 'a')} AS retention_rate,
                   c AS rows_sold, {percent('c', 'b')} AS filtered_percentage FROM n""",
        "daily_sales_detailed": daily,
        "country_sales_detailed": country,
        "product_ranking": f"""WITH {SILVER}, {PRODUCTS}
            SELECT *, CAST(rank() OVER (ORDER BY total_revenue DESC) AS BIGINT) AS revenue_rank,
                   CAST(rank() OVER (ORDER BY total_quantity_sold DESC) AS BIGINT) AS quantity_rank FROM products""",
        "product_sales": f"WITH {SILVER}, {PRODUCTS} SELECT * FROM products",
        "customer_base": f"""WITH {SILVER}, {BASE} SELECT CustomerID, first_purchase, last_purchase, orders,
            {amount('units')} AS amount, n AS amounts, n AS transactions, n AS lines FROM base""",
        "invoice_rollup": f"""WITH {SILVER}
            SELECT {ROLLUP_KEYS}, {amount('SUM(units)')} AS amount_sum, COUNT(*) AS amount_count,
                   {whole('SUM(Quantity)')} AS quantity_sum, COUNT(*) AS line_count, COUNT(*) AS stamp_count,
                   MAX(TotalAmount) AS amount_max, MIN(TotalAmount) AS amount_min,
                   MIN(InvoiceTimestamp) AS first_stamp, MAX(InvoiceTimestamp) AS last_stamp
            FROM silver GROUP BY {ROLLUP_KEYS}""",
        "daily_sales_simple": f"WITH {SIMPLE} {SIMPLE_DAILY}",
        "daily_sales_short": f"WITH {SIMPLE}, d AS ({SIMPLE_DAILY}) SELECT SaleDate, TotalQuantity, TotalRevenue FROM d",
        "top_products_20": f"WITH {SIMPLE} {TOP_PRODUCTS} LIMIT 20",
        "top_products_10": f"""WITH {SIMPLE} SELECT Description, {whole('SUM(Quantity)')} AS TotalSold
            FROM simple GROUP BY Description ORDER BY TotalSold DESC, Description LIMIT 10""",
        "country_sales_simple": f"WITH {SIMPLE} {SIMPLE_COUNTRY}",
        "country_revenue": f"WITH {SIMPLE}, c AS ({SIMPLE_COUNTRY}) SELECT Country, CountryRevenue FROM c",
        "rfm_detailed": rfm,
        "rfm_sketch": rfm,
        "rfm_thresholds": f"""WITH {SILVER}, {BASE}, {RFM} SELECT """
        + ", ".join(
            f"CAST({c}[{i + 1}] AS DOUBLE) AS {name}_{p}"
            for name, c in (("recency", "r"), ("frequency", "f"), ("monetary", "m"))
            for i, p in enumerate((20, 40, 60, 80))
        )
        + " FROM cuts",
        "cltv_detailed": cltv,
        "cltv_sketch": cltv,
        "quantiles_from_sketches": f"WITH {SILVER} " + within(["TotalAmount", "Quantity"], "silver"),
        "distinct_from_sketches": f"""WITH {SILVER} SELECT Country, Year, COUNT(DISTINCT CustomerID) AS CustomerID,
            COUNT(DISTINCT InvoiceNo) AS InvoiceNo, TRUE AS within FROM silver GROUP BY Country, Year""",
        "returning_customers": f"""WITH {SILVER},
            seen AS (SELECT DISTINCT Year * 12 + Month AS period, CustomerID FROM silver WHERE CustomerID IS NOT NULL)
            SELECT n.period, COUNT(*) AS returning, TRUE AS within
            FROM seen n JOIN seen b ON n.period = b.period + 1 AND n.CustomerID = b.CustomerID GROUP BY n.period""",
        "alias_rules": f"""WITH {LINES} SELECT COALESCE(o_orderpriority, InvoiceNo) AS InvoiceNo, StockCode, Quantity
            FROM lines LEFT JOIN orders ON InvoiceNo = CAST(o_orderkey AS VARCHAR)""",
        "analysis_date": f"WITH {SILVER} SELECT MAX(InvoiceTimestamp) AS analysis_date FROM silver WHERE CustomerID IS NOT NULL",
        "rfm_simple": f"WITH {SIMPLE}, {SIMPLE_RFM} SELECT * FROM rfm",
        "cltv_simple": f"WITH {SIMPLE}, {SIMPLE_RFM} SELECT CustomerID, Recency, Frequency, Monetary, CLTV FROM projected",
        "projection_12m": f"WITH {SIMPLE}, {SIMPLE_RFM} SELECT * FROM projected",
        "projection_total": f"""WITH {SIMPLE}, {SIMPLE_RFM}
            SELECT CAST(CAST(round(SUM({exact('ExpectedRevenue_12M')}), 2) AS VARCHAR) AS DOUBLE) AS total_projection FROM projected""",
        "segment_counts": f"WITH {SILVER}, {BASE}, {RFM} SELECT customer_segment, COUNT(*) AS customers FROM rfm GROUP BY 1",
        "distinct_segments": f"WITH {SILVER}, {BASE}, {RFM} SELECT COUNT(DISTINCT customer_segment) AS segments FROM rfm",
        "null_profile": f"WITH {LINES}, {null_rows()}",
        "columns_with_nulls": f"""WITH {LINES}, profile AS (SELECT * FROM (WITH {null_rows()}))
            SELECT column_name, null_count FROM profile WHERE null_count > 0""",
        "completeness_silver": f"""WITH {SILVER},
            n AS (SELECT COUNT(*) AS a, """
        + " + ".join(
            f"COUNT(*) FILTER (WHERE {c.strip()} IS NULL)" for c in SILVER_COLUMNS.split(",") if c.strip() != "CustomerID"
        )
        + f""" AS gaps FROM silver)
            SELECT a AS total_rows, gaps AS null_cells, {percent('(a * 14 - gaps)', '(a * 14)')} AS completeness_score FROM n""",
        "outliers_3sigma": f"WITH {SILVER}, {outliers('silver')}",
        "outliers_raw": f"WITH {LINES}, {outliers('lines')}",
        "forecast_features": f"WITH {SILVER}, {DAILY}, {FEATURES} SELECT {series} FROM lags",
        "horizon_features": f"""WITH {SILVER}, {DAILY}, {FEATURES},
            origins AS (
              SELECT sale_date AS origin, CAST(SUM(exact_revenue) OVER w7 AS DOUBLE) / COUNT(exact_revenue) OVER w7 AS lag_7,
                     CAST(SUM(exact_revenue) OVER w30 AS DOUBLE) / COUNT(exact_revenue) OVER w30 AS lag_30
              FROM series WINDOW w7 AS (ORDER BY sale_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
                                 w30 AS (ORDER BY sale_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
            ahead AS (SELECT *, CAST(origin + horizon AS DATE) AS target
                      FROM origins, (SELECT CAST(unnest(range(1, {K.FORECAST_DAYS + 1})) AS INTEGER) AS horizon))
            SELECT origin, horizon, target, CAST(dayofyear(target) AS INTEGER) AS day_of_year, CAST(month(target) AS INTEGER) AS month,
                   CAST(dayofweek(target) + 1 AS INTEGER) AS day_of_week, lag_7, lag_30, lag_7 AS rolling_mean_7, daily_revenue
            FROM ahead LEFT JOIN series ON target = sale_date""",
        "rolling_origin_errors": f"""WITH {SILVER}, {DAILY}, {FEATURES},
            aged AS (SELECT *, date_diff('day', sale_date, (SELECT MAX(sale_date) FROM lags)) AS age FROM lags),
            folds AS (SELECT *, age < fold * {K.FORECAST_DAYS} AS test
                      FROM aged JOIN (SELECT CAST(unnest(range(1, 7)) AS INTEGER) AS fold) ON age >= (fold - 1) * {K.FORECAST_DAYS})
            SELECT fold, COUNT(*) FILTER (WHERE NOT test) AS train_days, MAX(sale_date) FILTER (WHERE NOT test) AS train_end,
                   MIN(sale_date) FILTER (WHERE test) AS test_start, round(AVG(abs(daily_revenue - lag_7)) FILTER (WHERE test), 4) AS mae,
                   round(sqrt(AVG((daily_revenue - lag_7) ** 2) FILTER (WHERE test)), 3) AS rmse, COUNT(*) FILTER (WHERE test) AS sample_count
            FROM folds GROUP BY fold""",
        "direct_forecast_checked": f"""WITH {SILVER}, last AS (SELECT MAX(CAST(InvoiceTimestamp AS DATE)) AS day FROM silver)
            SELECT CAST(day + ahead AS DATE) AS prediction_date, ahead AS horizon, TRUE AS inside
            FROM last, (SELECT CAST(unnest(range(1, {K.FORECAST_DAYS + 1})) AS INTEGER) AS ahead)""",
        "future_features": f"""WITH {SILVER}, {DAILY}, {FEATURES},
            recent AS (SELECT *, row_number() OVER (ORDER BY sale_date DESC) AS age FROM series),
            latest AS (
              SELECT MAX(sale_date) AS newest,
                     CAST(SUM(exact_revenue) FILTER (WHERE age <= 7) AS DOUBLE) / COUNT(*) FILTER (WHERE age <= 7) AS lag_7,
                     CAST(SUM(exact_revenue) FILTER (WHERE age <= 30) AS DOUBLE) / COUNT(*) FILTER (WHERE age <= 30) AS lag_30
              FROM recent),
            days AS (SELECT CAST(newest + CAST(d AS INTEGER) AS DATE) AS prediction_date, lag_7, lag_30
                     FROM latest, (SELECT unnest(range(1, 31)) AS d))
            SELECT prediction_date, CAST(dayofyear(prediction_date) AS INTEGER) AS day_of_year,
                   CAST(month(prediction_date) AS INTEGER) AS month,
                   CAST(dayofweek(prediction_date) + 1 AS INTEGER) AS day_of_week,
                   lag_7, lag_30, lag_7 AS rolling_mean_7 FROM days""",
        "customer_features": f"WITH {SILVER}, {BASE}, {customer_features(AS_OF)} SELECT * FROM people",
        "customer_clusters_checked": f"""WITH {SILVER}, {BASE}, {customer_features(AS_OF)}
            SELECT CustomerID, recency, frequency, monetary, TRUE AS nearest FROM people""",
        "sales_forecast_checked": f"""WITH {SILVER}, last AS (SELECT MAX(CAST(InvoiceTimestamp AS DATE)) AS day FROM silver)
            SELECT CAST(day + ahead AS DATE) AS prediction_date, TRUE AS inside
            FROM last, (SELECT CAST(unnest(range(1, {K.FORECAST_DAYS + 1})) AS INTEGER) AS ahead)""",
        "model_reload": f"""WITH {SILVER}, {BASE}, {customer_features(AS_OF)}
            SELECT 'forecast' AS model, CAST({K.FORECAST_DAYS} AS BIGINT) AS rows, TRUE AS same
            UNION ALL SELECT 'clusters', COUNT(*), TRUE FROM people""",
        "cluster_profile": f"""WITH {LABELLED},
            p AS (SELECT cluster, COUNT(*) AS "count", {statistics('recency')}, {statistics('frequency')},
                         {statistics('monetary')} FROM labelled GROUP BY cluster)
            SELECT *, {percent('"count"', 'CAST(SUM("count") OVER () AS HUGEINT)')} AS percentage,
                   CAST(MIN("count") OVER () AS DOUBLE) / MAX("count") OVER () AS balance_ratio FROM p""",
        "cluster_balance": f"WITH {LABELLED}, {BALANCE} SELECT * FROM balance",
        "cluster_sizes": f'WITH {LABELLED} SELECT cluster, COUNT(*) AS "count" FROM labelled GROUP BY cluster',
        "regression_metrics": f"WITH {predictions('made')}, {errors('errs', 'made')} SELECT * FROM errs",
        "model_impact": f"""WITH {predictions('was', 5)}, {predictions('now', 2)}, {errors('e5', 'was')}, {errors('e2', 'now')},
            {values('base', 'e5')}, {values('cur', 'e2')},
            pairs AS (SELECT cur.model, cur.metric, base.value AS b, cur.value AS c
                      FROM base JOIN cur ON base.model = cur.model AND base.metric = cur.metric)
            SELECT model, metric || '_improvement_pct' AS impact,
                   CASE WHEN b = 0 THEN 0 ELSE round((c - b) / b * 100, 2) END AS value FROM pairs
            UNION ALL SELECT model, 'forecast_accuracy_improvement', round(b - c, 2) FROM pairs WHERE metric = 'mae'
            UNION ALL SELECT model, 'model_reliability_score', round(value * 100, 1) FROM cur WHERE metric = 'r_squared'""",
        "model_health": f"{HEALTH} SELECT * FROM health",
        "model_report": f"""{HEALTH} SELECT COUNT(*) AS models_evaluated,
            COALESCE(arg_max(status, model) FILTER (WHERE status <> 'healthy'), 'healthy') AS overall_health,
            CAST(SUM(alert_count) AS BIGINT) AS total_alerts FROM health""",
        "completeness": f"WITH {LINES} {COMPLETENESS}",
        "freshness": "WITH newest AS (SELECT MAX(ts) AS now FROM events), aged AS ("
        "SELECT event_type, (epoch_us((SELECT now FROM newest)) - epoch_us(MAX(ts))) / CAST(3600000000 AS DOUBLE) AS age "
        "FROM events GROUP BY event_type) "
        + metric(
            "'events_' || event_type || '_freshness'", "round(age, 6)", K.MAX_FRESHNESS_HOURS, "data_quality",
            "age <= 2", "'warning'", "(SELECT now FROM newest)", "aged",
        ),
        "accuracy_drift": f"WITH {predictions('made')} {accuracy()}",
        "prediction_volume": f"WITH {predictions('made')} {volume()}",
        "feature_drift": metric(
            "'lines_' || feature || '_drift'", "round(abs(now - was) / was, 9)", K.MAX_FEATURE_DRIFT,
            "model_performance", "abs(now - was) / was <= 0.1", "'warning'", AS_OF,
            "(" + " UNION ALL ".join(
                f"""SELECT '{c}' AS feature, CAST(CAST(SUM({exact(c)}) FILTER (WHERE l_linestatus <> 'F') AS VARCHAR) AS DOUBLE)
                    / COUNT({c}) FILTER (WHERE l_linestatus <> 'F') AS now,
                    CAST(CAST(SUM({exact(c)}) FILTER (WHERE l_linestatus = 'F') AS VARCHAR) AS DOUBLE)
                    / COUNT({c}) FILTER (WHERE l_linestatus = 'F') AS was FROM lineitem"""
                for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
            ) + ")",
        ),
        "distribution_drift": f"""WITH apart AS (
              SELECT 'flag' AS model, l_linestatus = 'F' AS early, * FROM lineitem
              UNION ALL SELECT 'units', l_quantity < 25, * FROM lineitem),
            long AS (UNPIVOT (SELECT model, early, CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice,
                CAST(l_discount AS DOUBLE) AS l_discount, CAST(l_tax AS DOUBLE) AS l_tax FROM apart)
              ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME feature VALUE x),
            counts AS (SELECT model, feature, x, COUNT(*) FILTER (WHERE early) AS was, COUNT(*) FILTER (WHERE NOT early) AS now FROM long GROUP BY ALL),
            shares AS (SELECT model, feature, SUM(was) OVER (w ORDER BY x) / SUM(was) OVER w - SUM(now) OVER (w ORDER BY x) / SUM(now) OVER w AS gap
              FROM counts WINDOW w AS (PARTITION BY model, feature)),
            ks AS (SELECT model, feature, MAX(abs(gap)) AS distance FROM shares GROUP BY ALL)
            SELECT model || '_' || feature || '_distribution_drift' AS name, CAST({K.MAX_FEATURE_DRIFT} AS DOUBLE) AS threshold,
                   'model_performance' AS metric_type, {AS_OF} AS "timestamp",
                   CASE WHEN distance <= {K.MAX_FEATURE_DRIFT} THEN 'healthy' ELSE 'unhealthy' END AS status,
                   CASE WHEN distance > {K.MAX_FEATURE_DRIFT} THEN 'warning' END AS alert_level FROM ks""",
        "model_age": metric(
            "model || '_age_days'", "round(days, 6)", K.MAX_MODEL_AGE_DAYS, "model_performance", "days <= 30", "'warning'", AS_OF,
            f"""(SELECT o_orderpriority AS model, date_diff('microseconds', MAX(o_orderdate), {AS_OF}) / 86400000000.0::DOUBLE AS days
                FROM orders GROUP BY 1)""",
        ),
        "pipeline_success": f"WITH {RUNS} {success()}",
        "pipeline_duration": f"WITH {RUNS} {duration()}",
        "alerts": f"WITH {ALERTS} SELECT * FROM alert_rows",
        "alert_routes": f"""WITH {ALERTS} SELECT id, level, unnest(CASE level WHEN 'critical' THEN ['log', 'email', 'slack']
            WHEN 'warning' THEN ['log', 'email'] ELSE ['log'] END) AS channel FROM alert_rows""",
        "active_alerts": f"WITH {ALERTS} SELECT * FROM alert_rows WHERE level <> 'warning'",
        "critical_alerts": f"WITH {ALERTS} SELECT * FROM alert_rows WHERE level = 'critical'",
        "metrics_summary": f"""WITH {ALERTS}, now AS (SELECT MAX("timestamp") AS t FROM log)
            SELECT COUNT(*) AS total_metrics,
                   COUNT(*) FILTER (WHERE "timestamp" > (SELECT t FROM now) - INTERVAL 24 HOUR) AS recent_metrics,
                   (SELECT COUNT(*) FROM alert_rows WHERE level <> 'warning') AS active_alerts,
                   CASE WHEN bool_and(status = 'healthy') FILTER (WHERE "timestamp" > (SELECT t FROM now) - INTERVAL 24 HOUR)
                        THEN 'healthy' ELSE 'unhealthy' END AS health_status,
                   CAST(NULL AS VARCHAR) AS message
            FROM metric_rows""",
        "recent_metrics": f'{metric_sets} SELECT * FROM metric_rows ORDER BY "timestamp" DESC, name LIMIT 10',
        "monitoring_cycle": f"""WITH {LINES}, {RUNS}, {predictions('made')},
            newest AS (SELECT date_diff('microseconds', MAX(ts), {AS_OF}) / CAST(3600000000 AS DOUBLE) AS age FROM events),
            cycle AS ({LINES_COMPLETENESS} UNION ALL {accuracy()} UNION ALL {volume()} UNION ALL {success(AS_OF)}
              UNION ALL {duration(AS_OF)} UNION ALL """
        + metric(
            "'events_freshness'", "age", K.MAX_FRESHNESS_HOURS, "data_quality", "age <= 2", "'warning'", AS_OF, "newest"
        )
        + """) SELECT metric_type, status, COUNT(*) AS metrics, COUNT(alert_level) AS alerts FROM cycle GROUP BY 1, 2""",
        "revenue_series": f"WITH {SIMPLE}, d AS ({SIMPLE_DAILY}) SELECT SaleDate, TotalRevenue FROM d",
        "revenue_totals": f"""WITH {SIMPLE} SELECT COUNT(DISTINCT CAST(InvoiceDate AS DATE)) AS days,
            {cents('SUM(units)')} AS total_revenue FROM simple""",
        "top10_lists": f"""WITH {SIMPLE}, p AS ({TOP_PRODUCTS} LIMIT 10),
            c AS ({SIMPLE_COUNTRY} ORDER BY CountryRevenue DESC, Country LIMIT 10)
            SELECT 'product' AS list, Description AS entry, CAST(TotalSold AS DOUBLE) AS measure FROM p
            UNION ALL SELECT 'country', Country, CountryRevenue FROM c""",
        "top20_customers": f"WITH {SIMPLE}, {SIMPLE_RFM} {best(20)}",
        "top5_customers": f"WITH {SIMPLE}, {SIMPLE_RFM} {best(5)}",
        "customer_kpis": f"""WITH {SIMPLE}, {SIMPLE_RFM}
            SELECT COUNT(*) AS customers, {kpi('Monetary')}, {kpi('Frequency')}, {kpi('Recency')} FROM rfm""",
        "value_histogram": f"WITH {SIMPLE}, {SIMPLE_RFM}, {HISTOGRAM}",
        "country_share": f"""WITH {SIMPLE}, c AS ({SIMPLE_COUNTRY} ORDER BY CountryRevenue DESC, Country LIMIT 5)
            SELECT Country, CountryRevenue, round(CountryRevenue / SUM(CountryRevenue) OVER () * 100, 2) AS share_pct FROM c""",
        "csv_ingest": f"WITH {LINES}, {BAD_LINES} SELECT *, {AS_OF} AS ingestion_timestamp FROM delivered",
        "table_overwrite": lines,
        "table_append": lines,
        "run_log_source": f"WITH {RUNS} SELECT * FROM log",
        "job_detailed_tables": f"""WITH {SILVER}, {DAILY}, {PRODUCTS}, {BASE}, {RFM},
            cltv AS (WITH {CLTV}), countries AS ({COUNTRY}),
            ranked AS (SELECT *, rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank,
                       rank() OVER (ORDER BY total_quantity_sold DESC) AS quantity_rank FROM products) """
        + stored_tables(DETAILED, ["daily", "countries", "ranked", "rfm", "cltv"]),
        "job_simple_tables": f"""WITH {SIMPLE}, {SIMPLE_RFM}, days AS ({SIMPLE_DAILY}), best AS ({TOP_PRODUCTS} LIMIT 20),
            countries AS ({SIMPLE_COUNTRY}) """
        + stored_tables(SIMPLE_TABLES, ["days", "best", "countries", "rfm", "projected", "projected"]),
        "job_detailed": country,
        "job_simple": f"WITH {SIMPLE}, {SIMPLE_RFM} SELECT * FROM projected",
        "stream_windows": f"WITH {WINDOWS} SELECT * FROM windows",
        "stream_sliding_windows": f"WITH {SLIDING}",
        "stream_alerts": f"""WITH {WINDOWS},
            peaks AS (
              SELECT 'events_' || event_type || '_peak' AS name, high AS value, COALESCE(mean + 3 * deviation, high) AS threshold,
                     'data_quality' AS metric_type, window_start AS "timestamp", 'warning' AS alert_level
              FROM windows WHERE high > mean + 3 * deviation)
            SELECT name || '_' || CAST(CAST(floor(epoch("timestamp")) AS BIGINT) AS VARCHAR) || '_' ||
                   substr(md5(name || '|' || metric_type || '|' || alert_level || '|' || CAST(epoch_us("timestamp") AS VARCHAR)), 1, 8) AS id,
                   'Data_Quality Alert: ' || name AS title,
                   printf('Metric %s is %.3f, threshold: %.3f', name, value, threshold) AS description,
                   alert_level AS level, name AS metric_name, value AS current_value, round(threshold, 4) AS threshold,
                   "timestamp", false AS resolved
            FROM peaks""",
        "stream_cleaning": f"WITH {SILVER} SELECT {SILVER_COLUMNS} FROM silver",
        "stream_redelivery": f"WITH {SILVER} SELECT {SILVER_COLUMNS} FROM silver",
        "stream_past_anomalies": f"""WITH {WINDOWS}, fine AS (
              SELECT event_type, date_trunc('day', ts) AS window_start, COUNT(*) AS n, AVG("value") AS mean,
                     stddev_samp("value") AS deviation, MAX("value") AS high
              FROM events GROUP BY 1, 2 HAVING date_trunc('day', ts) IN (SELECT window_start FROM windows)),
            moments AS (
              SELECT event_type, window_start, high, SUM(n) OVER past AS past_n, SUM(n * mean) OVER past / SUM(n) OVER past AS past_mean,
                     SUM((n - 1) * COALESCE(deviation, 0) ** 2 + n * (mean - 50) ** 2) OVER past AS squares
              FROM fine WINDOW past AS (PARTITION BY event_type ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
            judged AS (
              SELECT *, CASE WHEN past_n > 1
                THEN past_mean + 3 * sqrt(greatest((squares - past_n * (past_mean - 50) ** 2) / (past_n - 1), 0)) END AS most FROM moments)
            SELECT 'events_' || event_type || '_past_peak' AS name, high AS value, round(COALESCE(most, high), 4) AS threshold,
                   'data_quality' AS metric_type, window_start AS "timestamp",
                   CASE WHEN high > most THEN 'unhealthy' ELSE 'healthy' END AS status,
                   CASE WHEN high > most THEN 'warning' END AS alert_level
            FROM judged""",
        "stream_validation": f"""WITH {LINES}, {BAD_LINES} SELECT CASE WHEN corrupt THEN 'quarantine' ELSE 'valid' END AS "check",
            InvoiceNo, StockCode, Quantity, UnitPrice, corrupt, corrupt_text, delivery FROM delivered""",
        "stream_quality": f"""WITH {LINES}, c AS ({LINES_COMPLETENESS})
            SELECT name, value, threshold, status, alert_level FROM c""",
        "stream_daily_sales": dated_daily,
        "stream_daily_rollup": dated_daily,
    }
