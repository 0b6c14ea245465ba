"""Names, limits and labels that results must agree on."""

# --- text and time formats -------------------------------------------------
INVOICE_TIME_FORMAT = "M/d/yyyy H:mm"
MANUAL_SOURCE = "manual_input"

# --- business rules --------------------------------------------------------
CREDIT_PREFIX = "C"
NON_SALE_WORDS = ("TEST", "SAMPLE", "ADJUSTMENT")
COUNTRY_ALIASES = {
    "EIRE": "IRELAND",
    "EUROPEAN COMMUNITY": "EUROPE",
    "UNSPECIFIED": "UNKNOWN",
}
GUEST, REGISTERED = "GUEST", "REGISTERED"
REQUIRED_SIMPLE = ("InvoiceNo", "StockCode", "Description", "InvoiceDate", "CustomerID")

# --- scores, segments and bands --------------------------------------------
QUINTILES = (0.2, 0.4, 0.6, 0.8)

# (recency, frequency, monetary) score ranges, lowest and highest included;
# the first row that fits names the segment.
RFM_SEGMENTS = (
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal Customers", (3, 5), (3, 5), (3, 5)),
    ("New Customers", (4, 5), (1, 2), (1, 5)),
    ("At Risk", (1, 2), (3, 5), (1, 5)),
    ("Can't Lose Them", (1, 2), (1, 2), (3, 5)),
    ("Lost", (1, 2), (1, 2), (1, 2)),
    ("Potential Loyalists", (1, 5), (1, 5), (1, 5)),
)
# By number of quintile cut points reached, 0 to 4.
CLTV_BANDS = (
    "Low Value",
    "Low-Medium Value",
    "Medium Value",
    "Medium-High Value",
    "High Value",
)
# By rank of the cluster's mean spend; any further cluster takes the last label.
CLUSTER_LABELS = (
    "Champions",
    "Loyal_Customers",
    "Potential_Loyalists",
    "At_Risk",
    "Lost_Customers",
)
DAYS_PER_YEAR = 365
MONTHS_PER_YEAR = 12
TOP_PRODUCTS, TOP_PRODUCTS_SHORT = 20, 10
HISTOGRAM_BINS = 50
OUTLIER_SIGMAS = 3

# --- models ----------------------------------------------------------------
SEED = 42
FOREST_TREES = 100
CLUSTERS = 5
TRAIN_PERCENT = 80
FORECAST_DAYS = 30
FORECAST_FEATURES = (
    "day_of_year",
    "month",
    "day_of_week",
    "lag_7",
    "lag_30",
    "rolling_mean_7",
)
CUSTOMER_FEATURES = ("recency", "frequency", "monetary", "avg_order_value")

# Model health: metric, side of a breach, limit, status on breach, name, unit, digits shown.
MODEL_CHECKS = (
    ("r_squared", "below", 0.7, "warning", "R-squared", "", 3),
    ("mae", "above", 1000.0, "critical", "MAE", "", 2),
    ("mape", "above", 15.0, "warning", "MAPE", "%", 1),
    ("balance_ratio", "below", 0.3, "warning", "Cluster balance ratio", "", 3),
)
SEVERITY = ("healthy", "warning", "critical")

# --- monitoring ------------------------------------------------------------
HEALTHY, UNHEALTHY = "healthy", "unhealthy"
INFO, WARNING, CRITICAL = "info", "warning", "critical"
DATA_QUALITY = "data_quality"
MODEL_PERFORMANCE = "model_performance"
PIPELINE_HEALTH = "pipeline_health"
MIN_COMPLETENESS = 0.95
MAX_FRESHNESS_HOURS = 2.0
MISSING_FRESHNESS_HOURS = 999.0
BASELINE_ACCURACY = 0.85
MAX_ACCURACY_DRIFT = 0.05
MIN_ACCURACY = 0.8
MIN_PREDICTION_VOLUME = 0.8
MAX_FEATURE_DRIFT = 0.1
MAX_MODEL_AGE_DAYS = 30.0
MIN_SUCCESS_RATE = 0.98
MAX_DURATION_MINUTES = 60.0
ALERT_CHANNELS = {
    INFO: ("log",),
    WARNING: ("log", "email"),
    CRITICAL: ("log", "email", "slack"),
}
RECENT_HOURS = 24
RECENT_METRICS = 10
PIPELINE_END = "pipeline_end"
SUCCESS = "success"
