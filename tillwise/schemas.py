"""Explicit schemas, in DDL, of the tables that cross a job boundary."""

RAW_LINES = (
    "InvoiceNo string, StockCode string, Description string, Quantity int, "
    "InvoiceDate string, UnitPrice double, CustomerID string, Country string"
)

CORRUPT_COLUMN = "_corrupt_record"

METRICS = (
    "name string, value double, threshold double, metric_type string, "
    "timestamp timestamp, status string, alert_level string"
)

ALERTS = (
    "id string, title string, description string, level string, metric_name string, "
    "current_value double, threshold double, timestamp timestamp, resolved boolean"
)

RUN_LOG = (
    "timestamp timestamp, level string, logger string, message string, module string, "
    "function string, line int, exception string, pipeline_name string, event_type string, "
    "status string, duration_seconds double, table_name string, operation string"
)
