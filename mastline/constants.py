"""Names, bounds and tokens that results must agree on.

Everything in this file is a literal of the data contract (column names, table
names, file-name format, valid ranges, missing-value tokens).  No logic.
"""

# Source columns in file order, with the kind each one is expected to have.
EXPECTED_KINDS = {
    "tower_id": "int",
    "region": "object",
    "timestamp": "int",
    "signal_strength": "float",
    "data_volume_mb": "float",
}
REQUIRED_COLUMNS = list(EXPECTED_KINDS)

# A reading is unique on these within one execution date.
NATURAL_KEY = ["tower_id", "region", "timestamp"]

# Valid signal range in dBm, both ends included, and the lowest valid volume.
SIGNAL_MIN = -120.0
SIGNAL_MAX = -40.0
VOLUME_MIN = 0.0

# Lineage columns of the bronze layer.
LINEAGE_COLUMNS = ["_run_id", "_source_file", "_ingested_at", "_execution_date"]

# Tracked tables, in pipeline order.
BRONZE = "bronze.network_metrics_raw"
SILVER = "silver.network_metrics_clean"
FACT = "gold.fact_tower_daily_snapshot"
HOURLY = "gold.network_metrics_hourly"
DAILY = "gold.network_metrics_daily"
TRACKED_TABLES = [BRONZE, SILVER, FACT, HOURLY, DAILY]

# Bookkeeping tables.
DQ_LOG = "pipeline.dq_log"
LEDGER = "pipeline.pipeline_control"
SKETCHES = "gold.tower_sketches"

# Daily file name: prefix, yyyyMMdd, suffix.
FILE_PREFIX = "network_metrics_"
FILE_SUFFIX = ".csv"

# Text that a CSV field may hold to mean "missing" (the pandas defaults).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Text that makes a whole column boolean under type inference.
BOOLEAN_TOKENS = ["True", "TRUE", "true", "False", "FALSE", "false"]

# Longest error text kept in the ledger.
ERROR_TEXT_LIMIT = 2000

# Run states.
RUNNING = "running"
SUCCESS = "success"
FAIL = "fail"
SKIPPED = "skipped"
