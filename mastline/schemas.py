"""Declared table schemas.  Dates are ISO text, as the layers carry them."""

from pyspark.sql import types as T

_READING = [
    T.StructField("tower_id", T.LongType()),
    T.StructField("region", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("signal_strength", T.DoubleType()),
    T.StructField("data_volume_mb", T.DoubleType()),
]
_LINEAGE = [
    T.StructField("_run_id", T.StringType()),
    T.StructField("_source_file", T.StringType()),
    T.StructField("_ingested_at", T.StringType()),
    T.StructField("_execution_date", T.StringType()),
]

# Position of a row in its source, kept so that "first in file order" survives
# the move to Parquet: file part, byte offset of the scan split, row in scan.
ROW_SEQ = T.StructType(
    [
        T.StructField("part", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("row", T.LongType()),
    ]
)

BRONZE_SCHEMA = T.StructType([*_READING, *_LINEAGE, T.StructField("_row_seq", ROW_SEQ)])

SILVER_SCHEMA = T.StructType(
    [
        *_READING,
        T.StructField("event_datetime", T.TimestampType()),
        T.StructField("event_date", T.StringType()),
        T.StructField("event_hour", T.IntegerType()),
        *_LINEAGE,
    ]
)

FACT_SCHEMA = T.StructType(
    [
        T.StructField("tower_id", T.LongType()),
        T.StructField("region", T.StringType()),
        T.StructField("avg_signal_strength", T.DoubleType()),
        T.StructField("min_signal_strength", T.DoubleType()),
        T.StructField("max_signal_strength", T.DoubleType()),
        T.StructField("stddev_signal_strength", T.DoubleType()),
        T.StructField("total_data_volume_mb", T.DoubleType()),
        T.StructField("avg_data_volume_mb", T.DoubleType()),
        T.StructField("reading_count", T.LongType()),
        T.StructField("execution_date", T.StringType()),
    ]
)

_ROLLUP = [
    T.StructField("total_data_volume_mb", T.DoubleType()),
    T.StructField("avg_signal_strength", T.DoubleType()),
    T.StructField("tower_count", T.LongType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("execution_date", T.StringType()),
]
HOURLY_SCHEMA = T.StructType(
    [T.StructField("region", T.StringType()), T.StructField("event_hour", T.IntegerType()), *_ROLLUP]
)
DAILY_SCHEMA = T.StructType([T.StructField("region", T.StringType()), *_ROLLUP])

SKETCH_SCHEMA = T.StructType(
    [
        T.StructField("region", T.StringType()),
        T.StructField("event_hour", T.IntegerType()),
        T.StructField("towers", T.BinaryType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("execution_date", T.StringType()),
    ]
)

DQ_SCHEMA = T.StructType(
    [
        T.StructField("check_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("failed_rows", T.LongType()),
        T.StructField("checked_at", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("execution_date", T.StringType()),
    ]
)

LEDGER_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("execution_date", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("event_at", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("records_processed", T.LongType()),
        T.StructField("run_id", T.StringType()),
    ]
)
