from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from mastline.functions import clock
from mastline.sources import calendar
from tests.conftest import DAY, MIDNIGHT

SECONDS = [0, 1, 86399, 86400, -1, MIDNIGHT, MIDNIGHT + 86399, 1709164800, 4102444799]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_date_and_hour_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(s,) for s in SECONDS], "s bigint")
        got = df.select("s", clock.event_date(F.col("s")).alias("d"), clock.event_hour(F.col("s")).alias("h")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for row in got:
        utc = datetime.fromtimestamp(row.s, timezone.utc)
        assert (row.d, row.h) == (utc.strftime("%Y-%m-%d"), utc.hour)


def bounds(spark, date, tz):
    first, last = clock.day_bounds(F.lit(date), tz)
    row = spark.range(1).select(first.alias("a"), last.alias("b")).first()
    return row.a, row.b


def test_day_bounds(spark):
    assert bounds(spark, DAY, "UTC") == (MIDNIGHT, MIDNIGHT + 86399)
    assert bounds(spark, DAY, "Europe/Berlin") == (MIDNIGHT - 7200, MIDNIGHT - 7200 + 86399)
    assert bounds(spark, "someday", "UTC") == (None, None)


def test_day_bounds_across_a_clock_change(spark):
    first, last = bounds(spark, "2025-03-30", "Europe/Berlin")
    assert last - first == 23 * 3600 - 1


def test_file_name_and_back(spark):
    assert clock.file_name(DAY) == "network_metrics_20250723.csv"
    row = spark.range(1).select(
        clock.file_name_of(F.lit(DAY)).alias("n"),
        clock.date_in_path(F.lit("s3a://b/in/network_metrics_20250723.csv")).alias("file"),
        clock.date_in_path(F.lit("file:/x/drop=network_metrics_20250723.csv/part-0-99999999.csv")).alias("part"),
    ).first()
    assert (row.n, row.file, row.part) == ("network_metrics_20250723.csv", DAY, DAY)


def spine(df):
    return [r.execution_date for r in df.orderBy("execution_date").collect()]


def test_date_range_is_inclusive_and_crosses_months(spark):
    assert spine(calendar.date_spine(spark, "2024-02-28", "2024-03-01")) == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert spine(calendar.date_spine(spark, DAY, DAY)) == [DAY]


def test_reversed_range_is_empty(spark):
    assert spine(calendar.date_spine(spark, "2025-07-24", "2025-07-23")) == []


@pytest.mark.parametrize(
    "start, end, expected",
    [
        ("2025-07-01", "2025-07-03", ["2025-07-01", "2025-07-02", "2025-07-03"]),
        ("2025-07-01", None, [DAY]),
        (None, "2025-07-03", [DAY]),
        (None, None, [DAY]),
        ("", "", [DAY]),
        ("2025-07-03", "2025-07-01", []),
    ],
)
def test_run_dates(spark, start, end, expected):
    assert spine(calendar.resolve_dates(spark, DAY, start, end)) == expected
