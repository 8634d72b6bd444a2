import pytest
from pyspark.sql import functions as F

from mastline.constants import REQUIRED_COLUMNS
from mastline.operators import checks
from tests.conftest import DAY, MIDNIGHT, READING

GOOD = [
    (101, "North", MIDNIGHT, -75.0, 100.0),
    (102, "South", MIDNIGHT + 3600, -85.0, 200.0),
    (103, "East", MIDNIGHT + 7200, -65.0, 150.0),
]


def changed(index, **values):
    names = REQUIRED_COLUMNS
    rows = [dict(zip(names, r)) for r in GOOD]
    rows[index].update(values)
    return [tuple(r[n] for n in names) for r in rows]


@pytest.fixture
def verdict(frame):
    """Status, message and failed rows of one check on the given rows."""

    def run(name, rows=GOOD, drop=(), extra=(), **kw):
        df = frame(rows).drop("seq", *drop)
        for c in extra:
            df = df.withColumn(c, F.lit(1))
        r = checks.run_checks(df, checks=[name], **kw).where(F.col("execution_date") == DAY).first()
        assert r.check_name == name
        return r.status, r.message, r.failed_rows

    return run


def dates(spark, columns_by_date):
    return spark.createDataFrame(list(columns_by_date.items()), "execution_date string, columns array<string>")


def test_not_empty(verdict, spark, frame):
    assert verdict("not_empty") == ("pass", "3 rows found.", 0)
    assert verdict("not_empty", [], columns_by_date=dates(spark, {DAY: REQUIRED_COLUMNS})) == (
        "fail", "File contains zero rows.", 0,
    )


def test_schema_columns(verdict):
    assert verdict("schema_columns")[:2] == (
        "pass", "All required columns present. Extra columns (ignored): {'_execution_date'}",
    )
    assert verdict("schema_columns", drop=["signal_strength", "region"])[:2] == (
        "fail", "Missing columns: {'region', 'signal_strength'}",
    )
    status, message, _ = verdict("schema_columns", extra=["vendor"])
    assert (status, "'vendor'" in message) == ("pass", True)


def test_no_extra_columns(verdict, spark):
    only = dates(spark, {DAY: REQUIRED_COLUMNS})
    assert verdict("schema_columns", columns_by_date=only)[:2] == ("pass", "All required columns present.")


def test_null_check(verdict):
    assert verdict("null_check") == ("pass", "No nulls in required columns.", 0)
    assert verdict("null_check", changed(0, signal_strength=None)) == ("warn", "Nulls found — signal_strength=1", 1)
    assert verdict("null_check", changed(0, tower_id=None, data_volume_mb=None)) == (
        "warn", "Nulls found — tower_id=1, data_volume_mb=1", 2,
    )
    assert verdict("null_check", changed(0, signal_strength=float("nan")))[2] == 1
    assert verdict("null_check", drop=["signal_strength"])[0] == "pass"


@pytest.mark.parametrize(
    "signal, bad", [(-30.0, 1), (-125.0, 1), (-120.0, 0), (-40.0, 0), (-39.9999, 1), (None, 0), (float("nan"), 0)]
)
def test_signal_range(verdict, signal, bad):
    expected = (
        ("warn", "1 rows outside expected range [-120.0, -40.0] dBm.", 1)
        if bad
        else ("pass", "All values in [-120.0, -40.0] dBm.", 0)
    )
    assert verdict("signal_range", changed(0, signal_strength=signal)) == expected


@pytest.mark.parametrize("volume, bad", [(-5.0, 1), (0.0, 0), (None, 0), (-0.0, 0)])
def test_data_volume_positive(verdict, volume, bad):
    expected = ("warn", "1 rows with negative data_volume_mb.", 1) if bad else ("pass", "All data_volume_mb values ≥ 0.", 0)
    assert verdict("data_volume_positive", changed(1, data_volume_mb=volume)) == expected


@pytest.mark.parametrize(
    "at, bad", [(MIDNIGHT - 1, 1), (MIDNIGHT, 0), (MIDNIGHT + 86399, 0), (MIDNIGHT + 86400, 1), (1700000000, 1), (None, 0)]
)
def test_timestamp_freshness(verdict, at, bad):
    expected = (
        ("warn", f"1 rows have timestamps outside {DAY}.", 1) if bad else ("pass", f"All timestamps within {DAY}.", 0)
    )
    assert verdict("timestamp_freshness", changed(0, timestamp=at)) == expected


def test_timestamp_freshness_in_another_zone(verdict):
    # Midnight UTC is still the day before in New York.
    assert verdict("timestamp_freshness", tz="America/New_York")[2] == 3


def test_timestamp_freshness_of_an_unreadable_date(spark, frame):
    r = checks.run_checks(frame(GOOD, date="someday"), checks=["timestamp_freshness"]).first()
    assert (r.status, r.failed_rows) == ("warn", 0)
    assert r.message == "Could not validate freshness: time data 'someday' does not match format '%Y-%m-%d'"


@pytest.mark.parametrize(
    "name, column",
    [("signal_range", "signal_strength"), ("data_volume_positive", "data_volume_mb"), ("timestamp_freshness", "timestamp")],
)
def test_missing_column_is_a_warning(verdict, name, column):
    assert verdict(name, drop=[column]) == ("warn", f"Column {column} missing, skipped.", 0)


def test_duplicate_rows(verdict):
    assert verdict("duplicate_rows") == ("pass", "No duplicate rows.", 0)
    assert verdict("duplicate_rows", [*GOOD, GOOD[0]]) == (
        "warn", "2 duplicate rows on ['tower_id', 'region', 'timestamp'].", 2,
    )
    same_tower = changed(1, tower_id=101)
    assert verdict("duplicate_rows", same_tower, drop=["region", "timestamp"]) == (
        "warn", "2 duplicate rows on ['tower_id'].", 2,
    )
    assert verdict("duplicate_rows", drop=["tower_id", "region", "timestamp"])[:2] == (
        "warn", "Key columns missing, skipped.",
    )


def test_all_checks_in_order(frame):
    results = checks.run_checks(frame(GOOD))
    assert [r.check_name for r in results.collect()] == checks.ALL_CHECKS
    assert not checks.any_failure(results)
    checks.require_quality(results)


def test_warnings_do_not_fail(frame):
    results = checks.run_checks(frame(changed(0, signal_strength=-125.0)))
    assert not checks.any_failure(results)
    digest = checks.gate_digest(results).first()
    assert (digest.has_failures, digest.failed_checks, digest.warned_checks) == (False, "[]", "['signal_range']")


def test_missing_column_fails(frame):
    assert checks.any_failure(checks.run_checks(frame(GOOD).drop("signal_strength")))


def test_dates_are_judged_apart(spark, frame):
    """Columns and rows differ by date; an absent column is not a column of nulls."""
    lean = [c for c in REQUIRED_COLUMNS if c != "signal_strength"]
    union = frame(GOOD).unionByName(
        frame(GOOD, date="2025-07-24").withColumn("signal_strength", F.lit(None).cast("double"))
    )
    by_date = dates(spark, {DAY: REQUIRED_COLUMNS, "2025-07-24": lean, "2025-07-25": REQUIRED_COLUMNS})
    results = checks.run_checks(union, by_date)
    got = {(r.execution_date, r.check_name): (r.status, r.message) for r in results.collect()}
    assert len(got) == 21
    assert got["2025-07-24", "schema_columns"] == ("fail", "Missing columns: {'signal_strength'}")
    assert got["2025-07-24", "null_check"] == ("pass", "No nulls in required columns.")
    assert got["2025-07-24", "signal_range"] == ("warn", "Column signal_strength missing, skipped.")
    assert got["2025-07-25", "not_empty"][0] == "fail"
    assert got["2025-07-25", "duplicate_rows"] == ("pass", "No duplicate rows.")
    assert got[DAY, "signal_range"][0] == "pass"
    with pytest.raises(checks.QualityError) as caught:
        checks.require_quality(results)
    assert str(caught.value) == (
        'DQ hard failures: ["2025-07-24: [\'schema_columns\']", "2025-07-25: [\'not_empty\']"]'
    )


def test_text_columns_are_compared_as_numbers(spark):
    rows = [("1", "N", str(MIDNIGHT), "-30", "-1", DAY), ("x", "N", "later", "n/a", "much", DAY)]
    df = spark.createDataFrame(rows, READING.replace("bigint", "string").replace("double", "string") + ", _execution_date string")
    got = {r.check_name: r.failed_rows for r in checks.run_checks(df).collect()}
    assert (got["signal_range"], got["data_volume_positive"], got["timestamp_freshness"], got["null_check"]) == (1, 1, 0, 0)
