from pyspark.sql import functions as F

from mastline.operators import rollups, volume
from mastline.sources import calendar
from tests.conftest import MIDNIGHT


def test_volumes_are_held_against_the_last_date_with_rows(spark):
    counts = spark.createDataFrame([("2025-07-02", 100), ("2025-07-03", 49), ("2025-07-05", 99), ("2025-07-06", 198), ("2025-07-07", 99)], "execution_date string, rows long")
    got = volume.received_volume(counts, calendar.date_spine(spark, "2025-07-01", "2025-07-08")).orderBy("execution_date").collect()
    assert [(r.execution_date[-2:], r.rows, r.previous_rows, r.status) for r in got] == [
        ("01", 0, None, "missing"), ("02", 100, None, "first"), ("03", 49, 100, "drop"), ("04", 0, 49, "missing"),
        ("05", 99, 49, "surge"), ("06", 198, 99, "steady"), ("07", 99, 198, "steady"), ("08", 0, 99, "missing"),
    ]
    assert got[4].change == 99 / 49 and got[3].change is None
    assert {r.status for r in volume.received_volume(counts, calendar.date_spine(spark, "2025-07-06", "2025-07-07"), drop=0.6, surge=1.5).collect()} == {"first", "drop"}


def test_sketches_err_within_their_bound_and_merge(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 50 != 0, F.col("id") % 20_011).alias("tower_id"),
        F.when(F.col("id") % 7 != 0, "N").otherwise("S").alias("region"),
        (F.col("id") % 24).cast("int").alias("event_hour"),
        F.lit(MIDNIGHT).alias("timestamp"),
        F.lit("d1").alias("_execution_date"),
    )
    sketches = rollups.tower_sketches(rows)
    for keys in (["region", "execution_date"], ["region", "event_hour", "execution_date"], ["execution_date"]):
        exact = rows.withColumnRenamed("_execution_date", "execution_date").groupBy(*keys).agg(F.count_distinct("tower_id").alias("exact"), F.count("*").alias("n"))
        both = rollups.approximate_towers(sketches, keys).join(exact, keys).collect()
        assert both and all(abs(r.tower_count - r.exact) <= 0.05 * r.exact and r.record_count == r.n for r in both)
    assert sketches.count() == 48
