import random
import statistics
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from mastline.constants import DAILY, FACT, HOURLY
from mastline.operators import rollups
from mastline.operators.rollups import daily_rollup, fact_snapshot, hourly_rollup
from tests.conftest import DAY, MIDNIGHT, rows_of

HOUR = 3600

# Three towers in three regions, two readings each, one per hour.
SIX = [
    (101, "North", MIDNIGHT, -70.0, 100.0),
    (101, "North", MIDNIGHT + HOUR, -80.0, 200.0),
    (102, "South", MIDNIGHT + 2 * HOUR, -85.0, 150.0),
    (102, "South", MIDNIGHT + 3 * HOUR, -95.0, 250.0),
    (103, "East", MIDNIGHT + 4 * HOUR, -60.0, 50.0),
    (103, "East", MIDNIGHT + 5 * HOUR, -70.0, 100.0),
]


@pytest.fixture
def silver(frame):
    def make(rows, **kw):
        return frame(rows, **kw).withColumn("event_hour", F.expr("cast(pmod(timestamp, 86400) div 3600 as int)"))

    return make


def test_fact_grain_and_measures(silver):
    got = rows_of(fact_snapshot(silver(SIX)), "tower_id")
    assert [(r["tower_id"], r["region"]) for r in got] == [(101, "North"), (102, "South"), (103, "East")]
    assert got[0] == {
        "tower_id": 101,
        "region": "North",
        "avg_signal_strength": -75.0,
        "min_signal_strength": -80.0,
        "max_signal_strength": -70.0,
        "stddev_signal_strength": 7.0711,
        "total_data_volume_mb": 300.0,
        "avg_data_volume_mb": 150.0,
        "reading_count": 2,
        "execution_date": DAY,
    }
    assert (got[1]["min_signal_strength"], got[1]["max_signal_strength"]) == (-95.0, -85.0)


def test_hourly_grain_and_measures(silver):
    got = rows_of(hourly_rollup(silver(SIX)), "event_hour")
    assert [r["event_hour"] for r in got] == [0, 1, 2, 3, 4, 5]
    assert {r["tower_count"] for r in got} == {r["record_count"] for r in got} == {1}
    assert (got[0]["region"], got[0]["total_data_volume_mb"], got[0]["execution_date"]) == ("North", 100.0, DAY)


def test_daily_grain_and_measures(silver):
    got = {r["region"]: r for r in rows_of(daily_rollup(silver(SIX)))}
    assert set(got) == {"North", "South", "East"}
    assert got["North"]["total_data_volume_mb"] == 300.0
    assert got["East"]["avg_signal_strength"] == -65.0
    assert {r["record_count"] for r in got.values()} == {2}
    assert {r["execution_date"] for r in got.values()} == {DAY}


def test_column_order(silver):
    df = silver(SIX)
    assert fact_snapshot(df).columns[:2] == ["tower_id", "region"]
    assert hourly_rollup(df).columns == [
        "region", "event_hour", "total_data_volume_mb", "avg_signal_strength", "tower_count", "record_count",
        "execution_date",
    ]
    assert daily_rollup(df).columns == [c for c in hourly_rollup(df).columns if c != "event_hour"]


def test_dates_do_not_mix(silver):
    both = silver(SIX).union(silver(SIX[:1], date="2025-07-24"))
    got = rows_of(daily_rollup(both).where("region = 'North'"), "execution_date")
    assert [(r["execution_date"], r["total_data_volume_mb"]) for r in got] == [(DAY, 300.0), ("2025-07-24", 100.0)]


def test_towers_are_counted_once_per_group(silver):
    rows = [(t, "North", MIDNIGHT + i, -70.0, 1.0) for i, t in enumerate([1, 1, 2, 2, 2, 3])]
    assert daily_rollup(silver(rows)).first().tower_count == 3
    assert hourly_rollup(silver(rows)).first().tower_count == 3


def test_one_reading_has_no_spread(silver):
    assert fact_snapshot(silver(SIX[:1])).first().stddev_signal_strength is None


def test_group_without_values(silver):
    rows = [(1, "North", MIDNIGHT, None, None), (1, "North", MIDNIGHT + 1, None, None)]
    got = fact_snapshot(silver(rows)).first()
    assert got.total_data_volume_mb == 0.0
    assert (got.avg_data_volume_mb, got.avg_signal_strength, got.min_signal_strength) == (None, None, None)
    assert got.reading_count == 2
    assert daily_rollup(silver(rows)).first().total_data_volume_mb == 0.0


def test_nan_counts_as_missing(silver):
    rows = [(1, "North", MIDNIGHT, float("nan"), float("nan")), (1, "North", MIDNIGHT + 1, -70.0, 5.0)]
    got = fact_snapshot(silver(rows)).first()
    assert (got.avg_signal_strength, got.max_signal_strength, got.total_data_volume_mb) == (-70.0, -70.0, 5.0)


def test_rows_without_a_key_are_left_out(silver):
    rows = [*SIX, (None, "North", MIDNIGHT, -70.0, 1.0), (101, None, MIDNIGHT, -70.0, 1.0)]
    assert fact_snapshot(silver(rows)).count() == 3
    assert daily_rollup(silver(rows)).count() == 3
    # A tower-less reading still counts for its region.
    north = daily_rollup(silver(rows)).where("region = 'North'").first()
    assert (north.record_count, north.tower_count) == (3, 1)


def test_rounding_ties_go_to_even(silver):
    volumes = {1: [0.125], 2: [0.375], 3: [1.015], 4: [100.0, 0.125], 5: [1.005, 0.12]}
    rows = [(t, "N", MIDNIGHT + i, -70.0, v) for t, vs in volumes.items() for i, v in enumerate(vs)]
    got = {r.tower_id: r.total_data_volume_mb for r in fact_snapshot(silver(rows)).collect()}
    assert got == {t: float(np.round(sum(vs), 2)) for t, vs in volumes.items()}
    assert (got[1], got[2], got[4]) == (0.12, 0.38, 100.12)


def test_random_groups_against_plain_python(silver):
    rng = random.Random(7)
    rows = [
        (
            rng.randrange(20),
            rng.choice(["N", "S", "E"]),
            MIDNIGHT + rng.randrange(86_400),
            rng.choice([None, rng.randrange(-12000, -4000) / 100]),
            rng.choice([None, rng.randrange(0, 30000) / 100]),
        )
        for _ in range(3000)
    ]
    groups = defaultdict(list)
    for r in rows:
        groups[r[0], r[1]].append(r)
    got = {(r["tower_id"], r["region"]): r for r in rows_of(fact_snapshot(silver(rows).repartition(5)))}
    assert set(got) == set(groups)
    for key, members in groups.items():
        signal = [m[3] for m in members if m[3] is not None]
        volume = [m[4] for m in members if m[4] is not None]
        row = got[key]
        assert row["reading_count"] == len(members)
        assert row["avg_signal_strength"] == pytest.approx(statistics.fmean(signal), abs=5.1e-5)
        assert row["stddev_signal_strength"] == pytest.approx(statistics.stdev(signal), abs=5.1e-5)
        assert (row["min_signal_strength"], row["max_signal_strength"]) == (min(signal), max(signal))
        assert row["total_data_volume_mb"] == pytest.approx(sum(volume), abs=5.1e-3)
        assert row["avg_data_volume_mb"] == pytest.approx(statistics.fmean(volume), abs=5.1e-3)


def test_volumes_of_towers_add_up_to_their_region(silver):
    rng = random.Random(3)
    rows = [(i % 9, "NS"[i % 2], MIDNIGHT + i, -70.0, rng.randrange(10_000) / 100) for i in range(500)]
    df = silver(rows)
    towers = fact_snapshot(df).groupBy("region").agg(F.round(F.sum("total_data_volume_mb"), 2).alias("v"))
    assert {r.region: r.v for r in towers.collect()} == {
        r.region: r.total_data_volume_mb for r in daily_rollup(df).collect()
    }
    assert daily_rollup(df).agg(F.sum("record_count").alias("n")).first().n == 500


def test_hot_region_is_combined_before_the_shuffle(silver):
    plan = daily_rollup(silver(SIX))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    first_exchange = plan.rindex("Exchange")
    assert "partial_count" in plan[first_exchange:]


def test_three_aggregates_from_one_scan(spark, frame, tmp_path):
    rows = [(t, r, MIDNIGHT + 3600 * h + 60 * k, -70.0 - (t or 9) - k / 8 if k else None, (t or 9) + h / 4) for t in (1, 2, 3, None) for r in ("N", "S", None) for h in (0, 5) for k in range(3)]
    silver = frame(rows).withColumn("event_hour", F.when(F.col("timestamp") < MIDNIGHT + 9000, F.hour(F.timestamp_seconds("timestamp"))))
    silver.write.parquet(str(tmp_path / "s"))
    silver = spark.read.parquet(str(tmp_path / "s"))
    base = rollups.base_states(silver).persist()
    built = rollups.from_base(base)
    direct = {FACT: rollups.fact_snapshot, HOURLY: rollups.hourly_rollup, DAILY: rollups.daily_rollup}
    for name, build in direct.items():
        assert rows_of(built[name], *rollups.ORDERS[name]) == rows_of(build(silver), *rollups.ORDERS[name])
        plan = built[name]._jdf.queryExecution().executedPlan().toString()
        head, _, stored = plan.partition("InMemoryTableScan")  # the one scan is that of the stored states
        assert stored and "FileScan" not in head and stored.count("InMemoryTableScan") == 0 and "Expand" not in plan
    base.unpersist()
