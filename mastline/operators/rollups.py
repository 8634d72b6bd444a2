"""The three gold aggregates, each for any number of dates in one plan.

Rows are folded into states per region, hour and tower (or as few of these as an aggregate
needs); states of a finer grain merge into those of a coarser one, so all three
aggregates can share one scan.  A state has one row per tower, which makes tower counts exact
and spreads a hot region over its towers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mastline.constants import DAILY, FACT, HOURLY
from mastline.functions.numeric import Moments, nan_to_null, round_half_even

_SIGNAL = Moments("signal_strength", squares=True)
_PLAIN_SIGNAL = Moments("signal_strength")  # for aggregates without a deviation
_VOLUME = Moments("data_volume_mb")
_DATE = "execution_date"


def states(df: DataFrame, keys: list[str], whole: list[str], date_column: str = "_execution_date", signal: Moments = _SIGNAL) -> DataFrame:
    """One row per ``keys`` and date with the mergeable state of all measures; rows without a key of ``whole`` are left out."""
    needed = df.select(
        F.col(date_column).alias(_DATE),
        *keys,
        "timestamp",
        nan_to_null(F.col("signal_strength").cast("double")).alias("signal_strength"),
        nan_to_null(F.col("data_volume_mb").cast("double")).alias("data_volume_mb"),
    )
    for key in whole:  # unlike dropna, these reach the Parquet scan
        needed = needed.where(F.col(key).isNotNull())
    extremes = [F.min("signal_strength").alias("low"), F.max("signal_strength").alias("high")] if signal.squares else []
    return (
        _VOLUME.prepare(signal.prepare(needed))
        .groupBy(*keys, _DATE)
        .agg(*signal.state(), *_VOLUME.state(), *extremes, F.count("timestamp").alias("readings"))
    )


def _merged(finer: DataFrame, keys: list[str], signal: Moments, *more: Column) -> DataFrame:
    """States of a coarser grain."""
    extremes = [F.min("low").alias("low"), F.max("high").alias("high")] if signal.squares else []
    return finer.groupBy(*keys, _DATE).agg(
        *signal.merge(), *_VOLUME.merge(), *extremes, F.sum("readings").alias("readings"), *more
    )


def _total_volume() -> Column:
    # A group without any volume sums to zero, not NULL.
    return round_half_even(F.coalesce(_VOLUME.sum(), F.lit(0.0)), 2).alias("total_data_volume_mb")


def _mean_signal() -> Column:
    return round_half_even(_SIGNAL.mean(), 4).alias("avg_signal_strength")


def _fact(state: DataFrame) -> DataFrame:
    return state.select(
        "tower_id",
        "region",
        _mean_signal(),
        round_half_even(F.col("low"), 4).alias("min_signal_strength"),
        round_half_even(F.col("high"), 4).alias("max_signal_strength"),
        round_half_even(_SIGNAL.deviation(), 4).alias("stddev_signal_strength"),
        _total_volume(),
        round_half_even(_VOLUME.mean(), 2).alias("avg_data_volume_mb"),
        F.col("readings").alias("reading_count"),
        _DATE,
    )


def _rollup(by_tower: DataFrame, keys: list[str], signal: Moments = _PLAIN_SIGNAL) -> DataFrame:
    """A region rollup from states per ``keys`` and tower: as many towers as rows that name one."""
    return _merged(by_tower, keys, signal, F.count("tower_id").alias("tower_count")).select(
        *keys, _total_volume(), _mean_signal(), "tower_count", F.col("readings").alias("record_count"), _DATE
    )


def fact_snapshot(df: DataFrame, date_column: str = "_execution_date") -> DataFrame:
    """One row per tower, region and execution date."""
    return _fact(states(df, ["tower_id", "region"], ["tower_id", "region"], date_column))


def hourly_rollup(df: DataFrame, date_column: str = "_execution_date") -> DataFrame:
    """One row per region, UTC hour and execution date."""
    keys = ["region", "event_hour"]
    return _rollup(states(df, [*keys, "tower_id"], keys, date_column, _PLAIN_SIGNAL), keys)


def daily_rollup(df: DataFrame, date_column: str = "_execution_date") -> DataFrame:
    """One row per region and execution date."""
    return _rollup(states(df, ["region", "tower_id"], ["region"], date_column, _PLAIN_SIGNAL), ["region"])


def base_states(df: DataFrame, date_column: str = "_execution_date") -> DataFrame:
    """The states that all three aggregates follow from, by one scan of ``df``."""
    return states(df, ["region", "event_hour", "tower_id"], ["region"], date_column)


def tower_states(base: DataFrame) -> DataFrame:
    """``base_states`` without their hours: what the fact snapshot and the daily aggregate follow from."""
    return _merged(base, ["region", "tower_id"], _SIGNAL)


def from_base(base: DataFrame, by_tower: DataFrame | None = None) -> dict[str, DataFrame]:
    """The three aggregates from ``base_states`` and, if stored, the ``tower_states`` of these."""
    by_tower = tower_states(base) if by_tower is None else by_tower
    return {
        FACT: _fact(by_tower.where(F.col("tower_id").isNotNull())),
        HOURLY: _rollup(base.where(F.col("event_hour").isNotNull()), ["region", "event_hour"]),
        DAILY: _rollup(by_tower, ["region"]),
    }


def tower_sketches(df: DataFrame, date_column: str = "_execution_date", size: int = 12) -> DataFrame:
    """One mergeable sketch of the towers per region, hour and execution date, for approximate counts of any coarser grain.

    A sketch of 2^size registers errs by some 0.8 / sqrt(2^size), 1.3 % for 12, and has a few kilobytes.
    """
    present = df.where(F.col("region").isNotNull() & F.col("event_hour").isNotNull())
    return present.groupBy("region", "event_hour", F.col(date_column).alias(_DATE)).agg(
        F.hll_sketch_agg("tower_id", F.lit(size)).alias("towers"), F.count("timestamp").alias("record_count")
    )


def approximate_towers(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, tower_count, record_count) by merging stored sketches; readings are not scanned again."""
    return sketches.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("towers")).alias("tower_count"), F.sum("record_count").alias("record_count")
    )


# Presentation order of each aggregate within a date.
ORDERS = {
    FACT: ["tower_id", "region"],
    HOURLY: ["region", "event_hour"],
    DAILY: ["region"],
}
