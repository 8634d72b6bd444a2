import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mastline.operators import clean, dedup
from mastline.operators.clean import clean_readings
from mastline.operators.dedup import duplicate_counts, keep_first
from tests.conftest import DAY, MIDNIGHT, rows_of

TEXT = "tower_id string, region string, timestamp string, signal_strength string, data_volume_mb string"
HOUR = 3600


def row(tower="101", region="North", at=MIDNIGHT, signal="-75.0", volume="100.0"):
    return (tower, region, None if at is None else str(at), signal, volume)


@pytest.fixture
def raw(frame):
    def make(rows, **kw):
        return frame(rows, TEXT, **kw).withColumns(
            {"_run_id": F.lit("old"), "_source_file": F.lit("f.csv"), "_ingested_at": F.lit("t")}
        )

    return make


def cleaned(df, **kw):
    return clean_readings(df, "run-1", order=["seq"], **kw)


def test_types(raw):
    out = cleaned(raw([row()]))
    types = {f.name: f.dataType for f in out.schema}
    assert types["tower_id"] == T.LongType()
    assert types["timestamp"] == T.LongType()
    assert types["signal_strength"] == types["data_volume_mb"] == T.DoubleType()
    assert types["event_datetime"] == T.TimestampType()
    assert types["event_hour"] == T.IntegerType()
    got = out.first()
    assert (got.tower_id, got.signal_strength, got.data_volume_mb) == (101, -75.0, 100.0)


def test_time_columns(raw):
    got = rows_of(cleaned(raw([row(at=MIDNIGHT + 5 * HOUR + 59), row(at=MIDNIGHT + 24 * HOUR)])), "seq")
    assert [(r["event_date"], r["event_hour"]) for r in got] == [(DAY, 5), ("2025-07-24", 0)]
    # A late reading keeps the date of its file.
    assert {r["_execution_date"] for r in got} == {DAY}


def test_event_datetime_is_the_instant(raw):
    out = cleaned(raw([row(at=MIDNIGHT + 90)])).select(F.unix_seconds("event_datetime").alias("s"))
    assert out.first().s == MIDNIGHT + 90


def test_unparsable_metrics_become_null_and_stay(raw):
    got = cleaned(raw([row(signal="n/a?", volume="lots")])).first()
    assert (got.signal_strength, got.data_volume_mb) == (None, None)


@pytest.mark.parametrize("tower, kept", [("1e3", 1000), ("101.0", 101), ("101.5", None), ("bad", None)])
def test_tower_text(raw, tower, kept):
    assert [r.tower_id for r in cleaned(raw([row(tower)])).collect()] == ([kept] if kept else [])


def test_strict_rejects_fractional_towers(raw):
    with pytest.raises(Exception, match="non-integral tower_id"):
        cleaned(raw([row("101.5")]), strict=True).collect()
    assert cleaned(raw([row("bad"), row("7")]), strict=True).count() == 1


def test_first_in_order_survives(raw):
    rows = [row(volume="1"), row("102"), row(volume="2"), row(volume="3")]
    for partitions in (1, 5):
        out = cleaned(raw(rows).repartition(partitions))
        assert sorted((r.tower_id, r.data_volume_mb) for r in out.collect()) == [(101, 1.0), (102, 100.0)]


def test_duplicates_differ_by_any_key_part(raw):
    rows = [row(), row("102"), row(region="South"), row(at=MIDNIGHT + 1)]
    assert cleaned(raw(rows)).count() == 4


def test_same_key_on_two_dates_is_kept(raw):
    both = raw([row()]).union(raw([row()], date="2025-07-24"))
    assert cleaned(both).count() == 2


@pytest.mark.parametrize("gap", [{"tower": None}, {"region": None}, {"at": None}, {"tower": "x"}])
def test_null_keys_are_dropped(raw, gap):
    assert [r.tower_id for r in cleaned(raw([row(**gap), row("103")])).collect()] == [103]


def test_a_row_losing_its_key_does_not_shadow_its_copy(raw):
    rows = [row(), row("102", None), row("103"), row("102", "South")]
    assert sorted(r.tower_id for r in cleaned(raw(rows)).collect()) == [101, 102, 103]


def test_lineage(raw):
    got = cleaned(raw([row()])).first()
    assert (got["_run_id"], got["_source_file"], got["_ingested_at"]) == ("run-1", "f.csv", "t")
    assert got["_execution_date"] == DAY


def test_extra_columns_pass_through(raw):
    assert cleaned(raw([row()]).withColumn("vendor", F.lit("v"))).first().vendor == "v"


def test_numeric_input_with_nan(frame):
    out = clean_readings(frame([(1, "N", MIDNIGHT, float("nan"), 1.0)]), order=["seq"]).first()
    assert out.signal_strength is None


def test_hot_key_is_pruned_before_the_shuffle(spark):
    df = spark.range(0, 60_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id"
    )
    out = keep_first(df, ["k"], ["id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one below the exchange, one above
    assert out.count() == df.select("k").distinct().count()
    assert out.where("k = 0").first().id == 0


def test_duplicate_counts_take_every_copy_and_treat_nulls_as_equal(spark):
    rows = [("a", 1), ("a", 1), ("a", 2), ("a", None), ("a", None), ("b", 1), ("c", 5), ("c", 5), ("c", 5)]
    df = spark.createDataFrame(rows, "g string, k int")
    got = {r.g: r.duplicate_rows for r in duplicate_counts(df, "g", ["k"]).collect()}
    assert got == {"a": 4, "b": 0, "c": 3}


# -- repeats without sorting -----------------------------------------------------

PLACED = "tower_id bigint, region string, timestamp bigint, note string, _execution_date string, _row_seq struct<part:string,block:bigint,row:bigint>"


def placed(spark, n=600):
    """Keys that repeat within and across splits, the first copy with the smallest place; a third of all rows share one key."""
    import random

    rng = random.Random(4)
    rows = []
    for i in range(n):
        key = 7 if i % 3 == 0 else rng.randrange(150)
        rows.append((key, None if key % 11 == 0 else f"r{key % 2}", MIDNIGHT, f"row {i}", "d" + str(i % 2), ("", (i // 100) << 30, (rng.randrange(5) << 33) + i)))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, PLACED).repartition(5)


@pytest.mark.parametrize("most", [1000, 3])
def test_first_rows_are_those_that_sorting_keeps(spark, most):
    df = placed(spark)
    keys = ["timestamp", "tower_id", "region", "_execution_date"]
    repeated = dedup.repeated_keys(df, keys, dedup.file_position())
    got = dedup.only_first(df, repeated, keys, dedup.file_position(), most)
    want = dedup.keep_first(df, keys, ["_row_seq.part", "_row_seq.block", F.col("_row_seq.row").bitwiseAND(F.lit((1 << 33) - 1))])
    assert sorted(r.note for r in got.collect()) == sorted(r.note for r in want.collect())
    assert got.columns == df.columns and 100 < got.count() < 400


def test_repeats_are_found_without_a_sort_or_a_row_per_copy(spark):
    df = placed(spark)
    keys = ["timestamp", "tower_id", "region", "_execution_date"]
    repeated = dedup.repeated_keys(df, keys, dedup.file_position())
    plan = repeated._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and plan.count("Exchange hashpartitioning") == 1 and "note" not in plan.split("Exchange hashpartitioning")[0]
    kept = dedup.only_first(df, repeated, keys, dedup.file_position())
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan.replace("SortAggregate", "") and "BroadcastHashJoin" in plan


def test_files_of_a_date_are_in_order_of_their_names(spark):
    df = placed(spark).withColumn("_row_seq", F.col("_row_seq").withField("part", F.concat(F.lit("part-"), F.pmod(F.hash("note"), F.lit(3)).cast("string"))))
    typed = df.withColumns({"signal_strength": F.lit(1.0), "data_volume_mb": F.lit(1.0)})
    placed_ = clean.with_position(clean.keyed_readings(typed), dedup.part_ranks(typed, "_execution_date"))
    got = clean.finished(clean.without_repeats(placed_, clean.repeats(placed_)))
    low = F.col("_row_seq.row").bitwiseAND(F.lit((1 << 33) - 1))
    want = clean_readings(typed.withColumn("_row_seq", F.col("_row_seq").withField("row", low)))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.columns == want.columns


def test_file_position_orders_like_its_parts(spark):
    places = [("", 0, 5), ("", 0, (3 << 33) + 6), ("", 1, 0), ("", 1 << 45, (1 << 33) - 1), ("", (1 << 45) + 1, 0)]
    df = spark.createDataFrame([(p,) for p in places], "_row_seq struct<part:string,block:bigint,row:bigint>")
    got = [r[0] for r in df.select(dedup.file_position()).collect()]
    assert got == sorted(got) and len(set(got)) == len(got)
