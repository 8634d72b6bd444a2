import pytest

from mastline.operators import clean, rules
from tests.conftest import MIDNIGHT

TEXT = "tower_id string, region string, timestamp string, signal_strength string, data_volume_mb string"
ROWS = [
    ("1", "N", str(MIDNIGHT), "-75", "1.5"), ("1", "N", str(MIDNIGHT), "-74", "9"), ("x", "N", str(MIDNIGHT), "-75", "1"),
    ("2", None, str(MIDNIGHT), "-75", "1"), ("2", "S", "never", "-75", "1"), ("3", "S", str(MIDNIGHT), "-130", "-1"), ("4", "S", str(MIDNIGHT), "n/a", None),
]


def test_rules_of_readings_say_what_is_written_by_hand(spark, frame):
    df = frame(ROWS, TEXT)
    ruled = rules.Rules(rules.reading_rules(spark))
    assert ruled.key == ["tower_id", "region", "timestamp"]
    want = clean.clean_readings(df, order=["seq"]).drop("event_datetime", "event_date", "event_hour")
    got = ruled.clean(df, ["seq"]).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 3


def test_counts_by_rule(spark, frame):
    counts = rules.Rules(rules.reading_rules(spark)).counts(frame(ROWS, TEXT))
    assert {r.column_name: tuple(r)[2:] for r in counts.collect()} == {
        "tower_id": (7, 0, 1, 0), "region": (7, 1, 0, 0), "timestamp": (7, 0, 1, 0), "signal_strength": (7, 0, 1, 1), "data_volume_mb": (7, 1, 0, 1),
    }


def test_rules_of_another_table(spark, frame):
    table = spark.createDataFrame([(1, "region", "object", True, None, None), (0, "tower_id", "float", False, None, 2.0)], rules.SHAPE)
    df = frame(ROWS, TEXT)
    ruled = rules.Rules(table)
    assert [r.tower_id for r in ruled.clean(df, ["seq"]).orderBy("region").collect()] == [1.0, 2.0]
    assert {r.column_name: r.n_outside for r in ruled.counts(df).collect()} == {"tower_id": 2, "region": 0}


@pytest.mark.parametrize("rows", [[(0, "a", "date", False, None, None)], [(0, "a", "int", True, None, None), (1, "a", "int", True, None, None)]])
def test_rules_that_cannot_be_followed(spark, rows):
    with pytest.raises(rules.RuleError):
        rules.Rules(spark.createDataFrame(rows, rules.SHAPE))
