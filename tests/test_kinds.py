import io

import pandas as pd
import pytest

from mastline.constants import EXPECTED_KINDS, REQUIRED_COLUMNS
from mastline.operators.kinds import (
    SchemaEvolutionError,
    column_kinds,
    require_stable_schema,
    schema_evolution,
)
from mastline.sources import drops
from tests.conftest import DAY, MIDNIGHT, write_csv

HEAD = ",".join(REQUIRED_COLUMNS)
LINE = f"101,North,{MIDNIGHT},-75.5,100.5"

SOURCES = {
    "plain": f"{HEAD}\n{LINE}\n102,South,{MIDNIGHT},-80.5,1.5\n",
    "blank tower": f"{HEAD}\n{LINE}\n,South,{MIDNIGHT},-80.5,1.5\n",
    "whole signals": f"{HEAD}\n101,North,{MIDNIGHT},-75,100.5\n",
    "word signal": f"{HEAD}\n{LINE}\n102,South,{MIDNIGHT},strong,1.5\n",
    "fraction tower": f"{HEAD}\n101.5,North,{MIDNIGHT},-75.5,100.5\n",
    "number region": f"{HEAD}\n101,5,{MIDNIGHT},-75.5,100.5\n",
    "boolean region": f"{HEAD}\n101,True,{MIDNIGHT},-75.5,100.5\n102,false,{MIDNIGHT},-75.5,100.5\n",
    "empty region": f"{HEAD}\n101,,{MIDNIGHT},-75.5,100.5\n",
    "missing tokens": f"{HEAD}\nNA,North,{MIDNIGHT},n/a,null\n101,None,{MIDNIGHT},-75.5,100.5\n",
    "header only": f"{HEAD}\n",
    "infinite": f"{HEAD}\n101,North,{MIDNIGHT},-inf,inf\n",
    "quoted": f'{HEAD}\n101,"No ""r"", th",{MIDNIGHT},-75.5,100.5\n',
    "exponent tower": f"{HEAD}\n1e3,North,{MIDNIGHT},-7.5e1,1e2\n",
}


def scanned(spark, folder, text):
    write_csv(folder, DAY, text)
    found = [drops.Drop(DAY, str(folder / "network_metrics_20250723.csv"), len(text))]
    heads = drops.headers(spark, found)
    by_date = spark.createDataFrame(list(heads.items()), "execution_date string, columns array<string>")
    return drops.scan(spark, found, heads), by_date


def inferred(text):
    df = pd.read_csv(io.StringIO(text))
    found = []
    for column, kind in EXPECTED_KINDS.items():
        actual = str(df[column].dtype)
        if actual != {"int": "int64", "float": "float64", "object": "object"}[kind]:
            found.append(f"{column}: expected {kind.replace('object', 'string/object')}, got {actual}")
    return df, found


# Default-mode verdict where it differs from the strict one or is a failure.
LENIENT = {"word signal": "fail", "fraction tower": "fail", "number region": "fail", "boolean region": "fail",
           "exponent tower": "fail"}


@pytest.fixture(scope="module")
def judged(spark, tmp_path_factory):
    """Every source under its own date, all judged in one job per mode."""
    folder = tmp_path_factory.mktemp("kinds")
    days = {f"2025-01-{i:02d}": name for i, name in enumerate(SOURCES, 1)}
    found = []
    for day, name in days.items():
        found.append(drops.Drop(day, str(write_csv(folder, day, SOURCES[name])), 1))
    heads = drops.headers(spark, found)
    raw = drops.scan(spark, found, heads)
    by_date = spark.createDataFrame(list(heads.items()), "execution_date string, columns array<string>")
    verdicts = {
        strict: {days[r.execution_date]: r for r in schema_evolution(raw, by_date, strict=strict).collect()}
        for strict in (True, False)
    }
    kinds = {(days[r.execution_date], r.column_name): r.kind for r in column_kinds(raw).collect()}
    return verdicts, kinds


@pytest.mark.parametrize("name", SOURCES)
def test_strict_mode_sees_the_types_a_whole_file_reader_infers(judged, name):
    verdicts, kinds = judged
    df, mismatches = inferred(SOURCES[name])
    row = verdicts[True][name]
    if mismatches:
        assert row.status == "fail"
        assert row.message == (
            f"Column type mismatch detected: {mismatches}. Pipeline aborted to prevent data corruption."
        )
    else:
        assert (row.status, row.message) == ("pass", "No schema changes detected.")
    if len(df):
        assert {c: kinds[name, c] for c in REQUIRED_COLUMNS} == {c: str(df[c].dtype) for c in REQUIRED_COLUMNS}


@pytest.mark.parametrize("name", SOURCES)
def test_default_mode_lets_blanks_and_whole_numbers_pass(judged, name):
    assert judged[0][False][name].status == LENIENT.get(name, "pass")


def test_new_and_dropped_columns_warn(spark, tmp_path):
    raw, by_date = scanned(spark, tmp_path, f"{HEAD},vendor\n{LINE},v\n")
    row = schema_evolution(raw, by_date).first()
    assert (row.status, row.message) == (
        "warn", "New columns detected: {'vendor'}. Iceberg schema will be evolved automatically.",
    )


def test_dropped_column_warns(spark, tmp_path):
    raw, by_date = scanned(spark, tmp_path, f"tower_id,region,timestamp,signal_strength\n101,N,{MIDNIGHT},-75.5\n")
    row = schema_evolution(raw, by_date).first()
    assert (row.status, row.message) == (
        "warn",
        "Columns no longer in source: {'data_volume_mb'}. Existing Iceberg rows will show NULL for these columns.",
    )


def test_type_change_outranks_a_new_column(spark, tmp_path):
    raw, by_date = scanned(spark, tmp_path, f"{HEAD},vendor\n101,N,{MIDNIGHT},weak,1.5,v\n")
    verdicts = schema_evolution(raw, by_date)
    assert verdicts.first().status == "fail"
    with pytest.raises(SchemaEvolutionError, match="aborting bronze write: Column type mismatch detected: .'signal_strength"):
        require_stable_schema(verdicts)
