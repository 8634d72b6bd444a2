import pytest
from pyspark.sql import functions as F

from mastline.constants import BRONZE, FACT, SILVER, TRACKED_TABLES
from mastline.sinks.ledger import RunLedger
from tests.conftest import DAY


@pytest.fixture
def ledger(spark, tmp_path):
    return RunLedger(spark, str(tmp_path / "ledger"))


def by_table(ledger, run="run-1"):
    return {r.table_name: r for r in ledger.state(run).collect()}


def spine(spark, *dates):
    return spark.createDataFrame([(d,) for d in dates], "execution_date string")


def test_insert_opens_a_row(ledger):
    ledger.insert_run("run-1", BRONZE, DAY, "network_metrics_20250723.csv")
    (row,) = ledger.state().collect()
    assert (row.run_id, row.table_name, row.execution_date, row.status) == ("run-1", BRONZE, DAY, "running")
    assert row.file_name == "network_metrics_20250723.csv"
    assert row.start_datetime and row.finish_datetime is None


def test_open_covers_every_table_and_date(spark, ledger):
    ledger.open("run-1", spine(spark, DAY, "2025-07-24"))
    rows = ledger.state("run-1").collect()
    assert len(rows) == 2 * len(TRACKED_TABLES)
    assert {(r.execution_date, r.file_name) for r in rows} == {
        (DAY, "network_metrics_20250723.csv"), ("2025-07-24", "network_metrics_20250724.csv"),
    }


def test_opening_again_keeps_one_row_per_key(spark, ledger):
    ledger.open("run-1", spine(spark, DAY))
    ledger.update_status("run-1", BRONZE, "success", records_processed=5)
    ledger.open("run-1", spine(spark, DAY))
    row = by_table(ledger)[BRONZE]
    assert (row.status, row.finish_datetime, row.records_processed) == ("running", None, 5)
    assert ledger.state("run-1").count() == len(TRACKED_TABLES)


def test_success_and_failure(ledger):
    for t in (BRONZE, SILVER, FACT):
        ledger.insert_run("run-1", t, DAY)
    ledger.update_status("run-1", BRONZE, "success", records_processed=100)
    ledger.update_status("run-1", SILVER, "fail", error_message="RuntimeError: Hard DQ failure")
    rows = by_table(ledger)
    assert (rows[BRONZE].status, rows[BRONZE].records_processed) == ("success", 100)
    assert rows[BRONZE].finish_datetime
    assert (rows[SILVER].status, rows[SILVER].error_message) == ("fail", "RuntimeError: Hard DQ failure")
    assert rows[FACT].status == "running"


def test_absent_values_keep_the_earlier_ones(ledger):
    ledger.insert_run("run-1", BRONZE, DAY)
    ledger.update_status("run-1", BRONZE, "fail", error_message="first", records_processed=7)
    ledger.update_status("run-1", BRONZE, "success")
    row = by_table(ledger)[BRONZE]
    assert (row.status, row.error_message, row.records_processed) == ("success", "first", 7)


def test_update_of_one_date_or_of_all(spark, ledger):
    ledger.open("run-1", spine(spark, DAY, "2025-07-24"))
    ledger.update_status("run-1", BRONZE, "success", records_processed=1, execution_date=DAY)
    state = ledger.state("run-1").where(F.col("table_name") == BRONZE)
    assert {r.execution_date: r.status for r in state.collect()} == {DAY: "success", "2025-07-24": "running"}
    ledger.update_status("run-1", BRONZE, "fail")
    assert {r.status for r in state.collect()} >= {"success"}  # a read is a snapshot
    fresh = ledger.state("run-1").where(F.col("table_name") == BRONZE)
    assert {r.status for r in fresh.collect()} == {"fail"}


def test_closing_touches_running_rows_only(ledger):
    ledger.insert_run("run-1", BRONZE, DAY)
    ledger.insert_run("run-1", SILVER, DAY)
    ledger.insert_run("run-2", SILVER, DAY)
    ledger.update_status("run-1", BRONZE, "success")
    ledger.update_all_running("run-1", "skipped", "No file found")
    rows = by_table(ledger)
    assert (rows[BRONZE].status, rows[BRONZE].error_message) == ("success", None)
    assert (rows[SILVER].status, rows[SILVER].error_message) == ("skipped", "No file found")
    assert by_table(ledger, "run-2")[SILVER].status == "running"


def test_texts_are_kept_whole(ledger):
    ledger.record("run-1", [(BRONZE, DAY, "fail", "x" * 5000, None)])
    ledger.insert_run("run-2", BRONZE, DAY)
    ledger.update_all_running("run-2", "fail", "y" * 5000)
    assert {len(r.error_message) for r in ledger.state().collect()} == {5000}


def test_run_ids_with_path_characters(ledger):
    run = "scheduled__2025-07-23T02:00:00+00:00"
    ledger.insert_run(run, BRONZE, DAY)
    assert ledger.state(run).first().run_id == run


def test_no_ledger_yet(ledger):
    assert ledger.state().count() == 0


def test_a_folded_run_has_the_same_state_in_one_file(spark, tmp_path):
    ledger = RunLedger(spark, str(tmp_path / "ledger"))
    spine = spark.createDataFrame([("2025-07-23",), ("2025-07-24",), ("2025-07-25",)], "execution_date string")
    ledger.open("r1", spine)
    ledger.open("other", spine)
    ledger.record("r1", [(TRACKED_TABLES[0], "2025-07-23", "fail", "lost", 5), (TRACKED_TABLES[0], "2025-07-24", "success", None, 7)])
    ledger.record("r1", [(TRACKED_TABLES[0], "2025-07-23", "success", None, None)])
    ledger.update_status("r1", TRACKED_TABLES[1], "skipped", "none")
    before = sorted(map(tuple, ledger.state("r1").collect()), key=str)
    files = lambda run: [f for f in ledger.table.files.files(f"run_id={run}") if f.endswith(".parquet")]
    assert len(files("r1")) > 3
    others = files("other")
    ledger.fold("r1")
    assert sorted(map(tuple, ledger.state("r1").collect()), key=str) == before and len(before) == 15
    assert len(files("r1")) == 1 and files("other") == others
    ledger.fold("r1")
    ledger.update_all_running("r1", "success")
    after = {(r.table_name, r.execution_date): (r.status, r.error_message, r.records_processed) for r in ledger.state("r1").collect()}
    assert after[TRACKED_TABLES[0], "2025-07-23"] == ("success", "lost", 5) and after[TRACKED_TABLES[1], "2025-07-25"] == ("skipped", "none", None)
    assert {x[0] for x in after.values()} == {"success", "skipped"}
