import pytest
from pyspark.sql import functions as F

from mastline import Engine
from mastline.constants import BRONZE, DAILY, DQ_LOG, FACT, HOURLY, LEDGER, REQUIRED_COLUMNS, SILVER, TRACKED_TABLES
from mastline.operators import rollups
from mastline.operators.checks import QualityError
from mastline.operators.kinds import SchemaEvolutionError
from tests.conftest import DAY, MIDNIGHT, write_csv

HEAD = ",".join(REQUIRED_COLUMNS)
NEXT, THIRD = "2025-07-24", "2025-07-25"


def lines(date_index=0, towers=3, head=HEAD, tail=""):
    at = MIDNIGHT + date_index * 86400
    body = [f"{100 + t},North,{at + 900 * i},-7{t}.5,{10 * t + i}.25{tail}" for t in range(towers) for i in range(4)]
    return "\n".join([head, *body]) + "\n"


@pytest.fixture
def engine(spark, tmp_path):
    (tmp_path / "in").mkdir()
    return Engine(spark, str(tmp_path / "in"), str(tmp_path / "lake"))


@pytest.fixture
def drop(tmp_path):
    return lambda date, text: write_csv(tmp_path / "in", date, text)


def states(df):
    return {(r.execution_date, r.table_name): (r.status, r.records_processed) for r in df.collect()}


def test_daily_run(engine, drop):
    drop(DAY, lines() + f"100,North,{MIDNIGHT},-99,99\n,South,{MIDNIGHT},-70,1\n")
    ledger = states(engine.run("r1", DAY))
    assert ledger == {
        (DAY, BRONZE): ("success", 14),
        (DAY, SILVER): ("success", 12),
        (DAY, FACT): ("success", 3),
        (DAY, HOURLY): ("success", 1),
        (DAY, DAILY): ("success", 1),
    }
    (day,) = engine.read_table(DAILY).collect()
    assert (day.region, day.tower_count, day.record_count) == ("North", 3, 12)
    assert day.total_data_volume_mb == sum(10 * t + i + 0.25 for t in range(3) for i in range(4))
    silver = engine.read_silver(DAY)
    assert "_row_seq" not in silver.columns
    # The first copy in the file wins.
    assert silver.where(f"tower_id = 100 AND timestamp = {MIDNIGHT}").first().data_volume_mb == 0.25


def test_stored_gold_states_have_few_parts(engine, drop, spark, monkeypatch):
    drop(DAY, lines(towers=5))
    seen = []
    built = rollups.from_base
    monkeypatch.setattr(rollups, "from_base", lambda *stored: seen.extend(stored) or built(*stored))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        engine.run("r1", DAY)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(seen) == 2  # hours and towers, each merged once for all tables
    assert all(df.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism for df in seen)


def test_gold_in_presentation_order(engine, drop):
    drop(DAY, lines(towers=5) + f"7,East,{MIDNIGHT},-70.5,1\n7,West,{MIDNIGHT},-70.5,1\n")
    drop(NEXT, lines(1, towers=1))
    engine.run("r1", DAY, start=DAY, end=NEXT)
    fact = [(r.execution_date, r.tower_id, r.region) for r in engine.read_gold(FACT).collect()]
    assert fact == sorted(fact) and len(fact) == 8
    assert [r.region for r in engine.read_gold(DAILY, DAY).collect()] == ["East", "North", "West"]
    hourly = [(r.region, r.event_hour) for r in engine.read_gold(HOURLY, [DAY]).collect()]
    assert hourly == [("East", 0), ("North", 0), ("West", 0)]


def test_bronze_keeps_every_row_with_lineage(engine, drop):
    drop(DAY, lines() + f"100,North,{MIDNIGHT},-99,99\n")
    assert engine.ingest_bronze(DAY, "r1") == {DAY: 13}
    row = engine.read_bronze(DAY).first()
    assert (row["_run_id"], row["_source_file"], row["_execution_date"]) == ("r1", "network_metrics_20250723.csv", DAY)
    assert len(row["_ingested_at"]) == 19
    types = {f.name: f.dataType.simpleString() for f in engine.read_bronze(DAY).schema}
    assert (types["tower_id"], types["timestamp"], types["signal_strength"]) == ("bigint", "bigint", "double")


def test_quality_log(engine, drop):
    drop(DAY, lines() + f"100,North,{MIDNIGHT},-130,99\n")
    engine.run("r1", DAY)
    log = {r.check_name: r for r in engine.read_table(DQ_LOG, {"execution_date": DAY}).collect()}
    assert len(log) == 7
    assert log["signal_range"].status == log["duplicate_rows"].status == "warn"
    assert log["schema_columns"].message == (
        "All required columns present. Extra columns (ignored): "
        "{'_execution_date', '_ingested_at', '_run_id', '_source_file'}"
    )
    assert {r.run_id for r in log.values()} == {"r1"} and all(r.checked_at for r in log.values())


def test_quality_log_as_json(engine, drop, spark, tmp_path):
    drop(DAY, lines())
    engine.run("r1", DAY)
    engine.export_dq_json(DAY, str(tmp_path / "json"))
    got = spark.read.json(str(tmp_path / "json"))
    assert got.count() == 7
    assert {"check_name", "status", "message", "failed_rows", "checked_at", "run_id"} <= set(got.columns)


def test_backfill_skips_missing_dates(engine, drop):
    drop(DAY, lines())
    drop(THIRD, lines(2, towers=2))
    ledger = states(engine.run("r1", DAY, start=DAY, end=THIRD))
    assert len(ledger) == 15
    assert ledger[DAY, BRONZE] == ("success", 12)
    assert ledger[THIRD, BRONZE] == ("success", 8)
    assert ledger[THIRD, FACT] == ("success", 2)
    assert {v for k, v in ledger.items() if k[0] == NEXT} == {("skipped", None)}
    notes = engine.ledger.state("r1").where("status = 'skipped'").select("error_message").distinct().collect()
    assert [n[0] for n in notes] == [f"No source file for date(s): ['{NEXT}']"]


def test_one_bound_alone_is_a_daily_run(engine, drop):
    drop(DAY, lines())
    assert {k[0] for k in states(engine.run("r1", DAY, start="2025-07-01"))} == {DAY}


def test_nothing_to_do(engine):
    ledger = engine.run("r1", DAY)
    assert states(ledger) == {(DAY, t): ("skipped", None) for t in TRACKED_TABLES}
    assert ledger.first().error_message == f"No source file for date(s): ['{DAY}']"
    assert engine.read_table(BRONZE).count() == 0


def test_rerun_replaces_its_dates_only(engine, drop):
    drop(DAY, lines())
    drop(NEXT, lines(1))
    engine.run("r1", DAY, start=DAY, end=NEXT)
    before = sorted(map(tuple, engine.read_table(FACT).collect()))
    engine.run("r2", DAY)
    assert sorted(map(tuple, engine.read_table(FACT).collect())) == before
    runs = {r["_execution_date"]: r["_run_id"] for r in engine.read_table(SILVER).collect()}
    assert runs == {DAY: "r2", NEXT: "r1"}
    drop(DAY, lines(towers=1))
    engine.run("r3", DAY)
    assert {r.execution_date: r.n for r in engine.read_table(FACT).groupBy("execution_date").agg(F.count("*").alias("n")).collect()} == {DAY: 1, NEXT: 3}


def test_reload_left_without_usable_rows_empties_its_date(engine, drop):
    drop(DAY, lines())
    drop(NEXT, lines(1))
    engine.run("r1", DAY, start=DAY, end=NEXT)
    drop(DAY, f"{HEAD}\n,North,{MIDNIGHT},-70.5,1.5\n")
    ledger = states(engine.run("r2", DAY))
    assert ledger[DAY, SILVER] == ("success", 0) and ledger[DAY, FACT] == ("success", 0)
    assert {r.execution_date for r in engine.read_table(FACT).collect()} == {NEXT}


def test_changed_type_stops_before_any_write(engine, drop):
    drop(DAY, lines())
    drop(NEXT, lines(1).replace("-70.5", "weak"))
    with pytest.raises(SchemaEvolutionError, match="signal_strength: expected float, got object"):
        engine.run("r1", DAY, start=DAY, end=NEXT)
    assert engine.read_table(BRONZE).count() == 0
    ledger = states(engine.ledger.state("r1"))
    assert {v for k, v in ledger.items() if k[1] == BRONZE} == {("fail", None)}
    assert ledger[DAY, FACT] == ("running", None)


def test_hard_failure_is_logged_for_all_dates_then_raised(engine, drop):
    lean = HEAD.replace(",signal_strength", "")
    drop(DAY, lines())
    drop(NEXT, f"{lean}\n1,North,{MIDNIGHT + 86400},5.5\n")
    drop(THIRD, f"{HEAD}\n")
    with pytest.raises(QualityError) as caught:
        engine.run("r1", DAY, start=DAY, end=THIRD)
    assert str(caught.value) == (
        f"DQ hard failures: [\"{NEXT}: ['schema_columns']\", \"{THIRD}: ['not_empty']\"]"
    )
    log = engine.read_table(DQ_LOG)
    assert log.count() == 21
    ledger = states(engine.ledger.state("r1"))
    assert ledger[DAY, BRONZE] == ("success", 12) and ledger[THIRD, BRONZE] == ("success", 0)
    assert ledger[DAY, SILVER][0] == ledger[NEXT, SILVER][0] == "fail"
    assert ledger[DAY, DAILY][0] == "running"
    assert engine.read_table(SILVER).count() == 0


def test_source_columns_come_and_go(engine, drop):
    drop(DAY, lines())
    drop(NEXT, lines(1, head=f"{HEAD},vendor", tail=",acme"))
    engine.run("r1", DAY)
    engine.run("r2", NEXT)
    vendors = {r["_execution_date"]: r.vendor for r in engine.read_table(SILVER).select("_execution_date", "vendor").distinct().collect()}
    assert vendors == {DAY: None, NEXT: "acme"}
    log = engine.read_table(DQ_LOG, {"execution_date": NEXT, "check_name": "schema_columns"}).first()
    assert "'vendor'" in log.message
    # A reload of the old date is still reported with its own columns.
    engine.run("r3", DAY)
    log = engine.read_table(DQ_LOG, {"execution_date": DAY, "check_name": "schema_columns"}).first()
    assert "vendor" not in log.message


def test_a_file_of_zero_bytes_fails_bronze(engine, drop):
    drop(DAY, "")
    with pytest.raises(ValueError, match="No columns to parse from file"):
        engine.run("r1", DAY)
    assert states(engine.ledger.state("r1"))[DAY, BRONZE][0] == "fail"


def test_stage_calls_without_a_run(engine, drop):
    drop(DAY, lines())
    with pytest.raises(FileNotFoundError):
        engine.ingest_bronze([DAY, NEXT], "r1")
    assert engine.ingest_bronze([DAY], "r1") == {DAY: 12}
    assert engine.run_dq_checks(DAY, "r1").count() == 7
    assert engine.process_silver(DAY, "r1") == {DAY: 12}
    assert engine.process_gold(DAY, "r1") == {FACT: {DAY: 3}, HOURLY: {DAY: 1}, DAILY: {DAY: 1}}


def test_several_files_per_date(spark, tmp_path, drop):
    (tmp_path / "in").mkdir()
    drop(DAY, lines(towers=9))
    engine = Engine(spark, str(tmp_path / "in"), str(tmp_path / "lake"), rows_per_file=10)
    engine.run("r1", DAY)
    assert engine.read_silver(DAY).count() == 36
    assert engine.read_table(FACT).count() == 9


def test_strict_mode_refuses_blank_integers(spark, tmp_path, drop):
    (tmp_path / "in").mkdir()
    drop(DAY, lines() + f",North,{MIDNIGHT},-70.5,1.5\n")
    strict = Engine(spark, str(tmp_path / "in"), str(tmp_path / "lake"), strict=True)
    with pytest.raises(SchemaEvolutionError, match="tower_id: expected int, got float64"):
        strict.run("r1", DAY)


def test_tables_of_any_name(engine, spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "part string, n int")
    assert engine.write_table("mine.things", rows, "part") == {"a": 2, "b": 1}
    assert engine.write_table("mine.things", rows.where("n = 2"), "part", ["a", "b"]) == {"a": 1, "b": 0}
    again = Engine(spark, engine.source, engine.base)
    assert [(r.part, r.n) for r in again.read_table("mine.things", {"part": "a"}).collect()] == [("a", 2)]
    assert again.read_table("mine.nothing", {"part": "a"}).count() == 0
    assert again.read_table(LEDGER).count() == 0
    for bad in ("../out", "a..b", ""):
        with pytest.raises(ValueError, match="table name"):
            again.read_table(bad)
    with pytest.raises(ValueError, match="partitioned by"):
        engine.write_table("mine.things", rows, "n")
    with pytest.raises(ValueError, match="only written by runs"):
        engine.write_table(LEDGER, rows, "part")


def test_quality_log_as_json_in_a_run(spark, tmp_path, drop, engine):
    drop(DAY, lines())
    out = str(tmp_path / "log")
    logging = Engine(spark, engine.source, engine.base, dq_json=out)
    logging.run("r1", DAY)
    assert spark.read.json(out).count() == 7
    assert logging.read_table(LEDGER, {"run_id": "r1"}).count() == 5


def test_jobs_of_a_run_do_not_grow_with_its_dates(spark, tmp_path):
    import datetime

    used = []
    for n in (40, 100):  # beyond 32 folders Spark lists them by a job
        folder = tmp_path / f"in{n}"
        folder.mkdir()
        days = [datetime.date(2025, 1, 1) + datetime.timedelta(k) for k in range(n)]
        for d in days:
            start = int(datetime.datetime(d.year, d.month, d.day, tzinfo=datetime.UTC).timestamp())
            rows = [f"{t},North,{start + 60 * t},-75.5,{t}" for t in range(4)]
            write_csv(folder, str(d), "\n".join([",".join(REQUIRED_COLUMNS), *rows, rows[0], ""]))
        engine = Engine(spark, str(folder), str(tmp_path / f"lake{n}"))
        spark.sparkContext.setJobGroup(f"run of {n}", "")
        state = engine.run("r", str(days[-1]), str(days[0]), str(days[-1]))
        used.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"run of {n}")))
        assert {(r.status, r.records_processed) for r in state.collect() if "daily" in r.table_name} >= {("success", 1)}
        assert engine.read_silver([str(d) for d in days]).count() == 4 * n
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < used[1] <= used[0] + 3, used


def test_received_volume_and_sketches_of_a_lake(engine, drop):
    drop(DAY, lines())
    engine.run("r1", DAY)
    got = engine.received_volume("2025-07-22", "2025-07-24").orderBy("execution_date").collect()
    assert [r.status for r in got] == ["missing", "first", "missing"] and got[1].rows == engine.read_bronze(DAY).count()
    engine.write_tower_sketches(DAY)
    exact = {r.region: r.tower_count for r in engine.read_gold("gold.network_metrics_daily").collect()}
    about = {r.region: r.tower_count for r in engine.approximate_towers(DAY, ["region"]).collect()}
    assert about == exact


@pytest.mark.parametrize("parts", [False, True])
def test_both_ways_to_find_first_copies_agree(spark, tmp_path, parts):
    folder = tmp_path / "in"
    folder.mkdir()
    rows = [f"{i % 7},{'N' if i % 3 else 'S'},{MIDNIGHT + i % 5},-75.5,{i}" for i in range(300)]
    if parts:
        (folder / "network_metrics_20250723.csv").mkdir()
        for k in range(3):
            text = "\n".join([",".join(REQUIRED_COLUMNS), *rows[k * 100 : k * 100 + 100], ""])
            (folder / "network_metrics_20250723.csv" / f"part-{k}.csv").write_text(text)
    else:
        write_csv(folder, DAY, "\n".join([",".join(REQUIRED_COLUMNS), *rows, ""]))
    got = []
    for most in (1_000_000, 0):
        engine = Engine(spark, str(folder), str(tmp_path / f"lake{most}"), sorted_rows=most)
        engine.run("r", DAY)
        got.append(sorted((r.tower_id, r.region, r.timestamp, r.data_volume_mb) for r in engine.read_silver(DAY).collect()))
    first = {}
    for i in range(300):
        first.setdefault((i % 7, "N" if i % 3 else "S", MIDNIGHT + i % 5), float(i))
    assert got[0] == got[1] == sorted((*k, v) for k, v in first.items())
