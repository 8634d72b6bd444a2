from mastline import Engine
from mastline.__main__ import main
from mastline.constants import DAILY, REQUIRED_COLUMNS
from mastline.streaming.arrivals import follow
from tests.conftest import DAY, MIDNIGHT, write_csv

HEAD = ",".join(REQUIRED_COLUMNS)


def one_reading(volume):
    return f"{HEAD}\n101,North,{MIDNIGHT},-75.5,{volume}\n"


def test_files_are_processed_as_they_arrive(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    engine = Engine(spark, str(source), str(tmp_path / "lake"))

    def catch_up():
        stream = follow(engine, str(tmp_path / "checkpoint"))
        stream.awaitTermination(300)
        assert stream.exception() is None
        return {r.execution_date: r.total_data_volume_mb for r in engine.read_table(DAILY).collect()}

    write_csv(source, DAY, one_reading(1.5))
    assert catch_up() == {DAY: 1.5}
    write_csv(source, "2025-07-24", one_reading(2.5))
    assert catch_up() == {DAY: 1.5, "2025-07-24": 2.5}
    runs = {(r.run_id, r.execution_date) for r in engine.ledger.state().collect()}
    assert runs == {("arrival-0", DAY), ("arrival-1", "2025-07-24")}


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    write_csv(tmp_path / "in", DAY, one_reading(1.5))
    main(["--source", str(tmp_path / "in"), "--base", str(tmp_path / "lake"), "--start", DAY, "--end", DAY, "--run-id", "cli"])
    assert capsys.readouterr().out.count("success") == 5


def test_part_files_and_nested_files_arrive(spark, tmp_path):
    source = tmp_path / "in"
    folder = source / f"network_metrics_{DAY.replace('-', '')}.csv"
    folder.mkdir(parents=True)
    (folder / "part-0.csv").write_text(one_reading(1.5))
    (source / "late").mkdir()
    write_csv(source / "late", "2025-07-24", one_reading(2.5))
    engine = Engine(spark, str(source), str(tmp_path / "lake"))
    follow(engine, str(tmp_path / "checkpoint")).awaitTermination(300)
    assert {r.execution_date: r.total_data_volume_mb for r in engine.read_table(DAILY).collect()} == {DAY: 1.5, "2025-07-24": 2.5}
