import pytest
from pyspark.sql import functions as F

from mastline.constants import NA_TOKENS, REQUIRED_COLUMNS
from mastline.operators.dedup import keep_first
from mastline.sources import drops
from mastline.sources.adapters import write_drops
from tests.conftest import DAY, MIDNIGHT, rows_of, write_csv

HEAD = ",".join(REQUIRED_COLUMNS)
LINE = f"101,North,{MIDNIGHT},-75.5,100.5"


def scan(spark, folder):
    found = [drops.Drop(r.execution_date, r.path, r.bytes) for r in drops.manifest(spark, str(folder)).collect()]
    heads = drops.headers(spark, found)
    return drops.scan(spark, found, heads), heads


def test_manifest_lists_daily_files_only(spark, tmp_path):
    write_csv(tmp_path, DAY, f"{HEAD}\n{LINE}\n")
    (tmp_path / "notes.csv").write_text("x\n")
    (tmp_path / "network_metrics_2025072.csv").write_text("x\n")
    (tmp_path / "network_metrics_20251399.csv").write_text("x\n")
    got = drops.manifest(spark, str(tmp_path)).collect()
    assert [r.execution_date for r in got] == [DAY]
    assert got[0].path.endswith("/network_metrics_20250723.csv")
    assert got[0].bytes == len(f"{HEAD}\n{LINE}\n")


def test_manifest_does_not_read_content(spark, tmp_path):
    write_csv(tmp_path, DAY, f"{HEAD}\n")
    plan = drops.manifest(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_manifest_of_a_missing_folder_is_empty(spark, tmp_path):
    assert drops.manifest(spark, str(tmp_path / "nowhere")).count() == 0


def test_availability_splits_requested_dates(spark, tmp_path):
    write_csv(tmp_path, DAY, f"{HEAD}\n{LINE}\n")
    write_csv(tmp_path, "2025-07-20", f"{HEAD}\n{LINE}\n")
    spine = spark.createDataFrame([("2025-07-22",), (DAY,), ("2025-07-24",)], "execution_date string")
    arrivals = drops.manifest(spark, str(tmp_path))
    found, missing = drops.availability(spark, spine, str(tmp_path))
    assert [d.execution_date for d in found] == [DAY]
    assert missing == ["2025-07-22", "2025-07-24"]
    assert [r[0] for r in drops.arrived(spine, arrivals).collect()] == [DAY]
    assert sorted(r[0] for r in drops.missing(spine, arrivals).collect()) == missing


def test_columns_follow_their_names_not_their_places(spark, tmp_path):
    write_csv(tmp_path, DAY, f"{HEAD}\n{LINE}\n")
    turned = ["data_volume_mb", "region", "vendor", "timestamp", "tower_id"]
    write_csv(tmp_path, "2025-07-24", f"{','.join(turned)}\n7.5,South,acme,{MIDNIGHT},102\n")
    raw, heads = scan(spark, tmp_path)
    assert heads == {DAY: REQUIRED_COLUMNS, "2025-07-24": turned}
    first, second = rows_of(raw, "_execution_date")
    assert (first["tower_id"], first["signal_strength"], first["vendor"]) == ("101", "-75.5", None)
    assert (second["tower_id"], second["data_volume_mb"], second["vendor"]) == ("102", "7.5", "acme")
    assert second["signal_strength"] is None
    assert (second["_source_file"], second["_execution_date"]) == ("network_metrics_20250724.csv", "2025-07-24")


def test_missing_value_tokens(spark, tmp_path):
    lines = [f'{i},"{t}",{MIDNIGHT},-75.5,1' for i, t in enumerate(NA_TOKENS)]
    kept = ["North America", "na", "Nan ", "NONE", " NA"]
    lines += [f"{900 + i},{t},{MIDNIGHT},-75.5,1" for i, t in enumerate(kept)]
    write_csv(tmp_path, DAY, "\n".join([HEAD, *lines]))
    got = {int(r["tower_id"]): r["region"] for r in rows_of(scan(spark, tmp_path)[0])}
    assert all(got[i] is None for i in range(len(NA_TOKENS)))
    assert [got[900 + i] for i in range(len(kept))] == kept


def test_quotes_blank_lines_and_short_rows(spark, tmp_path):
    write_csv(tmp_path, DAY, f'{HEAD}\n\n1,"a, ""b""",{MIDNIGHT},-75.5,1\n2,c,{MIDNIGHT}\n\n,,,,\n')
    got = rows_of(scan(spark, tmp_path)[0], F.col("tower_id").asc_nulls_last())
    assert [(r["tower_id"], r["region"], r["data_volume_mb"]) for r in got] == [
        ("1", 'a, "b"', "1"), ("2", "c", None), (None, None, None),
    ]


def test_rows_with_too_many_fields_stop_the_scan(spark, tmp_path):
    write_csv(tmp_path, DAY, f"{HEAD}\n{LINE}\n{LINE},surplus\n")
    with pytest.raises(Exception, match="more fields than its header"):
        scan(spark, tmp_path)[0].collect()


def test_header_only_and_empty_files(spark, tmp_path):
    write_csv(tmp_path, DAY, f"{HEAD}\n")
    write_csv(tmp_path, "2025-07-24", "")
    spine = spark.createDataFrame([(DAY,), ("2025-07-24",), ("2025-07-25",)], "execution_date string")
    found, missing = drops.availability(spark, spine, str(tmp_path))
    assert ([d.execution_date for d in found], missing) == ([DAY, "2025-07-24"], ["2025-07-25"])
    heads = drops.headers(spark, found)
    assert heads == {DAY: REQUIRED_COLUMNS, "2025-07-24": []}
    assert drops.scan(spark, found, heads).count() == 0
    assert drops.scan(spark, found[1:], heads).count() == 0


def test_file_order_survives_splitting(spark, tmp_path):
    """A file read as many splits still yields its first copy of each key."""
    rows = [f"{i % 500},North,{MIDNIGHT},-75.5,{i}" for i in range(20_000)]
    write_csv(tmp_path, DAY, "\n".join([HEAD, *rows]))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        raw, _ = scan(spark, tmp_path)
        assert raw.rdd.getNumPartitions() > 8
        first = keep_first(raw, ["tower_id"], ["_row_seq.part", "_row_seq.block", "_row_seq.row"])
        got = {int(r.tower_id): int(r.data_volume_mb) for r in first.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: i for i in range(500)}


def test_written_drops_keep_row_order_across_part_files(spark, frame, tmp_path):
    rows = [(i % 7, "North", MIDNIGHT, -75.5, float(i)) for i in range(400)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_drops(frame(rows).repartition(3), str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    raw, heads = scan(spark, tmp_path / "out")
    assert heads == {DAY: REQUIRED_COLUMNS}
    assert raw.select("_row_seq.part").distinct().count() > 1
    first = keep_first(raw, ["tower_id"], ["_row_seq.part", "_row_seq.block", "_row_seq.row"])
    assert {int(r.tower_id): float(r.data_volume_mb) for r in first.collect()} == {i: float(i) for i in range(7)}


def test_a_later_file_header_change_is_not_bound_by_position(spark, tmp_path):
    """A header that differs from the one looked up stops the job."""
    write_csv(tmp_path, DAY, f"{HEAD}\n{LINE}\n")
    found = [drops.Drop(DAY, str(tmp_path / "network_metrics_20250723.csv"), 1)]
    swapped = [REQUIRED_COLUMNS[1], REQUIRED_COLUMNS[0], *REQUIRED_COLUMNS[2:]]
    with pytest.raises(Exception, match="(?i)header"):
        drops.scan(spark, found, {DAY: swapped}).collect()


def test_two_sources_of_a_date_are_refused(spark, tmp_path):
    write_csv(tmp_path, DAY, f"{HEAD}\n{LINE}\n")
    (tmp_path / "late").mkdir()
    write_csv(tmp_path / "late", DAY, f"{HEAD}\n{LINE}\n")
    spine = spark.createDataFrame([(DAY,)], "execution_date string")
    with pytest.raises(ValueError, match="Two sources for one date.*late"):
        drops.availability(spark, spine, str(tmp_path))
    with pytest.raises(Exception, match="two sources for"):
        drops.manifest(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("tail", [",", ",,", ',""'])
def test_empty_surplus_field_is_surplus(spark, tmp_path, tail):
    write_csv(tmp_path, DAY, f"{HEAD}\n{LINE}\n{LINE}{tail}\n")
    found = [drops.Drop(r.execution_date, r.path, r.bytes) for r in drops.manifest(spark, str(tmp_path)).collect()]
    with pytest.raises(Exception, match="more fields than its header"):
        drops.scan(spark, found, drops.headers(spark, found)).collect()


# -- line breaks in quoted fields -----------------------------------------------


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k, None) for k in keys}

    def cut(size):
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], "1")

    yield cut
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def odd_region(rng):
    pieces = ["North", "\n", "\r\n", '"', ",", "\n\n", ' ""', "x" * 30, "é漢"]
    return "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 7)))


def as_csv(rows, end="\n"):
    quoted = [[str(a), '"' + b.replace('"', '""') + '"' if b is not None else "", *map(str, rest)] for a, b, *rest in rows]
    return end.join([HEAD, *(",".join(r) for r in quoted)]) + end


@pytest.mark.parametrize("size", [50, 64, 333, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_line_breaks_in_fields_in_files_that_are_split(spark, tmp_path, small_splits, size, end):
    import random

    small_splits(size)
    rng = random.Random(size)
    days = {DAY: 60, "2025-07-24": 7, "2025-07-25": 1}
    want = {}
    for day, n in days.items():
        rows = [(i, odd_region(rng) if i % 3 else "plain", MIDNIGHT + i, -75.5, i / 4) for i in range(n)]
        (tmp_path / f"network_metrics_{day.replace('-', '')}.csv").write_bytes(as_csv(rows, end).encode())
        want[day] = rows
    raw, _ = scan(spark, tmp_path)
    if size < 100:
        assert raw.select("_row_seq.block").distinct().count() > 10
    for day, rows in want.items():
        got = raw.where(F.col("_execution_date") == day).orderBy("_row_seq.part", "_row_seq.block", "_row_seq.row").collect()
        assert [(int(r.tower_id), r.region, int(r.timestamp), float(r.data_volume_mb)) for r in got] == [(a, b, c, e) for a, b, c, _, e in rows]


def test_a_quote_inside_a_field_opens_nothing(spark, tmp_path, small_splits):
    small_splits(40)
    lines = [f'1,5" pipe,{MIDNIGHT},-75.5,1', f'2,"two\nlines, 5"" pipe",{MIDNIGHT},-75.5,2', f'3,"a"b",{MIDNIGHT},-75.5,3', f'4,x"",{MIDNIGHT},-75.5,4', "", f'5,"",{MIDNIGHT},-75.5,5']
    write_csv(tmp_path, DAY, "\n".join([HEAD, *lines, ""]))
    write_csv(tmp_path, "2025-07-24", "\n".join([HEAD, lines[0], lines[3], ""]))
    found = [drops.Drop(r.execution_date, r.path, r.bytes) for r in drops.manifest(spark, str(tmp_path)).collect()]
    assert {p[-12:-4] for p in drops.broken_drops(spark, found)} == {"20250723"}
    got = {int(r["tower_id"]): r["region"] for r in rows_of(scan(spark, tmp_path)[0].where(f"_execution_date = '{DAY}'"))}
    assert got[1] == '5" pipe' and got[2] == 'two\nlines, 5" pipe' and got[4] == 'x""' and got[5] is None and 3 in got


def test_broken_files_are_checked_like_others(spark, tmp_path, small_splits):
    small_splits(40)
    broken = f'7,"a\nb",{MIDNIGHT},-75.5,1'
    write_csv(tmp_path, DAY, f"{HEAD}\n{broken}\n{LINE},surplus\n")
    with pytest.raises(Exception, match="more fields than its header"):
        scan(spark, tmp_path)[0].collect()
    write_csv(tmp_path, DAY, f'{HEAD}\n{broken}\n8,c\n')
    found = [drops.Drop(DAY, str(tmp_path / "network_metrics_20250723.csv"), 99)]
    got = {r.tower_id: (r.region, r.timestamp) for r in drops.scan(spark, found, {DAY: REQUIRED_COLUMNS}).collect()}
    assert got == {"7": ("a\nb", str(MIDNIGHT)), "8": ("c", None)}
    write_csv(tmp_path, DAY, f'{HEAD}\n{broken}\n9,"never\nended\n')
    with pytest.raises(Exception, match="without an end"):
        drops.scan(spark, found, {DAY: REQUIRED_COLUMNS}).collect()
    write_csv(tmp_path, DAY, f"{HEAD}\n{broken}\n")
    swapped = [REQUIRED_COLUMNS[1], REQUIRED_COLUMNS[0], *REQUIRED_COLUMNS[2:]]
    with pytest.raises(Exception, match="(?i)another header"):
        drops.scan(spark, found, {DAY: swapped}).collect()


# -- discovery --------------------------------------------------------------------


def test_only_requested_names_are_looked_into(spark, tmp_path):
    deep = tmp_path / "2025" / "07"
    deep.mkdir(parents=True)
    write_csv(deep, DAY, f"{HEAD}\n{LINE}\n")
    folder = tmp_path / "network_metrics_20250724.csv"
    folder.mkdir()
    (folder / "part-0.csv").write_text("")
    (folder / "part-1.csv").write_text(f"a,\"b \"\"c\"\"\",,A\n{LINE}\n")
    (folder / "_SUCCESS").write_text("x")
    write_csv(tmp_path, "2025-07-25", "")
    dates = [DAY, "2025-07-24", "2025-07-25", "2025-07-26"]
    found, missing = drops.availability(spark, spark.createDataFrame([(d,) for d in dates], "execution_date string"), str(tmp_path))
    assert [(d.execution_date, d.bytes > 0) for d in found] == [(DAY, True), ("2025-07-24", True), ("2025-07-25", False)] and missing == ["2025-07-26"]
    heads = drops.headers(spark, found)
    assert heads == {DAY: REQUIRED_COLUMNS, "2025-07-24": ["a0", 'b "c"', "_c2", "A3"], "2025-07-25": []}
    assert heads["2025-07-24"] == spark.read.csv(str(folder / "part-1.csv"), header=True, escape='"').columns
    assert drops.availability(spark, spark.createDataFrame([], "execution_date string"), str(tmp_path)) == ([], [])
