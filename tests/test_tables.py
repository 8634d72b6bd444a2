import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mastline.sinks.files import partition_folder
from mastline.sinks.tables import DatedTable, LayoutConflictError, SchemaConflictError, union_evolved

SHAPE = "k int, v string, d string"


@pytest.fixture
def table(spark, tmp_path):
    return DatedTable(spark, str(tmp_path / "t"), "d")


@pytest.fixture
def rows(spark):
    return lambda *values, shape=SHAPE: spark.createDataFrame(list(values), shape)


def content(table, *columns):
    df = table.read()
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def test_replace_is_idempotent_and_leaves_other_dates(table, rows):
    both = rows((1, "a", "d1"), (2, "b", "d1"), (3, "c", "d2"))
    assert table.replace(both, ["d1", "d2"]) == {"d1": 2, "d2": 1}
    assert table.replace(both, ["d1", "d2"]) == {"d1": 2, "d2": 1}
    assert table.replace(rows((9, "z", "d1")), ["d1"]) == {"d1": 1}
    assert content(table, "k", "d") == [(3, "d2"), (9, "d1")]


def test_a_date_without_rows_is_cleared(table, rows):
    table.replace(rows((1, "a", "d1"), (2, "b", "d2")), ["d1", "d2"])
    assert table.replace(rows((5, "e", "d2")), ["d1", "d2", "d3"]) == {"d1": 0, "d2": 1, "d3": 0}
    assert content(table, "k", "d") == [(5, "d2")]
    # and can be filled again
    table.replace(rows((6, "f", "d1")), ["d1"])
    assert content(table, "k", "d") == [(5, "d2"), (6, "d1")]


def test_first_write_without_rows(table, rows):
    assert table.replace(rows().limit(0), ["d1"]) == {"d1": 0}
    assert content(table) == []


def test_new_column_is_null_in_old_rows(table, rows):
    table.replace(rows((1, "a", "d1")), ["d1"])
    table.replace(rows((2, "b", "x", "d2"), shape="k int, v string, w string, d string"), ["d2"])
    assert content(table, "k", "w") == [(1, None), (2, "x")]


def test_dropped_column_is_kept_and_null_in_new_rows(table, rows):
    table.replace(rows((1, "a", "d1")), ["d1"])
    table.replace(rows((2, "d2"), shape="k int, d string"), ["d2"])
    assert content(table, "k", "v") == [(1, "a"), (2, None)]
    assert table.schema().names == ["k", "v", "d"]


def test_changed_type_is_refused_and_nothing_changes(table, rows):
    table.replace(rows((1, "a", "d1")), ["d1"])
    with pytest.raises(SchemaConflictError, match="k: table has int, got string"):
        table.replace(rows(("x", "new", "d1"), shape="k string, extra string, d string"), ["d1"])
    assert content(table, "k", "v") == [(1, "a")]
    assert table.schema(refresh=True).names == ["k", "v", "d"]


def test_a_second_session_view_sees_the_evolved_schema(spark, table, rows):
    table.replace(rows((1, "a", "d1")), ["d1"])
    other = DatedTable(spark, table.path, "d")
    assert other.read().columns == ["k", "v", "d"]
    table.append(rows((2, "b", 1.5, "d2"), shape="k int, v string, score double, d string"))
    assert other.read().columns == ["k", "v", "d"]
    other.schema(refresh=True)
    assert content(other, "k", "score") == [(1, None), (2, 1.5)]
    other.append(rows((3, True, "d3"), shape="k int, flag boolean, d string"))
    assert content(DatedTable(spark, table.path, "d"), "k", "score", "flag") == [
        (1, None, None), (2, 1.5, None), (3, None, True),
    ]


def test_partition_column_stays_text(table, rows):
    table.replace(rows((1, "a", "2025-07-23")), ["2025-07-23"])
    assert table.read().schema["d"].dataType == T.StringType()


def test_filters_are_combined(table, rows):
    table.replace(rows((1, "a", "d1"), (1, "b", "d1"), (1, "a", "d2")), ["d1", "d2"])
    assert table.read({"v": "a", "d": "d1"}).count() == 1
    assert table.read({"k": 1}).count() == 3
    assert table.read({"k": 1, "v": "none"}).count() == 0


def test_filter_on_date_prunes_partitions(table, rows):
    table.replace(rows((1, "a", "d1"), (2, "b", "d2")), ["d1", "d2"])
    plan = table.read({"d": "d1", "k": 1})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan
    assert "PushedFilters: [IsNotNull(k), EqualTo(k,1)]" in plan


def test_missing_table_reads_as_empty(spark, tmp_path):
    declared = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("d", T.StringType())])
    assert DatedTable(spark, str(tmp_path / "no"), "d", declared).read({"k": 1}).count() == 0
    assert DatedTable(spark, str(tmp_path / "no"), "d").read().columns == []
    assert DatedTable(spark, str(tmp_path / "no"), "d").counts(["d1"]) == {"d1": 0}


def test_delete(table, rows):
    start = rows((1, "a", "d1"), (2, "b", "d1"), (1, "a", "d2"), (1, None, "d2"))
    table.replace(start, ["d1", "d2"])
    table.delete({"k": 1, "v": "a"})
    assert [(k, d) for k, d in content(table, "k", "d")] == [(1, "d2"), (2, "d1")]
    table.delete({"k": 2})
    assert content(table, "k", "d") == [(1, "d2")]
    table.delete({"d": "d2"})
    assert content(table) == []


def test_append_adds(table, rows):
    table.append(rows((1, "a", "d1")))
    table.append(rows((1, "a", "d1")))
    assert table.counts(["d1"]) == {"d1": 2}


def test_rows_are_sorted_within_files(spark, table):
    df = spark.range(1000).select(F.lit("d1").alias("d"), ((F.col("id") * 7919) % 1000).alias("k"))
    table.replace(df.repartition(4), ["d1"], sort=["k"])
    per_file = table.read().select(F.input_file_name().alias("f"), "k").collect()
    files = {}
    for r in per_file:
        files.setdefault(r.f, []).append(r.k)
    assert all(ks == sorted(ks) for ks in files.values())


def test_many_dates_do_not_make_a_file_per_task_and_date(spark, table):
    dates = [f"d{i}" for i in range(10)]
    df = spark.range(0, 5000, numPartitions=8).select(
        "id", F.concat(F.lit("d"), (F.col("id") % 10).cast("string")).alias("d")
    )
    table.replace(df, dates)
    assert table.read().select(F.input_file_name()).distinct().count() == 10


def test_spread_keeps_related_rows_together(spark, table):
    df = spark.range(0, 4000, numPartitions=8).select(F.lit("d1").alias("d"), (F.col("id") % 40).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.replace(df, ["d1"], spread=F.pmod(F.xxhash64("k"), F.lit(4)))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert set(table.read().columns) == {"d", "k"}
    placed = table.read().select("k", F.input_file_name().alias("f")).distinct().groupBy("k").count()
    assert placed.where("count > 1").count() == 0


def test_union_evolved(rows):
    out = union_evolved([rows((1, "a", "d1")), rows((2, "d2"), shape="k int, d string"), rows((3, 0.5, "d3"), shape="k int, z double, d string")])
    assert sorted((r.k, r.v, r.z) for r in out.collect()) == [(1, "a", None), (2, None, None), (3, None, 0.5)]


# -- rows chosen by a filter, several partition columns or none ------------------


def parquet_files(table):
    return {f for f in table.files.files() if f.endswith(".parquet")}


def test_overwrite_by_filter_writes_only_touched_files_again(table, rows):
    for date in ("d1", "d2", "d3"):
        table.replace(rows((1, "a", date), (2, "b", date)).coalesce(1), [date])
    table.replace(rows((3, "c", "d4")), ["d4"])
    before = parquet_files(table)
    table.overwrite(rows((9, "new", "d2")), {"v": "a"})
    assert content(table, "k", "v", "d") == [(2, "b", "d1"), (2, "b", "d2"), (2, "b", "d3"), (3, "c", "d4"), (9, "new", "d2")]
    same = before & parquet_files(table)
    assert {f.split("/")[0] for f in same} == {"d=d4"}
    table.delete({"k": 3, "v": "x"})  # nothing meets both
    assert same <= parquet_files(table) and table.read().count() == 5


def test_filters_on_missing_values(table, rows):
    table.append(rows((1, None, "d1"), (2, "b", "d1"), (None, "c", None)))
    table.overwrite(rows((7, "z", "d9")), {"v": None})
    assert table.read({"d": None}).count() == table.read(dates=[None]).count() == 1
    table.delete({"k": None})
    assert content(table, "k", "v", "d") == [(2, "b", "d1"), (7, "z", "d9")]


def test_delete_without_filters_empties_the_table(table, rows):
    table.append(rows((1, "a", "d1"), (2, "b", "d2")))
    table.delete({})
    assert content(table) == [] and table.schema().names == ["k", "v", "d"]
    table.append(rows((3, "c", "d1")))
    assert content(table, "k") == [(3,)]


@pytest.mark.parametrize("keys", [[], ["d", "v"]])
def test_layouts(spark, tmp_path, rows, keys):
    table = DatedTable(spark, str(tmp_path / "t"), keys)
    table.append(rows((1, "a", "d1"), (2, "b b", "d1")))
    table.append(rows((3, "a", "d2")))
    table.overwrite(rows((9, "a", "d1")), {"d": "d1", "v": "a"})
    other = DatedTable(spark, table.path)
    assert content(other, "k", "v", "d") == [(2, "b b", "d1"), (3, "a", "d2"), (9, "a", "d1")] and other.keys == keys
    with pytest.raises(LayoutConflictError):
        table.replace(rows((1, "a", "d1")), ["d1"])
    with pytest.raises(LayoutConflictError):
        DatedTable(spark, table.path, ["k"]).append(rows((1, "a", "d1")))
    with pytest.raises(ValueError, match="no column nope"):
        table.delete({"nope": 1})


def test_partition_column_has_to_be_there(table, rows):
    with pytest.raises(SchemaConflictError, match="no partition column d"):
        table.append(rows((1, "a"), shape="k int, v string"))


@pytest.mark.parametrize("value", [5, None, True, "North West", "a,b", "50% {x}", "x=y/z", "é'\"", 1.5])
def test_values_of_any_kind(spark, tmp_path, value):
    kind = {int: "int", bool: "boolean", float: "double"}.get(type(value), "string")
    other = {"int": 6, "boolean": False, "double": 2.5}.get(kind, "other")
    table = DatedTable(spark, str(tmp_path / "t"), "p")
    shape = f"n int, p {kind}"
    table.replace(spark.createDataFrame([(1, value), (2, other)], shape), [value, other])
    assert table.replace(spark.createDataFrame([(3, value)], shape), [value]) == {value: 1}
    assert [tuple(r) for r in DatedTable(spark, table.path, "p").read({"p": value}).collect()] == [(3, value)]
    assert table.replace(spark.createDataFrame([], shape), [value]) == {value: 0}
    assert content(table) == [(2, other)]


def test_partition_folders_are_spelled_as_spark_does(spark, tmp_path):
    odd = ["a b", "x:y", "50%", "{c}", "q?", "tab\there", "é", "a,b", None, ""]
    spark.createDataFrame([(i, v) for i, v in enumerate(odd)], "n int, p string").write.partitionBy("p").parquet(str(tmp_path / "t"))
    assert {f.name for f in (tmp_path / "t").iterdir() if f.is_dir()} == {partition_folder("p", v) for v in odd}


def test_an_exchange_cut_short_is_ended_by_the_next_use(spark, table, rows, monkeypatch):
    table.append(rows((1, "a", "d1"), (2, "b", "d1"), (3, "c", "d2")))
    other = DatedTable(spark, table.path, "d")
    with monkeypatch.context() as m:
        m.setattr(table.files, "move", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            table.overwrite(rows((9, "z", "d2")), {"v": "a"})
    assert content(other, "k", "d") == [(2, "d1"), (3, "d2"), (9, "d2")]
    assert not [f for f in table.files.files() if f.startswith("_staged")] and not table.files.exists("_pending")
    with monkeypatch.context() as m:  # before the exchange is recorded nothing has happened
        m.setattr(DatedTable, "_writer", lambda *_: (_ for _ in ()).throw(OSError("full")))
        with pytest.raises(OSError, match="full"):
            table.overwrite(rows((7, "z", "d2")), {"v": "b"})
    assert content(other, "k", "d") == [(2, "d1"), (3, "d2"), (9, "d2")]
