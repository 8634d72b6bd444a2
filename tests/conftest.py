import pytest

from mastline.session import build_session

DAY = "2025-07-23"
MIDNIGHT = 1753228800  # 2025-07-23 00:00:00 UTC

READING = (
    "tower_id bigint, region string, timestamp bigint, signal_strength double, data_volume_mb double"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "mastline-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Readings with their execution date and a row order, from plain tuples."""

    def make(rows, schema=READING, date=DAY):
        full = [(*row, date, i) for i, row in enumerate(rows)]
        return spark.createDataFrame(full, f"{schema}, _execution_date string, seq bigint")

    return make


def write_csv(folder, date, text):
    path = folder / f"network_metrics_{date.replace('-', '')}.csv"
    path.write_text(text)
    return path


def rows_of(df, *order):
    return [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]
