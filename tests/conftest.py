import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from urlaudit.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def value(spark):
    """Evaluate one column over rows given as tuples; returns the values in order."""
    from pyspark.sql import functions as F

    def run(column, rows, ddl):
        numbered = [(i, *row) for i, row in enumerate(rows)]
        df = spark.createDataFrame(numbered, f"_i int, {ddl}")
        return [r[1] for r in df.select("_i", F.struct(column.alias("v")).alias("s")).select("_i", "s.v").orderBy("_i").collect()]

    return run
