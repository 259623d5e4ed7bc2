import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect


@pytest.fixture
def market(spark):
    """A Silver frame from (type, state, value, 'yyyy-mm', count[, source]) tuples."""
    from tallymark.schemas import SILVER_SCHEMA
    import datetime

    def build(cells):
        out = []
        for kind, code, value, month, count, *source in cells:
            day = datetime.date.fromisoformat(month + "-01")
            out.append((
                kind, value, day.isoformat(), day.year, day.month, day.strftime("%B"), count,
                source[0] if source else f"{kind}_{code}_{day.year}.csv", code,
                code and f"State {code}", day))
        return spark.createDataFrame(out, SILVER_SCHEMA)

    return build
