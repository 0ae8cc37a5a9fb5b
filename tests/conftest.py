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
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def panel_of(spark):
    """Small typed panel from (iso_code, date, **columns) dictionaries."""
    import datetime as dt

    from pyspark.sql import types as T

    from tidemark.spec import column_type

    def build(rows, *columns):
        names = ("iso_code", "date", *columns)
        schema = T.StructType([T.StructField(c, column_type(c)) for c in names])

        def value(row, c):
            v = row.get(c)
            if c == "date" and isinstance(v, str):
                return dt.date.fromisoformat(v)
            return float(v) if v is not None and column_type(c) == T.DoubleType() else v

        return spark.createDataFrame([tuple(value(r, c) for c in names) for r in rows], schema)

    return build
