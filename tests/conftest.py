import datetime as dt
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tests-"))
    from tallyline.functions.scale import configure

    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Rows and a DDL schema to a DataFrame; times are given as text."""

    def build(rows, ddl):
        kinds = [part.strip().rsplit(" ", 1)[-1] for part in ddl.split(", ")]

        def value(v, kind):
            if v is None or kind not in ("timestamp", "date"):
                return v
            at = dt.datetime.fromisoformat(v)
            return at.replace(tzinfo=dt.timezone.utc) if kind == "timestamp" else at.date()

        return spark.createDataFrame([tuple(value(v, k) for v, k in zip(r, kinds)) for r in rows], ddl)

    return build
