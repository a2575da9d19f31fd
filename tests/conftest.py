import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(work / "shared"))
        .config("spark.sql.warehouse.dir", str(work / "warehouse"))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def put(**settings):
        for name, value in settings.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def rows():
    """The rows of a frame as plain tuples in a fixed order."""
    def collect(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
    return collect


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)
