import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("catalog")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data(spark):
    from eventmart.plans.registry import Data

    return Data(spark, SMALL)


@pytest.fixture
def make_raw(spark):
    """Raw rows from partial dicts; everything not given gets a plain default."""
    from eventmart.schemas import RAW

    def build(*rows):
        full = []
        for i, row in enumerate(rows):
            created = row.get("created_at", dt.datetime(2024, 1, 10, 12))
            defaults = {
                "event_id": str(i),
                "event_type": "PushEvent",
                "created_at": created,
                "event_date": created.date(),
                "actor_id": "1",
                "actor_login": "dev1",
                "repo_id": "10",
                "repo_name": "own/repo",
                "org_id": None,
                "org_login": None,
                "is_public": True,
                "payload": "{}",
                "source_file": "2024-01-10-12.json.gz",
                "ingested_at": created + dt.timedelta(hours=2),
                "updated_at": created + dt.timedelta(hours=2),
            }
            full.append(tuple((defaults | row)[f.name] for f in RAW))
        return spark.createDataFrame(full, RAW)

    return build


@pytest.fixture
def rows():
    """Sorted rows as plain dicts."""

    def collect(df, *columns):
        found = [r.asDict() for r in (df.select(*columns) if columns else df).collect()]
        return sorted(found, key=lambda r: [str(v) for v in r.values()])

    return collect
