import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rollout_quality.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8, "tests", spark__sql__shuffle__partitions="4", spark__default__parallelism="4", spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture
def values(spark):
    """Apply a Column function to many inputs in one job; returns the outputs in input order."""

    def run(rows, schema, fn):
        data = [(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)]
        df = spark.createDataFrame(data, f"i int, {schema}")
        return [r[0] for r in df.orderBy("i").select(fn().alias("out")).collect()]

    return run
