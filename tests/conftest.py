import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from dotreef.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            # Tests look for paths in plans, where Spark cuts what is longer than 100 characters.
            "spark.sql.maxMetadataStringLength": "1000",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def frame(spark):
    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


def bag(df, *names):
    rows = (df.select(*names) if names else df).collect()
    return sorted((tuple(r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))
