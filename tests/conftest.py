import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from markloom.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Run a Column function over texts and return the results."""

    def run(fn, *texts):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
        out = rows.withColumn("r", fn(F.col("t"))).orderBy("i").collect()
        results = [r.r for r in out]
        return results[0] if len(texts) == 1 else results

    return run
