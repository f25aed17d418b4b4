import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

from pyspark.sql import functions as F  # noqa: E402

from vulnlake.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "vulnlake-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="2g",
        spark__sql__warehouse__dir=str(folder / "warehouse"),
        spark__checkpoint__dir=str(folder / "checkpoints"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Apply a column function to a list of values, in order."""

    def run(fn, values, kind="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
        rows = df.select("i", fn(F.col("v")).alias("r")).collect()
        return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]

    return run
