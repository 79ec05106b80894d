import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from foliospark.session import build_session

    session = build_session("local[8]", app="tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('work')}"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def one(spark):
    """Value of a column expression over one-row input columns."""
    def run(expression, **columns):
        from pyspark.sql import functions as F

        values = {k: v if hasattr(v, "alias") else F.lit(v) for k, v in columns.items()}
        return spark.range(1).select(*[v.alias(k) for k, v in values.items()]).select(expression).first()[0]

    return run
