import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from runlens.session import build, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="runlens-test-")
    s = build("local[4]", 4, extra={
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.extraJavaOptions": f"-Dderby.system.home={scratch}",
    })
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s, fallback=os.path.join(scratch, "checkpoints"))  # set only because unset in tests
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="runlens-case-")


def one(spark, expr, schema=None, rows=None):
    """Evaluate a Column expression over a small frame and return the list of values."""
    df = spark.createDataFrame(rows, schema) if rows is not None else spark.range(1)
    return [r[0] for r in df.select(expr).collect()]
