import sys
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from claimstar.functions.session import session  # noqa: E402
from claimstar.sources.contracts import CONTRACTS, schema  # noqa: E402
from claimstar.sources.inputs import stage  # noqa: E402

RUN_TS = "2025-01-01 00:00:00"
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    spark = session(
        "tests",
        "local[8]",
        4,
        {
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(warehouse),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


def _typed(value, kind):
    if value is None:
        return None
    if kind == "date":
        return date.fromisoformat(value)
    if kind == "time":
        return datetime.fromisoformat(value)
    if kind == "number":
        return Decimal(str(value))
    return value


@pytest.fixture(scope="session")
def given(spark):
    """given(input name, rows as dicts) -> staged input; absent columns are null."""

    def make(name, *rows, staged=True):
        columns = CONTRACTS[name]
        for row in rows:
            assert set(row) <= set(columns), set(row) - set(columns)
        data = [tuple(_typed(r.get(c), kind) for c, kind in columns.items()) for r in rows]
        frame = spark.createDataFrame(data, schema(name))
        return stage(name, frame, RUN_TS) if staged else frame

    return make


def rows(frame, *columns):
    """Sorted tuples of the chosen columns."""
    picked = [tuple(r) for r in frame.select(*columns).collect()]
    return sorted(picked, key=lambda r: tuple((v is None, str(v)) for v in r))
