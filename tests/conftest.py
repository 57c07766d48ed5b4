import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))
sys.path.insert(0, str(ROOT / "tests"))

from celltables import CELLS  # noqa: E402

from refmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def grid(spark):
    """``grid({"sheet": [[row of values]]})`` → cells; None is an empty cell."""

    def kind(v):
        return "bool" if isinstance(v, bool) else "number" if isinstance(v, (int, float)) else "string"

    def build(sheets, workbook="b"):
        rows = [
            (workbook, name, r, c, str(v), kind(v))
            for name, lines in sheets.items()
            for r, line in enumerate(lines, 1)
            for c, v in enumerate(line, 1)
            if v is not None
        ]
        return spark.createDataFrame(rows, CELLS)

    return build
