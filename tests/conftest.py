import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gamepulse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]", shuffle_partitions=4,
        **{
            "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
            "spark.sql.maxMetadataStringLength": "2000", "spark.sql.codegen.wholeStage": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""
    return lambda df, *cols: sorted([tuple(r) for r in (df.select(*cols) if cols else df).collect()], key=str)
