import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from corpusmill.session import build_session, ship_package

    s = build_session(
        "tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.checkpoint.dir": "file://" + str(tmp_path_factory.mktemp("shared")), "spark.driver.memory": "3g"}
    )
    s.sparkContext.setLogLevel("ERROR")
    ship_package(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def rows():
    """The rows of a DataFrame as sorted tuples."""
    return lambda df, *cols: sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
