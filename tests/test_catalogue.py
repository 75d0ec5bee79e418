"""Each core query beside its SQL on the smallest tables."""

from pathlib import Path

import pytest

from corpusmill.plans import catalogue
from verify_queries import plain

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in FOLDER.glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, con, name):
    df = catalogue.queries()[name](spark, str(FOLDER))
    cols = sorted(df.columns)
    got = sorted("|".join(plain(r[c]) for c in cols) for r in df.collect())
    sql = catalogue.oracles().get(name)
    if sql is None:
        assert got
        return
    rel = con.sql(sql)
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    assert got == sorted("|".join(plain(r[i]) for i in at) for r in rel.fetchall())


def test_names_agree():
    assert set(catalogue.oracles()) <= set(catalogue.queries())


def test_core_does_not_import_the_subpackage():
    root = Path(__file__).resolve().parent.parent / "corpusmill"
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and "corpusmill.llm" in p.read_text()]
