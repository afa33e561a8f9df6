"""Every query runs on the smallest tables, and agrees with its SQL."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]
import __spark_entry__ as entry  # noqa: E402

SMALL = "/root/testdata/sf0.001"
CORE = {n: q for m in entry._modules() if m.__name__.startswith("lexiloom.plans") for n, q in m.QUERIES.items()}


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


@pytest.mark.parametrize("name", CORE)
def test_query(spark, connection, name):
    from oracle import compare

    sql = entry.oracle_sql()
    if name in sql:
        said = compare(spark, connection, SMALL, CORE[name], sql[name])
        assert said.startswith("ok"), said
    else:
        CORE[name](spark, SMALL).collect()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_outside_imports_the_llm_subpackage():
    for path in (ROOT / "lexiloom").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT / "lexiloom").parts:
            assert "lexiloom.llm" not in path.read_text(), path
