import ast
from pathlib import Path

import pytest

import __spark_entry__ as e

ROOT = Path(__file__).resolve().parent.parent
DATA = Path("/root/testdata/sf0.001")


def test_every_sql_has_a_query():
    assert set(e.oracle_sql()) <= set(e.queries())


def test_nothing_else_imports_the_llm_subpackage():
    for f in (ROOT / "lodestrand").rglob("*.py"):
        if "llm" in f.parts:
            continue
        for node in ast.walk(ast.parse(f.read_text())):
            names = [node.module or ""] if isinstance(node, ast.ImportFrom) else [a.name for a in node.names] if isinstance(node, ast.Import) else []
            assert not any("lodestrand.llm" in n for n in names), f


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_entry(spark):
    assert e.entry(spark).columns == ["dst", "sortorder", "n"]


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
@pytest.mark.parametrize("name", ["crawl_verdicts", "link_sortorder", "link_backlinks", "type_recognise", "relative_url", "p2_found"])
def test_query_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in DATA.iterdir():
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    rel = con.sql(e.oracle_sql()[name])
    want = sorted(repr(dict(sorted(zip(rel.columns, r, strict=True)))) for r in rel.fetchall())
    got = sorted(repr(dict(sorted(r.asDict().items()))) for r in e.queries()[name](spark, str(DATA)).collect())
    assert got == want
