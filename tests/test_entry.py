import ast
import importlib
import sys
from pathlib import Path

import pytest
from conftest import DATA, same_rows

import __spark_entry__ as entry
from tidemark.plans import data_queries, engine_queries, model_queries

OWN = {**data_queries.queries(), **model_queries.queries(), **engine_queries.queries()}
SQL = {**data_queries.oracle_sql(), **model_queries.oracle_sql(), **engine_queries.oracle_sql()}


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_gives_what_its_sql_gives(spark, duck, name):
    df = OWN[name](spark, DATA)
    if name in SQL:
        assert same_rows(df, duck.sql(SQL[name]))
    else:
        assert df.count() >= 0


def test_registered(spark):
    names = entry.queries()
    assert set(OWN) <= set(names) and set(entry.oracle_sql()) <= set(names)
    assert entry.entry(spark).columns == ["transaction_id", "party_role"]


def test_nothing_else_imports_the_llm_subpackage():
    root = Path(entry.__file__).parent
    for path in (root / "tidemark").rglob("*.py"):
        if path.parent.name == "llm":
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), path


def test_the_entry_does_without_the_llm_subpackage(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("tidemark.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "tidemark.llm", None)
    fresh = importlib.reload(entry)
    assert set(fresh.queries()) == set(OWN)
    monkeypatch.undo()
    importlib.reload(entry)
