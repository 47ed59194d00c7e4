import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from tidemark import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="tidemark-tests-")
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__sql__warehouse__dir=f"{folder}/warehouse", spark__checkpoint__dir=f"{folder}/shared",
        spark__driver__memory="4g", spark__driver__extraJavaOptions=f"-Dderby.system.home={folder}",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in sorted(Path(DATA).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def rows(df):
    """Rows as sorted tuples; nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))


def same_rows(df, relation):
    """Whether a query's rows are those of its SQL, whatever the order of rows and columns."""

    def plain(names, found):
        order = sorted(range(len(names)), key=lambda i: names[i])
        return sorted(tuple(f"{r[i]:.6g}" if isinstance(r[i], float) else str(r[i]) for i in order) for r in found)

    return sorted(df.columns) == sorted(relation.columns) and plain(df.columns, df.collect()) == plain(relation.columns, relation.fetchall())
