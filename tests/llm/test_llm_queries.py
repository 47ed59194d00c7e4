import pytest
from conftest import DATA, same_rows

import __spark_entry__ as entry
from tidemark.llm import queries


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_gives_what_its_sql_gives(spark, duck, name):
    df = queries.queries()[name](spark, DATA)
    sql = queries.oracle_sql()
    if name in sql:
        assert same_rows(df, duck.sql(sql[name]))
    else:
        assert df.count() > 0


def test_ids_are_those_of_the_library(spark, duck):
    tokenizers = pytest.importorskip("tokenizers")
    from tidemark.llm.tokenizer import vocabulary_path

    library = tokenizers.Tokenizer.from_file(vocabulary_path())
    library.encode_special_tokens = True
    texts = duck.sql("SELECT doc_id, text FROM documents").fetchall()
    want = {i: library.encode(t, add_special_tokens=False).ids if t else [] for i, t in texts}
    assert {r.doc_id: r.ids for r in queries.p7_ids(spark, DATA).collect()} == want


def test_registered():
    assert set(queries.queries()) <= set(entry.queries())
