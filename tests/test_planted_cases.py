"""Queries against their SQL on supplied tables into which cases are planted that the supplied rows don't hold."""

from pathlib import Path

import duckdb
import pytest
from conftest import DATA, same_rows

from tidemark.plans import data_queries, model_oracle, model_queries


@pytest.fixture
def planted(tmp_path):
    """Rewrites tables of a copy of the supplied folder: planted(table=SQL over the same table) to (folder, DuckDB)."""
    for p in Path(DATA).glob("*.parquet"):
        (tmp_path / p.name).symlink_to(p)
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")

    def rewrite(**tables):
        for name, sql in tables.items():
            target = tmp_path / f"{name}.parquet"
            target.unlink()
            con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
            con.execute(f"COPY ({sql}) TO '{target}' (FORMAT parquet)")
        for p in tmp_path.glob("*.parquet"):
            con.execute(f"CREATE OR REPLACE VIEW {p.stem} AS SELECT * FROM '{p}'")
        return str(tmp_path), con

    return rewrite


def agrees(spark, name, folder, con):
    queries, sql = (data_queries.queries(), data_queries.oracle_sql()) if name in data_queries.queries() else (model_queries.queries(), model_oracle.oracle_sql())
    return same_rows(queries[name](spark, folder), con.sql(sql[name]))


def test_fact_events_outside_the_span_of_the_payments(spark, planted):
    """A correctly keyed row whose instant lies years before or after every payment stays right."""
    third = "ascii(right(regexp_replace(lower(transaction_id), '[^0-9a-f]', '', 'g'), 1)) % 3"
    folder, con = planted(fact_payment=f"SELECT * REPLACE (CASE {third} WHEN 0 THEN '2031-05-06T07:08:09Z' WHEN 1 THEN '1999-01-02T03:04:05Z' ELSE event_time END AS event_time) FROM fact_payment")
    assert agrees(spark, "p6_found", folder, con)
    late = data_queries.p6_found(spark, folder).count()
    assert 0 < late < 2 * con.sql("SELECT count(DISTINCT transaction_id) FROM fact_payment").fetchall()[0][0]


def test_a_snapshot_without_reference_dates_is_a_snapshot(spark, planted):
    folder, con = planted(empresas="SELECT * REPLACE (CASE WHEN _snapshot_month = '2027-03' THEN NULL ELSE _snapshot_ref_date END AS _snapshot_ref_date) FROM empresas")
    assert agrees(spark, "p4_found", folder, con)
    kinds = {(r.snapshot_month, r.change_kind) for r in data_queries.p4_found(spark, folder).collect()}
    assert ("2027-03", "removed") in kinds or ("2027-03", "changed") in kinds


def test_sequential_producers_and_malformed_identifiers(spark, planted):
    """A third of the messages numbered on by one producer, some identifiers that are no number, one that holds a third of all rows."""
    case = "CASE {0} % 9 WHEN 0 THEN 'no-number ' || {0} // 27 WHEN 1 THEN '00ff' || lpad(printf('%x', {0} // 18), 12, '0') WHEN 2 THEN '00FF-' || lpad(printf('%x', {0} // 9), 12, '0') WHEN 3 THEN 'ab00000000000001' WHEN 4 THEN 'AB00000000000001' WHEN 5 THEN 'ab00-0000-0000-0001' ELSE transaction_id END".format("(rowid_ - 1)")
    folder, con = planted(payments=f"SELECT * EXCLUDE (rowid_) REPLACE ({case} AS transaction_id) FROM (SELECT *, row_number() OVER () AS rowid_ FROM payments)")
    assert agrees(spark, "p2_found", folder, con) and agrees(spark, "p2_messages", folder, con) and agrees(spark, "p2_seen_before", folder, con)


def test_references_with_null_parts(spark, planted):
    """Unreadable instants and missing counterparties leave a part of the composite key null."""
    folder, con = planted(
        payments="SELECT * EXCLUDE (rowid_) REPLACE (CASE WHEN rowid_ % 5 = 0 THEN 'soon' ELSE event_time END AS event_time, CASE WHEN rowid_ % 7 = 0 THEN NULL WHEN rowid_ % 3 = 0 THEN '99999999' ELSE payee_cnpj_basico END AS payee_cnpj_basico) FROM (SELECT *, row_number() OVER () AS rowid_ FROM payments)"
    )
    for name in ("p1_found", "p1_partial", "p1_simple"):
        assert agrees(spark, name, folder, con), name
    assert data_queries.p1_partial(spark, folder).filter("in_force is null and company = '99999999'").count() > 0


def test_stored_keys_that_no_dimension_row_has(spark, planted):
    folder, con = planted(fact_payment="SELECT * REPLACE (CASE WHEN event_date_key % 3 = 0 THEN 12345 ELSE payer_company_sk END AS payer_company_sk, CASE WHEN event_date_key % 5 = 0 THEN NULL ELSE payee_company_sk END AS payee_company_sk) FROM fact_payment")
    assert agrees(spark, "orphan_keys", folder, con) and model_queries.orphan_keys(spark, folder).count() == 1
    assert agrees(spark, "p1_references", folder, con)
