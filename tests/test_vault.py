import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark import store
from tidemark.functions.keys import KeyRefused, hash_key_of
from tidemark.operators import vault
from tidemark.operators.specs import MODEL, Domain, Effectivity, Hub, KeyColumn, Link, LinkEnd, Prefix, Satellite, SpecRefused, build_model

D = {"2027-05": dt.date(2027, 5, 9), "2027-06": dt.date(2027, 6, 13), "2027-07": dt.date(2027, 7, 11)}
HUB = MODEL["hub_empresa"]
SAT = MODEL["sat_empresa_dados"]


def at():
    return F.lit("2027-08-01T00:00:00Z").cast("timestamp")


def bronze(spark, data):
    """(key, month, name) rows of the registry."""
    return spark.createDataFrame([(k, n, "2062", "1,00", "01", m, D[m], "src-" + m, None) for k, m, n in data], "cnpj_basico string, razao_social string, natureza_juridica string, capital_social string, porte_empresa string, _snapshot_month string, _snapshot_ref_date date, _record_source string, load_date string")


DATA = [("1", "2027-05", "A"), ("00000001", "2027-06", "A"), ("1", "2027-07", "B"), ("2", "2027-06", "C"), ("2", "2027-05", "C"), ("3", "2027-07", "D"), ("3", "2027-07", "D")]


def test_hub_keeps_the_first_source_and_appends_once(spark):
    got = rows(vault.hub_candidates(bronze(spark, DATA), HUB).select("cnpj_basico", "record_source", "hub_empresa_hk"))
    assert got == [("00000001", "src-2027-05", hash_key_of(["00000001"])), ("00000002", "src-2027-05", hash_key_of(["00000002"])), ("00000003", "src-2027-07", hash_key_of(["00000003"]))]
    first = vault.load_hub(bronze(spark, DATA[:4]), HUB, "v_hub", at())
    again = vault.load_hub(bronze(spark, DATA[:4]), HUB, "v_hub", at())
    more = vault.load_hub(bronze(spark, DATA), HUB, "v_hub", at())
    assert (first.appended, again.appended, more.appended, more.held) == (2, 0, 1, 3)


def test_non_string_keys_are_refused(spark):
    with pytest.raises(KeyRefused):
        vault.hub_candidates(bronze(spark, DATA).withColumn("cnpj_basico", F.lit(1)), HUB)


def test_satellite_keeps_changes_and_incremental_equals_one_shot(spark):
    shown = lambda t: rows(spark.table(t).select("hub_empresa_hk", "applied_date", "razao_social"))
    all_ = bronze(spark, DATA)
    assert vault.load_satellite(all_, SAT, HUB, "v_sat1", at()).appended == 4
    for month in D:
        vault.load_satellite(all_.filter(F.col("_snapshot_month") == month), SAT, HUB, "v_sat2", at())
    assert vault.load_satellite(all_, SAT, HUB, "v_sat2", at()).appended == 0
    assert shown("v_sat1") == shown("v_sat2")
    assert [r[2] for r in shown("v_sat1") if r[0] == hash_key_of(["00000001"])] == ["A", "B"]


def test_values_that_return_are_kept(spark):
    df = spark.createDataFrame([("k", dt.date(2027, 1, d), v) for d, v in ((1, "a"), (2, "b"), (3, "a"), (4, "a"))], "k string, applied_date date, hash_diff string")
    assert [r[1].day for r in rows(vault.changed_rows(df, None, "k"))] == [1, 2, 3]
    assert [r[1].day for r in rows(vault.changed_rows(df, df.limit(1), "k"))] == [2, 3]
    assert vault.changed_rows(df.limit(0), None, "k").count() == 0


def test_all_five_states_of_the_ledger(spark):
    b = spark.createDataFrame([("a", "01"), ("a", "02"), ("b", "01"), ("c", "03"), (None, "01")], "k string, _snapshot_month string")
    q = spark.createDataFrame([("a", "02"), ("b", "02"), ("d", "02"), (None, "02"), ("z", None)], "k string, _snapshot_month string")
    got = {(r.k, r._snapshot_month): r.state for r in vault.observation_ledger(b, q, ["k"]).collect()}
    o, s, r, p, a = vault.OBSERVED, vault.SIBLINGS, vault.REJECTED, vault.BEFORE, vault.AFTER
    want = {"a": (o, s, a), "b": (o, r, a), "c": (p, p, o), "d": (p, r, a), None: (o, r, a)}
    assert got == {(k, m): states[i] for k, states in want.items() for i, m in enumerate(("01", "02", "03"))}
    window = {(r.k, r._snapshot_month): r.state for r in vault.observation_ledger(b, q, ["k"], window=["02", "03"]).collect()}
    assert window["b", "02"] == r and ("b", "01") not in window
    with pytest.raises(vault.LoadRefused):
        vault.observation_ledger(b, q, ["k"], window=["02", "09"])


def test_effectivity_closes_absence_and_not_our_own_rejects(spark):
    def side(data):
        return spark.createDataFrame([(k, e, m, D[m], "s" + m) for k, e, m in data], "k string, entry string, _snapshot_month string, _snapshot_ref_date date, _record_source string")

    b = side([("gone", "e1", "2027-05"), ("back", "e2", "2027-05"), ("back", "e3", "2027-07"), ("kept", "e4", "2027-05"), ("kept", "e4", "2027-07"), ("new", "e5", "2027-07"), ("rejected", "e6", "2027-05"), ("rejected", "e6", "2027-07")])
    q = side([("rejected", None, "2027-06"), ("x", None, "2027-06")])
    said = vault.effectivity_statements(b, q, F.col("k"), "key", ["k"], "entry")
    got = {}
    for r in sorted(vault.effectivity_rows(said, None, "key").collect(), key=lambda r: (r["key"], r.applied_date)):
        got.setdefault(r["key"], []).append((r.applied_date.month, r.is_active, r.entry, r.last_observed_on and r.last_observed_on.month, r.closed_by, r.record_source))
    after = vault.AFTER
    assert got["gone"] == [(5, True, "e1", None, None, "s2027-05"), (6, False, "e1", 5, after, "s2027-05")]
    assert got["back"] == [(5, True, "e2", None, None, "s2027-05"), (6, False, "e2", 5, after, "s2027-05"), (7, True, "e3", None, None, "s2027-07")]
    assert got["new"] == [(7, True, "e5", None, None, "s2027-07")] and len(got["rejected"]) == 1 and [g[1] for g in got["kept"]] == [True, False, True]
    with pytest.raises(vault.LoadRefused):
        vault.effectivity_statements(b, q, F.col("k"), "key", ["k"], "entry", window=["2027-05"])


def test_partner_link_and_its_effectivity(spark):
    columns = "cnpj_basico string, identificador_socio string, cpf_cnpj_socio string, data_entrada_sociedade string, _snapshot_month string, _snapshot_ref_date date, _record_source string"
    s = spark.createDataFrame([("1", "1", "12345678000190", "d1", m, D[m], "s") for m in D] + [("1", "2", "***123456**", "d2", "2027-05", D["2027-05"], "s"), ("1", "3", None, "d3", "2027-05", D["2027-05"], "s"), ("1", "3", None, "d4", "2027-05", D["2027-05"], "s"), ("1", "1", "123", "d5", "2027-06", D["2027-06"], "s")], columns)
    link, eff = MODEL["link_company_partner"], MODEL["sat_eff_company_partner"]
    with pytest.raises(vault.LoadRefused):
        vault.load_partner_link(s, link, HUB, "v_absent", "v_partner", at())
    vault.load_hub(s, HUB, "v_hub_p", at())
    done = vault.load_partner_link(s, link, HUB, "v_hub_p", "v_partner", at())
    assert done.appended == 4 and done.notes["collapsed"] == 3 and vault.load_partner_link(s, link, HUB, "v_hub_p", "v_partner", at()).appended == 0
    refs = {(r.identificador_socio, r.cpf_cnpj_socio): r.partner_hub_empresa_hk for r in spark.table("v_partner").collect()}
    assert refs[("1", "12345678000190")] == hash_key_of(["12345678"]) and [refs[k] for k in refs if k != ("1", "12345678000190")] == [None] * 3
    grain = ["cnpj_basico", "identificador_socio", "cpf_cnpj_socio"]
    first = vault.load_effectivity(s, s.limit(0), eff, link, {"hub_empresa": HUB}, grain, "v_eff", at())
    assert first.appended == 4 + 3 and vault.load_effectivity(s, s.limit(0), eff, link, {"hub_empresa": HUB}, grain, "v_eff", at()).appended == 0
    with pytest.raises(vault.LoadRefused):
        vault.load_effectivity(s, s.limit(0), eff, link, {"hub_empresa": HUB}, ["cnpj_basico"], "v_eff2", at())


def test_link_with_a_derived_end(spark):
    m = spark.createDataFrame([("m1", "12345678000190", "2027-05", "s"), ("m1", "87654321000190", "2027-06", "s")], "merchant_id string, cnpj string, _snapshot_month string, _record_source string")
    link, hubs = MODEL["link_merchant_empresa"], {h: MODEL[h] for h in ("hub_merchant", "hub_empresa")}
    got = {r.hub_empresa_hk: r.link_merchant_empresa_hk for r in vault.link_candidates(m, link, hubs).collect()}
    assert got == {hash_key_of([c]): hash_key_of(["m1", c]) for c in ("12345678", "87654321")}
    with pytest.raises(vault.LoadRefused):
        vault.link_candidates(m, link, {"hub_merchant": MODEL["hub_merchant"]})


def test_reference_takes_the_earliest_description(spark):
    r = spark.createDataFrame([("1", "new", "2027-06", "s", "/x/F.CNAE"), ("1", "old", "2027-05", "s", "/x/F.CNAE"), ("1", "other", "2027-05", "s", "/x/F.PAIS"), ("2", None, "2027-05", "s", "/x/f.cnae")], "codigo string, descricao string, _snapshot_month string, _record_source string, _source_file string")
    assert vault.load_reference(r, MODEL["ref_cnae"], "v_ref", at()).appended == 2 and vault.load_reference(r, MODEL["ref_cnae"], "v_ref", at()).appended == 0
    assert rows(spark.table("v_ref").select("codigo", "descricao")) == [("1", "old"), ("2", None)]


@pytest.mark.parametrize("build", [
    lambda: Hub("h", "hk", ()), lambda: Hub("h", "a", (KeyColumn("A"),)), lambda: KeyColumn("a", 0), lambda: Satellite("s", "h", ()), lambda: Link("l", "lk", (LinkEnd("h"),)), lambda: Link("l", "lk", (LinkEnd("h"), LinkEnd("h"))),
    lambda: build_model(Domain("d", (Satellite("s", "nothing", ("a",)),))), lambda: build_model(Domain("d", (Effectivity("e", "nothing", "a"),))), lambda: build_model(Domain("d", (HUB,)), Domain("e", (HUB,))),
    lambda: build_model(Domain("d", (HUB, MODEL["hub_merchant"], Link("l", "lk", (LinkEnd("hub_merchant"), LinkEnd("hub_empresa", key_from=(Prefix("c", 7),))))))), lambda: build_model(Domain("d", ()), Domain("D", ())),
])
def test_specs_that_contradict_themselves_are_refused(build):
    with pytest.raises(SpecRefused):
        build()


def test_loaders_leave_a_table_once_per_load(spark):
    assert store.rows_in(spark, "v_hub") == 3


def test_a_load_names_its_snapshots_and_says_what_became_of_them(spark):
    said = spark.createDataFrame([("00000001", "a", "2026-06", "2026-06-10"), ("00000001", "a", "2026-07", "2026-07-10"), ("00000002", "b", "2026-07", "2026-07-10")], "k string, v string, m string, d string")
    source = said.select(F.col("k").alias("cnpj_basico"), *(F.col("v").alias(c) for c in SAT.payload), F.col("m").alias("_snapshot_month"), F.col("d").cast("date").alias("_snapshot_ref_date"), F.lit("s").alias("_record_source"))
    for months in (["2026-06", "2026-08"], []):
        with pytest.raises(vault.LoadRefused):
            vault.load_satellite(source, SAT, HUB, "v_sat_months", at(), months=months)
    first = vault.load_satellite(source, SAT, HUB, "v_sat_months", at(), months=["2026-07"], diagnostics=True)
    assert first.appended == 2 and first.notes == {"candidates": 2, "held": 0, "unchanged": 0, "behind": 0, "keys": 2}
    second = vault.load_satellite(source, SAT, HUB, "v_sat_months", at(), diagnostics=True)
    assert second.appended == 1 and second.notes == {"candidates": 3, "held": 2, "unchanged": 0, "behind": 1, "keys": 2}
