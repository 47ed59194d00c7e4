import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark import store
from tidemark.operators import gold
from tidemark.operators.gold import BuildRefused

D = dt.date
US = 10**6


def us(*a):
    return int(dt.datetime(*a, tzinfo=dt.UTC).timestamp()) * US


SAT = [("h1", D(2026, 5, 9), "A"), ("h1", D(2026, 6, 13), "B"), ("h1", D(2026, 7, 11), "C"), ("h2", D(2026, 6, 13), "X")]
HUB = [("h1", "00000001"), ("h2", "00000002"), ("h2", "00000002"), ("h3", "00000003")]


def dimension(spark, sat=SAT):
    s = spark.createDataFrame(sat, "hk string, applied_date date, name string")
    h = spark.createDataFrame(HUB, "hk string, cnpj_basico string")
    return gold.scd2_rows(s, h, "hk", ["cnpj_basico"], ["name"], "company_sk", F.lit("2026-08-01T00:00:00Z").cast("timestamp"))


def shown(df):
    return rows(df.select("cnpj_basico", "name", F.unix_micros("valid_from").alias("f"), F.unix_micros("valid_to").alias("t"), "is_current", (F.col("company_sk") == -1).alias("ghost")))


CEILING = us(2999, 12, 31, 23, 59, 59) + 999_999


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_versions_tile_time_and_there_is_one_ghost(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = shown(dimension(spark))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [
        (None, None, 0, CEILING, True, True), ("00000001", "A", 0, us(2026, 6, 13), False, False), ("00000001", "B", us(2026, 6, 13), us(2026, 7, 11), False, False), ("00000001", "C", us(2026, 7, 11), CEILING, True, False), ("00000002", "X", 0, CEILING, True, False),
    ]


def test_the_dimension_is_built_once_and_refuses_to_be_outgrown(spark):
    assert gold.load_scd2(dimension(spark), "g_dim", "company_sk") == 5
    assert gold.load_scd2(dimension(spark), "g_dim", "company_sk") == 0
    with pytest.raises(BuildRefused):
        gold.load_scd2(dimension(spark, [*SAT, ("h2", D(2026, 7, 11), "Y")]), "g_dim", "company_sk")
    with pytest.raises(BuildRefused):
        gold.load_scd2(dimension(spark), "g_dim", "company_sk", ["2026-05"], ["2026-05", "2026-06"])
    assert store.rows_in(spark, "g_dim") == 5
    with pytest.raises(BuildRefused):
        gold.refuse_colliding_keys(dimension(spark).withColumn("company_sk", F.lit(1)), "company_sk")


def test_calendar_and_enumeration(spark):
    span = gold.covered_span(spark.createDataFrame([(D(2026, 2, 27),), (D(2026, 3, 2),)], "d date"), spark.createDataFrame([(D(2026, 2, 28),)], "e date"))
    got = rows(gold.calendar_rows(spark, *span).select("date_key", "day_of_week", "is_weekend"))
    assert got == [(-1, None, None), (20260227, 5, False), (20260228, 6, True), (20260301, 7, True), (20260302, 1, False)]
    assert gold.load_conformed(gold.calendar_rows(spark, *span), "g_cal", "date_key") == 5 and gold.load_conformed(gold.calendar_rows(spark, D(2026, 2, 27), D(2026, 3, 3)), "g_cal", "date_key") == 1
    for bad in ((None, None), (D(2026, 2, 2), D(2026, 2, 1))):
        with pytest.raises(BuildRefused):
            gold.calendar_rows(spark, *bad)
    with pytest.raises(BuildRefused):
        gold.covered_span(spark.createDataFrame([(None,)], "d date"))
    m = gold.enumerated_rows(spark.createDataFrame([("PIX",), ("PIX",), (None,), ("TED",)], "m string"), "m", "sk")
    assert [r[1] for r in rows(m.orderBy("m").select("sk", "m"))].count(None) == 1 and m.count() == 3


def test_point_in_time(spark):
    hub = spark.createDataFrame([("a",), ("b",), ("c",)], "hk string")
    s1 = spark.createDataFrame([("a", D(2026, 5, 1)), ("a", D(2026, 7, 1)), ("b", D(2026, 6, 1))], "hk string, applied_date date")
    s2 = spark.createDataFrame([("a", D(2026, 6, 1)), ("x", D(2026, 6, 1))], "hk string, applied_date date")
    got = rows(gold.pit_rows(hub, "hk", {"s1": s1, "s2": s2}))
    m = lambda n: n and D(2026, n, 1)
    assert got == [("a", m(5), m(5), None), ("a", m(6), m(5), m(6)), ("a", m(7), m(7), m(6)), ("b", m(6), m(6), None), ("b", m(7), m(6), None)]
    assert rows(gold.rows_per_as_of(gold.pit_rows(hub, "hk", {"s1": s1, "s2": s2}))) == [(m(5), 1), (m(6), 2), (m(7), 2)]
    assert gold.load_pit(gold.pit_rows(hub, "hk", {"s1": s1, "s2": s2}, as_of=[m(6), m(7)]), "g_pit", "hk") == 4
    assert gold.load_pit(gold.pit_rows(hub, "hk", {"s1": s1, "s2": s2}, as_of=[m(6), m(7), m(8)]), "g_pit", "hk") == 2
    with pytest.raises(BuildRefused):
        gold.load_pit(gold.pit_rows(hub, "hk", {"s1": s1, "s2": s2}, as_of=[m(5)]), "g_pit", "hk")
    with pytest.raises(BuildRefused):
        gold.pit_rows(hub, "hk", {"s1": s1.withColumn("applied_date", F.lit(None).cast("date"))})
    with pytest.raises(BuildRefused):
        gold.pit_rows(hub, "hk", {"s1": s1.limit(0)})


QUOTE = "quote_date string, currency string, data_hora_cotacao string, cotacao_compra string, cotacao_venda string"
QUOTES = [("2026-06-01", "USD", "2026-06-01 13:00:00.5", "5.0", "5.10000"), ("2026-06-01", "USD", "2026-06-01 13:00:07", "5.0", "5.1"), ("2026-06-02", "USD", "2026-06-02 13:00:00", "5.0", "5.2")]


def test_rate_intervals(spark):
    got = rows(gold.ptax_intervals(spark.createDataFrame(QUOTES, QUOTE)))
    t1 = us(2026, 6, 1, 16) + US // 2
    assert got == [("USD", D(2026, 6, 1), Decimal("5.10000"), t1, us(2026, 6, 2, 16)), ("USD", D(2026, 6, 2), Decimal("5.20000"), us(2026, 6, 2, 16), None)]
    for bad in ([], [*QUOTES, ("2026-06-02", "USD", "2026-06-02 13:00:00", "5.0", "5.3")], [("2026-06-02", "USD", "13:00", "5.0", "5.3")], [("2026-06-02", "USD", "2026-06-02 13:00:00", "5.0", "x")]):
        with pytest.raises(BuildRefused):
            gold.ptax_intervals(spark.createDataFrame(bad, QUOTE))


@pytest.mark.parametrize("sent", [gold.SENT_INTERVALS, 0])
def test_rates_are_those_in_force_at_the_instant(spark, monkeypatch, sent):
    monkeypatch.setattr(gold, "SENT_INTERVALS", sent)
    i = gold.ptax_intervals(spark.createDataFrame(QUOTES, QUOTE))
    e = spark.createDataFrame([(1, us(2026, 6, 1, 15), "USD"), (2, us(2026, 6, 2, 15, 59, 59), "USD"), (3, us(2026, 6, 2, 16), "USD"), (4, us(2026, 6, 9), "USD"), (5, us(2026, 6, 1, 1), "BRL"), (6, us(2026, 6, 9), "EUR"), (7, us(2026, 6, 9), None)], "i int, t long, c string")
    rated = gold.with_rates(e, i, "t", "c")
    got = {r.i: (r.fx_rate and float(r.fx_rate), r.fx_rate_date and r.fx_rate_date.day) for r in rated.collect()}
    assert got == {1: (None, None), 2: (5.1, 1), 3: (5.2, 2), 4: (5.2, 2), 5: (1.0, 1), 6: (None, None), 7: (None, None)}
    assert gold.fx_coverage(rated, "t", us(2026, 6, 2, 16)) == {"unresolved": 3, "beyond": 3, "widest": 7}


PAY = "transaction_id string, event_time string, emitted_at string, payer_cnpj_basico string, payee_cnpj_basico string, amount string, currency string, payment_method string, _record_source string"


def pay(i, at, payer="00000001", payee="00000002", amount="10.005", currency="BRL"):
    return (i, at, at, payer, payee, amount, currency, "PIX", "s")


def test_fact(spark):
    dim = dimension(spark)
    i = gold.ptax_intervals(spark.createDataFrame(QUOTES, QUOTE))
    data = [
        pay("0000000000000001", "2026-06-12T23:59:59.999Z"), pay("0000000000000001", "2026-06-12T23:59:59.999Z"), pay("0000-0000-0000-0002", "2026-06-13T00:00:00.000Z"), pay("0000000000000003", "2026-07-11T00:00:00.000Z", payer="00000002", payee="00000001"),
        pay("0000000000000004", "2026-06-12T23:59:59.999Z"), pay("0000000000000005", "2026-06-03T00:00:00.000Z", payer="99999999", payee=None, currency="USD"), pay(None, "2026-06-03T00:00:00.000Z"),
    ]
    payments = spark.createDataFrame(data, PAY)
    fact = gold.fact_rows(payments, dim, i, F.lit("2026-08-01T00:00:00Z").cast("timestamp"))
    name = {r.company_sk: r.name for r in dim.collect()}
    got = {r.transaction_id[-1]: (name[r.payer_company_sk], name[r.payee_company_sk], r.event_date_key, r.fx_rate_date_key, str(r.amount_brl)) for r in fact.collect()}
    assert got == {"1": ("A", "X", 20260612, 20260612, "10.01"), "2": ("B", "X", 20260613, 20260613, "10.01"), "3": ("X", "C", 20260711, 20260711, "10.01"), "4": ("A", "X", 20260612, 20260612, "10.01"), "5": (None, None, 20260603, 20260602, "52.05")}
    report = gold.load_fact(fact, "g_fact", payments, {"payer_company_sk": (dim, "company_sk"), "payee_company_sk": (dim, "company_sk")})
    assert report == {"appended": 5, "present": 5, "identities": 5, "unresolved": {"payer_company_sk": 1, "payee_company_sk": 1}, "orphans": {"payer_company_sk": 0, "payee_company_sk": 0}}
    assert gold.load_fact(fact, "g_fact", payments, {})["appended"] == 0
    assert gold.orphaned(fact, "payer_company_sk", dim.filter("name <> 'A'"), "company_sk") == 3
    for bad in (pay("0000000000000009", "yesterday"), pay("0000000000000009", "2026-06-03T00:00:00.000Z", amount="x"), pay("0000000000000009", "2026-05-03T00:00:00.000Z", currency="USD")):
        with pytest.raises(BuildRefused):
            gold.fact_rows(spark.createDataFrame([*data, bad], PAY), dim, i, F.lit(None).cast("timestamp"))
    assert gold.fact_rows(payments.limit(0), dim, i, F.lit(None).cast("timestamp")).count() == 0


def test_satellite_keys_the_hub_lacks_are_refused(spark):
    hub = spark.createDataFrame([("a",), ("a",)], "hk string")
    good, bad = (spark.createDataFrame(k, "hk string, applied_date string") for k in ([("a", "x"), (None, "x")], [("a", "x"), ("b", "x"), ("b", "y")]))
    gold.refuse_lost_keys(hub, "hk", {"s": good})
    with pytest.raises(BuildRefused, match="'t': 1"):
        gold.refuse_lost_keys(hub, "hk", {"s": good, "t": bad})


def test_refused_payments_stay_out_where_they_are_not_an_error(spark):
    dim, i = dimension(spark), gold.ptax_intervals(spark.createDataFrame(QUOTES, QUOTE))
    data = [pay("0000000000000001", "soon"), pay("0000000000000001", "2026-06-12T23:59:59.999Z"), pay("0000000000000002", "2026-05-03T00:00:00.000Z", currency="USD"), pay("0000000000000003", "soon")]
    payments = spark.createDataFrame(data, PAY)
    kept = gold.fact_rows(payments, dim, i, F.lit(None).cast("timestamp"), refuse=False)
    assert [r.transaction_id[-1] for r in kept.collect()] == ["1"]
    refused = {r.transaction_id[-1]: r.refusal for r in gold.refused_payments(gold.resolved_payments(payments, dim, i)).collect()}
    assert refused == {"2": gold.NO_RATE, "3": gold.UNREADABLE}
