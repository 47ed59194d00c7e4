import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark import store
from tidemark.operators import promote, quality
from tidemark.operators.promote import Promotion, PromoteRefused, plan_promotion
from tidemark.sources.contracts import COLUMNS, TABLES, UnknownTable, LandedTable, registry, rules_for, struct_of, table_spec

PTAX = ("2027-01-11", "USD", "2027-01-11 13:05:07.66", "5.1", "5.2")


def reasons(spark, contract, *changes, **extra):
    base = {"ptax": PTAX}.get(contract)
    columns = COLUMNS[contract]
    data = [tuple(c.get(n, v) for n, v in zip(columns, base, strict=True)) for c in changes]
    df = spark.createDataFrame(data, struct_of(contract)).withColumns({k: F.lit(v) for k, v in extra.items()})
    return [r[quality.REASON] for r in quality.classify(df, rules_for(contract)).collect()]


def test_first_match_wins(spark):
    got = reasons(spark, "ptax", {}, {"quote_date": None, "currency": " "}, {"quote_date": "2027-1-11"}, {"quote_date": "2027-02-30"}, {"cotacao_compra": "x"}, {"cotacao_venda": "1,2"}, {"data_hora_cotacao": "13:05:07"}, {"data_hora_cotacao": "2027-01-11"}, {"currency": "US�"})
    assert got == [None, "null_or_empty_quote_date", "bad_quote_date_shape", "bad_quote_date_shape", "unparseable_cotacao_compra", "unparseable_cotacao_venda", "unparseable_data_hora_cotacao", "unparseable_data_hora_cotacao", "encoding_replacement_char"]
    assert reasons(spark, "ptax", {"quote_date": None}, _rescued_data="{}") == ["rescued_data_present"]


def test_merchant_rules(spark):
    columns = COLUMNS["merchant"]
    good = dict.fromkeys(columns, "x") | {"cnpj": "12345678000190", "onboarded_on": "2027-01-01", "_snapshot_at": "2027-01-01T00:00:00.000000Z", "credit_limit": "1.00", "trade_name": None}
    cases = [({}, None), ({"cnpj": "1"}, "bad_cnpj_shape"), ({"onboarded_on": "01/01/2027"}, "bad_onboarded_on_shape"), ({"_snapshot_at": "2027-01-01T00:00:00Z"}, "bad_snapshot_at_shape"), ({"credit_limit": "1e400"}, "unparseable_credit_limit"), ({"legal_name": "ɤ"}, "unhashable_case_divergence"), ({"status": " "}, "null_or_empty_status")]
    df = spark.createDataFrame([tuple((good | c)[n] for n in columns) for c, _ in cases], struct_of("merchant")).withColumn("_snapshot_ref_date", F.lit("2027-01-01").cast("date"))
    assert [r[quality.REASON] for r in quality.classify(df, rules_for("merchant")).collect()] == [w for _, w in cases]
    undated = df.limit(1).withColumn("_snapshot_ref_date", F.lit(None).cast("date"))
    assert quality.classify(undated, rules_for("merchant")).first()[quality.REASON] == "unprovable_snapshot_ref_date"


def test_rules_of_missing_columns_are_announced(spark):
    df = spark.createDataFrame([("a",)], "codigo string")
    assert quality.skipped(df, rules_for("lookup")) == [("null_or_empty_descricao", ["descricao"]), ("encoding_replacement_char", ["descricao"])]
    assert quality.tally(quality.classify(df, rules_for("lookup"))) == (1, 0)


def test_split_tally_and_overlap(spark):
    df = spark.createDataFrame([("a", "b", None), (None, "", None), ("c", None, "{}"), ("d", "�", None)], "codigo string, descricao string, _rescued_data string")
    classified = quality.classify(df, rules_for("lookup"))
    good, bad = quality.split(classified)
    assert (good.count(), bad.count()) == quality.tally(classified) == (1, 3) and quality.REASON not in good.columns
    o = quality.overlap(df, rules_for("lookup")).first().asDict()
    assert o == {"rows": 4, "rescued_rows": 1, "null_or_empty_codigo": 1, "null_or_empty_descricao": 2, "encoding_replacement_char": 1, "rows_with_two_or_more": 1, "rescued_with_a_rule": 1}
    assert quality.overlap(df.limit(0), rules_for("lookup")).first()["rows"] == 0


def test_rule_order_is_a_contract():
    assert [r.reason for r in rules_for("payments")] == [f"null_or_empty_{c}" for c in COLUMNS["payments"]] + ["bad_payer_cnpj_basico_length", "bad_payee_cnpj_basico_length", "encoding_replacement_char"]
    assert [r.reason for r in rules_for("empresas")][-3:] == ["bad_cnpj_basico_length", "encoding_replacement_char", "unprovable_snapshot_ref_date"]
    assert len(rules_for("merchant")) == 13 + 4 + 1 + 1 + 1
    with pytest.raises(UnknownTable):
        rules_for("nothing")


def test_registry_refusals():
    with pytest.raises(UnknownTable):
        table_spec("nothing")
    with pytest.raises(ValueError):
        registry(TABLES["ptax"], LandedTable("ptax", "api"))
    with pytest.raises(ValueError):
        LandedTable("ptax", "post")
    with pytest.raises(UnknownTable):
        LandedTable("nope", "api")


@pytest.mark.parametrize("counts,want", [
    ((3, 3, 3, True), Promotion(promote.ALREADY, 0)), ((3, 0, 0, True), Promotion(promote.ALREADY_GONE, 0)), ((2, 3, 3, True), None), ((0, 0, 0, True), Promotion(promote.NOTHING, 0)),
    ((0, 0, 0, False), None), ((0, 0, 2, True), None), ((0, 2, 3, False), Promotion(promote.APPENDED, 2)),
])
def test_promotion_decisions(counts, want):
    if want is None:
        with pytest.raises(PromoteRefused):
            plan_promotion(*counts)
    else:
        assert plan_promotion(*counts) == want


def staged(spark, name, data):
    df = spark.createDataFrame(data, "codigo string, descricao string, _batch_id string")
    store.append(df, name)


def test_gate_and_promotion_are_idempotent_and_all_or_nothing(spark):
    s, b, q = "t_stage", "t_bronze", "t_quar"
    rules = rules_for("lookup")
    staged(spark, s, [("1", "a", "good"), ("2", "b", "good"), ("3", "c", "bad"), (None, "d", "bad")])
    assert promote.run_batch(spark, s, b, q, "good", rules) == Promotion(promote.APPENDED, 2)
    assert promote.run_batch(spark, s, b, q, "good", rules) == Promotion(promote.ALREADY, 0)
    for _ in range(2):
        with pytest.raises(PromoteRefused):
            promote.run_batch(spark, s, b, q, "bad", rules)
    assert store.rows_of_batch(spark, q, "bad") == 1 and store.rows_of_batch(spark, b, "bad") == 0
    assert promote.promote_batch(spark, "bad", s, b, rules, in_flow=False) == Promotion(promote.APPENDED, 1)
    assert promote.promote_batch(spark, "none", s, b, rules, in_flow=True).outcome == promote.NOTHING
    with pytest.raises(PromoteRefused):
        promote.promote_batch(spark, "none", s, b, rules, in_flow=False)
    with pytest.raises(PromoteRefused):
        promote.promote_batch(spark, " ", s, b, rules, in_flow=True)
    staged(spark, s, [("9", "late", "good")])
    with pytest.raises(PromoteRefused):
        promote.run_batch(spark, s, b, q, "good", rules)


def test_broken_promises_stop_the_write(spark):
    staged(spark, "t_stage2", [("", "a", "x")])
    with pytest.raises(store.WriteRefused):
        promote.promote_batch(spark, "x", "t_stage2", "t_bronze2", [], in_flow=True, promises=["length(trim(codigo)) > 0"])
    assert not store.table_exists(spark, "t_bronze2")


def test_partitioned_tables_stay_partitioned(spark):
    df = spark.createDataFrame([("a", "2027-01"), ("b", "2027-02")], "k string, _snapshot_month string")
    store.append(df, "t_part", ["_snapshot_month"])
    store.append(df.select("_snapshot_month", "k"), "t_part")
    assert store.swap(spark.table("t_part").filter("k = 'a'"), "t_part") == 2
    assert [c.name for c in spark.catalog.listColumns("t_part") if c.isPartition] == ["_snapshot_month"]
    assert rows(spark.table("t_part")) == [("a", "2027-01"), ("a", "2027-01")]


def test_store(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "k int, v string")
    assert store.append_new(df, "t_store", ["k"]) == 2 and store.append_new(df, "t_store", ["k"]) == 0
    assert store.append_new(df.withColumn("k", F.col("k") + 1), "t_store", ["k"]) == 1
    assert store.rows_in(spark, "t_store") == 3 and store.rows_in(spark, "t_absent") == 0
    assert rows(store.new_rows(df, df, ["k", "v"])) == [(1, None)] and rows(store.new_rows(df, df, ["k", "v"], null_safe=True)) == []
    with pytest.raises(store.WriteRefused):
        store.append(df.select("k"), "t_store")
    with pytest.raises(store.WriteRefused):
        store.rows_of_batch(spark, "t_store", "x")
    assert store.swap(spark.table("t_store").filter("k < 3"), "t_store") == 2 and store.rows_in(spark, "t_store") == 2
    with pytest.raises(store.WriteRefused):
        store.swap(spark.table("t_store").limit(0), "t_store")
