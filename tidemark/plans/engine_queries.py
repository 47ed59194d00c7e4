"""Queries of the engine's smaller operators, whose inputs are made from the supplied tables by SQL that both engines read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.identity import company_key, company_text
from tidemark.functions.times import day_of, event_micros, ref_date_of_instant
from tidemark.operators import dataops, gold, governance, quality, vault
from tidemark.operators.asof import Reach
from tidemark.operators.specs import MODEL, Reference
from tidemark.plans import model_queries
from tidemark.plans.model_oracle import ENGINE_CASES
from tidemark.plans.tables import table
from tidemark.sources import generator
from tidemark.sources.contracts import rules_for
from tidemark.sources.readers import lookup_type


def _made(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Rows that one of ENGINE_CASES makes of a supplied table."""
    source, columns = ENGINE_CASES[name]
    return table(spark, folder, source).selectExpr(*(f"{sql} AS {c}" for c, sql in columns.items()))


def dq_merchant(spark, folder):
    """Merchants made of customers, with the first rule that rejects each: shapes of keys, dates, instants and amounts, letters."""
    return quality.classify(_made(spark, folder, "merchant"), rules_for("merchant")).select("merchant_id", quality.REASON)


def lookup_kinds(spark, folder):
    """Kind of lookup that a file's name states."""
    return _made(spark, folder, "lookup").select("codigo", "_source_file", lookup_type(F.col("_source_file")).alias("kind"))


def lookup_references(spark, folder):
    """The earliest description of every code of each kind of lookup file."""
    rows, all_ = _made(spark, folder, "lookup"), None
    for spec in MODEL.values():
        if isinstance(spec, Reference):
            own = vault.reference_candidates(rows, spec).withColumn("reference", F.lit(spec.name))
            all_ = own if all_ is None else all_.unionByName(own)
    return all_


def ref_date_instant(spark, folder):
    """Reference dates that snapshot instants prove, and the day that a text begins with."""
    rows = _made(spark, folder, "instants")
    return rows.select("event_id", "said", ref_date_of_instant(F.col("said")).alias("ref_date"), day_of(F.col("said")).alias("day"))


def latest_task_runs(spark, folder):
    """The two hundred task runs that ended last."""
    return dataops.latest_runs(model_queries._telemetry(spark, folder)).select("run_id", "task_key", "job_id", "job_run_id", "sql_telemetry", "statements")


def sql_coverage(spark, folder):
    """Per task: runs, measured, not yet attributed, failed."""
    return dataops.sql_coverage(model_queries._telemetry(spark, folder)).drop("last_ended_at")


def rule_overlap_sweep(spark, folder):
    """Hits of every rule of two landed sources by batch, not just the first rule's."""
    both = [quality.overlap_by_rule(table(spark, folder, name), rules_for(name), name) for name in ("payments", "empresas")]
    return both[0].unionByName(both[1])


def gate_counts(spark, folder):
    """Rows of every batch of payments that the gate lets through and holds back."""
    bad = F.col(quality.REASON).isNotNull()
    good_rows, bad_rows = quality.split(quality.classify(table(spark, folder, "payments"), rules_for("payments")))
    both = good_rows.select("_batch_id", F.lit(False).alias("bad")).unionByName(bad_rows.select("_batch_id", bad.alias("bad")))
    return both.groupBy("_batch_id").agg(F.count(F.when(~F.col("bad"), 1)).alias("good"), F.count(F.when(F.col("bad"), 1)).alias("held_back"))


#: Batch whose files are accounted for by `file_accounts_of_batch`: the largest of the supplied payments.
BATCH = "pay-20270109-0"


def file_accounts_of_batch(spark, folder):
    """Accounts by file of one batch, by SQL with a bound parameter."""
    names = {}
    for _, role, rows in model_queries._legs(spark, folder):
        names[role] = f"tidemark_{role}"
        rows.createOrReplaceTempView(names[role])
    return dataops.file_accounts_of_batch(spark, "payments", names, BATCH)


def fx_totals(spark, folder):
    """Payments without a rate, beyond the last quote, and the widest reach back in days, in one pass."""
    intervals = model_queries.fx_intervals(spark, folder)
    last = intervals.agg(F.max("valid_from")).first()[0]
    found = gold.fx_coverage(model_queries._priced(spark, folder), "at", last)
    return spark.createDataFrame([(found["unresolved"], found["beyond"], found["widest"])], "unresolved long, beyond long, widest int")


def party_reach(spark, folder):
    """Companies that payments name in either role, with the span of each one's events: what versions can be reached."""
    key = lambda c: company_text(company_key(F.col(c)))
    rows = table(spark, folder, "payments").select(event_micros(F.col("event_time")).alias("at"), F.explode(F.array(key("payer_cnpj_basico"), key("payee_cnpj_basico"))).alias("company"))
    return Reach(rows, "company", "at").spans.select("company", F.col("__n").alias("events"), F.col("__first").alias("first_at"), F.col("__last").alias("last_at"))


def orphan_counts(spark, folder):
    """Rows whose key another table lacks, counted by distinct key: customers without orders, parts nobody supplies, stored keys."""
    t = lambda name: table(spark, folder, name)
    cases = {"customers_without_orders": (t("customer"), "c_custkey", t("orders"), "o_custkey"), "parts_without_lines": (t("part"), "p_partkey", t("lineitem"), "l_partkey"), "fact_keys": (t("fact_payment"), "payee_company_sk", t("dim_company"), "company_sk")}
    return spark.createDataFrame([(name, gold.orphaned(rows, column, there, key)) for name, (rows, column, there, key) in cases.items()], "measure string, n long")


def masked_suppliers(spark, folder):
    """Suppliers through a masked view: nobody is a member of the group that may see names."""
    table(spark, folder, "supplier").createOrReplaceTempView("tidemark_suppliers")
    spark.createDataFrame([], "user string, member_group string").createOrReplaceTempView("tidemark_members")
    governance.mask_function(spark, "tidemark_mask", "tidemark_members", "readers")
    governance.masked_view(spark, "tidemark_suppliers", "tidemark_suppliers_masked", ["s_name"], "tidemark_mask")
    return spark.table("tidemark_suppliers_masked")


def stream_digests(spark, folder):
    """Digests that a generated stream draws from: hash of name space, seed, purpose, place and salt."""
    s = generator.PROFILES["plain"].stream(("00000001", "00000002"))
    return table(spark, folder, "orders").select("o_orderkey", s.digest("amount", F.col("o_orderkey")).alias("digest"))


def text_instants(spark, folder):
    """Instants as text with milliseconds, and the instants read back from it."""
    ms: Column = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, folder, "events").select("event_id", generator.instant_text(ms).alias("said")).withColumn("micros", event_micros(F.col("said")))


QUERIES = (
    dq_merchant, lookup_kinds, lookup_references, ref_date_instant, latest_task_runs, sql_coverage, rule_overlap_sweep, gate_counts, file_accounts_of_batch, fx_totals, party_reach,
    orphan_counts, masked_suppliers, stream_digests, text_instants,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    from tidemark.plans.model_oracle import engine_sql

    return engine_sql()
