"""Queries p1 to p6 over the project's tables, each through its operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.identity import company_key, company_text, hex_number, hex_text, message_id
from tidemark.functions.times import event_micros, midnight, month_of
from tidemark.operators.asof import Reach, asof_join
from tidemark.operators.errorparse import parse_records
from tidemark.operators.history import attribute_history
from tidemark.operators.orphans import find_orphans, latest_at, orphan_report
from tidemark.operators.redelivery import absorb, accepted_rows, identifier, ranges_after, whole_ranges, with_sequence
from tidemark.operators.skew import hot_keys
from tidemark.operators.snapshotdiff import snapshot_changes
from tidemark.plans import data_oracle
from tidemark.plans.tables import accepted_registry, delivered_snapshots, history_content, registry_content, snapshot_months, table
from tidemark.session import cut, written

#: Width in days of the time buckets of the as-of join: about two versions of a company fall into one.
BUCKET_DAYS = 64
OPEN_END = "2999-12-31"
#: Month from which `p2_seen_before` takes deliveries as a second batch.
SECOND_BATCH = "2027-04"


def _roles(payer: str, payee: str) -> Column:
    """One row for each role of a message: (party_role, company)."""
    return F.inline(F.array(F.struct(F.lit("payer").alias("party_role"), F.col(payer).alias("company")), F.struct(F.lit("payee").alias("party_role"), F.col(payee).alias("company"))))


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    """Deliveries with an identifier: (id, other_id, at, payer, payee); id is the number the hex digits spell."""
    bare = message_id(F.col("transaction_id"))
    rows = table(spark, folder, "payments").select(bare.alias("bare"), event_micros(F.col("event_time")).alias("at"), company_key(F.col("payer_cnpj_basico")).alias("payer"), company_key(F.col("payee_cnpj_basico")).alias("payee"))
    number = hex_number(F.col("bare"))
    return rows.filter(F.col("bare").isNotNull()).select(number.alias("id"), F.when(number.isNull(), F.col("bare")).alias("other_id"), "at", "payer", "payee")


def _id_text() -> Column:
    return F.coalesce(hex_text(F.col("id")), F.col("other_id"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """References to companies that the registry snapshot in force at the event does not hold.

    The reference is the composite (company, snapshot in force), matched in full: with no snapshot in force yet the
    key is partly null and an orphan.
    """
    registry = accepted_registry(spark, folder)
    held = registry.select("company", F.col("_snapshot_month").alias("in_force"))
    refs = _messages(spark, folder).filter(F.col("at").isNotNull()).select("id", "other_id", "at", _roles("payer", "payee")).filter(F.col("company").isNotNull())
    hot, _ = hot_keys(refs, ["company"])
    placed = refs.withColumn("in_force", latest_at(F.col("at"), delivered_snapshots(registry)))
    orphans = find_orphans(placed, held, ["company", "in_force"], semantics="full", hot=hot, hot_on=["company"], salt_on=["id", "other_id"])
    return orphans.select("id", "other_id", "party_role", month_of(F.col("at")).alias("event_month")).distinct().select(_id_text().alias("transaction_id"), "party_role", "event_month")


def _nullable_references(spark: SparkSession, folder: str, semantics: str) -> DataFrame:
    """Orphans among all references of payments, those with an unreadable instant or without a company included.

    An unreadable instant leaves the snapshot of the composite key null, a missing counterparty its company.
    """
    registry = accepted_registry(spark, folder)
    held = registry.select("company", F.col("_snapshot_month").alias("in_force"))
    refs = _messages(spark, folder).select("id", "other_id", "at", _roles("payer", "payee"))
    placed = refs.withColumn("in_force", latest_at(F.col("at"), delivered_snapshots(registry)))
    hot, _ = hot_keys(placed, ["company", "in_force"])
    orphans = find_orphans(placed, held, ["company", "in_force"], semantics=semantics, hot=hot, salt_on=["id", "other_id"])
    return orphans.select("id", "other_id", "party_role", "company", "in_force").distinct().select(_id_text().alias("transaction_id"), "party_role", company_text(F.col("company")).alias("company"), "in_force")


def p1_partial(spark: SparkSession, folder: str) -> DataFrame:
    """References whose known parts occur together in no registry row: a key with nulls is looked up on the rest."""
    return _nullable_references(spark, folder, "partial")


def p1_simple(spark: SparkSession, folder: str) -> DataFrame:
    """References that are complete and name no registry row; a key with a null refers to nothing."""
    return _nullable_references(spark, folder, "simple")


def p1_references(spark: SparkSession, folder: str) -> DataFrame:
    """Orphan references per table, role and month: payments to the registry, the fact to its dimension, statements to the hub."""
    dim = table(spark, folder, "dim_company").select(F.col("company_sk").alias("key"))
    fact = table(spark, folder, "fact_payment").select("transaction_id", month_of(event_micros(F.col("event_time"))).alias("event_month"), _roles("payer_company_sk", "payee_company_sk").alias("party_role", "key"))
    hub = table(spark, folder, "hub_empresa").select(F.col("hub_empresa_hk").alias("key"))
    said = table(spark, folder, "sat_empresa_dados").select(F.col("hub_empresa_hk").alias("key"), F.lit("statement").alias("party_role"), F.date_format("applied_date", "yyyy-MM").alias("event_month"), "hash_diff")
    report = p1_report(spark, folder)
    for name, refs, target, salt_on in (("fact_payment", fact, dim, "transaction_id"), ("sat_empresa_dados", said, hub, "hash_diff")):
        hot, _ = hot_keys(refs, ["key"])
        report = report.unionByName(orphan_report(find_orphans(refs, target, ["key"], hot=hot, salt_on=[salt_on]), name, "party_role", "event_month"))
    return report


def p1_report(spark: SparkSession, folder: str) -> DataFrame:
    """Orphan references of payments per role and month."""
    return orphan_report(p1_found(spark, folder), "payments", "party_role", "event_month")


def _deliveries(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    rows = table(spark, folder, "payments").select("transaction_id", *columns)
    return with_sequence(rows, message_id(F.col("transaction_id"))).drop("transaction_id")


def _identifier_text() -> Column:
    return F.coalesce(identifier(F.col("producer"), F.col("number")), F.col("other"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Identifiers with redeliveries: batch after batch, deliveries of a number that the seen ranges already cover."""
    again = absorb(_deliveries(spark, folder, "_batch_id"), order="_batch_id").filter(F.col("redelivered") > 0)
    return again.select("producer", "number", "other").distinct().select(_identifier_text().alias("transaction_id"))


def p2_seen_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Disjoint, non-adjacent ranges of numbers seen per producer after all deliveries."""
    ranges = whole_ranges(cut(ranges_after(_deliveries(spark, folder, "_batch_id"), order="_batch_id")))
    return ranges.select("producer", F.col("lo").alias("range_from"), F.col("hi").alias("range_to"))


def p2_seen_before(spark: SparkSession, folder: str) -> DataFrame:
    """Identifiers delivered from April on that the ranges seen up to March cover: the state carried between batches."""
    deliveries = _deliveries(spark, folder, "_snapshot_month")
    early, late = (deliveries.filter(f"_snapshot_month {sign} '{SECOND_BATCH}'").drop("_snapshot_month") for sign in ("<", ">="))
    texts = early.filter(F.col("other").isNotNull()).select("other").distinct()
    second = absorb(late, ranges_after(early), texts)
    return second.filter(F.col("accepted") == 0).select(_identifier_text().alias("transaction_id"), "deliveries")


def p2_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Exactly one row of each message, the delivery that the seen ranges accept; rows without identifier all stay."""
    kept = accepted_rows(table(spark, folder, "payments"), message_id(F.col("transaction_id")), ["_ingested_at", "_batch_id", "_source_file"], "_batch_id")
    return kept.withColumn("_ingested_at", F.unix_micros("_ingested_at"))


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    return parse_records(table(spark, folder, "raw_empresas").select("line_id", "raw_line", "_rescued_data"), "raw_line", "_rescued_data")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Records that do not become a row, with the first reason that applies."""
    return _parsed(spark, folder).filter(F.col("reason").isNotNull()).select("line_id", "reason")


def p3_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Records that load, as rows of the company contract."""
    return _parsed(spark, folder).filter(F.col("reason").isNull()).drop("raw_line", "_rescued_data", "reason", "quote_edits", "delimiter_edits", "edits")


def _costly(spark: SparkSession, folder: str) -> DataFrame:
    return _parsed(spark, folder).filter((F.col("quote_edits") > 0) | (F.col("delimiter_edits") > 0))


def p3_edits(spark: SparkSession, folder: str) -> DataFrame:
    """Records that parse only at a cost, with the numbers of quotes and delimiters that would have to be edited."""
    return _costly(spark, folder).select("line_id", "quote_edits", "delimiter_edits")


def p3_operations(spark: SparkSession, folder: str) -> DataFrame:
    """Records that parse only at a cost, with the edits that would repair them."""
    return _costly(spark, folder).select("line_id", "edits")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Companies added, removed or changed between consecutive snapshots."""
    registry = accepted_registry(spark, folder)
    months = snapshot_months(registry)
    changes = snapshot_changes(registry, F.col("company"), F.col("_snapshot_month"), registry_content(), F.unix_micros("_ingested_at"), months)
    return changes.select(company_text(F.col("key")).alias("cnpj_basico"), F.col("period").alias("snapshot_month"), "change_kind")


def company_history(spark: SparkSession, folder: str, companies: DataFrame | None = None) -> DataFrame:
    """Versions of every company of the hub: (company, version_no, valid_from, valid_to, attributes…).

    Statements are reduced to the latest per hash key and day before they meet the hub, so that a company with many
    rows is small when it is joined. `companies`: a list of distinct companies to keep to; the hub is reduced by it
    first, so the statements of all others end at their join with the hub.
    """
    hub = table(spark, folder, "hub_empresa").select(F.col("hub_empresa_hk").alias("hk"), company_key(F.col("cnpj_basico")).alias("company")).dropna().distinct()
    if companies is not None:
        hub = hub.join(companies, "company", "left_semi")
    state = F.struct(F.unix_micros("load_date").alias("loaded"), *history_content_columns())
    daily = table(spark, folder, "sat_empresa_dados").filter("hub_empresa_hk is not null and applied_date is not null").groupBy(F.col("hub_empresa_hk").alias("hk"), "applied_date").agg(F.max(state).alias("said"))
    said = daily.join(hub, "hk").select("company", "applied_date", "said.*")
    history = attribute_history(said, "company", "applied_date", F.col("loaded"), {c: F.col(c) for c in history_content()})
    return history.withColumnRenamed("entity", "company")


def history_content_columns() -> list[Column]:
    return [c.alias(n) for n, c in history_content().items()]


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every version of every company of the hub with its period."""
    end = F.coalesce(F.date_format("valid_to", "yyyy-MM-dd"), F.lit(OPEN_END))
    return company_history(spark, folder).select(company_text(F.col("company")).alias("cnpj_basico"), F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from"), end.alias("valid_to"))


def p5_history(spark: SparkSession, folder: str) -> DataFrame:
    """The full history with canonical attribute values; capital_social in hundredths."""
    end = F.coalesce(F.date_format("valid_to", "yyyy-MM-dd"), F.lit(OPEN_END))
    return company_history(spark, folder).select(company_text(F.col("company")).alias("cnpj_basico"), "version_no", F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from"), end.alias("valid_to"), *history_content())


def _versions_with_keys(spark: SparkSession, folder: str, companies: DataFrame) -> DataFrame:
    """Versions of the companies' history with the dimension's surrogate keys for them: (company, valid_from, valid_to, right_keys)."""
    dim = table(spark, folder, "dim_company").filter(F.col("company_sk") != -1)
    keys = dim.select(company_key(F.col("cnpj_basico")).alias("company"), F.unix_micros("valid_from").alias("valid_from"), "company_sk").groupBy("company", "valid_from").agg(F.collect_set("company_sk").alias("right_keys"))
    versions = company_history(spark, folder, companies).select("company", midnight(F.col("valid_from")).alias("valid_from"), midnight(F.col("valid_to")).alias("valid_to"))
    return versions.join(keys, ["company", "valid_from"], "left").select("company", "valid_from", "valid_to", "right_keys")


def _stored_roles(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each message of the fact and role: (id, other_id, at, party_role, company, least, most stored key).

    Deliveries and fact rows of a message meet in one aggregation. A stored null counts as 0, which is no key.
    """
    nothing = lambda kind: F.lit(None).cast(kind)
    said = _messages(spark, folder).select("id", "other_id", "payer", "payee", nothing("long").alias("at"), nothing("long").alias("payer_sk"), nothing("long").alias("payee_sk"))
    bare = message_id(F.col("transaction_id"))
    stored = table(spark, folder, "fact_payment").select(bare.alias("bare"), event_micros(F.col("event_time")).alias("at"), F.col("payer_company_sk").alias("payer_sk"), F.col("payee_company_sk").alias("payee_sk"))
    stored = stored.filter(F.col("bare").isNotNull()).withColumns({"id": hex_number(F.col("bare")), "payer_sk": F.coalesce("payer_sk", F.lit(0)), "payee_sk": F.coalesce("payee_sk", F.lit(0))})
    stored = stored.select("id", F.when(F.col("id").isNull(), F.col("bare")).alias("other_id"), nothing("int").alias("payer"), nothing("int").alias("payee"), "at", "payer_sk", "payee_sk")
    extremes = [f(c).alias(f"{n}_{c}") for c in ("payer_sk", "payee_sk") for n, f in (("least", F.min), ("most", F.max))]
    one = said.unionByName(stored).groupBy("id", "other_id").agg(F.max("payer").alias("payer"), F.max("payee").alias("payee"), F.min("at").alias("at"), *extremes)
    role = lambda r: F.struct(F.lit(r).alias("party_role"), F.col(r).alias("company"), F.col(f"least_{r}_sk").alias("least"), F.col(f"most_{r}_sk").alias("most"))
    return one.filter(F.col("least_payer_sk").isNotNull()).select("id", "other_id", "at", F.inline(F.array(role("payer"), role("payee"))))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of the fact and roles whose stored key is not that of the version valid at the event.

    A message's stored keys are right only if the least and the greatest of them are. The messages are written down
    once; their companies and the span of each one's events decide which versions take part in the join at all.
    """
    roles = written(_stored_roles(spark, folder), "fact-roles")
    reach = Reach(roles, "company", "at")
    known = asof_join(roles, _versions_with_keys(spark, folder, reach.entities()), "company", "at", reach=reach, days=BUCKET_DAYS, salt_on=["id", "other_id"])
    ghost = (F.col("least") == -1) & (F.col("most") == -1)
    held = F.coalesce(F.array_contains("right_keys", F.col("least")) & F.array_contains("right_keys", F.col("most")), F.lit(False))
    right = F.when(F.col("valid_from").isNull(), ghost).otherwise(held)
    return known.filter(~right).select(_id_text().alias("transaction_id"), "party_role")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_report, p1_partial, p1_simple, p1_references, p2_found, p2_seen_ranges, p2_seen_before, p2_messages, p3_found, p3_rows, p3_edits, p3_operations, p4_found, p5_found, p5_history, p6_found)}


def oracle_sql() -> dict[str, str]:
    return data_oracle.oracle_sql()
