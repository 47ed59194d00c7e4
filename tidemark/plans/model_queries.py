"""Queries of the engine's own operators over the supplied tables, and their SQL.

Each is a function (session, folder) to a DataFrame over whole tables; `oracle_sql` has the same result in SQL,
written apart from the operators. Keys are cleaned as the data states before they are hashed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.identity import check_digits, company_key, company_text, message_id
from tidemark.functions.keys import hash_key, zero_padded
from tidemark.functions.times import DAY_US, event_micros, midnight, ref_date_of_file, token_month
from tidemark.operators import dataops, gold, governance, quality, vault
from tidemark.operators.asof import Reach, asof_join, intervals_from_changes
from tidemark.operators.promote import PromoteRefused, plan_promotion
from tidemark.operators.redelivery import one_of_each
from tidemark.operators.snapshotdiff import missed_by_watermark, snapshot_changes
from tidemark.operators.specs import Hub, KeyColumn, Link, LinkEnd, Prefix, Satellite
from tidemark.plans.tables import snapshot_months, table
from tidemark.session import cut, passing_folder, written
from tidemark.sources import generator
from tidemark.sources.contracts import COLUMNS, LandedTable, rules_for
from tidemark.store import new_rows
from tidemark.streaming import ingest, measures

COMPANY = Hub("hub_company", "hub_company_hk", (KeyColumn("cnpj_basico", 8),))
COMPANY_DATA = Satellite("sat_company", "hub_company", ("razao_social", "natureza_juridica", "capital_social", "porte_empresa"))
PAYER_PAYEE = Link("link_payer_payee", "link_payer_payee_hk", (LinkEnd("hub_company", "payer"), LinkEnd("hub_company", "payee")))
PAYER_PARTNER = Link("link_payer_partner", "link_payer_partner_hk", (LinkEnd("hub_company", "company"), LinkEnd("hub_company", "partner", identifying=False)), ("kind", "number"))
#: Day as of which freshness is stated, so that the result doesn't change with the calendar.
TODAY = dt.date(2027, 9, 1)
HOUR_MS = 3_600_000


def _registry(spark: SparkSession, folder: str) -> DataFrame:
    """Registry rows with an eight-digit key; rejects included, see `_rescued_data`."""
    return table(spark, folder, "empresas").withColumn("cnpj_basico", company_text(company_key(F.col("cnpj_basico"))))


def _accepted(spark: SparkSession, folder: str) -> DataFrame:
    return _registry(spark, folder).filter(F.col("_rescued_data").isNull() & F.col("cnpj_basico").isNotNull())


def _instants(spark: SparkSession, folder: str) -> DataFrame:
    """Payments with readable instants: (id, event_ms, emitted_ms)."""
    rows = table(spark, folder, "payments").select(message_id(F.col("transaction_id")).alias("id"), event_micros(F.col("event_time")).alias("e"), event_micros(F.col("emitted_at")).alias("m"))
    ms = lambda c: ((F.col(c) - F.pmod(F.col(c), F.lit(1000))) / 1000).cast("long")
    return rows.filter("e is not null and m is not null").select("id", ms("e").alias("event_ms"), ms("m").alias("emitted_ms"))


# --- quality ------------------------------------------------------------------------------------------------------


def dq_classify(spark, folder):
    """Every registry row with the first rule that rejects it."""
    return quality.classify(table(spark, folder, "empresas"), rules_for("empresas")).select("cnpj_basico", "_snapshot_month", "_source_file", quality.REASON)


def dq_tally(spark, folder):
    """Payments per reason to reject them."""
    return quality.classify(table(spark, folder, "payments"), rules_for("payments")).groupBy(quality.REASON).agg(F.count(F.lit(1)).alias("rows"))


def dq_overlap(spark, folder):
    """Hits of every payment rule, per month, and rows that several rules reject."""
    return quality.overlap(table(spark, folder, "payments"), rules_for("payments"), by=["_snapshot_month"])


def dq_ptax(spark, folder):
    """Exchange quotes that the gate lets through."""
    return quality.split(quality.classify(table(spark, folder, "ptax"), rules_for("ptax")))[0]


# --- keys ---------------------------------------------------------------------------------------------------------


def hash_keys(spark, folder):
    """Business-key hashes of customers: a padded number, a nation key that may be blank or null, a name with spaces around it."""
    c = table(spark, folder, "customer")
    nation = F.when(F.col("c_nationkey") % 5 == 0, F.lit(None)).when(F.col("c_nationkey") % 5 == 1, F.lit("")).when(F.col("c_nationkey") % 5 == 2, F.lit(" \t ")).otherwise(F.col("c_nationkey").cast("string"))
    return c.select("c_custkey", hash_key(zero_padded(F.col("c_custkey").cast("string"), 8), nation, F.concat(F.lit("  "), F.lower("c_name"), F.lit(" "))).alias("customer_hk"))


def hub_company(spark, folder):
    """Companies of the accepted registry rows and the source that first showed each."""
    return vault.hub_candidates(_accepted(spark, folder), COMPANY)


def hub_company_increment(spark, folder):
    """Companies the hub would append from July, given what it holds up to June."""
    rows = _accepted(spark, folder)
    held = vault.hub_candidates(rows.filter(F.col("_snapshot_month") < "2027-07"), COMPANY)
    return new_rows(vault.hub_candidates(rows.filter(F.col("_snapshot_month") == "2027-07"), COMPANY), held, ["hub_company_hk"])


def _parties(spark, folder):
    key = lambda c: company_text(company_key(F.col(c)))
    return table(spark, folder, "payments").select(key("payer_cnpj_basico").alias("payer"), key("payee_cnpj_basico").alias("payee"), "payment_method", "payee_cnpj_basico", "_snapshot_month", "_record_source").filter("payer is not null and payee is not null")


def link_payer_payee(spark, folder):
    """Who paid whom: a link of the company hub to itself, both ends identifying."""
    link = Link(PAYER_PAYEE.name, PAYER_PAYEE.hash_key, (LinkEnd("hub_company", "payer", key_from=(Prefix("payer", 8),)), LinkEnd("hub_company", "payee", key_from=(Prefix("payee", 8),))))
    return vault.link_candidates(_parties(spark, folder), link, {"hub_company": COMPANY})


def link_payer_partner(spark, folder):
    """Payers and their partners: the partner is a company only for kind 1 and a full number, else the reference is null."""
    digits = F.regexp_replace("payee_cnpj_basico", "[^0-9]", "")
    rows = _parties(spark, folder).select(F.col("payer").alias("cnpj_basico"), F.when(F.col("payment_method") == "PIX", "2").otherwise("1").alias("kind"), digits.alias("number"), "_snapshot_month", "_record_source")
    return vault.partner_link_candidates(rows, PAYER_PARTNER, COMPANY, "kind", "number")


# --- satellites ---------------------------------------------------------------------------------------------------


def _latest(spark, folder):
    """The accepted row of each company and snapshot that counts: the last ingested."""
    rows = _accepted(spark, folder)
    columns = [*COMPANY_DATA.payload, "_snapshot_ref_date", "_record_source", "_rescued_data"]
    return rows.groupBy("cnpj_basico", "_snapshot_month").agg(F.max(F.struct("_ingested_at", *columns)).alias("r")).select("cnpj_basico", "_snapshot_month", *(F.col(f"r.{c}").alias(c) for c in columns))


def _shown(rows):
    return rows.select("hub_company_hk", "applied_date", "hash_diff", *COMPANY_DATA.payload)


def sat_changed_rows(spark, folder):
    """Changes of company attributes over the snapshots, as delivered, by payload hash."""
    return _shown(vault.changed_rows(vault.satellite_candidates(_latest(spark, folder), COMPANY_DATA, COMPANY), None, "hub_company_hk"))


def sat_incremental(spark, folder):
    """The same in two loads, the second seeded with what the first kept."""
    candidates = vault.satellite_candidates(_latest(spark, folder), COMPANY_DATA, COMPANY)
    first = vault.changed_rows(candidates.filter("applied_date < DATE'2027-04-01'"), None, "hub_company_hk")
    second = vault.changed_rows(candidates.filter("applied_date >= DATE'2027-04-01'"), first, "hub_company_hk")
    return _shown(first.unionByName(second))


def observation_ledger(spark, folder):
    """State of every company key in every snapshot; rejected rows are the gate's side, keyless ones included."""
    rows = _registry(spark, folder)
    return vault.observation_ledger(rows.filter("_rescued_data is null"), rows.filter("_rescued_data is not null"), ["cnpj_basico"])


def effectivity_windows(spark, folder):
    """When companies were listed: opened where observed, closed by absence; the legal nature is carried on."""
    rows = _registry(spark, folder).filter("cnpj_basico is not null")
    good, bad = rows.filter("_rescued_data is null"), rows.filter("_rescued_data is not null")
    said = vault.effectivity_statements(good, bad, F.col("cnpj_basico"), "company", ["cnpj_basico"], "natureza_juridica")
    return vault.effectivity_rows(said, None, "company")


def reference_pick(spark, folder):
    """One description per code: of each part brand the type of its first part."""
    rows = table(spark, folder, "part")
    return vault.earliest(rows, ["p_brand"], "p_partkey", "p_type")


# --- dimensions ---------------------------------------------------------------------------------------------------


def scd2_company(spark, folder):
    """Versioned companies with floor, ceiling and ghost, without the hashed key and the load date."""
    kept = vault.changed_rows(vault.satellite_candidates(_latest(spark, folder), COMPANY_DATA, COMPANY), None, "hub_company_hk")
    rows = gold.scd2_rows(kept, hub_company(spark, folder), "hub_company_hk", ["cnpj_basico"], list(COMPANY_DATA.payload), "company_sk", F.current_timestamp())
    return rows.select("cnpj_basico", *COMPANY_DATA.payload, F.unix_micros("valid_from").alias("valid_from"), F.unix_micros("valid_to").alias("valid_to"), "is_current", "record_source")


def xxhash_injective(spark, folder):
    """Versions and distinct surrogate keys of the company dimension: they must be equal."""
    kept = vault.changed_rows(vault.satellite_candidates(_latest(spark, folder), COMPANY_DATA, COMPANY), None, "hub_company_hk")
    rows = gold.scd2_rows(kept, hub_company(spark, folder), "hub_company_hk", ["cnpj_basico"], list(COMPANY_DATA.payload), "company_sk", F.lit(None).cast("timestamp"))
    keys = rows.groupBy("company_sk").agg(F.count(F.lit(1)).alias("n"))
    return keys.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys"))


def dim_calendar(spark, folder):
    """Calendar over the days of orders and of shipments."""
    span = gold.covered_span(table(spark, folder, "orders").select(F.to_date("o_orderdate")), table(spark, folder, "lineitem").select(F.to_date("l_shipdate")))
    return gold.calendar_rows(spark, *span)


def dim_channel(spark, folder):
    """Members of the channel dimension and its ghost, without the hashed key."""
    return gold.enumerated_rows(table(spark, folder, "payments"), "payment_method", "channel_key").select("payment_method", (F.col("channel_key") == gold.GHOST).alias("is_ghost"))


def _customer_satellites(spark, folder):
    """Two satellites of customers, by month of order: the least status and the least priority, changes only."""
    o = table(spark, folder, "orders").select(F.col("o_custkey").alias("hk"), F.trunc("o_orderdate", "month").alias("applied_date"), "o_orderstatus", "o_orderpriority")
    by = o.groupBy("hk", "applied_date").agg(F.min("o_orderstatus").alias("status"), F.min("o_orderpriority").alias("priority"))
    return {c: vault.changed_rows(by.select("hk", "applied_date", c), None, "hk", change=c) for c in ("status", "priority")}


def pit_customer(spark, folder):
    """Per customer and as-of month the row of each satellite in force."""
    hub = table(spark, folder, "customer").select(F.col("c_custkey").alias("hk"))
    return gold.pit_rows(hub, "hk", _customer_satellites(spark, folder))


def pit_rows_per_as_of(spark, folder):
    """Rows of the point-in-time table per as-of month."""
    return gold.rows_per_as_of(pit_customer(spark, folder))


def customer_asof(spark, folder):
    """Revenue of shipments by the customer's status as known when they shipped: deliveries reduced to one, interval join, sum."""
    lines = fact_dedup(spark, folder)
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("hk"))
    cents = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100).cast("long")
    micros = F.unix_micros(F.col("l_shipdate").cast("timestamp"))
    events = lines.join(orders, "l_orderkey").select("hk", "l_orderkey", "l_linenumber", micros.alias("at"), cents.alias("cents"))
    events = written(events, "shipments")  # read for its reach and for the join
    changes = _customer_satellites(spark, folder)["status"].select("hk", F.unix_date("applied_date").cast("long").alias("day"), "status")
    versions = status_intervals(changes)
    known = asof_join(events, versions, "hk", "at", reach=Reach(events, "hk", "at"), days=128, salt_on=["l_orderkey", "l_linenumber"])
    return known.groupBy(F.coalesce("status", F.lit("(none yet)")).alias("status")).agg(F.count(F.lit(1)).alias("lines"), F.sum("cents").alias("revenue_cents"))


def status_intervals(changes):
    """Half-open intervals in epoch microseconds from changes by day."""
    micros = lambda c: F.col(c) * F.lit(DAY_US)
    return intervals_from_changes(changes, ["hk"], "day").select("hk", "status", micros("valid_from").alias("valid_from"), micros("valid_to").alias("valid_to"))


# --- fact ---------------------------------------------------------------------------------------------------------


def fact_dedup(spark, folder):
    """One row of each order line, the least by all its columns."""
    rows = table(spark, folder, "lineitem")
    return one_of_each(rows, F.concat_ws("-", "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


def fx_intervals(spark, folder):
    """Intervals in which each exchange quote is in force, by instant of publication."""
    return gold.ptax_intervals(dq_ptax(spark, folder))


def _cleaned(spark, folder):
    """Payments with eight-digit company keys."""
    key = lambda c: company_text(company_key(F.col(c)))
    return table(spark, folder, "payments").withColumns({"payer_cnpj_basico": key("payer_cnpj_basico"), "payee_cnpj_basico": key("payee_cnpj_basico")})


def _payable(spark, folder):
    """Messages that can be priced: identifier, readable instant and amount; company keys cleaned; no rejects by shape."""
    return _cleaned(spark, folder).filter(event_micros(F.col("event_time")).isNotNull() & F.col("amount").try_cast(gold.AMOUNT).isNotNull())


def _priced(spark, folder):
    rows = one_of_each(_payable(spark, folder).select("transaction_id", "event_time", "amount", "currency").filter(message_id(F.col("transaction_id")).isNotNull()), message_id(F.col("transaction_id")), ["transaction_id"])
    events = rows.select(message_id(F.col("transaction_id")).alias("id"), event_micros(F.col("event_time")).alias("at"), F.col("amount").try_cast(gold.AMOUNT).alias("amount"), "currency")
    return gold.with_rates(events, fx_intervals(spark, folder), "at", "currency")


def fx_resolution(spark, folder):
    """Payments with the exchange rate in force at their instant and the converted amount."""
    return _priced(spark, folder).select("id", "currency", "amount", "fx_rate", "fx_rate_date", gold.converted(F.col("amount"), F.col("fx_rate")).alias("amount_brl"))


def fx_coverage(spark, folder):
    """Payments per currency, those without a rate, and the widest reach back in days."""
    day = F.date_from_unix_date(F.floor(F.col("at") / 86_400_000_000).cast("int"))
    return _priced(spark, folder).groupBy("currency").agg(F.count(F.lit(1)).alias("payments"), F.count(F.when(F.col("fx_rate").isNull(), 1)).alias("unresolved"), F.max(F.datediff(day, F.col("fx_rate_date"))).cast("int").alias("widest_days"))


def fact_payment_rows(spark, folder):
    """The payment fact: one row per message, both roles and the rate as of the event; hashed keys left out."""
    fact = gold.fact_rows(_cleaned(spark, folder), table(spark, folder, "dim_company"), fx_intervals(spark, folder), F.lit(None).cast("timestamp"), refuse=False)
    return fact.drop("channel_key", "currency_key", "load_date", "record_source", "event_time")


def fact_refused(spark, folder):
    """Messages that can't become fact rows, with the reason."""
    return gold.refused_payments(gold.resolved_payments(_cleaned(spark, folder), table(spark, folder, "dim_company"), fx_intervals(spark, folder)))


def fact_accounts(spark, folder):
    """What the payments and the stored fact add up to: identities, business tuples, legitimate repeats, identities lacking."""
    return gold.fact_accounts(table(spark, folder, "payments"), COLUMNS["payments"][3:], table(spark, folder, "fact_payment"))


def fact_hashed_keys(spark, folder):
    """Hashed keys of channels and currencies as facts and dimensions share them."""
    rows = table(spark, folder, "payments")
    members = [gold.enumerated_rows(rows, column, key).select(F.lit(column).alias("dimension"), F.col(column).alias("member"), F.col(key).alias("key")) for column, key in (("payment_method", "channel_key"), ("currency", "currency_key"))]
    return members[0].unionByName(members[1])


def pit_lost_keys(spark, folder):
    """Keys of the supplied satellite that its hub lacks: a point-in-time table would have no rows for them."""
    return gold.lost_keys(table(spark, folder, "hub_empresa"), "hub_empresa_hk", {"sat_empresa_dados": table(spark, folder, "sat_empresa_dados")})


def role_unresolved(spark, folder):
    """Stored fact rows per role whose company has no version: key −1."""
    f = table(spark, folder, "fact_payment")
    return f.agg(*(F.count(F.when(F.col(c) == -1, 1)).alias(c) for c in ("payer_company_sk", "payee_company_sk")))


def orphan_keys(spark, folder):
    """Stored fact rows whose company key no dimension row has, per role."""
    f, d = table(spark, folder, "fact_payment"), table(spark, folder, "dim_company").select(F.col("company_sk").alias("k"))
    keys = f.select(F.inline(F.array(*(F.struct(F.lit(r).alias("role"), F.col(f"{r}_company_sk").alias("sk")) for r in ("payer", "payee")))))
    distinct = keys.filter("sk is not null").groupBy("role", "sk").agg(F.count(F.lit(1)).alias("n"))
    return distinct.join(d, distinct.sk == d.k, "left_anti").groupBy("role").agg(F.sum("n").alias("orphans"))


# --- operations ---------------------------------------------------------------------------------------------------


def _legs(spark, folder):
    """Three sides of payments by what happened to a row: keyless ones are rejected, rows with rescued data still wait, one channel came twice."""
    rows = table(spark, folder, "payments").select("_batch_id", "_source_file", "transaction_id", "_rescued_data", "payment_method")
    twice = rows.filter("_batch_id like '%-3' and payment_method = 'TED'")
    return [("payments", "staged", rows), ("payments", "promoted", rows.filter("transaction_id is not null and _rescued_data is null").unionByName(twice)), ("payments", "quarantined", rows.filter("transaction_id is null"))]


def reconcile_batch(spark, folder):
    """Staged, promoted and quarantined rows of every batch with a verdict."""
    return dataops.batch_accounts(_legs(spark, folder))


def reconcile_file(spark, folder):
    """The same by file, and whether the file may be deleted."""
    return dataops.file_accounts(_legs(spark, folder))


def promotion_plan(spark, folder):
    """The promotion decision over every combination of small counts."""
    rows = []
    for b in range(3):
        for p in range(3):
            for s in range(p, 3):
                for flow in (True, False):
                    try:
                        plan = plan_promotion(b, p, s, flow)
                        rows.append((b, p, s, flow, plan.outcome, plan.rows))
                    except PromoteRefused:
                        rows.append((b, p, s, flow, "refused", 0))
    return spark.createDataFrame(rows, "bronze int, promotable int, staged int, in_flow boolean, outcome string, appended int")


def freshness_status(spark, folder):
    """Ages and status of the landed sources as of a fixed day."""
    cadences = [dataops.Cadence("empresas", "declared", 45), dataops.Cadence("payments", "no_source_axis"), dataops.Cadence("raw_empresas", "paused"), dataops.Cadence("merchant", "undeclared"), dataops.Cadence("socios", "declared", 90)]
    e, p, r = (table(spark, folder, n) for n in ("empresas", "payments", "raw_empresas"))
    stamp = F.lit(None).cast("timestamp")
    sides = [(e, "empresas"), (p, "payments"), (r.withColumn("_ingested_at", stamp), "raw_empresas"), (e.drop("_snapshot_ref_date"), "merchant"), (e, "socios")]
    all_ = None
    for rows, name in sides:
        one = dataops.measured(rows, name)
        all_ = one if all_ is None else all_.unionByName(one)
    return dataops.freshness(all_, cadences, TODAY).select("source", "bronze_rows", "last_snapshot_month", "pipeline_age_days", "source_age_days", "source_freshness_status")


def _telemetry(spark, folder):
    """Task runs and their statements, from events read as a timeline, a list of jobs and a statement history."""
    e = table(spark, folder, "events").withColumn("at", F.col("ts").cast("timestamp"))
    run = (F.col("event_id") / 4).cast("int")
    timeline = e.filter("event_type <> 'view'").select(
        run.cast("string").alias("run_id"), (F.col("user_id") % 20).alias("job_id"), (F.col("user_id") % 40).alias("job_run_id"), F.col("event_type").alias("task_key"),
        F.col("at").alias("period_start_time"), (F.col("at") + F.expr("INTERVAL 1 HOUR")).alias("period_end_time"), F.when(F.col("event_id") % 4 == 3, "SUCCEEDED").when(F.col("event_id") % 4 == 1, "FAILED").alias("result_state"),
        *(F.lit(i).cast("long").alias(f"{p}_duration_seconds") for i, p in enumerate(("setup", "execution", "cleanup"))),
    )
    jobs = e.filter("event_type = 'view'").select((F.col("user_id") % 15).alias("job_id"), F.concat(F.lit("job "), F.col("event_id").cast("string")).alias("name"), F.col("at").alias("change_time"))
    history = e.filter("event_type = 'purchase'").select(F.when(F.col("event_id") % 2 == 0, run.cast("string")).alias("run_id"), F.col("at").alias("end_time"), F.col("event_id").alias("read_rows"), F.lit(1).cast("long").alias("written_rows"), F.lit(2).cast("long").alias("written_bytes"))
    return dataops.task_telemetry(timeline, jobs, history)


def task_telemetry(spark, folder):
    """Task runs, their statements and how far these can be trusted."""
    return _telemetry(spark, folder).select("run_id", "job_id", "job_name", "job_run_id", "task_key", "attempt", "result_state", "timeline_periods", "sql_telemetry", "statements", "read_rows")


def snapshot_diff_orders(spark, folder):
    """Customers of every month of orders as snapshots: who came, went or changed status from each month to the next delivered one."""
    o = table(spark, folder, "orders").withColumn("m", F.date_format("o_orderdate", "yyyy-MM"))
    months = [r["m"] for r in o.filter("m is not null").select("m").distinct().collect()]  # one row for each snapshot
    rows = o.groupBy("o_custkey", "m").agg(F.min("o_orderstatus").alias("s"))
    return snapshot_changes(rows, F.col("o_custkey"), F.col("m"), [F.coalesce("s", F.lit(""))], F.lit(0), months)


def watermark_misses(spark, folder):
    """Changes of every snapshot that an extract by time of ingest would miss, were it taken from the twelfth of the snapshot's month on, per kind."""
    rows = _accepted(spark, folder)
    content = [F.coalesce(F.col(c), F.lit("")) for c in COMPANY_DATA.payload]
    changes = snapshot_changes(rows, F.col("cnpj_basico"), F.col("_snapshot_month"), content, F.unix_micros("_ingested_at"), snapshot_months(rows))
    since = midnight(F.try_to_date(F.concat("_snapshot_month", F.lit("-12")), "yyyy-MM-dd"))
    missed = missed_by_watermark(changes, rows, F.col("cnpj_basico"), F.unix_micros("_ingested_at"), since, F.col("_snapshot_month"))
    return missed.groupBy(F.col("period").alias("snapshot_month"), "change_kind").agg(F.count(F.lit(1)).alias("missed"))


def full_keys(spark, folder):
    """Full fourteen-digit keys of the hub's companies, with their check digits."""
    hub = table(spark, folder, "hub_empresa").select("cnpj_basico").distinct()
    twelve = F.concat("cnpj_basico", F.lit("0001"))
    return hub.select("cnpj_basico", F.concat(twelve, check_digits(twelve)).alias("cnpj"))


def grant_plan(spark, folder):
    """What to grant, revoke or escalate: rights observed on nations against a roster by region."""
    n = table(spark, folder, "nation")
    observed = n.filter("n_nationkey % 3 <> 0").select(F.col("n_name").alias("principal"), F.concat(F.lit("t"), F.col("n_regionkey")).alias("object"), (F.col("n_nationkey") % 4 != 0).alias("revocable"))
    return governance.grant_plan(observed, n.filter("n_nationkey % 2 = 0").select(F.col("n_name").alias("principal"), F.concat(F.lit("t"), F.col("n_regionkey")).alias("object")))


def masked_projection(spark, folder):
    """Suppliers with their names hidden."""
    return governance.masked(table(spark, folder, "supplier"), ["s_name"], shown=False)


# --- streams ------------------------------------------------------------------------------------------------------


def late_arrivals(spark, folder):
    """Payment rows whose event lies before one emitted earlier."""
    return measures.late_arrivals(_instants(spark, folder), "event_ms", "emitted_ms", HOUR_MS).groupBy("id", "event_ms", "emitted_ms").agg(F.count(F.lit(1)).alias("rows"))


def window_crossing(spark, folder):
    """Payment rows emitted in a later hour than their event's, per day of the event."""
    i = _instants(spark, folder).filter(measures.crosses_window(F.col("event_ms"), F.col("emitted_ms"), HOUR_MS))
    return i.groupBy(F.date_from_unix_date(F.floor(F.col("event_ms") / 86_400_000).cast("int")).alias("event_day")).agg(F.count(F.lit(1)).alias("rows"))


def redeliveries(spark, folder):
    """Rows, identities and redeliveries of payments."""
    rows = table(spark, folder, "payments").select(message_id(F.col("transaction_id")).alias("id")).filter("id is not null")
    return measures.duplicate_rows(rows, "id")


def null_drop_trap(spark, folder):
    """Distinct counterparty pairs, and those a distinct count over columns leaves out for a null."""
    return measures.null_drop(table(spark, folder, "payments"), ["payer_cnpj_basico", "payee_cnpj_basico", "payment_method"])


def undeclared_fields(spark, folder):
    """Fields of payment messages that the contract doesn't declare."""
    return measures.undeclared_keys(table(spark, folder, "payments"), "_rescued_data", ("transaction_id",))


def pool_topk(spark, folder):
    """A pseudo-random but fixed pool of 100 companies: the least digests."""
    rows = table(spark, folder, "hub_empresa").select("cnpj_basico").distinct()
    return rows.select("cnpj_basico", F.sha2(F.concat("cnpj_basico", F.lit("|20260809")), 256).alias("digest")).orderBy("digest").limit(100).select("cnpj_basico")


def ref_date_token(spark, folder):
    """Reference dates that registry file names prove, and the month they assert."""
    rows = table(spark, folder, "empresas").select("_source_file", "_snapshot_month").distinct()
    return rows.select("_source_file", "_snapshot_month", token_month(F.col("_source_file")).alias("asserted"), ref_date_of_file(F.col("_source_file"), F.col("_snapshot_month")).alias("ref_date"))


def stream_ingest(spark, folder):
    """Payments written as JSON lines, ingested by the file stream in two runs: what both runs together deliver, once each.

    Messages whose rows hold rescued data are written with a field that no contract declares, and every message paid by
    TED in BRL as a line that breaks off; both keep their text. The lines and the stream's state lie in the folder all
    executors share; a second run starts from no checkpoint, so only what has landed keeps it from adding rows.
    """
    base, columns = passing_folder(spark, "stream"), COLUMNS["payments"]
    p = table(spark, folder, "payments").withColumn("surplus", F.when(F.col("_rescued_data").isNotNull(), "x"))
    line = F.to_json(F.struct(*columns, "surplus"))
    broken = (F.col("payment_method") == "TED") & (F.col("currency") == "BRL")
    p.select(F.when(broken, F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line).alias("value")).write.text(f"{base}/in")
    contract = LandedTable("payments", "generated", format="json")
    out = f"{base}/out"
    for run in range(2):
        rows = ingest.file_stream(spark, contract, f"{base}/in").select(*columns, "_rescued_data", "_source_file")

        def write(batch, _epoch):
            held = batch.sparkSession.read.parquet(out) if run else None
            (batch if held is None else ingest.unlanded(batch, held)).write.mode("append").parquet(out)

        rows.writeStream.option("checkpointLocation", f"{base}/checkpoint-{run}").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    return spark.read.parquet(out).drop("_source_file")


def generated_stream(spark, folder):
    """Rows, identities, business tuples and late rows of a generated stream: exactly the numbers asked for."""
    pool = generator.pool_of(table(spark, folder, "hub_empresa"), "cnpj_basico", 40, 7)
    s = generator.PROFILES["messy"].stream(pool, events=4000, repeats=300)
    rows = cut(generator.deliveries(spark, s))
    late = measures.late_arrivals(rows.select("transaction_id", event_micros(F.col("event_time")).alias("e"), event_micros(F.col("emitted_at")).alias("m")), "e", "m")
    one = lambda df, *c: df.select(*c).distinct().agg(F.count(F.lit(1)).alias("n"))
    parts = {"rows": rows.agg(F.count(F.lit(1)).alias("n")), "identities": one(rows, "transaction_id"), "business_tuples": one(rows, *COLUMNS["payments"][3:]), "late_identities": one(late, "transaction_id")}
    out = None
    for name, df in parts.items():
        own = df.select(F.lit(name).alias("measure"), "n")
        out = own if out is None else out.unionByName(own)
    return out


QUERIES = (
    dq_classify, dq_tally, dq_overlap, dq_ptax, hash_keys, hub_company, hub_company_increment, link_payer_payee, link_payer_partner, sat_changed_rows, sat_incremental, observation_ledger, effectivity_windows, reference_pick,
    scd2_company, xxhash_injective, dim_calendar, dim_channel, pit_customer, pit_rows_per_as_of, customer_asof, fact_dedup, fx_intervals, fx_resolution, fx_coverage, fact_payment_rows, fact_refused, fact_accounts, fact_hashed_keys, pit_lost_keys, role_unresolved, orphan_keys,
    reconcile_batch, reconcile_file, promotion_plan, freshness_status, task_telemetry, snapshot_diff_orders, watermark_misses, full_keys, grant_plan, masked_projection, late_arrivals, window_crossing, redeliveries, null_drop_trap, undeclared_fields, pool_topk, ref_date_token, stream_ingest, generated_stream,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    from tidemark.plans.model_oracle import oracle_sql as written

    return written()
