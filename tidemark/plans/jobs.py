"""Jobs: tasks and what they wait for, run in order on one session. A failed task stops those that depend on it."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import day_of
from tidemark.operators import dataops, gold, vault
from tidemark.operators.governance import assert_predicate, assert_revision, grant_plan
from tidemark.operators.promote import PromoteRefused, gate, promote_batch
from tidemark.operators.quality import overlap_by_rule
from tidemark.operators.specs import MODEL, Effectivity, Hub, Link, Reference, Satellite
from tidemark.operators.star import Calendar, Enumerated, Fact, PointInTime, Versioned, build_star
from tidemark.sources.contracts import MONTH, TABLES, LandedTable, rules_for, table_spec
from tidemark.sources.readers import snapshot_window
from tidemark.streaming.ingest import ingest


class JobRefused(ValueError):
    """Parameters a job can't run with."""


def required_months(text: str) -> list[str]:
    """Comma-separated months, each once, none malformed."""
    months = [m.strip() for m in (text or "").split(",")]
    if not all(re.fullmatch(MONTH, m) for m in months) or len(set(months)) < len(months):
        raise JobRefused(f"not a list of months: {text!r}")
    return months


def optional_flag(text: str | None) -> bool:
    if text in (None, "", "false"):
        return False
    if text == "true":
        return True
    raise JobRefused(f"a flag is true or false, not {text!r}")


def required_instant(text: str) -> str:
    """An ISO instant with its zone."""
    if not re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)", text or ""):
        raise JobRefused(f"not an instant with a zone: {text!r}")
    return text


def required_spec(name: str, kind: type):
    spec = MODEL.get(name)
    if spec is None or not isinstance(spec, kind):
        raise JobRefused(f"{name!r} is no {kind.__name__.lower()}; there are {sorted(n for n, s in MODEL.items() if isinstance(s, kind))}")
    return spec


@dataclass(frozen=True)
class Task:
    name: str
    run: Callable[[], object]
    after: tuple[str, ...] = ()


@dataclass
class Job:
    name: str
    tasks: Sequence[Task]
    results: dict = field(default_factory=dict)

    def order(self) -> list[Task]:
        """Tasks in an order that respects what they wait for; a circle or an unknown name is refused."""
        by, done, order = {t.name: t for t in self.tasks}, set(), []
        if len(by) < len(self.tasks) or any(a not in by for t in self.tasks for a in t.after):
            raise JobRefused(f"{self.name}: task names")
        while len(done) < len(by):
            ready = [t for t in self.tasks if t.name not in done and set(t.after) <= done]
            if not ready:
                raise JobRefused(f"{self.name}: tasks wait for each other")
            order += ready
            done |= {t.name for t in ready}
        return order

    def run(self) -> Mapping[str, object]:
        for task in self.order():
            self.results[task.name] = task.run()
        return self.results


def guard(expected: str | None, stamped: str | None) -> Task:
    """First task of every job: the code that runs is the revision expected; none expected, none checked."""
    return Task("guard", lambda: assert_revision(expected, stamped) if expected else None)


def bronze_job(spark: SparkSession, table: str, *, root: str, month: str, batch_id: str, record_source: str, prepare: Callable[[], object] | None = None, reclaim: bool = False, revision: tuple[str | None, str | None] = (None, None)) -> Job:
    """guard → [generate, fetch or unzip] → ingest → gate → promote, or fail with the batch left in staging → [reclaim]."""
    t: LandedTable = table_spec(table)
    job = Job(f"bronze_{table}", ())

    def promote():
        bad = job.results["gate"]
        if bad:
            raise PromoteRefused(f"{bad} rows of {batch_id} rejected; they wait in {t.quarantine}")
        return promote_batch(spark, batch_id, t.staging, t.bronze, rules_for(table), in_flow=True, promises=t.promises)

    def reclaim_files():
        accounts = dataops.file_accounts(dataops.legs_of(spark, [t], batch_id))
        stamped = dataops.months_of_batch(spark.table(t.staging), batch_id)
        dataops.resolve_month(month, stamped)
        return dataops.delete_reclaimable(accounts, root)

    tasks = [guard(*revision)]
    if prepare:
        tasks.append(Task("prepare", prepare, ("guard",)))
    tasks += [
        Task("ingest", lambda: ingest(spark, t, root=root, month=month, batch_id=batch_id, record_source=record_source).lastProgress, (tasks[-1].name,)),
        Task("gate", lambda: gate(spark, t.staging, t.quarantine, batch_id, rules_for(table)), ("ingest",)),
        Task("promote", promote, ("gate",)),
    ]
    if reclaim:
        tasks.append(Task("reclaim", reclaim_files, ("promote",)))
    job.tasks = tasks
    return job


def repromote(spark: SparkSession, table: str, batch_id: str):
    """Promotes a triaged batch by itself."""
    t = table_spec(table)
    return promote_batch(spark, batch_id, t.staging, t.bronze, rules_for(table), in_flow=False, promises=t.promises)


#: Vault tables by job, with the source each is loaded from and the tables it waits for.
VAULT_JOBS: Mapping[str, tuple[tuple[str, str, tuple[str, ...]], ...]] = {
    "vault_empresa": (("hub_empresa", "empresas", ()), ("sat_empresa_dados", "empresas", ("hub_empresa",))),
    "vault_estabelecimento": (
        ("hub_estabelecimento", "estabelecimentos", ()), ("hub_empresa", "estabelecimentos", ("hub_estabelecimento",)), ("sat_estabelecimento_dados", "estabelecimentos", ("hub_estabelecimento",)),
        ("sat_estabelecimento_endereco", "estabelecimentos", ("sat_estabelecimento_dados",)), ("link_empresa_estabelecimento", "estabelecimentos", ("hub_empresa", "hub_estabelecimento")),
    ),
    "vault_partner": (("link_company_partner", "socios", ()), ("sat_eff_company_partner", "socios", ("link_company_partner",))),
    "vault_merchant": (("hub_merchant", "merchant", ()), ("sat_merchant_dados", "merchant", ("hub_merchant",)), ("link_merchant_empresa", "merchant", ("hub_merchant",)), ("sat_eff_merchant_empresa", "merchant", ("link_merchant_empresa",))),
    "vault_reference": tuple((f"ref_{k}", "lookup", ()) for k in ("cnae", "motivo", "municipio", "natureza_juridica", "pais", "qualificacao")),
}


def _load(spark: SparkSession, name: str, source: str, load_date: str, months: list[str] | None):
    spec, t = MODEL[name], TABLES[source]
    axis = t.axis.column
    rows, at = snapshot_window(spark, t.bronze, months, axis, t.axis.shape), F.lit(load_date).cast("timestamp")
    vault.refuse_absent_snapshots(rows, months, axis)
    hubs = {e.hub: MODEL[e.hub] for e in getattr(spec, "ends", ())}
    if isinstance(spec, Hub):
        return vault.load_hub(rows, spec, name, at, axis)
    if isinstance(spec, Satellite):
        return vault.load_satellite(rows, spec, MODEL[spec.parent], name, at, diagnostics=True)
    if isinstance(spec, Reference):
        return vault.load_reference(rows, spec, name, at)
    if isinstance(spec, Effectivity):
        link = MODEL[spec.parent]
        hubs = {e.hub: MODEL[e.hub] for e in link.ends}
        grain = [p.column for e in link.ends if e.identifying for p in e.key_from] + [k.name for e in link.ends if e.identifying and not e.key_from for k in hubs[e.hub].keys] + list(link.dependent)
        held = spark.table(t.quarantine) if spark.catalog.tableExists(t.quarantine) else rows.limit(0)
        return vault.load_effectivity(rows, held, spec, link, hubs, grain, name, at, window=months, axis=axis)
    if isinstance(spec, Link) and spec.dependent:
        return vault.load_partner_link(rows, spec, MODEL["hub_empresa"], "hub_empresa", name, at)
    return vault.load_link(rows, spec, hubs, sorted(hubs), name, at, axis)


def vault_job(spark: SparkSession, job: str, *, load_date: str, months: list[str] | None = None, revision: tuple[str | None, str | None] = (None, None)) -> Job:
    """The loads of one vault job after the guard; at most one writer per table."""
    required_instant(load_date)
    tasks = [guard(*revision)]
    for name, source, after in VAULT_JOBS[job]:
        tasks.append(Task(name, lambda name=name, source=source: _load(spark, name, source, load_date, months), after or ("guard",)))
    return Job(job, tasks)


#: The dimensional tables, checked as a set when this module is imported.
STAR = build_star(
    (
        Versioned("dim_company", "company_sk", "sat_empresa_dados"), Calendar("dim_date", "date_key"), Enumerated("dim_channel", "channel_key", "payment_method"), Enumerated("dim_currency", "currency_key", "currency"),
        PointInTime("pit_estabelecimento", "hub_estabelecimento", ("sat_estabelecimento_dados", "sat_estabelecimento_endereco")),
        Fact("fact_payment", "transaction_id", (("payer_company_sk", "dim_company"), ("payee_company_sk", "dim_company"), ("event_date_key", "dim_date"), ("fx_rate_date_key", "dim_date"), ("channel_key", "dim_channel"), ("currency_key", "dim_currency")), ("amount", "fx_rate", "amount_brl", "event_time")),
    ),
    MODEL, [n for t in TABLES.values() for n in (t.staging, t.bronze, t.quarantine)],
)


def gold_job(spark: SparkSession, job: str, *, load_date: str, revision: tuple[str | None, str | None] = (None, None)) -> Job:
    """Builds of one gold job from the vault's and bronze's tables: conformed, company, establishment or fact."""
    at = F.lit(required_instant(load_date)).cast("timestamp")
    t = spark.table
    scd2 = lambda: gold.scd2_rows(t("sat_empresa_dados"), t("hub_empresa"), "hub_empresa_hk", ["cnpj_basico"], list(MODEL["sat_empresa_dados"].payload), "company_sk", at)
    days = lambda: gold.covered_span(t("bronze_payments").select(day_of(F.col("event_time"))), t("sat_empresa_dados").select("applied_date"))
    members = lambda column, key: gold.load_conformed(gold.enumerated_rows(t("bronze_payments"), column, key), f"dim_{key.removesuffix('_key')}", key)

    def fact():
        payments = t("bronze_payments")
        rows = gold.fact_rows(payments, t("dim_company"), gold.ptax_intervals(t("bronze_ptax")), at)
        keys = {column: (dimension, STAR[dimension].surrogate) for column, dimension in STAR["fact_payment"].keys if column != "fx_rate_date_key"}
        return gold.load_fact(rows, "fact_payment", payments, {c: (t(d), k) for c, (d, k) in keys.items() if spark.catalog.tableExists(d)})

    def point_in_time():
        satellites = {n: t(n) for n in ("sat_estabelecimento_dados", "sat_estabelecimento_endereco")}
        gold.refuse_lost_keys(t("hub_estabelecimento"), "hub_estabelecimento_hk", satellites)
        return gold.load_pit(gold.pit_rows(t("hub_estabelecimento"), "hub_estabelecimento_hk", satellites), "pit_estabelecimento", "hub_estabelecimento_hk")

    builds: dict[str, list[Task]] = {
        "gold_conformed": [Task("dim_date", lambda: gold.load_conformed(gold.calendar_rows(spark, *days()), "dim_date", "date_key"), ("guard",)), Task("dim_channel", lambda: members("payment_method", "channel_key"), ("guard",)), Task("dim_currency", lambda: members("currency", "currency_key"), ("guard",))],
        "gold_company": [Task("dim_company", lambda: gold.load_scd2(scd2(), "dim_company", "company_sk"), ("guard",))],
        "gold_establishment": [Task("pit_estabelecimento", point_in_time, ("guard",))],
        "gold_fact": [Task("fact_payment", fact, ("guard",))],
    }
    if job not in builds:
        raise JobRefused(f"{job!r} is none of {sorted(builds)}")
    return Job(job, [guard(*revision), *builds[job]])


def rule_overlaps(spark: SparkSession, batches: Sequence[str] | None = None) -> DataFrame | None:
    """Hits of every rule of every landed source, by batch: (source, _batch_id, rows, reason, hits). None if nothing is landed.

    All rules of a source are counted in one pass over its staged rows; `batches` keeps to some of them.
    """
    all_ = None
    for t in TABLES.values():
        if not spark.catalog.tableExists(t.staging):
            continue
        rows = spark.table(t.staging)
        own = overlap_by_rule(rows.filter(F.col("_batch_id").isin(list(batches))) if batches else rows, rules_for(t.name), t.name)
        all_ = own if all_ is None else all_.unionByName(own)
    return all_


def dataops_job(spark: SparkSession, today=None, telemetry: tuple[DataFrame, DataFrame, DataFrame] | None = None, masks: Mapping[str, tuple[str, str]] | None = None, grants: tuple[DataFrame, DataFrame] | None = None) -> Job:
    """guard → {views, rule overlap, masks → governance} over whatever sources are landed.

    `telemetry`: timeline, jobs and statement history of the platform; `masks`: the deployed and the declared body of
    each mask function, which must agree; `grants`: observed rights and the roster, of which the plan is kept as a view.
    """

    def views():
        landed = [t for t in TABLES.values() if spark.catalog.tableExists(t.bronze)]
        legs = dataops.legs_of(spark, list(TABLES.values()))
        made = {}
        if legs:
            made |= {"reconciliation": dataops.batch_accounts(legs), "reconciliation_by_file": dataops.file_accounts(legs)}
        if landed:
            measures = None
            for t in landed:
                one = dataops.measured(spark.table(t.bronze), t.name)
                measures = one if measures is None else measures.unionByName(one)
            made["freshness"] = dataops.freshness(measures, dataops.CADENCES, today)
        if telemetry:
            made["task_telemetry"] = dataops.task_telemetry(*telemetry)
        return dataops.create_views(spark, made)

    def overlaps():
        found = rule_overlaps(spark)
        return dataops.create_views(spark, {"rule_overlap": found} if found is not None else {})

    def assert_masks():
        for deployed, declared in (masks or {}).values():
            assert_predicate(deployed, declared)
        return sorted(masks or {})

    def governance():
        return dataops.create_views(spark, {"grant_plan": grant_plan(*grants)} if grants else {})

    return Job("dataops", [guard(None, None), Task("views", views, ("guard",)), Task("rule_overlap", overlaps, ("guard",)), Task("masks", assert_masks, ("guard",)), Task("governance", governance, ("masks",))])
