"""DuckDB SQL for the queries of `model_queries`."""

from __future__ import annotations

from tidemark.plans.data_oracle import _id, _instant, _key
from tidemark.sources.contracts import CURRENCIES, PAYMENT_METHODS

_WHITE = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(160)"


def _xxhash64(text: str) -> int:
    """The hash of a text by the reference implementation of XXH64, with the seed that Spark's function has."""
    import xxhash

    n = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return n - (1 << 64) if n >> 63 else n


def _enc(c: str) -> str:
    t = f"upper(trim({c}, {_WHITE}))"
    return f"CASE WHEN {c} IS NULL THEN 'N' WHEN {c} = '' THEN 'E' WHEN {t} = '' THEN 'W' ELSE 'S' || length({t}) || ':' || {t} END"


def _hash(*components: str) -> str:
    return f"sha256(concat_ws('||', {', '.join(_enc(c) for c in components)}))"


def _json_field(c: str) -> str:
    return f"""CASE WHEN {c} IS NOT NULL THEN '"{c}":' || CAST(to_json({c}) AS VARCHAR) END"""


def _blank(c: str) -> str:
    return f"({c} IS NULL OR trim({c}, ' ') = '')"


def _replaced(columns: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"coalesce(contains({c}, chr(65533)), false)" for c in columns) + ")"


EMPRESAS = ("cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel", "capital_social", "porte_empresa", "ente_federativo_responsavel")
PAYMENTS = ("transaction_id", "event_time", "emitted_at", "payer_cnpj_basico", "payee_cnpj_basico", "amount", "currency", "payment_method")
PAYMENT_RULES = [(f"null_or_empty_{c}", _blank(c)) for c in PAYMENTS] + [(f"bad_{c}_length", f"coalesce(length(trim({c}, ' ')) <> 8, false)") for c in PAYMENTS[3:5]] + [("encoding_replacement_char", _replaced(PAYMENTS))]
EMPRESA_RULES = [(f"null_or_empty_{c}", _blank(c)) for c in EMPRESAS[:3]] + [("bad_cnpj_basico_length", "length(trim(cnpj_basico, ' ')) <> 8"), ("encoding_replacement_char", _replaced(EMPRESAS)), ("unprovable_snapshot_ref_date", "_snapshot_ref_date IS NULL")]


def _reason(rules) -> str:
    return "CASE WHEN _rescued_data IS NOT NULL THEN 'rescued_data_present' " + " ".join(f"WHEN {p} THEN '{r}'" for r, p in rules) + " END"


_MANY = " + ".join(f"CAST({p} AS INTEGER)" for _, p in PAYMENT_RULES)
_SAT = ("razao_social", "natureza_juridica", "capital_social", "porte_empresa")
REGISTRY = f"registry AS (SELECT * REPLACE ({_key('cnpj_basico')} AS cnpj_basico) FROM empresas), accepted AS (SELECT * FROM registry WHERE _rescued_data IS NULL AND cnpj_basico IS NOT NULL)"
LATEST = f"""{REGISTRY}, latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cnpj_basico, _snapshot_month ORDER BY _ingested_at DESC) AS n FROM accepted) WHERE n = 1),
said AS (SELECT {_hash('cnpj_basico')} AS hub_company_hk, cnpj_basico, _snapshot_ref_date AS applied_date, {_hash(*_SAT)} AS hash_diff, {', '.join(_SAT)} FROM latest),
marked AS (SELECT *, lag(hash_diff) OVER (PARTITION BY hub_company_hk ORDER BY applied_date) AS p FROM said),
kept AS (SELECT * FROM marked WHERE p IS NULL OR p <> hash_diff)"""
CHANGED = f"WITH {LATEST} SELECT hub_company_hk, applied_date, hash_diff, {', '.join(_SAT)} FROM kept"

PARTIES = f"""parties AS (SELECT {_key('payer_cnpj_basico')} AS payer, {_key('payee_cnpj_basico')} AS payee, payment_method, regexp_replace(payee_cnpj_basico, '[^0-9]', '', 'g') AS number, _snapshot_month, _record_source
  FROM payments WHERE {_key('payer_cnpj_basico')} IS NOT NULL AND {_key('payee_cnpj_basico')} IS NOT NULL)"""

LEDGER = f"""{REGISTRY}, sides AS (SELECT cnpj_basico AS k, _snapshot_month AS m, _rescued_data IS NULL AS b FROM registry),
seen AS (SELECT k, m, bool_or(b) AS b, bool_or(NOT b) AS q FROM sides GROUP BY k, m),
firsts AS (SELECT k, min(m) AS f FROM seen GROUP BY k), months AS (SELECT DISTINCT m FROM seen),
grid AS (SELECT f.k, f.f, m.m FROM firsts f CROSS JOIN months m),
ledger AS (SELECT g.k AS cnpj_basico, g.m AS _snapshot_month, coalesce(s.b, false) AS in_bronze, coalesce(s.q, false) AS in_quarantine,
  CASE WHEN s.b AND s.q THEN 'observed_with_rejected_siblings' WHEN s.b THEN 'observed' WHEN s.q THEN 'rejected_by_our_gate' WHEN g.m < g.f THEN 'absent_before_first_observation' ELSE 'absent_after_observation' END AS state
  FROM grid g LEFT JOIN seen s ON s.k IS NOT DISTINCT FROM g.k AND s.m = g.m)"""

_SATS = """o AS (SELECT o_custkey AS hk, CAST(date_trunc('month', o_orderdate) AS DATE) AS d, min(o_orderstatus) AS status, min(o_orderpriority) AS priority FROM orders GROUP BY 1, 2),
m AS (SELECT *, lag(status) OVER w AS ps, lag(priority) OVER w AS pp FROM o WINDOW w AS (PARTITION BY hk ORDER BY d)),
sats AS (SELECT hk, d, status FROM m WHERE ps IS NULL OR ps <> status), satp AS (SELECT hk, d FROM m WHERE pp IS NULL OR pp <> priority)"""
PIT = f"""WITH {_SATS}, dates AS (SELECT d AS as_of_date FROM sats UNION SELECT d FROM satp),
hubs AS (SELECT DISTINCT c_custkey AS hk FROM customer),
grid AS (SELECT h.hk, a.as_of_date FROM hubs h CROSS JOIN dates a),
points AS (SELECT g.hk, g.as_of_date, s.d AS s, p.d AS p FROM grid g LEFT JOIN sats s ON s.hk = g.hk AND s.d = g.as_of_date LEFT JOIN satp p ON p.hk = g.hk AND p.d = g.as_of_date),
pit AS (SELECT hk, as_of_date, max(s) OVER w AS status_applied_date, max(p) OVER w AS priority_applied_date FROM points WINDOW w AS (PARTITION BY hk ORDER BY as_of_date))"""

QUOTES = """ok AS (SELECT DISTINCT quote_date, currency, data_hora_cotacao, cotacao_venda FROM ptax),
reduced AS (SELECT currency, CAST(quote_date AS DATE) AS quote_date, min(CAST(cotacao_venda AS DECIMAL(18,5))) AS rate, min(epoch_us(CAST(data_hora_cotacao AS TIMESTAMP)) + 10800000000) AS valid_from FROM ok GROUP BY 1, 2),
intervals AS (SELECT *, lead(valid_from) OVER (PARTITION BY currency ORDER BY valid_from, quote_date) AS valid_to FROM reduced)"""
PRICED = f"""{QUOTES},
readable AS (SELECT *, {_id('transaction_id')} AS id, epoch_us({_instant('event_time')}) AS us, try_cast(amount AS DECIMAL(18,2)) AS money FROM payments WHERE {_instant('event_time')} IS NOT NULL AND try_cast(amount AS DECIMAL(18,2)) IS NOT NULL),
one AS (SELECT id, us, money, currency, {_key('payer_cnpj_basico')} AS payer, {_key('payee_cnpj_basico')} AS payee FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY transaction_id, event_time, emitted_at) AS n FROM readable WHERE id IS NOT NULL) WHERE n = 1),
priced AS (SELECT o.*, CASE WHEN o.currency = 'BRL' THEN CAST(1 AS DECIMAL(18,5)) ELSE i.rate END AS fx_rate, CASE WHEN o.currency = 'BRL' THEN CAST(make_timestamp(o.us) AS DATE) ELSE i.quote_date END AS fx_rate_date
  FROM one o LEFT JOIN intervals i ON o.currency <> 'BRL' AND i.currency = o.currency AND o.us >= i.valid_from AND (i.valid_to IS NULL OR o.us < i.valid_to))"""
_MONEY = "CAST(money * fx_rate AS DECIMAL(18,2))"

LEGS = """WITH l AS (
  SELECT _batch_id, _source_file, 1 AS s, 0 AS p, 0 AS q FROM payments
  UNION ALL SELECT _batch_id, _source_file, 0, 1, 0 FROM payments WHERE transaction_id IS NOT NULL AND _rescued_data IS NULL
  UNION ALL SELECT _batch_id, _source_file, 0, 1, 0 FROM payments WHERE _batch_id LIKE '%-3' AND payment_method = 'TED'
  UNION ALL SELECT _batch_id, _source_file, 0, 0, 1 FROM payments WHERE transaction_id IS NULL)"""


def _accounts(by: str) -> str:
    return f"""{LEGS}, a AS (SELECT 'payments' AS source, {by}, CAST(sum(s) AS BIGINT) AS staged, CAST(sum(p) AS BIGINT) AS promoted, CAST(sum(q) AS BIGINT) AS quarantined FROM l GROUP BY {by}),
v AS (SELECT *, staged - promoted - quarantined AS unaccounted, CASE WHEN promoted + quarantined > staged THEN 'over_promoted' WHEN promoted + quarantined = staged THEN 'reconciled' WHEN quarantined > 0 THEN 'stranded_gated' ELSE 'stranded_unexplained' END AS verdict FROM a)"""


INSTANTS = f"i AS (SELECT {_id('transaction_id')} AS id, epoch_us({_instant('event_time')}) // 1000 AS event_ms, epoch_us({_instant('emitted_at')}) // 1000 AS emitted_ms FROM payments WHERE {_instant('event_time')} IS NOT NULL AND {_instant('emitted_at')} IS NOT NULL)"
_NATION = "CASE c_nationkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ' || chr(9) || ' ' ELSE CAST(c_nationkey AS VARCHAR) END"


def _weighted(text: str, weights: tuple[int, ...]) -> str:
    return " + ".join(f"CAST({text}[{i + 1}] AS INTEGER) * {w}" for i, w in enumerate(weights))


def oracle_sql() -> dict[str, str]:
    hk = _hash("cnpj_basico")
    first = "SELECT {c}, record_source FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY m, record_source NULLS FIRST) AS n FROM {t}) WHERE n = 1"
    return {
        "dq_classify": f"SELECT cnpj_basico, _snapshot_month, _source_file, {_reason(EMPRESA_RULES)} AS _dq_reject_reason FROM empresas",
        "dq_tally": f"SELECT {_reason(PAYMENT_RULES)} AS _dq_reject_reason, count(*) AS rows FROM payments GROUP BY 1",
        "dq_overlap": "SELECT _snapshot_month, count(*) AS rows, CAST(sum(CAST(_rescued_data IS NOT NULL AS INTEGER)) AS BIGINT) AS rescued_rows, "
        + ", ".join(f"CAST(sum(CAST({p} AS INTEGER)) AS BIGINT) AS {r}" for r, p in PAYMENT_RULES)
        + f", CAST(sum(CAST({_MANY} >= 2 AS INTEGER)) AS BIGINT) AS rows_with_two_or_more, CAST(sum(CAST(_rescued_data IS NOT NULL AND {_MANY} >= 1 AS INTEGER)) AS BIGINT) AS rescued_with_a_rule FROM payments GROUP BY 1",
        "dq_ptax": f"SELECT * FROM ptax WHERE NOT ({' OR '.join(_blank(c) for c in ('quote_date', 'currency', 'data_hora_cotacao', 'cotacao_compra', 'cotacao_venda'))}) AND try_cast(quote_date AS DATE) IS NOT NULL AND try_cast(cotacao_compra AS DECIMAL(18,5)) IS NOT NULL AND try_cast(cotacao_venda AS DECIMAL(18,5)) IS NOT NULL AND try_cast(data_hora_cotacao AS TIMESTAMP) IS NOT NULL",
        "hash_keys": f"WITH c AS (SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS a, {_NATION} AS b, '  ' || lower(c_name) || ' ' AS n FROM customer) SELECT c_custkey, {_hash('a', 'b', 'n')} AS customer_hk FROM c",
        "hub_company": f"WITH {REGISTRY}, k AS (SELECT {hk} AS hub_company_hk, cnpj_basico, _snapshot_month AS m, _record_source AS record_source FROM accepted) " + first.format(c="hub_company_hk, cnpj_basico", k="hub_company_hk", t="k"),
        "hub_company_increment": f"WITH {REGISTRY}, k AS (SELECT {hk} AS hub_company_hk, cnpj_basico, _snapshot_month AS m, _record_source AS record_source FROM accepted WHERE _snapshot_month = '2027-07' AND cnpj_basico NOT IN (SELECT cnpj_basico FROM accepted WHERE _snapshot_month < '2027-07')) " + first.format(c="hub_company_hk, cnpj_basico", k="hub_company_hk", t="k"),
        "link_payer_payee": f"WITH {PARTIES}, k AS (SELECT {_hash('payer', 'payee')} AS link_payer_payee_hk, {_hash('payer')} AS payer_hub_company_hk, {_hash('payee')} AS payee_hub_company_hk, _snapshot_month AS m, _record_source AS record_source FROM parties) "
        + first.format(c="link_payer_payee_hk, payer_hub_company_hk, payee_hub_company_hk", k="link_payer_payee_hk", t="k"),
        "link_payer_partner": f"WITH {PARTIES}, r AS (SELECT payer, CASE WHEN payment_method = 'PIX' THEN '2' ELSE '1' END AS kind, number, _snapshot_month, _record_source FROM parties), "
        f"k AS (SELECT {_hash('payer', 'kind', 'number')} AS link_payer_partner_hk, {_hash('payer')} AS company_hub_company_hk, CASE WHEN kind = '1' AND length(number) = 14 THEN {_hash('left(number, 8)')} END AS partner_hub_company_hk, kind, number, _snapshot_month AS m, _record_source AS record_source FROM r) "
        + first.format(c="link_payer_partner_hk, company_hub_company_hk, partner_hub_company_hk, kind, number", k="link_payer_partner_hk", t="k"),
        "sat_changed_rows": CHANGED,
        "sat_incremental": CHANGED,
        "observation_ledger": f"WITH {LEDGER} SELECT * FROM ledger",
        "effectivity_windows": f"""WITH {LEDGER}, refs AS (SELECT _snapshot_month AS m, min(_snapshot_ref_date) AS d FROM registry WHERE cnpj_basico IS NOT NULL GROUP BY 1),
observed AS (SELECT cnpj_basico AS company, _snapshot_ref_date AS applied_date, true AS is_active, natureza_juridica, _record_source AS record_source FROM
  (SELECT *, row_number() OVER (PARTITION BY cnpj_basico, _snapshot_ref_date ORDER BY natureza_juridica NULLS FIRST, _record_source NULLS FIRST) AS n FROM accepted) WHERE n = 1),
closed AS (SELECT l.cnpj_basico AS company, r.d AS applied_date, false AS is_active, NULL AS natureza_juridica, NULL AS record_source FROM ledger l JOIN refs r ON r.m = l._snapshot_month WHERE l.state = 'absent_after_observation' AND l.cnpj_basico IS NOT NULL),
both_ AS (SELECT * FROM observed UNION ALL SELECT * FROM closed),
f AS (SELECT *, max(CASE WHEN is_active THEN applied_date END) OVER w AS seen, lag(is_active) OVER (PARTITION BY company ORDER BY applied_date) AS p FROM both_ WINDOW w AS (PARTITION BY company ORDER BY applied_date))
SELECT f.company, f.applied_date, f.is_active, o.natureza_juridica, CASE WHEN NOT f.is_active THEN f.seen END AS last_observed_on, CASE WHEN NOT f.is_active THEN 'absent_after_observation' END AS closed_by, o.record_source
FROM f LEFT JOIN observed o ON o.company = f.company AND o.applied_date = f.seen WHERE f.p IS NULL OR f.p <> f.is_active""",
        "reference_pick": "SELECT p_brand, p_type FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey, p_type) AS n FROM part) WHERE n = 1",
        "scd2_company": f"""WITH {LATEST}, b AS (SELECT *, lag(applied_date) OVER w AS pd, lead(applied_date) OVER w AS nd FROM kept WINDOW w AS (PARTITION BY hub_company_hk ORDER BY applied_date))
SELECT cnpj_basico, {', '.join(_SAT)}, CASE WHEN pd IS NULL THEN 0 ELSE epoch_us(CAST(applied_date AS TIMESTAMP)) END AS valid_from, CASE WHEN nd IS NULL THEN 32503679999999999 ELSE epoch_us(CAST(nd AS TIMESTAMP)) END AS valid_to, nd IS NULL AS is_current, 'gold_build' AS record_source FROM b
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, 0, 32503679999999999, true, 'ghost'""",
        "xxhash_injective": f"WITH {LATEST} SELECT CAST(count(*) + 1 AS BIGINT) AS rows, CAST(count(*) + 1 AS BIGINT) AS keys FROM kept",
        "dim_calendar": """WITH s AS (SELECT CAST(min(d) AS DATE) AS a, CAST(max(d) AS DATE) AS b FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem)),
days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM s)
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week, isodow(d) > 5 AS is_weekend FROM days
UNION ALL SELECT -1, NULL, NULL, NULL, NULL, NULL, NULL, NULL""",
        "dim_channel": "SELECT DISTINCT payment_method, false AS is_ghost FROM payments WHERE payment_method IS NOT NULL UNION ALL SELECT NULL, true",
        "pit_customer": f"{PIT} SELECT * FROM pit WHERE status_applied_date IS NOT NULL OR priority_applied_date IS NOT NULL",
        "pit_rows_per_as_of": f"{PIT} SELECT as_of_date, count(*) AS rows FROM pit WHERE status_applied_date IS NOT NULL OR priority_applied_date IS NOT NULL GROUP BY 1",
        "customer_asof": f"""WITH {_SATS}, v AS (SELECT hk, CAST(d AS TIMESTAMP) AS f, CAST(lead(d) OVER (PARTITION BY hk ORDER BY d) AS TIMESTAMP) AS t, status FROM sats),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS n FROM lineitem) WHERE n = 1),
e AS (SELECT o.o_custkey AS hk, l.l_shipdate AS at, CAST(round(l.l_extendedprice * (1 - l.l_discount) * 100) AS BIGINT) AS cents FROM l JOIN orders o ON o.o_orderkey = l.l_orderkey)
SELECT coalesce(v.status, '(none yet)') AS status, count(*) AS lines, CAST(sum(e.cents) AS BIGINT) AS revenue_cents FROM e LEFT JOIN v ON v.hk = e.hk AND e.at >= v.f AND (v.t IS NULL OR e.at < v.t) GROUP BY 1""",
        "fact_dedup": "SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS n FROM lineitem) WHERE n = 1",
        "fx_intervals": f"WITH {QUOTES} SELECT currency, quote_date, rate, valid_from, valid_to FROM intervals",
        "fx_resolution": f"WITH {PRICED} SELECT id, currency, money AS amount, fx_rate, fx_rate_date, {_MONEY} AS amount_brl FROM priced",
        "fx_coverage": f"WITH {PRICED} SELECT currency, count(*) AS payments, count(*) FILTER (WHERE fx_rate IS NULL) AS unresolved, CAST(max(date_diff('day', fx_rate_date, CAST(make_timestamp(us) AS DATE))) AS INTEGER) AS widest_days FROM priced GROUP BY 1",
        "fact_payment_rows": f"""WITH {PRICED}, d AS (SELECT company_sk, cnpj_basico, epoch_us(valid_from) AS f, epoch_us(valid_to) AS t FROM dim_company WHERE company_sk <> -1)
SELECT coalesce(a.company_sk, -1) AS payer_company_sk, coalesce(b.company_sk, -1) AS payee_company_sk, CAST(strftime(make_timestamp(p.us), '%Y%m%d') AS INTEGER) AS event_date_key, CAST(strftime(p.fx_rate_date, '%Y%m%d') AS INTEGER) AS fx_rate_date_key,
  p.id AS transaction_id, p.money AS amount, p.fx_rate, {_MONEY} AS amount_brl
FROM priced p LEFT JOIN d a ON a.cnpj_basico = p.payer AND p.us >= a.f AND (a.t IS NULL OR p.us < a.t) LEFT JOIN d b ON b.cnpj_basico = p.payee AND p.us >= b.f AND (b.t IS NULL OR p.us < b.t) WHERE p.fx_rate IS NOT NULL""",
        "fact_refused": f"""WITH {PRICED}, ids AS (SELECT DISTINCT {_id('transaction_id')} AS id FROM payments WHERE {_id('transaction_id')} IS NOT NULL)
SELECT i.id AS transaction_id, CASE WHEN p.id IS NULL THEN 'unreadable_instant_or_amount' ELSE 'no_rate' END AS refusal FROM ids i LEFT JOIN priced p ON p.id = i.id WHERE p.id IS NULL OR p.fx_rate IS NULL""",
        "fact_accounts": f"""WITH p AS (SELECT {_id('transaction_id')} AS id, {', '.join(PAYMENTS[3:])} FROM payments WHERE {_id('transaction_id')} IS NOT NULL),
n AS (SELECT id, count(*) AS c FROM p GROUP BY 1), f AS (SELECT {_id('transaction_id')} AS id, count(*) AS c FROM fact_payment GROUP BY 1),
o AS (SELECT DISTINCT ON (id) * FROM p ORDER BY id, {', '.join(f'{c} NULLS FIRST' for c in PAYMENTS[3:])}), t AS (SELECT count(*) AS v FROM (SELECT DISTINCT {', '.join(PAYMENTS[3:])} FROM o))
SELECT 'deliveries' AS measure, CAST(sum(c) AS BIGINT) AS n FROM n UNION ALL SELECT 'identities', count(*) FROM n UNION ALL SELECT 'redeliveries', CAST(sum(c) - count(*) AS BIGINT) FROM n UNION ALL SELECT 'business_tuples', v FROM t
UNION ALL SELECT 'legitimate_repeats', (SELECT count(*) FROM n) - v FROM t UNION ALL SELECT 'fact_rows', CAST(sum(c) AS BIGINT) FROM f UNION ALL SELECT 'fact_identities', count(*) FROM f
UNION ALL SELECT 'identities_lacking', count(*) FROM n WHERE id NOT IN (SELECT id FROM f WHERE id IS NOT NULL)""",
        "fact_hashed_keys": f"""WITH k AS (SELECT * FROM (VALUES {', '.join(f"('{m}', CAST({_xxhash64(m)} AS BIGINT))" for m in (*PAYMENT_METHODS, *CURRENCIES))}) v(member, key))
SELECT 'payment_method' AS dimension, payment_method AS member, key FROM (SELECT DISTINCT payment_method FROM payments WHERE payment_method IS NOT NULL) LEFT JOIN k ON k.member = payment_method
UNION ALL SELECT 'currency', currency, key FROM (SELECT DISTINCT currency FROM payments WHERE currency IS NOT NULL) LEFT JOIN k ON k.member = currency
UNION ALL SELECT d, NULL, -1 FROM (VALUES ('payment_method'), ('currency')) g(d)""",
        "pit_lost_keys": "SELECT DISTINCT 'sat_empresa_dados' AS satellite, hub_empresa_hk FROM sat_empresa_dados WHERE hub_empresa_hk IS NOT NULL AND hub_empresa_hk NOT IN (SELECT hub_empresa_hk FROM hub_empresa WHERE hub_empresa_hk IS NOT NULL)",
        "role_unresolved": "SELECT count(*) FILTER (WHERE payer_company_sk = -1) AS payer_company_sk, count(*) FILTER (WHERE payee_company_sk = -1) AS payee_company_sk FROM fact_payment",
        "orphan_keys": "SELECT role, count(*) AS orphans FROM (SELECT 'payer' AS role, payer_company_sk AS k FROM fact_payment UNION ALL SELECT 'payee', payee_company_sk FROM fact_payment) WHERE k NOT IN (SELECT company_sk FROM dim_company) GROUP BY 1",
        "reconcile_batch": f"{_accounts('_batch_id')} SELECT *, CASE WHEN verdict IN ('stranded_gated', 'stranded_unexplained') THEN 'promote_batch table=payments batch_id=' || _batch_id END AS remedy FROM v",
        "reconcile_file": f"{_accounts('_batch_id, _source_file')} SELECT *, promoted > 0 AND promoted + quarantined = staged AS reclaimable FROM v",
        "promotion_plan": """WITH n AS (SELECT CAST(unnest(range(3)) AS INTEGER) AS v), c AS (SELECT b.v AS bronze, p.v AS promotable, s.v AS staged, f.f AS in_flow FROM n b, n p, n s, (SELECT unnest([true, false]) AS f) f WHERE s.v >= p.v)
SELECT *, CASE WHEN bronze > 0 AND bronze = promotable THEN 'already_promoted' WHEN bronze > 0 AND staged = 0 THEN 'already_promoted_staging_gone' WHEN bronze > 0 THEN 'refused' WHEN staged = 0 AND in_flow THEN 'nothing_ingested' WHEN staged = 0 OR promotable = 0 THEN 'refused' ELSE 'appended' END AS outcome,
  CASE WHEN bronze = 0 AND promotable > 0 THEN promotable ELSE 0 END AS appended FROM c""",
        "freshness_status": """WITH m AS (
  SELECT 'empresas' AS source, count(*) AS n, max(_ingested_at) AS i, max(_snapshot_month) AS m, max(_snapshot_ref_date) AS d, 'declared' AS k, 45 AS e FROM empresas
  UNION ALL SELECT 'socios', count(*), max(_ingested_at), max(_snapshot_month), max(_snapshot_ref_date), 'declared', 90 FROM empresas
  UNION ALL SELECT 'merchant', count(*), max(_ingested_at), max(_snapshot_month), NULL, 'undeclared', NULL FROM empresas
  UNION ALL SELECT 'payments', count(*), max(_ingested_at), max(_snapshot_month), NULL, 'no_source_axis', NULL FROM payments
  UNION ALL SELECT 'raw_empresas', count(*), NULL, max(_snapshot_month), NULL, 'paused', NULL FROM raw_empresas),
a AS (SELECT *, CAST(date_diff('day', CAST(i AT TIME ZONE 'UTC' AS DATE), DATE '2027-09-01') AS INTEGER) AS pa, CAST(date_diff('day', d, DATE '2027-09-01') AS INTEGER) AS sa FROM m)
SELECT source, n AS bronze_rows, m AS last_snapshot_month, pa AS pipeline_age_days, sa AS source_age_days,
  CASE WHEN k = 'paused' THEN 'paused_by_decision' WHEN i IS NULL THEN 'never_ingested' WHEN k = 'no_source_axis' THEN 'no_source_axis' WHEN k = 'undeclared' THEN 'no_declared_cadence' WHEN d IS NULL THEN 'source_date_missing' WHEN sa > e THEN 'overdue' ELSE 'within_cadence' END AS source_freshness_status FROM a""",
        "task_telemetry": """WITH t AS (SELECT CAST(event_id // 4 AS VARCHAR) AS run_id, user_id % 20 AS job_id, user_id % 40 AS job_run_id, event_type AS task_key, ts AS s, ts + INTERVAL 1 HOUR AS e, CASE event_id % 4 WHEN 3 THEN 'SUCCEEDED' WHEN 1 THEN 'FAILED' END AS st FROM events WHERE event_type <> 'view'),
runs AS (SELECT run_id, job_id, job_run_id, task_key, min(s) AS started_at, max(e) AS ended_at, (array_agg(st ORDER BY e DESC))[1] AS result_state, count(*) AS timeline_periods FROM t GROUP BY ALL),
jobs AS (SELECT user_id % 15 AS job_id, max_by('job ' || event_id, ts) AS job_name FROM events WHERE event_type = 'view' GROUP BY 1),
h AS (SELECT CASE WHEN event_id % 2 = 0 THEN CAST(event_id // 4 AS VARCHAR) END AS run_id, ts AS end_time, event_id FROM events WHERE event_type = 'purchase'),
w AS (SELECT min(end_time) AS o, max(end_time) AS n FROM h), said AS (SELECT run_id, count(*) AS statements, CAST(sum(event_id) AS BIGINT) AS read_rows FROM h WHERE run_id IS NOT NULL GROUP BY 1)
SELECT r.run_id, r.job_id, j.job_name, r.job_run_id, r.task_key, CAST(row_number() OVER (PARTITION BY r.job_run_id, r.task_key ORDER BY r.started_at) AS INTEGER) AS attempt, r.result_state, r.timeline_periods,
  CASE WHEN s.statements IS NOT NULL THEN 'measured' WHEN w.n IS NULL OR r.ended_at > w.n THEN 'not_yet_attributed' WHEN r.ended_at < w.o THEN 'older_than_history' ELSE 'no_sql_attributed' END AS sql_telemetry, s.statements, s.read_rows
FROM runs r CROSS JOIN w LEFT JOIN jobs j ON j.job_id = r.job_id LEFT JOIN said s ON s.run_id = r.run_id""",
        "snapshot_diff_orders": """WITH o AS (SELECT o_custkey AS k, strftime(o_orderdate, '%Y-%m') AS m, min(o_orderstatus) AS s FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL GROUP BY 1, 2),
p AS (SELECT m, lead(m) OVER (ORDER BY m) AS t FROM (SELECT DISTINCT m FROM o)), a AS (SELECT o.k, p.t AS m, o.s FROM o JOIN p ON p.m = o.m WHERE p.t IS NOT NULL), b AS (SELECT * FROM o WHERE m > (SELECT min(m) FROM o))
SELECT coalesce(a.k, b.k) AS key, coalesce(a.m, b.m) AS period, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' ELSE 'changed' END AS change_kind FROM a FULL JOIN b ON a.k = b.k AND a.m = b.m WHERE a.k IS NULL OR b.k IS NULL OR coalesce(a.s, '') <> coalesce(b.s, '')""",
        "watermark_misses": f"""WITH {REGISTRY}, r AS (SELECT *, row_number() OVER (PARTITION BY cnpj_basico, _snapshot_month ORDER BY _ingested_at DESC) AS n FROM accepted WHERE _snapshot_month IS NOT NULL),
v AS (SELECT cnpj_basico AS k, _snapshot_month AS m, concat_ws('|', {', '.join(f"coalesce({c}, '')" for c in _SAT)}) AS v FROM r WHERE n = 1), p AS (SELECT m, lead(m) OVER (ORDER BY m) AS t FROM (SELECT DISTINCT m FROM v)),
a AS (SELECT v.k, p.t AS m, v.v FROM v JOIN p ON p.m = v.m WHERE p.t IS NOT NULL), b AS (SELECT * FROM v WHERE m > (SELECT min(m) FROM v)),
c AS (SELECT coalesce(a.k, b.k) AS k, coalesce(a.m, b.m) AS m, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' ELSE 'changed' END AS change_kind FROM a FULL JOIN b ON a.k = b.k AND a.m = b.m WHERE a.k IS NULL OR b.k IS NULL OR a.v <> b.v)
SELECT m AS snapshot_month, change_kind, count(*) AS missed FROM c WHERE NOT EXISTS (SELECT 1 FROM accepted x WHERE x.cnpj_basico = c.k AND x._snapshot_month = c.m AND epoch_us(x._ingested_at) > epoch_us(CAST(c.m || '-12' AS TIMESTAMP))) GROUP BY 1, 2""",
        "full_keys": f"""WITH h AS (SELECT DISTINCT cnpj_basico, cnpj_basico || '0001' AS t FROM hub_empresa),
f AS (SELECT *, ({_weighted('t', (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2))}) % 11 AS r FROM h), g AS (SELECT *, t || CASE WHEN r < 2 THEN 0 ELSE 11 - r END AS u FROM f), s AS (SELECT *, ({_weighted('u', (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2))}) % 11 AS q FROM g)
SELECT cnpj_basico, u || CASE WHEN q < 2 THEN 0 ELSE 11 - q END AS cnpj FROM s""",
        "grant_plan": """WITH o AS (SELECT n_name AS principal, 't' || n_regionkey AS object, n_nationkey % 4 <> 0 AS revocable FROM nation WHERE n_nationkey % 3 <> 0), r AS (SELECT n_name AS principal, 't' || n_regionkey AS object FROM nation WHERE n_nationkey % 2 = 0)
SELECT coalesce(o.principal, r.principal) AS principal, coalesce(o.object, r.object) AS object, CASE WHEN o.principal IS NULL THEN 'grant' WHEN o.revocable THEN 'revoke' ELSE 'escalate' END AS action FROM o FULL JOIN r ON o.principal = r.principal AND o.object = r.object WHERE o.principal IS NULL OR r.principal IS NULL""",
        "masked_projection": "SELECT s_suppkey, CASE WHEN s_name IS NOT NULL THEN '***' END AS s_name, s_nationkey, s_acctbal FROM supplier",
        "late_arrivals": f"WITH {INSTANTS}, l AS (SELECT *, max(event_ms) OVER (ORDER BY emitted_ms RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM i) SELECT id, event_ms, emitted_ms, count(*) AS rows FROM l WHERE event_ms < seen GROUP BY 1, 2, 3",
        "window_crossing": f"WITH {INSTANTS} SELECT CAST(make_timestamp(event_ms * 1000) AS DATE) AS event_day, count(*) AS rows FROM i WHERE emitted_ms // 3600000 > event_ms // 3600000 GROUP BY 1",
        "redeliveries": f"WITH p AS (SELECT {_id('transaction_id')} AS id FROM payments) SELECT count(*) AS rows, count(DISTINCT id) AS identities, count(*) - count(DISTINCT id) AS duplicates FROM p WHERE id IS NOT NULL",
        "null_drop_trap": "WITH d AS (SELECT DISTINCT payer_cnpj_basico AS a, payee_cnpj_basico AS b, payment_method AS c FROM payments) SELECT count(*) AS tuples, count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL) AS complete_tuples, count(*) FILTER (WHERE a IS NULL OR b IS NULL OR c IS NULL) AS dropped_tuples FROM d",
        "undeclared_fields": "SELECT key, count(*) AS rows FROM (SELECT unnest(json_keys(_rescued_data)) AS key FROM payments WHERE _rescued_data IS NOT NULL) WHERE key <> 'transaction_id' GROUP BY 1",
        "stream_ingest": f"""WITH l AS (SELECT *, '{{' || concat_ws(',', {', '.join(_json_field(c) for c in PAYMENTS)}, CASE WHEN _rescued_data IS NOT NULL THEN '"surplus":"x"' END) || '}}' AS line, coalesce(payment_method = 'TED' AND currency = 'BRL', false) AS broken FROM payments)
SELECT {', '.join(f"CASE WHEN NOT broken THEN {c} END AS {c}" for c in PAYMENTS)}, CASE WHEN broken THEN left(line, -1) WHEN _rescued_data IS NOT NULL THEN line END AS _rescued_data FROM l""",
        "generated_stream": "SELECT * FROM (VALUES ('rows', CAST(4210 AS BIGINT)), ('identities', 4000), ('business_tuples', 3700), ('late_identities', 60)) v(measure, n)",
        "pool_topk": "SELECT cnpj_basico FROM (SELECT DISTINCT cnpj_basico FROM hub_empresa) ORDER BY sha256(cnpj_basico || '|20260809') LIMIT 100",
        "ref_date_token": r"""WITH f AS (SELECT DISTINCT _source_file, _snapshot_month, regexp_extract(_source_file, '[^/]*$') AS n FROM empresas), t AS (SELECT *, regexp_extract(n, '\.D(\d\d)(\d\d)(\d\d)', 1) AS y, regexp_extract(n, '\.D(\d\d)(\d\d)(\d\d)', 2) AS mo, regexp_extract(n, '\.D(\d\d)(\d\d)(\d\d)', 3) AS dd FROM f)
SELECT _source_file, _snapshot_month, CASE WHEN y <> '' THEN y || '-' || mo END AS asserted, CASE WHEN y <> '' AND right(_snapshot_month, 5) = y || '-' || mo THEN try_cast(_snapshot_month || '-' || dd AS DATE) END AS ref_date FROM t""",
    }


#: Inputs made of supplied tables, in SQL that Spark and DuckDB read alike: the table, and each column's expression.
ENGINE_CASES = {
    "merchant": ("customer", {
        "merchant_id": "CASE WHEN c_custkey % 37 = 0 THEN ' ' ELSE concat('M', CAST(c_custkey AS STRING)) END",
        "cnpj": "CASE c_custkey % 6 WHEN 0 THEN lpad(CAST(c_custkey AS STRING), 13, '0') WHEN 1 THEN concat(lpad(CAST(c_custkey AS STRING), 13, '0'), 'x') ELSE lpad(CAST(c_custkey AS STRING), 14, '0') END",
        "legal_name": "CASE WHEN c_custkey % 11 = 0 THEN concat(c_name, 'ƛ') WHEN c_custkey % 41 = 0 THEN concat(c_name, '�') ELSE c_name END",
        "trade_name": "CAST(NULL AS STRING)", "status": "CASE WHEN c_custkey % 13 = 0 THEN '' ELSE 'active' END", "mcc": "'5411'", "settlement_account": "'1-2'", "risk_tier": "'low'",
        "credit_limit": "CASE WHEN c_custkey % 7 = 0 THEN 'much' ELSE '1000.50' END",
        "onboarded_on": "CASE WHEN c_custkey % 17 = 0 THEN '2026-02-30' WHEN c_custkey % 19 = 0 THEN '20260101' ELSE '2026-01-31' END", "updated_at": "'2026-01-31'",
        "_snapshot_at": "CASE WHEN c_custkey % 23 = 0 THEN '2026-08-01T00:00:00.00000Z' WHEN c_custkey % 29 = 0 THEN '2026-02-30T00:00:00.000000Z' ELSE '2026-08-01T00:00:00.000000Z' END",
        "_pg_snapshot": "'10:20:'", "_pg_wal_lsn": "'0/1'", "_snapshot_ref_date": "CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE CAST('2026-08-01' AS DATE) END",
    }),
    "lookup": ("part", {
        "codigo": "CAST(p_partkey % 50 AS STRING)", "descricao": "p_name", "_snapshot_month": "concat('2027-0', CAST(1 + p_partkey % 3 AS STRING))", "_record_source": "p_brand",
        "_source_file": "concat('/landing/F.K', CAST(p_partkey % 9 AS STRING), '.', CASE p_partkey % 7 WHEN 0 THEN 'CNAECSV.CNAE' WHEN 1 THEN 'moti' WHEN 2 THEN 'MUNIC' WHEN 3 THEN 'D.NATJU' WHEN 4 THEN 'Pais' WHEN 5 THEN 'QUALS' ELSE 'EMPRE' END)",
    }),
    "instants": ("events", {
        "event_id": "event_id",
        "said": "CASE event_id % 5 WHEN 0 THEN concat('2026-0', CAST(1 + event_id % 9 AS STRING), '-30T01:02:03.000004Z') WHEN 1 THEN '2026-03-04' WHEN 2 THEN concat('2026-03-04T', lpad(CAST(event_id % 30 AS STRING), 2, '0'), ':00:00.000000Z') WHEN 3 THEN '2026-03-04T01:02:03Z' END",
    }),
}

_ACCOUNTED = "SELECT _source_file, count(*) FILTER (WHERE side = 's') AS staged, count(*) FILTER (WHERE side = 'p') AS promoted, count(*) FILTER (WHERE side = 'q') AS quarantined"


def _case_rows(name: str) -> str:
    source, columns = ENGINE_CASES[name]
    return f"SELECT {', '.join(f'{sql} AS {c}' for c, sql in columns.items())} FROM {source}"


def _counted(source: str, rules: list[tuple[str, str]]) -> str:
    hits = [f"CASE WHEN {p} THEN 1 ELSE 0 END" for _, p in rules]
    both = [(r, h) for (r, _), h in zip(rules, hits, strict=True)]
    both += [("rescued_rows", "CASE WHEN _rescued_data IS NOT NULL THEN 1 ELSE 0 END"), ("rows_with_two_or_more", f"CASE WHEN {' + '.join(hits)} >= 2 THEN 1 ELSE 0 END"), ("rescued_with_a_rule", f"CASE WHEN _rescued_data IS NOT NULL AND {' + '.join(hits)} >= 1 THEN 1 ELSE 0 END")]
    return " UNION ALL ".join(f"SELECT '{source}' AS source, _batch_id, count(*) AS rows, '{reason}' AS reason, CAST(sum({h}) AS BIGINT) AS hits FROM {source} GROUP BY _batch_id" for reason, h in both)


def engine_sql() -> dict[str, str]:
    """SQL of `engine_queries`."""
    from tidemark.sources.contracts import COLUMNS, LOOKUP_SUFFIXES

    merchant = COLUMNS["merchant"]
    reasons = [(f"null_or_empty_{c}", _blank(c)) for c in merchant if c != "trade_name"] + [
        ("bad_cnpj_shape", "NOT regexp_full_match(cnpj, '[0-9]{14}')"),
        ("bad_onboarded_on_shape", "NOT regexp_full_match(onboarded_on, '[0-9]{4}-[0-9]{2}-[0-9]{2}') OR try_cast(onboarded_on AS DATE) IS NULL"),
        ("bad_snapshot_at_shape", "length(_snapshot_at) <> 27 OR try_cast(_snapshot_at AS TIMESTAMPTZ) IS NULL"),
        ("unparseable_credit_limit", "try_cast(credit_limit AS DECIMAL(14, 2)) IS NULL"), ("encoding_replacement_char", _replaced(merchant)),
        ("unhashable_case_divergence", "contains(legal_name, chr(411))"), ("unprovable_snapshot_ref_date", "_snapshot_ref_date IS NULL"),
    ]
    kind = "CASE " + " ".join(f"WHEN upper(_source_file) LIKE '%{suffix}' THEN '{name}'" for suffix, name in LOOKUP_SUFFIXES.items()) + " END"
    telemetry = oracle_sql()["task_telemetry"].replace("SELECT r.run_id,", "SELECT r.ended_at, r.run_id,", 1)
    legs = f"""SELECT 's' AS side, * FROM payments WHERE _batch_id = 'pay-20270109-0' UNION ALL SELECT 'p', * FROM payments WHERE _batch_id = 'pay-20270109-0' AND transaction_id IS NOT NULL AND _rescued_data IS NULL
UNION ALL SELECT 'q', * FROM payments WHERE _batch_id = 'pay-20270109-0' AND transaction_id IS NULL"""
    bad = " OR ".join(f"coalesce({p}, false)" for _, p in PAYMENT_RULES)
    parties = f"SELECT epoch_us({_instant('event_time')}) AS at_, {_key('payer_cnpj_basico')} AS company FROM payments UNION ALL SELECT epoch_us({_instant('event_time')}), {_key('payee_cnpj_basico')} FROM payments"
    return {
        "dq_merchant": f"SELECT merchant_id, CASE {' '.join(f'WHEN {p} THEN {chr(39)}{r}{chr(39)}' for r, p in reasons)} END AS _dq_reject_reason FROM ({_case_rows('merchant')})",
        "lookup_kinds": f"SELECT codigo, _source_file, {kind} AS kind FROM ({_case_rows('lookup')})",
        "lookup_references": f"""SELECT codigo, descricao, record_source, 'ref_' || kind AS reference FROM (SELECT codigo, descricao, _record_source AS record_source, {kind} AS kind,
  row_number() OVER (PARTITION BY {kind}, codigo ORDER BY _snapshot_month, _record_source, descricao) AS n FROM ({_case_rows('lookup')})) WHERE n = 1 AND kind IS NOT NULL""",
        "ref_date_instant": f"SELECT event_id, said, CASE WHEN length(said) = 27 AND try_cast(said AS TIMESTAMPTZ) IS NOT NULL THEN try_cast(left(said, 10) AS DATE) END AS ref_date, try_cast(left(said, 10) AS DATE) AS day FROM ({_case_rows('instants')})",
        "latest_task_runs": f"SELECT run_id, task_key, job_id, job_run_id, sql_telemetry, statements FROM ({telemetry}) ORDER BY ended_at DESC, run_id, task_key, job_run_id, job_id LIMIT 200",
        "sql_coverage": f"SELECT task_key, count(*) AS runs, count(*) FILTER (WHERE sql_telemetry = 'measured') AS measured, count(*) FILTER (WHERE sql_telemetry = 'not_yet_attributed') AS not_yet, count(*) FILTER (WHERE result_state = 'FAILED') AS failed FROM ({telemetry}) GROUP BY 1",
        "rule_overlap_sweep": f"{_counted('payments', PAYMENT_RULES)} UNION ALL {_counted('empresas', EMPRESA_RULES)}",
        "gate_counts": f"SELECT _batch_id, count(*) FILTER (WHERE NOT bad) AS good, count(*) FILTER (WHERE bad) AS held_back FROM (SELECT _batch_id, _rescued_data IS NOT NULL OR {bad} AS bad FROM payments) GROUP BY 1",
        "file_accounts_of_batch": f"SELECT 'payments' AS source, *, promoted > 0 AND promoted + quarantined = staged AS reclaimable FROM ({_ACCOUNTED} FROM ({legs}) GROUP BY 1)",
        "fx_totals": f"""WITH {PRICED} SELECT count(*) FILTER (WHERE fx_rate IS NULL) AS unresolved, count(*) FILTER (WHERE us > (SELECT max(valid_from) FROM intervals)) AS beyond,
  CAST(max(date_diff('day', fx_rate_date, CAST(make_timestamp(us) AS DATE))) AS INTEGER) AS widest FROM priced""",
        "party_reach": f"SELECT company, count(*) AS events, min(at_) AS first_at, max(at_) AS last_at FROM ({parties}) WHERE company IS NOT NULL AND at_ IS NOT NULL GROUP BY 1",
        "orphan_counts": """SELECT 'customers_without_orders' AS measure, count(*) AS n FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT 'parts_without_lines', count(*) FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem)
UNION ALL SELECT 'fact_keys', count(*) FROM fact_payment WHERE payee_company_sk NOT IN (SELECT company_sk FROM dim_company)""",
        "masked_suppliers": "SELECT * REPLACE (CASE WHEN s_name IS NOT NULL THEN '***' END AS s_name) FROM supplier",
        "stream_digests": f"SELECT o_orderkey, {_hash(chr(39) + 'NAMESPACE' + chr(39), chr(39) + '11' + chr(39), chr(39) + 'TIDE-PLAIN/amount' + chr(39), 'CAST(o_orderkey AS VARCHAR)', chr(39) + '0' + chr(39))} AS digest FROM orders".replace("NAMESPACE", _namespace()),
        "text_instants": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS said, epoch_us(ts) // 1000 * 1000 AS micros FROM events",
    }


def _namespace() -> str:
    from tidemark.sources.generator import NAMESPACE

    return NAMESPACE
