"""DuckDB SQL for the queries of `data_queries`, written from the problem statements and apart from the operators."""

from __future__ import annotations


def _key(c: str) -> str:
    d = f"regexp_replace({c}, '[^0-9]', '', 'g')"
    return f"(CASE WHEN {d} = '' THEN NULL WHEN length({d}) >= 8 THEN left({d}, 8) ELSE right('0000000' || {d}, 8) END)"


def _id(c: str) -> str:
    return rf"nullif(lower(regexp_replace({c}, '[-\s]', '', 'g')), '')"


def _instant(c: str) -> str:
    return rf"(CASE WHEN regexp_full_match(trim({c}), '\d{{4}}-\d{{2}}-\d{{2}}T\d{{2}}:\d{{2}}(:\d{{2}}(\.\d+)?)?(Z|[+-]\d{{2}}:\d{{2}})') THEN try_cast(trim({c}) AS TIMESTAMPTZ) AT TIME ZONE 'UTC' END)"


def _text(c: str) -> str:
    return rf"upper(trim(regexp_replace(coalesce({c}, ''), '\s+', ' ', 'g')))"


def _amount(c: str) -> str:
    return f"regexp_replace(regexp_replace(coalesce({c}, ''), '[^0-9-]', '', 'g'), '^(-?)0+([0-9])', '\\1\\2')"


MESSAGES = f"""messages AS (
  SELECT {_id('transaction_id')} AS id, {_instant('event_time')} AS ts, {_key('payer_cnpj_basico')} AS payer, {_key('payee_cnpj_basico')} AS payee
  FROM payments WHERE {_id('transaction_id')} IS NOT NULL)"""

ORPHANS = f"""WITH {MESSAGES},
registry AS (SELECT DISTINCT {_key('cnpj_basico')} AS company, _snapshot_month AS m FROM empresas WHERE _rescued_data IS NULL),
delivered AS (SELECT _snapshot_month AS m, min(_snapshot_ref_date) AS d FROM empresas WHERE _rescued_data IS NULL AND {_key('cnpj_basico')} IS NOT NULL GROUP BY 1),
spans AS (SELECT m, CAST(d AS TIMESTAMP) AS f, CAST(lead(d) OVER (ORDER BY d) AS TIMESTAMP) AS t FROM delivered),
refs AS (SELECT id, ts, 'payer' AS party_role, payer AS company FROM messages UNION SELECT id, ts, 'payee', payee FROM messages),
placed AS (SELECT r.id, r.ts, r.party_role, r.company, s.m FROM refs r LEFT JOIN spans s ON r.ts >= s.f AND (s.t IS NULL OR r.ts < s.t) WHERE r.ts IS NOT NULL AND r.company IS NOT NULL),
orphans AS (SELECT DISTINCT p.id AS transaction_id, p.party_role, strftime(p.ts, '%Y-%m') AS event_month
  FROM placed p LEFT JOIN registry g ON p.company = g.company AND p.m = g.m WHERE g.company IS NULL)"""

NULLABLE = ORPHANS[: ORPHANS.rindex(" WHERE r.ts IS NOT NULL")].replace("refs AS", "refs AS MATERIALIZED") + ")"
_SHOWN_REFERENCE = "SELECT DISTINCT id AS transaction_id, party_role, company, m AS in_force FROM placed p"

PAYMENT_COLUMNS = ("transaction_id", "event_time", "emitted_at", "payer_cnpj_basico", "payee_cnpj_basico", "amount", "currency", "payment_method", "_rescued_data", "_source_file", "_ingested_at", "_record_source", "_batch_id", "_snapshot_month")
_FIRST = ("_ingested_at", "_batch_id", "_source_file")
_ORDER = ", ".join(f"{c} NULLS FIRST" for c in [*_FIRST, *(c for c in PAYMENT_COLUMNS if c not in _FIRST)])
_SHOWN = ", ".join("epoch_us(_ingested_at) AS _ingested_at" if c == "_ingested_at" else c for c in PAYMENT_COLUMNS)

COMPANY_COLUMNS = ("cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel", "capital_social", "porte_empresa", "ente_federativo_responsavel")
_FIELD = '"([^"]|"")*"|[^";][^;]*|'
_VALID = " AND ".join(f"regexp_full_match(v[{i + 1}], '{p}')" for i, p in enumerate((r"[0-9]{8}", r"(?s).+", r"[0-9]{4}", r"[0-9]{2}", r"[0-9]+,[0-9]{2}", r"(00|01|03|05)?")))
RECORDS = rf"""WITH lines AS (SELECT line_id, _rescued_data, regexp_replace(coalesce(raw_line, ''), '\r$', '') AS rec FROM raw_empresas),
cut AS (SELECT *, regexp_full_match(rec, '({_FIELD})(;({_FIELD}))*') AS quoted, regexp_extract_all(rec || ';', '("(?:[^"]|"")*"|[^;]*);', 1) AS f FROM lines),
bare AS (SELECT *, [trim(CASE WHEN x LIKE '"%' THEN replace(substring(x, 2, length(x) - 2), '""', '"') ELSE x END) FOR x IN f] AS v FROM cut),
parsed AS (SELECT *, CASE WHEN _rescued_data IS NOT NULL THEN 'rescued' WHEN NOT quoted THEN 'quoting' WHEN len(f) <> 7 THEN 'column_count'
  WHEN NOT ({_VALID}) OR contains(rec, chr(65533)) THEN 'invalid_value' END AS reason FROM bare)"""

def _parse_costs(fields: int = 7) -> str:
    """Least (quote edits, delimiter edits) of each record, as a recursive table over its tokens: one column a state and
    number of fields, holding a million times the quote edits plus the delimiter edits."""
    start, plain, quoted, after = range(4)
    states, counts, far, quote = (start, plain, quoted, after), range(1, fields + 1), 10**12, 10**6
    c = lambda s, k: f"c{s}_{k}"
    r = lambda s, k: f"r{s}_{k}"
    inserted = {start: [], plain: [], quoted: [start, after], after: [quoted]}
    ready = ", ".join(f"least({', '.join([c(s, k), *(f'{c(o, k)} + {quote}' for o in inserted[s])])}, {far}) AS {r(s, k)}" for s in states for k in counts)

    def then(s: int, k: int) -> str:
        at_quote = {start: [], plain: [r(plain, k)], quoted: [r(start, k), r(after, k)], after: [r(quoted, k)]}[s] + [f"{c(s, k)} + {quote}"]
        outside = (start, plain, after)
        at_mark = {start: [f"{r(o, k)} + 1" for o in outside] + [r(o, k - 1) for o in outside if k > 1], quoted: [r(quoted, k)]}.get(s, [])
        at_else = {plain: [r(start, k), r(plain, k)], quoted: [r(quoted, k)]}.get(s, [])
        least = lambda ways: f"least({', '.join([*ways, str(far)])})"
        return f"CASE token WHEN '\"' THEN {least(at_quote)} WHEN ';' THEN {least(at_mark)} ELSE {least(at_else)} END AS {c(s, k)}"

    first = ", ".join(f"CAST({0 if (s, k) == (start, 1) else far} AS BIGINT) AS {c(s, k)}" for s in states for k in counts)
    cost = f"least({', '.join(f'{c(s, k)} + {fields - k + (quote if s == quoted else 0)}' for s in states for k in counts)})"
    return f"""WITH RECURSIVE shapes AS (SELECT line_id, regexp_replace(regexp_replace(coalesce(raw_line, ''), '\\r$', ''), '[^;"]+', 'x', 'g') AS shape FROM raw_empresas),
walk AS (SELECT DISTINCT shape, 0 AS place, {first} FROM shapes
  UNION ALL SELECT shape, place + 1, {", ".join(then(s, k) for s in states for k in counts)}
  FROM (SELECT *, substring(shape, place + 1, 1) AS token, {ready} FROM walk WHERE place < length(shape))),
costs AS (SELECT shape, {cost} AS cost FROM walk WHERE place = length(shape))
SELECT line_id, CAST(cost // {quote} AS INTEGER) AS quote_edits, CAST(cost % {quote} AS INTEGER) AS delimiter_edits FROM shapes JOIN costs USING (shape) WHERE cost > 0"""


SNAPSHOTS = f"""WITH ranked AS (
  SELECT {_key('cnpj_basico')} AS k, _snapshot_month AS m, concat_ws('|', {', '.join(_text(c) for c in COMPANY_COLUMNS[1:] if c != 'capital_social')}, {_amount('capital_social')}) AS v,
    row_number() OVER (PARTITION BY {_key('cnpj_basico')}, _snapshot_month ORDER BY _ingested_at DESC) AS n
  FROM empresas WHERE _rescued_data IS NULL AND {_key('cnpj_basico')} IS NOT NULL),
rows_ AS (SELECT k, m, v FROM ranked WHERE n = 1),
pairs AS (SELECT m, lag(m) OVER (ORDER BY m) AS before FROM (SELECT DISTINCT m FROM rows_)),
later AS (SELECT r.k, r.m, r.v, p.before FROM rows_ r JOIN pairs p ON r.m = p.m WHERE p.before IS NOT NULL),
earlier AS (SELECT r.k, p.m, r.v FROM rows_ r JOIN pairs p ON r.m = p.before)"""

HISTORY = f"""WITH hub AS (SELECT DISTINCT hub_empresa_hk AS hk, {_key('cnpj_basico')} AS company FROM hub_empresa),
ranked AS (
  SELECT h.company, s.applied_date AS d, {_text('s.razao_social')} AS razao_social, {_text('s.natureza_juridica')} AS natureza_juridica, {_amount('s.capital_social')} AS capital_social, {_text('s.porte_empresa')} AS porte_empresa,
    row_number() OVER (PARTITION BY h.company, s.applied_date ORDER BY s.load_date DESC) AS n
  FROM sat_empresa_dados s JOIN hub h ON s.hub_empresa_hk = h.hk),
said AS (SELECT *, concat_ws('|', razao_social, natureza_juridica, capital_social, porte_empresa) AS v FROM ranked WHERE n = 1),
marked AS (SELECT *, lag(v) OVER (PARTITION BY company ORDER BY d) AS p FROM said),
versions AS (SELECT *, lead(d) OVER (PARTITION BY company ORDER BY d) AS e, row_number() OVER (PARTITION BY company ORDER BY d) AS no FROM marked WHERE p IS NULL OR p <> v)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"{ORPHANS} SELECT * FROM orphans",
        "p1_report": f"{ORPHANS} SELECT 'payments' AS table_name, party_role, event_month, count(*) AS orphan_references FROM orphans GROUP BY 1, 2, 3",
        "p1_partial": f"""{NULLABLE} {_SHOWN_REFERENCE} WHERE (company IS NOT NULL OR m IS NOT NULL)
  AND NOT EXISTS (SELECT 1 FROM registry g WHERE (p.company IS NULL OR g.company = p.company) AND (p.m IS NULL OR g.m = p.m) AND g.company IS NOT NULL)""",
        "p1_simple": f"{NULLABLE} {_SHOWN_REFERENCE} WHERE company IS NOT NULL AND m IS NOT NULL AND (company, m) NOT IN (SELECT company, m FROM registry WHERE company IS NOT NULL)",
        "p1_references": f"""{ORPHANS} SELECT 'payments' AS table_name, party_role, event_month, count(*) AS orphan_references FROM orphans GROUP BY 1, 2, 3
UNION ALL SELECT 'fact_payment', role, strftime({_instant('event_time')}, '%Y-%m'), count(*) FROM (SELECT event_time, 'payer' AS role, payer_company_sk AS k FROM fact_payment UNION ALL SELECT event_time, 'payee', payee_company_sk FROM fact_payment)
  WHERE k IS NOT NULL AND k NOT IN (SELECT company_sk FROM dim_company) GROUP BY 1, 2, 3
UNION ALL SELECT 'sat_empresa_dados', 'statement', strftime(applied_date, '%Y-%m'), count(*) FROM sat_empresa_dados
  WHERE hub_empresa_hk IS NOT NULL AND hub_empresa_hk NOT IN (SELECT hub_empresa_hk FROM hub_empresa WHERE hub_empresa_hk IS NOT NULL) GROUP BY 1, 2, 3""",
        "p2_found": f"SELECT {_id('transaction_id')} AS transaction_id FROM payments WHERE {_id('transaction_id')} IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
        "p2_seen_ranges": f"""WITH ids AS (SELECT DISTINCT {_id('transaction_id')} AS id FROM payments WHERE {_id('transaction_id')} IS NOT NULL),
n AS (SELECT CAST('0x' || left(id, 4) AS INTEGER) AS producer, CAST('0x' || right(id, 12) AS BIGINT) AS n FROM ids),
i AS (SELECT producer, n, n - row_number() OVER (PARTITION BY producer ORDER BY n) AS island FROM n)
SELECT producer, min(n) AS range_from, max(n) AS range_to FROM i GROUP BY producer, island""",
        "p2_seen_before": f"""WITH p AS (SELECT {_id('transaction_id')} AS id, _snapshot_month >= '2027-04' AS late FROM payments WHERE {_id('transaction_id')} IS NOT NULL)
SELECT id AS transaction_id, count(*) AS deliveries FROM p WHERE late AND id IN (SELECT id FROM p WHERE NOT late) GROUP BY 1""",
        "p2_messages": f"""SELECT {_SHOWN} FROM (SELECT *, row_number() OVER (PARTITION BY {_id('transaction_id')} ORDER BY {_ORDER}) AS n FROM payments WHERE {_id('transaction_id')} IS NOT NULL) WHERE n = 1
UNION ALL SELECT {_SHOWN} FROM payments WHERE {_id('transaction_id')} IS NULL""",
        "p3_found": f"{RECORDS} SELECT line_id, reason FROM parsed WHERE reason IS NOT NULL",
        "p3_rows": f"{RECORDS} SELECT line_id, {', '.join(f'v[{i + 1}] AS {c}' for i, c in enumerate(COMPANY_COLUMNS))} FROM parsed WHERE reason IS NULL",
        "p3_edits": _parse_costs(),
        "p4_found": f"""{SNAPSHOTS} SELECT coalesce(l.k, e.k) AS cnpj_basico, coalesce(l.m, e.m) AS snapshot_month,
  CASE WHEN e.k IS NULL THEN 'added' WHEN l.k IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
FROM later l FULL JOIN earlier e ON l.k = e.k AND l.m = e.m WHERE l.k IS NULL OR e.k IS NULL OR l.v <> e.v""",
        "p5_found": f"{HISTORY} SELECT company AS cnpj_basico, strftime(d, '%Y-%m-%d') AS valid_from, coalesce(strftime(e, '%Y-%m-%d'), '2999-12-31') AS valid_to FROM versions",
        "p5_history": f"{HISTORY} SELECT company AS cnpj_basico, CAST(no AS INTEGER) AS version_no, strftime(d, '%Y-%m-%d') AS valid_from, coalesce(strftime(e, '%Y-%m-%d'), '2999-12-31') AS valid_to, razao_social, natureza_juridica, capital_social, porte_empresa FROM versions",
        "p6_found": f"""{HISTORY}, {MESSAGES},
said_by AS (SELECT id, min(payer) AS payer, min(payee) AS payee FROM messages GROUP BY id),
stored AS (SELECT {_id('f.transaction_id')} AS id, {_instant('f.event_time')} AS ts, f.payer_company_sk AS payer_sk, f.payee_company_sk AS payee_sk FROM fact_payment f),
roles AS (
  SELECT s.id, s.ts, 'payer' AS party_role, m.payer AS company, s.payer_sk AS sk FROM stored s LEFT JOIN said_by m ON s.id = m.id
  UNION SELECT s.id, s.ts, 'payee', m.payee, s.payee_sk FROM stored s LEFT JOIN said_by m ON s.id = m.id),
keyed AS (SELECT v.company, CAST(v.d AS TIMESTAMP) AS f, CAST(v.e AS TIMESTAMP) AS t, k.company_sk AS right_sk FROM versions v
  LEFT JOIN dim_company k ON k.company_sk <> -1 AND {_key('k.cnpj_basico')} = v.company AND k.valid_from AT TIME ZONE 'UTC' = CAST(v.d AS TIMESTAMP))
SELECT DISTINCT r.id AS transaction_id, r.party_role FROM roles r LEFT JOIN keyed k ON r.company = k.company AND r.ts >= k.f AND (k.t IS NULL OR r.ts < k.t)
WHERE (k.f IS NULL AND r.sk IS DISTINCT FROM -1) OR (k.f IS NOT NULL AND (k.right_sk IS NULL OR r.sk IS DISTINCT FROM k.right_sk))""",
    }
