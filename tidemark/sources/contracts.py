"""Contracts: the ordered columns of each source, all STRING and nullable, and the tables they land in."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

from pyspark.sql import types as T

from tidemark.operators import quality as q

#: Ordered columns of each source; order is authoritative, for the CSV files have no header. (fixed values)
COLUMNS: Mapping[str, tuple[str, ...]] = MappingProxyType({
    "lookup": ("codigo", "descricao"),
    "empresas": ("cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel", "capital_social", "porte_empresa", "ente_federativo_responsavel"),
    "estabelecimentos": (
        "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial", "nome_fantasia", "situacao_cadastral", "data_situacao_cadastral", "motivo_situacao_cadastral", "nome_cidade_exterior", "pais",
        "data_inicio_atividade", "cnae_fiscal_principal", "cnae_fiscal_secundaria", "tipo_logradouro", "logradouro", "numero", "complemento", "bairro", "cep", "uf", "municipio",
        "ddd_1", "telefone_1", "ddd_2", "telefone_2", "ddd_fax", "fax", "correio_eletronico", "situacao_especial", "data_situacao_especial",
    ),
    "socios": ("cnpj_basico", "identificador_socio", "nome_socio_razao_social", "cpf_cnpj_socio", "qualificacao_socio", "data_entrada_sociedade", "pais", "representante_legal", "nome_do_representante", "qualificacao_representante_legal", "faixa_etaria"),
    "simples": ("cnpj_basico", "opcao_pelo_simples", "data_opcao_simples", "data_exclusao_simples", "opcao_mei", "data_opcao_mei", "data_exclusao_mei"),
    "payments": ("transaction_id", "event_time", "emitted_at", "payer_cnpj_basico", "payee_cnpj_basico", "amount", "currency", "payment_method"),
    "ptax": ("quote_date", "currency", "data_hora_cotacao", "cotacao_compra", "cotacao_venda"),
    "merchant": ("merchant_id", "cnpj", "legal_name", "trade_name", "status", "mcc", "settlement_account", "risk_tier", "credit_limit", "onboarded_on", "updated_at", "_snapshot_at", "_pg_snapshot", "_pg_wal_lsn"),
})

#: Columns that are never null or blank. (fixed values)
REQUIRED: Mapping[str, tuple[str, ...]] = MappingProxyType({
    "lookup": COLUMNS["lookup"],
    "estabelecimentos": ("cnpj_basico", "cnpj_ordem", "cnpj_dv", "municipio"),
    "empresas": ("cnpj_basico", "razao_social", "natureza_juridica"),
    "socios": ("cnpj_basico", "identificador_socio", "nome_socio_razao_social", "qualificacao_socio"),
    "payments": COLUMNS["payments"],
    "ptax": COLUMNS["ptax"],
    "merchant": tuple(c for c in COLUMNS["merchant"] if c != "trade_name"),
})

#: File-name suffixes of the lookup files and the kind of lookup they hold. (fixed values)
LOOKUP_SUFFIXES = {"CNAE": "cnae", "MOTI": "motivo", "MUNIC": "municipio", "NATJU": "natureza_juridica", "PAIS": "pais", "QUALS": "qualificacao"}

#: Audit columns of the landing layer, in order.
AUDIT = ("_rescued_data", "_source_file", "_ingested_at", "_record_source", "_batch_id", "_snapshot_month", "_snapshot_ref_date")

CURRENCIES = ("BRL", "USD")
PAYMENT_METHODS = ("PIX", "TED", "BOLETO", "CARTAO_CREDITO", "CARTAO_DEBITO")

MONTH = r"\d{4}-(0[1-9]|1[0-2])"


class UnknownTable(ValueError):
    """A table or contract nobody registered."""


@dataclass(frozen=True)
class SnapshotAxis:
    """The column that says when a row was observed, and the shape of its values."""

    column: str
    shape: str


MONTHLY = SnapshotAxis("_snapshot_month", MONTH)
INSTANT = SnapshotAxis("_snapshot_at", r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}Z")


@dataclass(frozen=True)
class LandedTable:
    """A landed source: its contract, its three tables, where files land and what its rows promise.

    `landing`: zips (archives unpacked here), local (loose files), generated, api or postgres. `promises`: SQL
    conditions every promoted row meets; they are asserted after a write.
    """

    name: str
    landing: str
    prefix: str | None = None
    axis: SnapshotAxis = MONTHLY
    promises: tuple[str, ...] = ()
    format: str = "csv"
    staging: str = field(init=False)
    bronze: str = field(init=False)
    quarantine: str = field(init=False)

    def __post_init__(self):
        if self.name not in COLUMNS:
            raise UnknownTable(f"no contract for {self.name!r}")
        if self.landing not in ("zips", "local", "generated", "api", "postgres"):
            raise ValueError(f"{self.name}: unknown landing {self.landing!r}")
        object.__setattr__(self, "bronze", f"bronze_{self.name}")
        object.__setattr__(self, "staging", f"bronze_{self.name}_staging")
        object.__setattr__(self, "quarantine", f"bronze_{self.name}_quarantine")


def registry(*tables: LandedTable) -> Mapping[str, LandedTable]:
    """Tables by name. Names that differ only in case, or one table's name as another's, are refused."""
    seen: dict[str, str] = {}
    for t in tables:
        for name in (t.name, t.staging, t.bronze, t.quarantine):
            other = seen.setdefault(name.casefold(), t.name)
            if other != t.name:
                raise ValueError(f"{name} is claimed by {other} and {t.name}")
        if t.axis is not MONTHLY and t.axis.column not in COLUMNS[t.name]:
            raise ValueError(f"{t.name} has no column {t.axis.column}")
    if len({t.name for t in tables}) < len(tables):
        raise ValueError("a table is registered twice")
    return MappingProxyType({t.name: t for t in tables})


def check_contracts() -> None:
    """Refuses contracts that contradict themselves; run when this module is imported.

    Columns are distinct whatever their case and none is an audit column; required columns are declared.
    """
    for name, columns in COLUMNS.items():
        folded = [c.casefold() for c in columns]
        if not columns or len(set(folded)) < len(folded) or set(folded) & set(AUDIT):
            raise ValueError(f"{name}: columns repeated, or those of the landing layer")
    for name, required in REQUIRED.items():
        if name not in COLUMNS or not set(required) <= set(COLUMNS[name]):
            raise ValueError(f"{name}: required columns that no contract declares")


def check_tables(tables: Mapping[str, LandedTable]) -> None:
    """Refuses landed tables that can't be ingested or gated: each needs a known format, rules that read declared
    columns, and a prefix exactly where it comes in archives, no two alike."""
    prefixes = [t.prefix for t in tables.values() if t.prefix]
    if len({p.casefold() for p in prefixes}) < len(prefixes):
        raise ValueError(f"an archive prefix is claimed twice: {prefixes}")
    for t in tables.values():
        if t.format not in ("csv", "json"):
            raise ValueError(f"{t.name}: unknown format {t.format!r}")
        if (t.landing == "zips") != bool(t.prefix):
            raise ValueError(f"{t.name}: a prefix belongs to archives, and only to them")
        unread = {c for r in rules_for(t.name) for c in r.reads} - set(COLUMNS[t.name]) - set(AUDIT)
        if unread:
            raise ValueError(f"{t.name}: rules read {sorted(unread)}, which nothing declares")


_KEY8 = "length(trim(cnpj_basico)) = 8"
TABLES = registry(
    LandedTable("lookup", "local", promises=("length(trim(codigo)) > 0",)),
    LandedTable("estabelecimentos", "zips", "Estabelecimentos", promises=(_KEY8,)),
    LandedTable("empresas", "zips", "Empresas", promises=(_KEY8, "razao_social IS NOT NULL")),
    LandedTable("socios", "zips", "Socios", promises=("cnpj_basico IS NOT NULL", "identificador_socio IS NOT NULL")),
    LandedTable("payments", "generated", promises=("length(trim(transaction_id)) > 0", "payer_cnpj_basico IS NOT NULL", "payee_cnpj_basico IS NOT NULL"), format="json"),
    LandedTable("ptax", "api", promises=("quote_date RLIKE '^[0-9]{4}-[0-9]{2}-[0-9]{2}$'", "cotacao_venda IS NOT NULL"), format="json"),
    LandedTable("merchant", "postgres", axis=INSTANT, promises=("merchant_id IS NOT NULL", "onboarded_on IS NOT NULL", "length(_snapshot_at) = 27"), format="json"),
)


def table_spec(name: str) -> LandedTable:
    if name not in TABLES:
        raise UnknownTable(f"unknown table {name!r}; registered: {', '.join(sorted(TABLES))}")
    return TABLES[name]


def struct_of(contract: str) -> T.StructType:
    """Read schema of a contract: every column STRING and nullable."""
    if contract not in COLUMNS:
        raise UnknownTable(f"unknown contract {contract!r}")
    return T.StructType([T.StructField(c, T.StringType(), True) for c in COLUMNS[contract]])


def rules_for(contract: str) -> list[q.Rule]:
    """Ordered rules of a contract: missing values, shapes, bytes, and what concerns the whole file last."""
    if contract not in REQUIRED:
        raise UnknownTable(f"no rules for {contract!r}")
    columns = COLUMNS[contract]
    missing = [q.blank(c) for c in REQUIRED[contract]]
    bytes_ = [q.replacement_character(columns)]
    if contract == "lookup":
        return missing + bytes_
    if contract == "payments":
        return [*missing, q.wrong_length("payer_cnpj_basico"), q.wrong_length("payee_cnpj_basico"), *bytes_]
    if contract == "ptax":
        return [*missing, q.wrong_date("quote_date"), q.wrong_decimal("cotacao_compra", "decimal(18,5)"), q.wrong_decimal("cotacao_venda", "decimal(18,5)"), q.wrong_publication("data_hora_cotacao"), *bytes_]
    if contract == "merchant":
        return [*missing, q.wrong_full_cnpj(), q.wrong_date("onboarded_on"), q.wrong_snapshot_instant(), q.wrong_decimal("credit_limit", "decimal(14,2)"), *bytes_, q.case_divergence(columns), q.unprovable_ref_date()]
    return [*missing, q.wrong_length("cnpj_basico"), *bytes_, q.unprovable_ref_date()]


check_contracts()
check_tables(TABLES)
