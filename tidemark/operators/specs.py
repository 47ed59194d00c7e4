"""Declarative specs of the historised model and their registry."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from types import MappingProxyType


class SpecRefused(ValueError):
    """A spec that contradicts itself or the others."""


def _distinct(what: str, names: Iterable[str]) -> None:
    names = list(names)
    if len({n.casefold() for n in names}) < len(names):
        raise SpecRefused(f"{what}: a name is used twice in {names}")
    if not all(names):
        raise SpecRefused(f"{what}: an empty name")


@dataclass(frozen=True)
class KeyColumn:
    """A business-key column; `width` pads it with zeros, none leaves it as it is."""

    name: str
    width: int | None = None

    def __post_init__(self):
        if not self.name or (self.width is not None and self.width <= 0):
            raise SpecRefused(f"key column {self.name!r} of width {self.width}")


@dataclass(frozen=True)
class Hub:
    """A business object and its key."""

    name: str
    hash_key: str
    keys: tuple[KeyColumn, ...]

    def __post_init__(self):
        if not self.keys:
            raise SpecRefused(f"{self.name} has no key")
        _distinct(self.name, [self.hash_key, *(k.name for k in self.keys)])

    @property
    def key_names(self) -> tuple[str, ...]:
        return tuple(k.name for k in self.keys)


@dataclass(frozen=True)
class Satellite:
    """Attributes of a hub whose changes are kept."""

    name: str
    parent: str
    payload: tuple[str, ...]

    def __post_init__(self):
        if not self.payload:
            raise SpecRefused(f"{self.name} has no payload")
        _distinct(self.name, self.payload)


@dataclass(frozen=True)
class Prefix:
    """A key column that is the first `width` characters of another column."""

    column: str
    width: int


@dataclass(frozen=True)
class LinkEnd:
    """One end of a link. `role` tells two ends on one hub apart; an end that isn't identifying is carried but not
    part of the link's key; `key_from` derives the hub's key columns from others."""

    hub: str
    role: str | None = None
    identifying: bool = True
    key_from: tuple[Prefix, ...] = ()


@dataclass(frozen=True)
class Link:
    """A relationship between hubs; its key is that of its identifying ends, then its dependent columns."""

    name: str
    hash_key: str
    ends: tuple[LinkEnd, ...]
    dependent: tuple[str, ...] = ()

    def __post_init__(self):
        _distinct(self.name, [self.hash_key, *(self.reference(e) for e in self.ends), *self.dependent])
        if sum(e.identifying for e in self.ends) + len(self.dependent) < 2:
            raise SpecRefused(f"{self.name} needs two identifying components")
        by_hub = [e.hub for e in self.ends if not e.role]
        if len(set(by_hub)) < len(by_hub):
            raise SpecRefused(f"{self.name}: two ends on one hub need roles")

    @staticmethod
    def reference(end: LinkEnd) -> str:
        return f"{end.role}_{end.hub}_hk" if end.role else f"{end.hub}_hk"


@dataclass(frozen=True)
class Effectivity:
    """When a relationship was delivered: opened by the source, closed by its absence."""

    name: str
    parent: str
    entry: str


@dataclass(frozen=True)
class Reference:
    """Codes and their description, without history, routed by the kind of lookup file."""

    name: str
    lookup_type: str
    key: str = "codigo"
    payload: str = "descricao"


@dataclass(frozen=True)
class Domain:
    """A named set of specs."""

    name: str
    tables: tuple = field(default_factory=tuple)


def build_model(*domains: Domain) -> Mapping[str, object]:
    """All domains' tables by name, refused as a whole set if any doesn't fit.

    Names must be unique whatever their case; satellites hang off hubs, effectivity off links; links join registered
    hubs; derived ends must give a hub's key in number and width.
    """
    tables = [t for d in domains for t in d.tables]
    _distinct("domains", [d.name for d in domains])
    _distinct("model", [t.name for t in tables])
    by = {t.name: t for t in tables}
    for t in tables:
        if isinstance(t, Satellite) and not isinstance(by.get(t.parent), Hub):
            raise SpecRefused(f"{t.name} hangs off {t.parent!r}, which is no hub")
        if isinstance(t, Effectivity) and not isinstance(by.get(t.parent), Link):
            raise SpecRefused(f"{t.name} hangs off {t.parent!r}, which is no link")
        if isinstance(t, Link):
            for end in t.ends:
                hub = by.get(end.hub)
                if not isinstance(hub, Hub):
                    raise SpecRefused(f"{t.name} joins {end.hub!r}, which is no hub")
                if end.key_from and [p.width for p in end.key_from] != [k.width for k in hub.keys]:
                    raise SpecRefused(f"{t.name}: the derived key of {end.hub} does not fit")
    return MappingProxyType(by)


HUB_EMPRESA = Hub("hub_empresa", "hub_empresa_hk", (KeyColumn("cnpj_basico", 8),))
HUB_ESTABELECIMENTO = Hub("hub_estabelecimento", "hub_estabelecimento_hk", (KeyColumn("cnpj_basico", 8), KeyColumn("cnpj_ordem", 4), KeyColumn("cnpj_dv", 2)))
HUB_MERCHANT = Hub("hub_merchant", "hub_merchant_hk", (KeyColumn("merchant_id"),))
LINK_COMPANY_PARTNER = Link("link_company_partner", "link_company_partner_hk", (LinkEnd("hub_empresa", "company"), LinkEnd("hub_empresa", "partner", identifying=False)), ("identificador_socio", "cpf_cnpj_socio"))
LINK_MERCHANT_EMPRESA = Link("link_merchant_empresa", "link_merchant_empresa_hk", (LinkEnd("hub_merchant"), LinkEnd("hub_empresa", key_from=(Prefix("cnpj", 8),))))

#: The model of the registry and merchant sources.
MODEL = build_model(
    Domain("registry", (
        HUB_EMPRESA,
        Satellite("sat_empresa_dados", "hub_empresa", ("razao_social", "natureza_juridica", "capital_social", "porte_empresa")),
        HUB_ESTABELECIMENTO,
        Satellite("sat_estabelecimento_dados", "hub_estabelecimento", ("nome_fantasia", "cnae_fiscal_principal", "cnae_fiscal_secundaria", "situacao_cadastral", "data_situacao_cadastral", "motivo_situacao_cadastral")),
        Satellite("sat_estabelecimento_endereco", "hub_estabelecimento", ("tipo_logradouro", "logradouro", "numero", "complemento", "bairro", "cep", "uf", "municipio", "nome_cidade_exterior", "pais")),
        Link("link_empresa_estabelecimento", "link_empresa_estabelecimento_hk", (LinkEnd("hub_empresa"), LinkEnd("hub_estabelecimento"))),
        LINK_COMPANY_PARTNER,
        Effectivity("sat_eff_company_partner", "link_company_partner", "data_entrada_sociedade"),
        *(Reference(f"ref_{kind}", kind) for kind in ("cnae", "motivo", "municipio", "natureza_juridica", "pais", "qualificacao")),
    )),
    Domain("merchants", (
        HUB_MERCHANT,
        Satellite("sat_merchant_dados", "hub_merchant", ("legal_name", "trade_name", "status", "mcc", "settlement_account", "risk_tier", "credit_limit")),
        LINK_MERCHANT_EMPRESA,
        Effectivity("sat_eff_merchant_empresa", "link_merchant_empresa", "onboarded_on"),
    )),
)
