import pytest

from tidemark.operators.specs import MODEL
from tidemark.operators.star import Calendar, Enumerated, Fact, PointInTime, StarRefused, Versioned, build_star
from tidemark.plans.jobs import STAR
from tidemark.sources.contracts import LandedTable, check_tables

DIM, DAYS, KIND = Versioned("dim_company", "company_sk", "sat_empresa_dados"), Calendar("dim_date", "date_key"), Enumerated("dim_kind", "kind_key", "payment_method")
PIT = PointInTime("pit_x", "hub_estabelecimento", ("sat_estabelecimento_dados",))
FACT = Fact("fact_x", "transaction_id", (("payer_sk", "dim_company"), ("day_key", "dim_date"), ("kind_key", "dim_kind")), ("amount",))


def test_the_star_is_built():
    assert set(STAR) == {"dim_company", "dim_date", "dim_channel", "dim_currency", "pit_estabelecimento", "fact_payment"}
    assert list(build_star((DIM, DAYS, KIND, PIT, FACT), MODEL)) == ["dim_company", "dim_date", "dim_kind", "pit_x", "fact_x"]
    with pytest.raises(TypeError):
        STAR["x"] = DIM


@pytest.mark.parametrize(
    "tables, others, fault",
    [
        ((Calendar("Bronze_Payments", "k"),), ("bronze_payments",), "another layer"),
        ((Calendar("HUB_EMPRESA", "k"),), (), "another layer"),
        ((DAYS, Calendar("DIM_DATE", "k2")), (), "two tables"),
        ((KIND, Enumerated("dim_other", "other_key", "PAYMENT_METHOD")), (), "draw from"),
        ((DAYS, Calendar("dim_day", "DATE_KEY")), (), "surrogate key of two"),
        ((Versioned("d", "k", "hub_empresa"),), (), "no satellite"),
        ((Versioned("d", "Razao_Social", "sat_empresa_dados"),), (), "both a column"),
        ((Enumerated("d", "x", "X"),), (), "is its column"),
        ((PointInTime("p", "sat_empresa_dados", ("sat_empresa_dados",)),), (), "no hub"),
        ((PointInTime("p", "hub_empresa", ("sat_estabelecimento_dados",)),), (), "no satellite of"),
        ((PointInTime("p", "hub_empresa", ()),), (), "no satellites"),
        ((PointInTime("p", "hub_empresa", ("sat_empresa_dados",), "hub_empresa_hk"),), (), "hash key"),
        ((DIM, DAYS, Fact("f", "i", (("a", "dim_company"),), ())), (), "doesn't reach dim_date"),
        ((DAYS, Fact("f", "i", (("a", "dim_date"), ("b", "nothing")), ())), (), "no dimension"),
        ((DAYS, Fact("f", "i", (("a", "dim_date"),), ("A",))), (), "named twice"),
    ],
)
def test_sets_that_dont_fit_are_refused(tables, others, fault):
    with pytest.raises(StarRefused, match=fault):
        build_star(tables, MODEL, others)


def test_landed_tables_that_cant_be_gated_are_refused():
    for bad in (LandedTable("payments", "generated", prefix="P"), LandedTable("empresas", "zips"), LandedTable("payments", "generated", format="xml")):
        with pytest.raises(ValueError):
            check_tables({bad.name: bad})
    two = (LandedTable("empresas", "zips", "Empresas"), LandedTable("socios", "zips", "EMPRESAS"))
    with pytest.raises(ValueError, match="claimed twice"):
        check_tables({t.name: t for t in two})
