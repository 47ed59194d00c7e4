"""Tables of a data folder, and how this project's data states its entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.identity import amount, attribute, company_key
from tidemark.functions.times import midnight

#: Registry contract columns besides the key; amounts are compared as amounts.
REGISTRY_TEXT = ("razao_social", "natureza_juridica", "qualificacao_responsavel", "porte_empresa", "ente_federativo_responsavel")
#: Attributes whose history the satellite holds.
HISTORY_ATTRIBUTES = ("razao_social", "natureza_juridica", "capital_social", "porte_empresa")
#: More snapshots than this are refused: their list is brought to the driver and becomes part of the plan.
MOST_SNAPSHOTS = 4096


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def accepted_registry(spark: SparkSession, folder: str) -> DataFrame:
    """Registry rows that belong to a snapshot: no rejects, no rows without a key; `company` is the key as INT."""
    rows = table(spark, folder, "empresas").filter(F.col("_rescued_data").isNull())
    return rows.withColumn("company", company_key(F.col("cnpj_basico"))).filter(F.col("company").isNotNull())


def delivered_snapshots(registry: DataFrame) -> list[tuple[int, str]]:
    """(00:00 UTC of the reference date in epoch microseconds, month) of each delivered snapshot, in order."""
    found = registry.groupBy(F.col("_snapshot_month").alias("month")).agg(F.min(midnight(F.col("_snapshot_ref_date"))).alias("at")).filter(F.col("month").isNotNull() & F.col("at").isNotNull()).limit(MOST_SNAPSHOTS + 1).collect()
    if len(found) > MOST_SNAPSHOTS:
        raise ValueError(f"more than {MOST_SNAPSHOTS} snapshots")
    return sorted((r["at"], r["month"]) for r in found)


def snapshot_months(registry: DataFrame) -> list[str]:
    """The snapshots a registry holds, told apart by their month alone, whether or not a reference date is known."""
    found = registry.select("_snapshot_month").filter(F.col("_snapshot_month").isNotNull()).distinct().limit(MOST_SNAPSHOTS + 1).collect()
    if len(found) > MOST_SNAPSHOTS:
        raise ValueError(f"more than {MOST_SNAPSHOTS} snapshots")
    return sorted(r["_snapshot_month"] for r in found)


def registry_content() -> list:
    """Canonical columns of a registry row, without nulls."""
    return [attribute(F.col(c)) for c in REGISTRY_TEXT] + [amount(F.col("capital_social"))]


def history_content() -> dict:
    """Canonical columns of a satellite row, without nulls, by name."""
    return {c: (amount if c == "capital_social" else attribute)(F.col(c)) for c in HISTORY_ATTRIBUTES}
