"""Batch readers: contract to format, options and schema; rescued data without a platform's help."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import ref_date_of_file, ref_date_of_instant
from tidemark.sources.contracts import COLUMNS, LOOKUP_SUFFIXES, MONTH, LandedTable, struct_of

#: Reader options: doubled quotes, line breaks inside quotes, cp1252; JSON Lines in UTF-8. (fixed values)
CSV_OPTIONS = {"header": "false", "sep": ";", "quote": '"', "escape": '"', "encoding": "cp1252", "multiLine": "true", "mode": "PERMISSIVE"}
JSON_OPTIONS = {"multiLine": "false", "encoding": "UTF-8", "mode": "PERMISSIVE"}


def read_options(table: LandedTable) -> dict[str, str]:
    return dict(CSV_OPTIONS if table.format == "csv" else JSON_OPTIONS)


def read_csv_batch(spark: SparkSession, path: str, contract: str) -> DataFrame:
    """CSV files of a contract, all columns STRING. One file is one task, for quotes may hold line breaks."""
    return spark.read.schema(struct_of(contract)).options(**CSV_OPTIONS).csv(path)


def read_jsonl_batch(spark: SparkSession, path: str, contract: str) -> DataFrame:
    """JSON Lines of a contract with `_rescued_data`."""
    return parse_json_lines(spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_source_file")), contract)


def rescued_json(line: Column, contract: str) -> Column:
    """The raw line if it isn't a JSON object or has keys the contract doesn't declare, else null."""
    keys = F.json_object_keys(line)
    surplus = F.array_except(keys, F.array(*(F.lit(c) for c in COLUMNS[contract])))
    return F.when(keys.isNull() | (F.size(surplus) > 0), line)


def parse_json_lines(lines: DataFrame, contract: str, column: str = "value") -> DataFrame:
    """Contract columns of JSON text lines, with `_rescued_data`; other columns of `lines` stay."""
    parsed = F.from_json(F.col(column), struct_of(contract))
    rest = [c for c in lines.columns if c != column]
    return lines.withColumn("__p", parsed).withColumn("_rescued_data", rescued_json(F.col(column), contract)).select(*(F.col(f"__p.{c}").alias(c) for c in COLUMNS[contract]), "_rescued_data", *rest)


def audited(rows: DataFrame, *, record_source: str, batch_id: str, month: str) -> DataFrame:
    """Adds the audit columns every landed row has."""
    return rows.withColumns({"_ingested_at": F.current_timestamp(), "_record_source": F.lit(record_source), "_batch_id": F.lit(batch_id), "_snapshot_month": F.lit(month)})


def audited_file(rows: DataFrame, *, record_source: str, batch_id: str, month: str) -> DataFrame:
    """Audit columns with the reference date that the source file's name proves, null where it proves none."""
    return audited(rows, record_source=record_source, batch_id=batch_id, month=month).withColumn("_snapshot_ref_date", ref_date_of_file(F.col("_source_file"), month))


def audited_instant(rows: DataFrame, *, column: str, record_source: str, batch_id: str, month: str) -> DataFrame:
    """Audit columns with the reference date of the rows' own snapshot instant."""
    return audited(rows, record_source=record_source, batch_id=batch_id, month=month).withColumn("_snapshot_ref_date", ref_date_of_instant(F.col(column)))


def lookup_type_of(name: str) -> str | None:
    """Kind of lookup that a file name's suffix states; null for others."""
    return next((kind for suffix, kind in LOOKUP_SUFFIXES.items() if name.upper().endswith(suffix)), None)


def lookup_type(path: Column) -> Column:
    """The same as a Column."""
    kind = F.lit(None).cast("string")
    for suffix, name in LOOKUP_SUFFIXES.items():
        kind = F.when(F.endswith(F.upper(path), F.lit(suffix)), F.lit(name)).otherwise(kind)
    return kind


def snapshot_window(spark: SparkSession, name: str, values: list[str] | None, column: str = "_snapshot_month", shape: str | None = None) -> DataFrame:
    """Rows of a table whose snapshot column is among `values`; None is the whole table.

    A text instead of a list, an empty list, a repeated or malformed value and a missing column are refused.
    """
    rows = spark.table(name)
    if column not in rows.columns:
        raise ValueError(f"{name} has no {column}")
    if values is None:
        return rows
    checked_values(values, shape)
    return rows.filter(F.col(column).isin(list(values)))


def checked_values(values: list[str], shape: str | None) -> list[str]:
    """The values, refused unless they are a list of distinct ones of the shape (months by default)."""
    if isinstance(values, str) or not values:
        raise ValueError("name at least one snapshot, as a list")
    bad = [v for v in values if not re.fullmatch(shape or MONTH, v)]
    if bad or len(set(values)) < len(values):
        raise ValueError(f"snapshots malformed or repeated: {bad or values}")
    return list(values)
