"""Adding snapshot columns to a table that was landed without them: one pass to look, one rewrite, one pass to verify."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import ref_date_of_file, token_month
from tidemark.store import WriteRefused, rows_in, swap

COLUMNS = ("_snapshot_month", "_snapshot_ref_date")


@dataclass(frozen=True)
class Scan:
    rows: int
    files: int
    nameless: int
    other_month: int
    other_source_month: int
    months: tuple[str, ...]


def missing_columns(rows: DataFrame) -> list[str]:
    return [c for c in COLUMNS if c not in rows.columns]


def scan(rows: DataFrame, month: str) -> Scan:
    """Everything the refusals need, in one pass: rows, files, rows whose file proves no month, or another one."""
    asserted = token_month(F.col("_source_file"))
    path_month = F.regexp_extract("_source_file", r"/(\d{4}-\d{2})/", 1)
    held = F.col("_snapshot_month") if "_snapshot_month" in rows.columns else F.lit(None).cast("string")
    r = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("_source_file").alias("files"), F.count(F.when(asserted.isNull(), 1)).alias("nameless"),
        F.count(F.when(~F.endswith(F.lit(month), asserted) | (held != month), 1)).alias("other"), F.count(F.when((path_month != "") & (path_month != month), 1)).alias("source"),
        F.collect_set(F.when(path_month != "", path_month)).alias("months"),
    ).first()
    return Scan(r["rows"], r["files"], r["nameless"], r["other"], r["source"], tuple(sorted(r["months"])))


def backfill(rows: DataFrame, table: str, month: str, quarantine: str | None = None) -> int:
    """Rewrites `table` from `rows` with both columns; refused if any file contradicts the month or rejects are waiting.

    Rows whose file proves no day get a null reference date, which the gate's last rule then names.
    """
    spark = rows.sparkSession
    found = scan(rows, month)
    if not found.rows:
        raise WriteRefused(f"{table} has no rows")
    if found.other_month or found.other_source_month:
        raise WriteRefused(f"{found.other_month} rows assert another month than {month}, {found.other_source_month} lie under {found.months}")
    if quarantine and rows_in(spark, quarantine):
        raise WriteRefused(f"{quarantine} is not empty")
    filled = rows.withColumns({"_snapshot_month": F.lit(month), "_snapshot_ref_date": ref_date_of_file(F.col("_source_file"), month)})

    def verify(safe: DataFrame) -> None:
        after = safe.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("_snapshot_month").isNull(), 1)).alias("empty")).first()
        if after["n"] != found.rows or after["empty"]:
            raise WriteRefused(f"{table}: {after['n']} rows to write, {found.rows} before, {after['empty']} without a month")

    return swap(filled, table, verify)


def fingerprint(rows: DataFrame) -> DataFrame:
    """One row (rows, digest) that depends on a table's rows but not on their order: sums of row hashes, no row is gathered."""
    h = F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("\u0000null")) for c in sorted(rows.columns)), *(F.col(c).isNull() for c in sorted(rows.columns)))
    wide = F.sum(h.cast("decimal(38,0)"))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.sha2(F.concat_ws("|", F.count(F.lit(1)).cast("string"), wide.cast("string"), F.bit_xor(h).cast("string")), 256).alias("digest"))
