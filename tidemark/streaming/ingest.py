"""Incremental file ingest: Structured Streaming over a directory, every available file exactly once."""

from __future__ import annotations

import re
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.skew import hot_keys, salted_join
from tidemark.session import cut
from tidemark.sources.contracts import MONTH, LandedTable, struct_of
from tidemark.sources.readers import audited, audited_file, audited_instant, lookup_type, parse_json_lines, read_options
from tidemark.store import append, table_exists


class IngestRefused(ValueError):
    """An ingest whose parameters contradict each other."""


def checkpoint_location(root: str, month: str, table: LandedTable) -> str:
    """Checkpoint of a stream: month and table are its identity."""
    return f"{root}/_checkpoints/{month}/{table.name}"


def require_month(month: str) -> str:
    if not isinstance(month, str) or not re.fullmatch(MONTH, month):
        raise IngestRefused(f"not a month: {month!r}")
    return month


def landing_dir(root: str, month: str, table: LandedTable) -> str:
    """Where a table's files of a month land, by landing mode."""
    kind = {"zips": "files", "local": "files"}.get(table.landing, table.landing)
    return f"{root}/{kind}/{require_month(month)}/{table.name}"


def refuse_another_months_dir(source: str, root: str, month: str, table: LandedTable) -> None:
    """A stream reads its own month's directory and no other."""
    if PurePosixPath(source) != PurePosixPath(landing_dir(root, month, table)):
        raise IngestRefused(f"{source} is not where {table.name} of {month} lands: {landing_dir(root, month, table)}")


def file_stream(spark: SparkSession, table: LandedTable, source: str) -> DataFrame:
    """A directory's files as a stream of contract rows with `_source_file` and `_rescued_data`.

    Schemas are declared, never inferred. JSON lines that are malformed or hold undeclared keys keep their text in
    `_rescued_data`, as do CSV records with surplus fields.
    """
    if table.format == "json":
        lines = spark.readStream.text(source).select("value", F.col("_metadata.file_path").alias("_source_file"))
        return parse_json_lines(lines, table.name)
    schema = struct_of(table.name).add("_rescued_data", "string")
    rows = spark.readStream.schema(schema).options(**read_options(table), columnNameOfCorruptRecord="_rescued_data").csv(source)
    rows = rows.select("*", F.col("_metadata.file_path").alias("_source_file"))
    return rows.withColumn("lookup_type", lookup_type(F.col("_source_file"))) if table.name == "lookup" else rows


#: A micro-batch of up to this many files is compared with the staged files by sending its list of names to every task.
SENT_FILES = 10_000


def unlanded(batch: DataFrame, staged: DataFrame) -> DataFrame:
    """Rows of files that the staging table doesn't hold yet.

    A file is one value of `_source_file` and may have very many rows on both sides, so rows are never joined by it: the
    batch's distinct names are looked up among the distinct staged ones, and only names already landed, mostly none, are
    taken out of the batch. Their number is checked before they are sent to every task; beyond SENT_FILES they are
    spread by a hash of the row. Rows without a name are kept.
    """
    names = batch.select("_source_file").filter(F.col("_source_file").isNotNull()).distinct()
    landed = cut(names.join(staged.select(F.col("_source_file").alias("__held")).distinct(), F.col("_source_file") == F.col("__held"), "left_semi"))
    n = landed.limit(SENT_FILES + 1).count()
    if not n:
        return batch
    if n <= SENT_FILES:
        return batch.join(F.broadcast(landed.withColumnRenamed("_source_file", "__landed")), F.col("_source_file") == F.col("__landed"), "left_anti")
    hot, _ = hot_keys(batch, ["_source_file"])
    return salted_join(batch, landed, ["_source_file"], "left_anti", hot=hot, salt_on=batch.columns)


def ingest(spark: SparkSession, table: LandedTable, *, root: str, month: str, batch_id: str, record_source: str, source: str | None = None) -> StreamingQuery:
    """Appends all files not yet ingested to the staging table and stops. Run again, it appends none."""
    require_batch_id(batch_id)
    source = source or landing_dir(root, month, table)
    refuse_another_months_dir(source, root, month, table)
    rows = file_stream(spark, table, source)
    common = {"record_source": record_source, "batch_id": batch_id, "month": month}
    if table.landing in ("zips", "local"):
        rows = audited_file(rows, **common)
    elif table.landing == "postgres":
        rows = audited_instant(rows, column=table.axis.column, **common)
    else:
        rows = audited(rows, **common)

    def write(batch: DataFrame, _epoch: int) -> None:
        # a file is the unit of delivery: one whose rows are there already, from a run that ended before its
        # checkpoint was written, is left out, so every file lands exactly once
        own = batch.sparkSession
        if table_exists(own, table.staging):
            batch = unlanded(batch, own.table(table.staging).filter(F.col("_snapshot_month") == month))
        append(batch, table.staging, ["_snapshot_month"])

    query = rows.writeStream.option("checkpointLocation", checkpoint_location(root, month, table)).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    if table_exists(spark, table.staging):  # written by the stream's own session
        spark.catalog.refreshTable(table.staging)
    return query


def require_batch_id(batch_id: str) -> str:
    if not isinstance(batch_id, str) or not batch_id.strip():
        raise IngestRefused("a batch needs an id")
    return batch_id
