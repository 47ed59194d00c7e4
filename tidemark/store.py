"""Table input and output: idempotent appends, whole-table swaps, safe counts. Loads never update a row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.session import cut


class WriteRefused(ValueError):
    """A write that would break an invariant; nothing has been written."""


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def rows_in(spark: SparkSession, name: str) -> int:
    """Rows of a table, 0 where there is none."""
    return spark.table(name).count() if table_exists(spark, name) else 0


def rows_of_batch(spark: SparkSession, name: str, batch_id: str) -> int:
    """Rows a batch has in a table, 0 where there is no table."""
    if not table_exists(spark, name):
        return 0
    rows = spark.table(name)
    if "_batch_id" not in rows.columns:
        raise WriteRefused(f"{name} has no _batch_id")
    return rows.filter(F.col("_batch_id") == batch_id).count()


def new_rows(candidates: DataFrame, held: DataFrame | None, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Candidates whose key `held` doesn't have. With `null_safe` a null equals a null."""
    if held is None:
        return candidates
    there = held.select(*(F.col(k).alias(f"__held_{k}") for k in keys))
    same = reduce(lambda a, b: a & b, ((F.col(k).eqNullSafe(F.col(f"__held_{k}")) if null_safe else F.col(k) == F.col(f"__held_{k}")) for k in keys))
    return candidates.join(there, same, "left_anti")


def append(rows: DataFrame, name: str, partition_by: Sequence[str] = ()) -> int:
    """Appends to a table, making it where there is none; the number of rows, counted as they are written.

    `partition_by`: columns whose values become directories of a new table, so that scans by them are pruned.
    """
    spark = rows.sparkSession
    new = not table_exists(spark, name)
    if not new:
        held = spark.table(name).columns
        if set(held) != set(rows.columns):
            raise WriteRefused(f"{name} has columns {held}, the rows {rows.columns}")
        rows = rows.select(*held)
        partition_by = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    seen = Observation()
    writer = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").format("parquet")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
    return seen.get.get("rows") or 0


def append_new(candidates: DataFrame, name: str, keys: Sequence[str], null_safe: bool = False) -> int:
    """Appends the candidates whose key the table doesn't hold; a second run appends none. One writer at a time."""
    spark = candidates.sparkSession
    held = spark.table(name) if table_exists(spark, name) else None
    return append(new_rows(candidates, held, keys, null_safe), name)


def swap(rows: DataFrame, name: str, verify: Callable[[DataFrame], None] | None = None) -> int:
    """Replaces a table by rows that may come from it: they are written down and verified first, then take its place.

    Zero rows are refused: an empty result is more likely a mistake than a wish. `verify` raises if the rows written
    down aren't what the table may become; the table is untouched then.
    """
    spark = rows.sparkSession
    safe = cut(rows)
    n = safe.count()
    if not n:
        raise WriteRefused(f"refusing to replace {name} by no rows")
    if verify:
        verify(safe)
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition] if table_exists(spark, name) else []
    writer = safe.write.mode("overwrite").format("parquet")
    (writer.partitionBy(*parts) if parts else writer).saveAsTable(name)
    return n


def assert_none(rows: DataFrame, what: str) -> None:
    """Refuses rows that break a constraint; the stand-in for CHECK and NOT NULL, which parquet tables don't enforce."""
    broken = rows.limit(1).count()
    if broken:
        raise WriteRefused(what)
