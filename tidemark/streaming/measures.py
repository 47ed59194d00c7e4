"""Measures of a delivered stream: lateness, window crossings, redeliveries, undeclared fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import hot_keys, salted_join


def late_arrivals(rows: DataFrame, event: str, emitted: str, width: int = 3_600_000_000) -> DataFrame:
    """Rows whose event lies before the greatest event among rows emitted strictly earlier.

    Rows are first reduced to one per emission instant. The running maximum is then taken within parts of `width`
    units of emission time and across the parts' maxima, so no task sorts more than a part's instants, and rows are
    compared with the limit of their instant; instants that many rows share are split by salt.
    """
    instants = rows.groupBy(F.col(emitted).alias("__m")).agg(F.max(event).alias("__e")).withColumn("__part", (F.col("__m") - F.pmod("__m", F.lit(width))) / F.lit(width))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = instants.groupBy("__part").agg(F.max("__e").alias("__most")).withColumn("__before", F.max("__most").over(before)).select("__part", "__before")
    inside = Window.partitionBy("__part").orderBy("__m").rowsBetween(Window.unboundedPreceding, -1)
    limits = instants.withColumn("__inside", F.max("__e").over(inside)).join(earlier, "__part").select(F.col("__m").alias(emitted), F.greatest("__inside", "__before").alias("__limit"))
    hot, _ = hot_keys(rows, [emitted])
    return salted_join(rows, limits, [emitted], "inner", hot=hot, salt_on=rows.columns, condition=F.col(event) < F.col("__limit")).drop("__limit")


def crosses_window(event: Column, emitted: Column, width: int) -> Column:
    """Whether a row is emitted in a later tumbling window than its event's."""
    return F.floor(emitted / F.lit(width)) > F.floor(event / F.lit(width))


def redelivered(rows: DataFrame, identity: str) -> DataFrame:
    """Identities delivered more than once with their number of rows."""
    return rows.filter(F.col(identity).isNotNull()).groupBy(identity).agg(F.count(F.lit(1)).alias("deliveries")).filter(F.col("deliveries") > 1)


def duplicate_rows(rows: DataFrame, identity: str) -> DataFrame:
    """One row: rows, identities, and rows beyond the first of each."""
    counted = rows.groupBy(identity).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("identities"), (F.sum("n") - F.count(F.lit(1))).alias("duplicates"))


def null_drop(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: distinct tuples, those that count_distinct sees, which leaves out tuples with a null, and the difference."""
    distinct = rows.select(*columns).distinct()
    whole = distinct.filter(F.lit(True))
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    return whole.agg(F.count(F.lit(1)).alias("tuples"), F.count(F.when(complete, 1)).alias("complete_tuples"), F.count(F.when(~complete, 1)).alias("dropped_tuples"))


def undeclared_keys(lines: DataFrame, column: str, declared: Sequence[str]) -> DataFrame:
    """Keys of JSON objects that are not declared, with the number of rows that hold them."""
    surplus = F.array_except(F.json_object_keys(F.col(column)), F.array(*(F.lit(c) for c in declared)))
    return lines.select(F.explode(surplus).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("rows"))


def watermarked_dedup(stream: DataFrame, identity: str, event: str, delay: str = "1 hour") -> DataFrame:
    """A stream with one row per identity, state bounded by a watermark on event time."""
    return stream.withWatermark(event, delay).dropDuplicatesWithinWatermark([identity])
