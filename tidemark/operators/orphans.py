"""References to records that do not exist."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import Hot, salted_join

SEMANTICS = ("simple", "partial", "full")


def null_mask(columns: Sequence[Column]) -> Column:
    """Bit i is set where column i is null."""
    return reduce(lambda a, b: a + b, (F.when(c.isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(columns)))


def find_orphans(refs: DataFrame, target: DataFrame, on: Sequence[str], *, semantics: str = "simple", hot: Hot = (), hot_on: Sequence[str] | None = None, salt_on: Sequence[str]) -> DataFrame:
    """Rows of `refs` whose composite key `on` names no row of `target`.

    References are grouped by null mask and each mask is looked up on its non-null columns, under the declared
    match semantics of the SQL foreign key:
    - simple: a key with any null refers to nothing and is no orphan;
    - full: a key is wholly null (no reference) or must exist wholly; a partly null one is an orphan;
    - partial: the non-null columns must occur together in some target row; wholly null is no reference.

    All masks go through one anti-join: its key is the mask and the columns, null where the mask says so. A target row is
    repeated for each mask that the semantics look up (at most 2^columns - 1), reduced to the mask's non-null columns
    and made distinct. Under `full` no target row stands under a partly null mask, so all its references are orphans.
    Repeated rows of `refs` each come out; an empty target makes every reference an orphan; target rows with a null
    in a column that a mask compares match nothing under it. Other columns of `target` are not read. `hot`: hot keys of
    `hot_on` (by default `on`), as `hot_keys` gives them; `salt_on`: see `salted_join`.
    """
    if semantics not in SEMANTICS:
        raise ValueError(f"semantics must be one of {SEMANTICS}, not {semantics!r}")
    on = list(on)
    mask = null_mask([F.col(c) for c in on])
    everything = (1 << len(on)) - 1
    looked_up = range(everything) if semantics == "partial" else (0,)
    asked = refs.withColumn("__mask", mask).filter(F.col("__mask") == 0 if semantics == "simple" else F.col("__mask") != everything)
    keys = target.select(*on).distinct().withColumn("__mask", F.explode(F.array(*(F.lit(m) for m in looked_up))))
    shown = [F.when(F.col("__mask").bitwiseAND(F.lit(1 << i)) == 0, F.col(c)).alias(c) for i, c in enumerate(on)]
    there = keys.select("__mask", *shown).filter(mask == F.col("__mask")).distinct()
    return salted_join(asked, there, ["__mask", *on], "left_anti", hot=hot, hot_on=hot_on or on, salt_on=salt_on, null_safe=True).drop("__mask")


def latest_at(micros: Column, steps: Sequence[tuple[int, str]]) -> Column:
    """The label of the last step at or before an instant; null before the first.

    `steps`: (epoch microseconds, label) of the few points in time at which the label changes.
    """
    label = F.when(F.lit(False), F.lit(None).cast("string"))
    for at, name in sorted(steps, reverse=True):  # one flat CASE, latest first
        label = label.when(micros >= F.lit(at), F.lit(name))
    return label


def orphan_report(orphans: DataFrame, table: str, role: str, period: str) -> DataFrame:
    """Number of orphan references per table, role and period."""
    return orphans.groupBy(F.lit(table).alias("table_name"), F.col(role), F.col(period)).agg(F.count(F.lit(1)).alias("orphan_references"))
