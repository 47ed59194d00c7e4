"""What changed between full snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def consecutive(periods: Sequence[str]) -> dict[str, str]:
    """Each delivered period with the next delivered one."""
    ordered = sorted(set(periods))
    return dict(zip(ordered, ordered[1:], strict=False))


def snapshot_changes(rows: DataFrame, key: Column, period: Column, content: Sequence[Column], recency: Column, periods: Sequence[str]) -> DataFrame:
    """Records added, removed or changed between each snapshot and the next: (key, period, change_kind).

    All pairs of consecutive snapshots are compared at once: a row counts as the new side of its own period and as
    the old side of the following one. Each side is reduced to a row hash, of several rows of a key in a snapshot
    the one of the greatest `recency` (ties: the greater hash), and the pair is classified, in a single aggregation
    shuffle by key and period. Partial aggregation keeps a key that holds many of the rows at one row per task.

    `periods`: the delivered snapshots; it grows by one per delivery and is all this brings to the driver. Rows
    with a null key or period are in no snapshot. `content` must hold no nulls (a null would not change the hash),
    see `functions.identity`. The first snapshot has no changes; fewer than two snapshots give no rows.
    """
    follows = consecutive(periods)
    if not follows:
        return rows.select(key.alias("key"), F.lit("").alias("period"), F.lit("").alias("change_kind")).limit(0)
    following = F.create_map(*(F.lit(x) for pair in follows.items() for x in pair))
    first = min(follows)
    mine = rows.select(key.alias("key"), period.alias("own"), F.struct(recency.alias("at"), F.xxhash64(*content).alias("hash")).alias("state"))
    sides = F.array(F.struct(F.when(F.col("own") != first, F.col("own")).alias("period"), F.lit(True).alias("new")), F.struct(F.element_at(following, F.col("own")).alias("period"), F.lit(False).alias("new")))
    tagged = mine.filter(F.col("key").isNotNull() & F.col("own").isNotNull()).select("key", "state", F.inline(sides)).filter(F.col("period").isNotNull())
    both = tagged.groupBy("key", "period").agg(F.max(F.when(F.col("new"), F.col("state"))).alias("after"), F.max(F.when(~F.col("new"), F.col("state"))).alias("before"))
    kind = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").when(F.col("before.hash") != F.col("after.hash"), "changed")
    return both.select("key", "period", kind.alias("change_kind")).filter(F.col("change_kind").isNotNull())


def missed_by_watermark(changes: DataFrame, rows: DataFrame, key: Column, watermark: Column, since: Column, period: Column) -> DataFrame:
    """Changes (as of `snapshot_changes`) that an extract of each period's rows with `watermark > since` would not deliver.

    Such an extract never shows removals, nor updates that left the watermark as it was or were committed behind it.
    Keys are compared as they are; a null watermark is never delivered.
    """
    delivered = rows.filter(watermark > since).select(key.alias("__key"), period.alias("__period")).distinct()
    return changes.join(delivered, (F.col("key") == F.col("__key")) & (F.col("period") == F.col("__period")), "left_anti")
