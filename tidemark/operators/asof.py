"""Attributes as known at event time: interval join of events with validity intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import DAY_US
from tidemark.operators.skew import Hot, counted_keys, hot_among, salted_join
from tidemark.session import cut


def bucket_of(micros: Column, days: int) -> Column:
    """Number of the time bucket of `days` days that an instant lies in."""
    width = F.lit(days * DAY_US)
    return ((micros - F.pmod(micros, width)) / width).cast("int")


def intervals_from_changes(changes: DataFrame, entity: Sequence[str], at: str) -> DataFrame:
    """Half-open intervals `[valid_from, valid_to)` from successive change times; the last one's end is null."""
    w = Window.partitionBy(*entity).orderBy(at)
    return changes.withColumns({"valid_from": F.col(at), "valid_to": F.lead(at).over(w)})


class Reach:
    """What of the versions a set of events can reach: the entities they name, each with the span of its events.

    Found in one pass over the events, by partial aggregation, and written down: one row per entity. It tells the hot
    entities, reduces versions to those of entities with events, and bounds the buckets they are exploded into.
    """

    def __init__(self, events: DataFrame, entity: str, at: str):
        named = events.select(F.col(entity), F.col(at)).filter(F.col(entity).isNotNull() & F.col(at).isNotNull())
        self.entity = entity
        self.spans = cut(counted_keys(named, [entity], {"__first": F.min(at), "__last": F.max(at)}))
        self.hot, _ = hot_among(self.spans, [entity])

    def entities(self) -> DataFrame:
        return self.spans.select(self.entity)


def asof_join(events: DataFrame, versions: DataFrame, entity: str, at: str, *, reach: Reach | None = None, first: int | None = None, last: int | None = None, days: int, hot: Hot = (), salt_on: Sequence[str], how: str = "left") -> DataFrame:
    """Events with the version of their entity that is valid at the event's instant, nothing known later.

    `versions`: (entity, valid_from, valid_to, …), instants in epoch microseconds, half-open, valid_to null if open,
    at most one valid at a time. Intervals are cut to the span of the events and exploded into buckets of `days` days;
    events meet them by an equi-join on entity and bucket, and containment decides. An event at valid_from has that
    version, one at valid_to the next. Events of hot entities are split by salt.

    The span and the hot entities come from `reach`, for each entity by itself, and versions of entities without
    events go before they are exploded. Without it, `first` and `last` must hold every event's instant, and `hot` the
    hot entities. `reach` must be that of these events.

    Events with a null entity or instant, or without a valid version, stay with nulls under `left` and go under
    `inner`; repeated events each come out. A version column that events have too comes out as `version_` and its
    name. An empty versions table leaves every event without one.
    """
    others = [c for c in versions.columns if c != entity]
    own = versions.select(entity, *(F.col(c).alias(f"__v_{c}") for c in others))
    if reach is None:
        own = own.withColumns({"__first": F.lit(first), "__last": F.lit(last)})
    else:
        own, hot = own.join(reach.spans.drop("__n"), entity), reach.hot
    start, stop = F.col("__v_valid_from"), F.col("__v_valid_to")
    end = F.least(F.coalesce(stop - 1, F.col("__last")), F.col("__last"))
    begin = F.greatest(start, F.col("__first"))
    cut_to_span = own.filter((begin <= end) & F.col(entity).isNotNull()).withColumn("__bucket", F.explode(F.sequence(bucket_of(begin, days), bucket_of(end, days)))).drop("__first", "__last")
    placed = events.withColumn("__bucket", bucket_of(F.col(at), days))
    within = (F.col(at) >= start) & (stop.isNull() | (F.col(at) < stop))
    joined = salted_join(placed, cut_to_span, [entity, "__bucket"], how, hot=hot, hot_on=[entity], salt_on=salt_on, condition=within)
    named = [F.col(f"__v_{c}").alias(f"version_{c}" if c in events.columns else c) for c in others]
    return joined.select(*events.columns, *named)
