"""The historised model: hubs, links, satellites with change capture, the observation ledger, effectivity.

Transformations are functions from DataFrames to DataFrames; the loaders around them only append what is new.
Groups are reduced by partial aggregation before anything is sorted, and every key's rows are bounded by the number
of its snapshots.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import hash_key, refuse_non_strings, zero_padded
from tidemark.operators.specs import Effectivity, Hub, Link, LinkEnd, Reference, Satellite
from tidemark.sources.readers import lookup_type
from tidemark.store import append, append_new, new_rows, rows_in, table_exists

#: States of a key in a snapshot. (fixed values)
OBSERVED, SIBLINGS, REJECTED, BEFORE, AFTER = "observed", "observed_with_rejected_siblings", "rejected_by_our_gate", "absent_before_first_observation", "absent_after_observation"


class LoadRefused(ValueError):
    """A load whose inputs don't fit; nothing has been written."""


# --- keys ---------------------------------------------------------------------------------------------------------


def hub_components(hub: Hub, sources: Sequence[Column] | None = None) -> list[Column]:
    """The hub's key columns, padded; `sources` in their place where they are derived."""
    given = sources or [F.col(k.name) for k in hub.keys]
    return [zero_padded(c, k.width) if k.width else c for k, c in zip(hub.keys, given, strict=True)]


def end_components(end: LinkEnd, hub: Hub) -> list[Column]:
    return hub_components(hub, [F.substring(F.col(p.column), 1, p.width) for p in end.key_from] or None)


def link_key(link: Link, hubs: dict[str, Hub]) -> Column:
    """Hash key of a link: its identifying ends' components in order, then its dependent columns."""
    parts = [c for e in link.ends if e.identifying for c in end_components(e, hubs[e.hub])]
    return hash_key(*parts, *(F.col(c) for c in link.dependent))


def partner_root(kind: Column, number: Column) -> Column:
    """Company root of a partner: the first eight of fourteen characters where the partner is a company, else null."""
    return F.when((kind == "1") & (F.length(number) == 14), F.substring(number, 1, 8))


def earliest(rows: DataFrame, keys: Sequence[str], axis: str, *columns: str) -> DataFrame:
    """Per key the `columns` of the row with the least (axis, columns), nulls first; by partial aggregation."""
    chosen = F.min(F.struct(axis, *columns)).alias("__first")
    return rows.groupBy(*keys).agg(chosen).select(*keys, *(F.col(f"__first.{c}").alias(c) for c in columns))


# --- hubs and links -----------------------------------------------------------------------------------------------


def hub_candidates(source: DataFrame, hub: Hub, axis: str = "_snapshot_month", record_source: str = "_record_source") -> DataFrame:
    """One row per key: hash key, padded key columns, the source that first showed it."""
    refuse_non_strings(source, hub.key_names)
    padded = hub_components(hub)
    keyed = source.select(hash_key(*padded).alias(hub.hash_key), *(c.alias(k.name) for k, c in zip(hub.keys, padded, strict=True)), F.col(axis).alias("__axis"), F.col(record_source).alias("record_source"))
    return earliest(keyed, [hub.hash_key, *hub.key_names], "__axis", "record_source")


def link_candidates(source: DataFrame, link: Link, hubs: dict[str, Hub], axis: str = "_snapshot_month", record_source: str = "_record_source") -> DataFrame:
    """One row per relationship: link key, a reference to the hub of each end, dependent columns, first source."""
    refuse_other_hubs(link, hubs)
    references = [hash_key(*end_components(e, hubs[e.hub])).alias(Link.reference(e)) for e in link.ends]
    keyed = source.select(link_key(link, hubs).alias(link.hash_key), *references, *link.dependent, F.col(axis).alias("__axis"), F.col(record_source).alias("record_source"))
    return earliest(keyed, [link.hash_key, *(Link.reference(e) for e in link.ends), *link.dependent], "__axis", "record_source")


def partner_link_candidates(source: DataFrame, link: Link, hub: Hub, kind: str, number: str, axis: str = "_snapshot_month", record_source: str = "_record_source") -> DataFrame:
    """A link of a hub to itself: the second end is the partner's company root, null where the partner is none."""
    company, partner = link.ends
    root = partner_root(F.col(kind), F.col(number))
    reference = F.when(root.isNotNull(), hash_key(*hub_components(hub, [root])))
    keyed = source.select(link_key(link, {hub.name: hub}).alias(link.hash_key), hash_key(*end_components(company, hub)).alias(Link.reference(company)), reference.alias(Link.reference(partner)), *link.dependent, F.col(axis).alias("__axis"), F.col(record_source).alias("record_source"))
    return earliest(keyed, [link.hash_key, Link.reference(company), Link.reference(partner), *link.dependent], "__axis", "record_source")


def refuse_other_hubs(link: Link, hubs: dict[str, Hub]) -> None:
    if {e.hub for e in link.ends} != set(hubs) or any(name != h.name for name, h in hubs.items()):
        raise LoadRefused(f"{link.name} joins {[e.hub for e in link.ends]}, not {sorted(hubs)}")


def refuse_empty_hubs(spark: SparkSession, tables: Sequence[str]) -> None:
    empty = [t for t in tables if not table_exists(spark, t) or spark.table(t).isEmpty()]
    if empty:
        raise LoadRefused(f"hubs not loaded: {', '.join(empty)}")


# --- satellites ---------------------------------------------------------------------------------------------------


def satellite_candidates(source: DataFrame, satellite: Satellite, hub: Hub, applied: str = "_snapshot_ref_date", record_source: str = "_record_source") -> DataFrame:
    """One row per key and applied date: (hash key, applied_date, hash_diff, payload…, record_source), the least of several."""
    if satellite.parent != hub.name:
        raise LoadRefused(f"{satellite.name} hangs off {satellite.parent}, not {hub.name}")
    refuse_non_strings(source, [*hub.key_names, *satellite.payload])
    stated = source.select(hash_key(*hub_components(hub)).alias(hub.hash_key), F.col(applied).alias("applied_date"), hash_key(*(F.col(c) for c in satellite.payload)).alias("hash_diff"), *satellite.payload, F.col(record_source).alias("record_source"))
    rest = ["hash_diff", *satellite.payload, "record_source"]
    chosen = stated.groupBy(hub.hash_key, "applied_date").agg(F.min(F.struct(*rest)).alias("__c"))
    return chosen.select(hub.hash_key, "applied_date", *(F.col(f"__c.{c}").alias(c) for c in rest))


def changed_rows(candidates: DataFrame, existing: DataFrame | None, key: str, change: str = "hash_diff", applied: str = "applied_date") -> DataFrame:
    """Candidates whose value of `change` differs from the one before in applied order, or that are the key's first.

    `existing` rows take part in the order but never come out; candidates at a date they hold are dropped. One
    window over the key's snapshots, no join back to the payload.
    """
    new = new_rows(candidates, existing, [key, applied]).withColumn("__new", F.lit(True))
    both = new if existing is None else new.unionByName(existing.select(key, applied, change).withColumn("__new", F.lit(False)), allowMissingColumns=True)
    before = F.lag(change).over(Window.partitionBy(key).orderBy(applied))
    return both.withColumn("__before", before).filter(F.col("__new") & (F.col("__before").isNull() | (F.col("__before") != F.col(change)))).drop("__new", "__before")


# --- presence and absence -----------------------------------------------------------------------------------------


def observation_ledger(bronze: DataFrame, quarantine: DataFrame, keys: Sequence[str], axis: str = "_snapshot_month", window: Sequence[str] | None = None) -> DataFrame:
    """One row per key and snapshot with its state: what the source showed, what our gate rejected, what is absent.

    `window`: the snapshots to report, each of which must exist on either side; None means all. A null key component
    equals itself. The grid of absent snapshots comes from exploding the snapshots a key lacks, so observed rows are
    shuffled once, by key, after partial aggregation; the list of snapshots is small.
    """
    window = list(window) if window is not None else None
    side = lambda rows, seen: (rows.filter(F.col(axis).isin(window)) if window else rows).select(*keys, F.col(axis).alias("axis"), F.lit(seen).alias("in_bronze"), F.lit(not seen).alias("in_quarantine"))
    seen = side(bronze, True).unionByName(side(quarantine, False)).filter(F.col("axis").isNotNull()).groupBy(*keys, "axis").agg(F.max("in_bronze").alias("in_bronze"), F.max("in_quarantine").alias("in_quarantine"))
    held = sorted(r[0] for r in bronze.select(axis).unionByName(quarantine.select(axis)).distinct().collect() if r[0] is not None)
    missing = sorted(set(window or ()) - set(held))
    if missing:
        raise LoadRefused(f"snapshots on neither side: {missing}")
    snapshots = F.array(*(F.lit(s) for s in (sorted(window) if window else held)))
    per_key = seen.groupBy(*keys).agg(F.min("axis").alias("__first"), F.map_from_entries(F.collect_list(F.struct("axis", F.struct("in_bronze", "in_quarantine")))).alias("__seen"))
    grid = per_key.select(*keys, "__first", "__seen", F.explode(snapshots).alias(axis))
    at = F.try_element_at("__seen", F.col(axis))
    b, q = F.coalesce(at["in_bronze"], F.lit(False)), F.coalesce(at["in_quarantine"], F.lit(False))
    state = F.when(b & q, SIBLINGS).when(b, OBSERVED).when(q, REJECTED).when(F.col(axis) < F.col("__first"), BEFORE).otherwise(AFTER)
    return grid.select(*keys, axis, b.alias("in_bronze"), q.alias("in_quarantine"), state.alias("state"))


def effectivity_statements(bronze: DataFrame, quarantine: DataFrame, key: Column, key_name: str, grain: Sequence[str], entry: str, *, axis: str = "_snapshot_month", ref_date: str = "_snapshot_ref_date", record_source: str = "_record_source", window: Sequence[str] | None = None) -> DataFrame:
    """What the snapshots state about relationships: active where observed, closed where absent after observation.

    Closing rows carry on the entry, the source and the date of the last observation. Only absence closes: what our
    own gate rejected stays open. Columns: key, applied_date, is_active, entry, last_observed_on, closed_by,
    record_source. A window of one snapshot can close nothing and is refused.
    """
    if window is not None and len(window) < 2:
        raise LoadRefused("one snapshot can't close anything")
    inside = bronze.filter(F.col(axis).isin(list(window))) if window else bronze
    observed = inside.select(key.alias(key_name), F.col(ref_date).alias("applied_date"), F.struct(F.col(entry).alias(entry), F.col(record_source).alias("record_source")).alias("said"))
    observed = observed.groupBy(key_name, "applied_date").agg(F.min("said").alias("said")).withColumn("is_active", F.lit(True))
    dates = bronze.select(axis, ref_date).unionByName(quarantine.select(axis, ref_date)).groupBy(axis).agg(F.min(ref_date).alias("applied_date"))
    absent = observation_ledger(bronze, quarantine, grain, axis, window).filter(F.col("state") == AFTER)
    closed = absent.select(key.alias(key_name), axis).distinct().join(F.broadcast(dates), axis).select(key_name, "applied_date", F.lit(None).cast(observed.schema["said"].dataType).alias("said"), F.lit(False).alias("is_active"))
    so_far = Window.partitionBy(key_name).orderBy("applied_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    active = F.col("is_active")
    carried = F.last(F.when(active, F.struct(F.col("applied_date").alias("on"), "said")), ignorenulls=True).over(so_far)
    both = observed.unionByName(closed).withColumn("__c", carried)
    return both.select(key_name, "applied_date", "is_active", F.col(f"__c.said.{entry}").alias(entry), F.when(~active, F.col("__c.on")).alias("last_observed_on"), F.when(~active, F.lit(AFTER)).alias("closed_by"), F.col("__c.said.record_source").alias("record_source"))


def effectivity_rows(statements: DataFrame, existing: DataFrame | None, key: str) -> DataFrame:
    """Statements at which a relationship opens, closes or opens again."""
    return changed_rows(statements, existing, key, change="is_active")


# --- reference ----------------------------------------------------------------------------------------------------


def reference_candidates(source: DataFrame, reference: Reference, axis: str = "_snapshot_month", record_source: str = "_record_source") -> DataFrame:
    """One row per code of this kind of lookup file: its earliest description and source."""
    mine = source.filter(lookup_type(F.col("_source_file")) == reference.lookup_type).select(F.col(reference.key), F.col(reference.payload), F.col(axis).alias("__axis"), F.col(record_source).alias("record_source"))
    return earliest(mine, [reference.key], "__axis", "record_source", reference.payload)


# --- loaders ------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Loaded:
    """What a load did."""

    table: str
    appended: int
    held: int
    notes: dict


def _done(spark: SparkSession, table: str, appended: int, **notes) -> Loaded:
    return Loaded(table, appended, rows_in(spark, table), notes)


def load_hub(source: DataFrame, hub: Hub, table: str, load_date: Column, axis: str = "_snapshot_month") -> Loaded:
    """Appends keys the hub doesn't hold."""
    rows = hub_candidates(source, hub, axis).select(hub.hash_key, *hub.key_names, load_date.alias("load_date"), "record_source")
    return _done(source.sparkSession, table, append_new(rows, table, [hub.hash_key]))


def load_link(source: DataFrame, link: Link, hubs: dict[str, Hub], hub_tables: Sequence[str], table: str, load_date: Column, axis: str = "_snapshot_month") -> Loaded:
    """Appends relationships the link doesn't hold; its hubs must be loaded."""
    refuse_empty_hubs(source.sparkSession, hub_tables)
    rows = link_candidates(source, link, hubs, axis).withColumn("load_date", load_date)
    return _done(source.sparkSession, table, append_new(rows, table, [link.hash_key]))


def load_partner_link(source: DataFrame, link: Link, hub: Hub, hub_table: str, table: str, load_date: Column, kind: str = "identificador_socio", number: str = "cpf_cnpj_socio") -> Loaded:
    """Appends partnerships; notes how many delivered rows fell together."""
    refuse_empty_hubs(source.sparkSession, [hub_table])
    rows = partner_link_candidates(source, link, hub, kind, number).withColumn("load_date", load_date)
    grain = source.select(*hub.key_names, *link.dependent)
    return _done(source.sparkSession, table, append_new(rows, table, [link.hash_key]), collapsed=grain.count() - grain.distinct().count())


def refuse_absent_snapshots(source: DataFrame, months: Sequence[str] | None, axis: str = "_snapshot_month") -> None:
    """Refuses a window of snapshots of which the source holds no row: such a load would do nothing and not say so."""
    if months is not None:
        held = {r[0] for r in source.filter(F.col(axis).isin(list(months))).select(axis).distinct().collect()}  # at most the months asked for
        missing = sorted(set(months) - held)
        if missing or not months:
            raise LoadRefused(f"snapshots not in the source: {missing or 'none asked for'}")


def satellite_diagnostics(candidates: DataFrame, existing: DataFrame | None, hub_key: str) -> dict[str, int]:
    """What becomes of the candidates of a load, in one pass over the merged order.

    candidates; keys; held: stated for a date the satellite has; unchanged: the same as before; behind: dated before
    rows of the key that the satellite holds.
    """
    own = candidates.select(hub_key, "applied_date", "hash_diff", F.lit(True).alias("__new"))
    both = own if existing is None else own.unionByName(existing.select(hub_key, "applied_date", "hash_diff").withColumn("__new", F.lit(False)))
    dated = both.groupBy(hub_key, "applied_date").agg(F.max("__new").alias("new"), F.max(~F.col("__new")).alias("old"), F.coalesce(F.max(F.when(~F.col("__new"), F.col("hash_diff"))), F.max("hash_diff")).alias("state"))
    order = Window.partitionBy(hub_key).orderBy("applied_date")
    marked = dated.withColumns({"__before": F.lag("state").over(order), "__newest": F.max(F.when(F.col("old"), F.col("applied_date"))).over(Window.partitionBy(hub_key))})
    fresh = F.col("new") & ~F.col("old")
    counts = {
        "candidates": F.col("new"), "held": F.col("new") & F.col("old"), "unchanged": fresh & (F.col("__before") == F.col("state")), "behind": fresh & (F.col("applied_date") < F.col("__newest")),
    }
    r = marked.agg(*(F.count(F.when(c, 1)).alias(n) for n, c in counts.items()), F.count_distinct(F.when(F.col("new"), F.col(hub_key))).alias("keys")).first()
    return r.asDict()


def load_satellite(source: DataFrame, satellite: Satellite, hub: Hub, table: str, load_date: Column, months: Sequence[str] | None = None, axis: str = "_snapshot_month", diagnostics: bool = False) -> Loaded:
    """Appends changes of a hub's attributes against what the satellite holds.

    `months`: the snapshots to load, each of which the source must hold; none is all. With `diagnostics` the notes say
    what became of the candidates, see `satellite_diagnostics`.
    """
    spark = source.sparkSession
    refuse_absent_snapshots(source, months, axis)
    if months is not None:
        source = source.filter(F.col(axis).isin(list(months)))
    existing = spark.table(table) if table_exists(spark, table) else None
    candidates = satellite_candidates(source, satellite, hub)
    notes = satellite_diagnostics(candidates, existing, hub.hash_key) if diagnostics else {}
    rows = changed_rows(candidates, existing, hub.hash_key)
    rows = rows.select(hub.hash_key, load_date.alias("load_date"), "applied_date", "record_source", "hash_diff", *satellite.payload)
    return _done(spark, table, append(rows, table), **notes)


def load_effectivity(bronze: DataFrame, quarantine: DataFrame, spec: Effectivity, link: Link, hubs: dict[str, Hub], grain: Sequence[str], table: str, load_date: Column, window: Sequence[str] | None = None, axis: str = "_snapshot_month") -> Loaded:
    """Appends openings and closings of a link's relationships. `grain` must be the link's identity."""
    if spec.parent != link.name:
        raise LoadRefused(f"{spec.name} hangs off {spec.parent}, not {link.name}")
    expected = [p.column for e in link.ends if e.identifying for p in e.key_from] + [k.name for e in link.ends if e.identifying and not e.key_from for k in hubs[e.hub].keys] + list(link.dependent)
    if sorted(expected) != sorted(grain):
        raise LoadRefused(f"the ledger is kept at {sorted(grain)}, {link.name} is identified by {sorted(expected)}")
    spark = bronze.sparkSession
    existing = spark.table(table) if table_exists(spark, table) else None
    said = effectivity_statements(bronze, quarantine, link_key(link, hubs), link.hash_key, grain, spec.entry, axis=axis, window=window)
    rows = effectivity_rows(said, existing, link.hash_key).withColumn("load_date", load_date)
    return _done(spark, table, append(rows, table))


def load_reference(source: DataFrame, reference: Reference, table: str, load_date: Column) -> Loaded:
    """Appends codes the table doesn't hold; descriptions are not historised."""
    rows = reference_candidates(source, reference).withColumn("load_date", load_date)
    return _done(source.sparkSession, table, append_new(rows, table, [reference.key]))
