"""Declarative specs of the dimensional tables and their registry, checked as a whole set."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from types import MappingProxyType

from tidemark.operators.specs import Hub, Satellite

#: Columns that the loaders of versioned dimensions, point-in-time tables and facts write themselves.
WRITTEN = frozenset({"valid_from", "valid_to", "is_current", "load_date", "record_source"})


class StarRefused(ValueError):
    """A set of dimensional tables that doesn't fit together."""


@dataclass(frozen=True)
class Versioned:
    """A dimension of an entity's versions, from the satellite that keeps its changes."""

    name: str
    surrogate: str
    satellite: str


@dataclass(frozen=True)
class Enumerated:
    """A dimension of the values of one column of the fact's source."""

    name: str
    surrogate: str
    column: str


@dataclass(frozen=True)
class Calendar:
    name: str
    surrogate: str


@dataclass(frozen=True)
class PointInTime:
    """Which row of each satellite of a hub is in force at each as-of date."""

    name: str
    hub: str
    satellites: tuple[str, ...]
    as_of: str = "as_of_date"


@dataclass(frozen=True)
class Fact:
    """Events at the grain of `identity`. `keys`: each key column with the dimension it refers to."""

    name: str
    identity: str
    keys: tuple[tuple[str, str], ...]
    measures: tuple[str, ...]


def _clashes(names: Iterable[str]) -> list[str]:
    seen: set[str] = set()
    return [n for n in names if n.casefold() in seen or seen.add(n.casefold())]


def build_star(tables: Iterable, model: Mapping[str, object], others: Iterable[str] = ()) -> Mapping[str, object]:
    """The tables by name, or a refusal that names every fault of the whole set.

    `model`: the historised model they are built from; `others`: names that other layers own. Checked: names of their
    own, whatever the case; satellites and hubs that exist and belong together; enumerated columns drawn once; surrogate
    keys and payload apart from each other and from what the loaders write; as-of columns apart from hash keys; facts
    that reach every dimension but name no other, with columns of distinct names.
    """
    tables, faults = list(tables), []
    owned = {n.casefold() for n in (*others, *model)}
    faults += [f"{t.name} is owned by another layer" for t in tables if t.name.casefold() in owned]
    faults += [f"{n} is the name of two tables" for n in _clashes(t.name for t in tables)]
    drawn = [t.column for t in tables if isinstance(t, Enumerated)]
    faults += [f"two dimensions draw from {c}" for c in _clashes(drawn)]
    dimensions = {t.name: t for t in tables if isinstance(t, Versioned | Enumerated | Calendar)}
    faults += [f"{k} is the surrogate key of two dimensions" for k in _clashes(d.surrogate for d in dimensions.values())]
    for t in tables:
        if isinstance(t, Versioned):
            satellite = model.get(t.satellite)
            if not isinstance(satellite, Satellite):
                faults.append(f"{t.name} reads {t.satellite}, which is no satellite")
                continue
            source = (*model[satellite.parent].key_names, *satellite.payload)
            faults += [f"{t.name}: {c} is both a column of its source and what the loader writes" for c in source if c.casefold() in {*WRITTEN, t.surrogate.casefold()}]
        elif isinstance(t, Enumerated) and t.surrogate.casefold() == t.column.casefold():
            faults.append(f"{t.name}: its surrogate key is its column")
        elif isinstance(t, PointInTime):
            hub = model.get(t.hub)
            if not isinstance(hub, Hub):
                faults.append(f"{t.name} is of {t.hub}, which is no hub")
                continue
            if t.as_of.casefold() == hub.hash_key.casefold():
                faults.append(f"{t.name}: its as-of column is the hub's hash key")
            if not t.satellites or _clashes(t.satellites):
                faults.append(f"{t.name}: no satellites, or one twice")
            faults += [f"{t.name}: {s} is no satellite of {t.hub}" for s in t.satellites if getattr(model.get(s), "parent", None) != t.hub or not isinstance(model[s], Satellite)]
        elif isinstance(t, Fact):
            faults += [f"{t.name}: {c} is named twice" for c in _clashes((t.identity, *(k for k, _ in t.keys), *t.measures, *sorted(WRITTEN - {"valid_from", "valid_to", "is_current"})))]
            reached = {d for _, d in t.keys}
            faults += [f"{t.name} refers to {d}, which is no dimension" for d in sorted(reached - set(dimensions))]
            faults += [f"{t.name} doesn't reach {d}" for d in sorted(set(dimensions) - reached)]
    if faults:
        raise StarRefused("; ".join(faults))
    return MappingProxyType({t.name: t for t in tables})
