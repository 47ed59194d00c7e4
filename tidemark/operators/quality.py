"""Ordered data-quality rules: first match wins, a row without a match is good."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import CASE_DIVERGENT_CLASS

REASON = "_dq_reject_reason"
RESCUED = "_rescued_data"
RESCUED_REASON = "rescued_data_present"


@dataclass(frozen=True)
class Rule:
    """A reason, the predicate that is true of rows to reject, and the columns it reads."""

    reason: str
    predicate: Callable[[], Column]
    reads: tuple[str, ...]


def blank(c: str) -> Rule:
    return Rule(f"null_or_empty_{c}", lambda: F.col(c).isNull() | (F.trim(F.col(c)) == ""), (c,))


def replacement_character(columns: Sequence[str]) -> Rule:
    return Rule("encoding_replacement_char", lambda: reduce(lambda a, b: a | b, (F.coalesce(F.contains(F.col(c), F.lit("�")), F.lit(False)) for c in columns)), tuple(columns))


def case_divergence(columns: Sequence[str]) -> Rule:
    return Rule("unhashable_case_divergence", lambda: reduce(lambda a, b: a | b, (F.coalesce(F.col(c).rlike(CASE_DIVERGENT_CLASS), F.lit(False)) for c in columns)), tuple(columns))


def wrong_length(c: str, width: int = 8) -> Rule:
    return Rule(f"bad_{c}_length", lambda: F.length(F.trim(F.col(c))) != width, (c,))


def wrong_date(c: str) -> Rule:
    return Rule(f"bad_{c}_shape", lambda: ~F.col(c).rlike(r"\A\d{4}-\d\d-\d\d\z") | F.try_to_date(F.col(c), "yyyy-MM-dd").isNull(), (c,))


def wrong_decimal(c: str, kind: str) -> Rule:
    return Rule(f"unparseable_{c}", lambda: F.col(c).try_cast(kind).isNull(), (c,))


def wrong_publication(c: str) -> Rule:
    return Rule(f"unparseable_{c}", lambda: ~F.col(c).rlike(r"\A\d{4}-\d\d-\d\d \d\d:\d\d:\d\d(\.\d{1,6})?\z") | F.col(c).try_cast("timestamp").isNull(), (c,))


def wrong_full_cnpj(c: str = "cnpj") -> Rule:
    return Rule("bad_cnpj_shape", lambda: ~F.col(c).rlike(r"\A[0-9]{14}\z"), (c,))


def wrong_snapshot_instant(c: str = "_snapshot_at") -> Rule:
    return Rule("bad_snapshot_at_shape", lambda: ~F.col(c).rlike(r"\A\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}Z\z") | F.col(c).try_cast("timestamp").isNull(), (c,))


def unprovable_ref_date() -> Rule:
    return Rule("unprovable_snapshot_ref_date", lambda: F.col("_snapshot_ref_date").isNull(), ("_snapshot_ref_date",))


def rescued(rows: DataFrame) -> Column:
    """Whether a row holds rescued data; never where the column is absent."""
    return F.col(RESCUED).isNotNull() if RESCUED in rows.columns else F.lit(False)


def skipped(rows: DataFrame, rules: Iterable[Rule]) -> list[tuple[str, list[str]]]:
    """Rules that can't be evaluated and the columns they miss; a gate announces them."""
    missing = [(r.reason, [c for c in r.reads if c not in rows.columns]) for r in rules]
    return [(reason, columns) for reason, columns in missing if columns]


def _usable(rows: DataFrame, rules: Iterable[Rule]) -> list[Rule]:
    return [r for r in rules if set(r.reads) <= set(rows.columns)]


def classify(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds the reason to reject a row: rescued data above all, then the first rule that matches, else null.

    A predicate that is null does not match; rules whose columns are missing are left out, see `skipped`.
    """
    reason = F.when(rescued(rows), F.lit(RESCUED_REASON))
    for rule in _usable(rows, rules):
        reason = reason.when(rule.predicate(), F.lit(rule.reason))
    return rows.withColumn(REASON, reason.otherwise(F.lit(None).cast("string")))


def split(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the reason, bad rows with it."""
    return classified.filter(F.col(REASON).isNull()).drop(REASON), classified.filter(F.col(REASON).isNotNull())


def tally(classified: DataFrame) -> tuple[int, int]:
    """Good and bad rows, in one pass."""
    n = {r["bad"]: r["n"] for r in classified.groupBy(F.col(REASON).isNotNull().alias("bad")).agg(F.count(F.lit(1)).alias("n")).collect()}
    return n.get(False, 0), n.get(True, 0)


def overlap_by_rule(rows: DataFrame, rules: Sequence[Rule], source: str, by: str = "_batch_id") -> DataFrame:
    """`overlap` as one row for each batch and reason: (source, batch, rows, reason, hits); all rules in one pass."""
    wide = overlap(rows, rules, by=[by])
    reasons = [c for c in wide.columns if c not in (by, "rows")]
    return wide.select(F.lit(source).alias("source"), by, "rows", F.inline(F.array(*(F.struct(F.lit(c).alias("reason"), F.col(c).alias("hits")) for c in reasons))))


def overlap(rows: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """Every rule, not just the first, in one pass: rows, hits per rule, rows with two or more, and with rescued data.

    Columns: rows, rescued_rows, then one per rule under its reason, rows_with_two_or_more, rescued_with_a_rule.
    """
    usable = _usable(rows, rules)
    hit = {r.reason: F.when(r.predicate(), 1).otherwise(0) for r in usable}
    many = reduce(lambda a, b: a + b, hit.values(), F.lit(0))
    aggregates = [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.when(rescued(rows), 1).otherwise(0)), F.lit(0)).alias("rescued_rows")]
    aggregates += [F.coalesce(F.sum(h), F.lit(0)).alias(reason) for reason, h in hit.items()]
    aggregates += [F.coalesce(F.sum(F.when(many >= 2, 1).otherwise(0)), F.lit(0)).alias("rows_with_two_or_more"), F.coalesce(F.sum(F.when(rescued(rows) & (many >= 1), 1).otherwise(0)), F.lit(0)).alias("rescued_with_a_rule")]
    return (rows.groupBy(*by) if by else rows).agg(*aggregates)
