"""The gate and the promotion of a batch: all or nothing, decided by counts, idempotent."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.operators.quality import Rule, classify, split, tally
from tidemark.store import WriteRefused, append, assert_none, rows_of_batch, table_exists

APPENDED, ALREADY, ALREADY_GONE, NOTHING = "appended", "already_promoted", "already_promoted_staging_gone", "nothing_ingested"


class PromoteRefused(WriteRefused):
    """A promotion whose counts don't add up."""


@dataclass(frozen=True)
class Promotion:
    outcome: str
    rows: int


def plan_promotion(bronze: int, promotable: int, staged: int, in_flow: bool) -> Promotion:
    """What to do, from the batch's rows in bronze, those of staging that pass, and all of staging."""
    if bronze > 0:
        if bronze == promotable:
            return Promotion(ALREADY, 0)
        if staged == 0:
            return Promotion(ALREADY_GONE, 0)
        raise PromoteRefused(f"bronze holds {bronze} rows of the batch, {promotable} are promotable: promoted in part or twice")
    if staged == 0:
        if in_flow:
            return Promotion(NOTHING, 0)
        raise PromoteRefused("staging holds nothing of the batch")
    if promotable == 0:
        raise PromoteRefused(f"all {staged} staged rows are rejected")
    return Promotion(APPENDED, promotable)


def gate(spark: SparkSession, staging: str, quarantine: str, batch_id: str, rules: Sequence[Rule]) -> int:
    """Number of rejected rows of a batch; they are held in quarantine once, however often this runs."""
    classified = classify(spark.table(staging).filter(F.col("_batch_id") == batch_id), rules)
    bad = tally(classified)[1]
    held = rows_of_batch(spark, quarantine, batch_id)
    if held not in (0, bad):
        raise WriteRefused(f"{quarantine} holds {held} of {bad} rejected rows")
    if bad and not held:
        append(split(classified)[1], quarantine)
    return bad


def promote_batch(spark: SparkSession, batch_id: str, staging: str, bronze: str, rules: Sequence[Rule], *, in_flow: bool, promises: Sequence[str] = ()) -> Promotion:
    """Appends the passing rows of a batch to bronze, by `plan_promotion`, and asserts what they promise."""
    if not batch_id or not batch_id.strip():
        raise PromoteRefused("a batch needs an id")
    classified = None
    promotable = staged = 0
    if table_exists(spark, staging):
        classified = classify(spark.table(staging).filter(F.col("_batch_id") == batch_id), rules)
        promotable, bad = tally(classified)
        staged = promotable + bad
    plan = plan_promotion(rows_of_batch(spark, bronze, batch_id), promotable, staged, in_flow)
    if plan.outcome == APPENDED:
        good = split(classified)[0]
        for promise in promises:
            assert_none(good.filter(f"({promise}) IS NOT TRUE"), f"rows of {batch_id} break {promise}")
        append(good, bronze, [c for c in ("_snapshot_month",) if c in good.columns])
    return plan


def run_batch(spark: SparkSession, staging: str, bronze: str, quarantine: str, batch_id: str, rules: Sequence[Rule], promises: Sequence[str] = ()) -> Promotion:
    """Gate, then promotion only if nothing was rejected; else the batch waits for triage."""
    bad = gate(spark, staging, quarantine, batch_id, rules)
    if bad:
        raise PromoteRefused(f"{bad} rows rejected; the batch waits in {staging}")
    return promote_batch(spark, batch_id, staging, bronze, rules, in_flow=True, promises=promises)
