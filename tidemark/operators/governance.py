"""Masks, grants, column classes and the revision guard."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Personal columns by contract, and what a reader without the right sees. (fixed values)
CLASSIFIED: Mapping[str, tuple[str, ...]] = {"socios": ("nome_socio_razao_social", "nome_do_representante")}
HIDDEN = "***"


class GovernanceRefused(ValueError):
    """A governed object that isn't as declared."""


def mask_function(spark: SparkSession, name: str, members: str, group: str) -> str:
    """Makes a SQL function that shows its argument to members of a group only, and fails closed.

    `members`: a table of (user, member_group) read by the session's user; no user is a member by default. Returns
    the function's body, see `assert_predicate`.
    """
    body = f"CASE WHEN exists(SELECT 1 FROM {members} m WHERE m.user = current_user() AND m.member_group = '{group}') THEN value ELSE '{HIDDEN}' END"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING) RETURNS STRING RETURN {body}")
    return body


def masked(rows: DataFrame, columns: Sequence[str], shown: bool) -> DataFrame:
    """Rows with the columns hidden unless `shown`; null stays null."""
    if shown:
        return rows
    missing = [c for c in columns if c not in rows.columns]
    if missing:
        raise GovernanceRefused(f"classified columns missing: {missing}")
    return rows.withColumns({c: F.when(F.col(c).isNotNull(), F.lit(HIDDEN)) for c in columns})


def masked_view(spark: SparkSession, table: str, view: str, columns: Sequence[str], function: str) -> None:
    """A view of a table whose classified columns go through the mask function."""
    held = spark.table(table).columns
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} AS SELECT " + ", ".join(f"{function}({c}) AS {c}" if c in columns else c for c in held) + f" FROM {table}")


def assert_predicate(deployed: str, shipped: str) -> None:
    """Refuses a deployed mask body that doesn't hold the shipped predicate, white space aside."""
    plain = lambda s: " ".join(s.split())
    if plain(shipped) not in plain(deployed):
        raise GovernanceRefused("the deployed mask is not the shipped one")


def grant_plan(observed: DataFrame, roster: DataFrame) -> DataFrame:
    """(principal, object, action): grant what the roster has and nobody observed, revoke the reverse, escalate what can't be revoked.

    `observed` has a boolean `revocable`. Null principals equal each other.
    """
    o = observed.select("principal", "object", "revocable", F.lit(1).alias("o"), F.lit(0).alias("r"))
    r = roster.select("principal", "object", F.lit(True).alias("revocable"), F.lit(0).alias("o"), F.lit(1).alias("r"))
    both = o.unionByName(r).groupBy("principal", "object").agg(F.max("o").alias("o"), F.max("r").alias("r"), F.min("revocable").alias("revocable"))
    action = F.when((F.col("o") == 0) & (F.col("r") == 1), "grant").when((F.col("o") == 1) & (F.col("r") == 0) & F.col("revocable"), "revoke").when((F.col("o") == 1) & (F.col("r") == 0), "escalate")
    return both.select("principal", "object", action.alias("action")).filter(F.col("action").isNotNull())


def tagged(rows: DataFrame, contract: str) -> DataFrame:
    """Rows whose classified columns carry their class as column metadata."""
    for c in CLASSIFIED.get(contract, ()):
        if c in rows.columns:
            rows = rows.withColumn(c, F.col(c).alias(c, metadata={"class": "personal"}))
    return rows


def assert_revision(expected: str, stamped: str | None) -> str:
    """Refuses to run other code than the revision expected; unstamped, dirty or abbreviated ids are none."""
    clean = (expected or "").strip().lower()
    if not re.fullmatch(r"[0-9a-f]{40}([0-9a-f]{24})?", clean):
        raise GovernanceRefused(f"{expected!r} is no object id")
    if not stamped:
        raise GovernanceRefused("the artefact carries no revision")
    if stamped.strip().lower() != clean:
        raise GovernanceRefused(f"expected {clean}, the artefact is {stamped}")
    return clean
