"""History of changing entity attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attribute_history(statements: DataFrame, entity: str, applied: str, recency: Column, attributes: dict[str, Column]) -> DataFrame:
    """Every version of every entity: (entity, version_no, valid_from, valid_to, attributes…), valid_to null if open.

    First the statement of the latest `recency` per entity and applied date is kept (ties: the greatest attribute
    values), by partial aggregation, so an entity that holds a third of the rows is reduced before the shuffle to at
    most one row per date. Only then are an entity's statements gathered: sorted as a struct array and folded by a
    higher-order function that appends a version only where the attributes together differ from the version before.
    A version ends where the next begins. The array is bounded by the number of calendar days the source covers.

    Rows with a null entity or applied date state nothing. Attributes must hold no nulls, see `functions.identity`.
    Values that return make a new version. An empty table gives no versions.
    """
    names = list(attributes)
    state = F.struct(*(attributes[n].alias(n) for n in names))
    said = statements.select(F.col(entity).alias("entity"), F.col(applied).alias("at"), F.struct(recency.alias("recency"), state.alias("state")).alias("said")).filter(F.col("entity").isNotNull() & F.col("at").isNotNull())
    daily = said.groupBy("entity", "at").agg(F.max("said").alias("said"))
    gathered = daily.groupBy("entity").agg(F.sort_array(F.collect_list(F.struct("at", F.col("said.state").alias("state")))).alias("all"))
    version = "array<struct<at:date,state:struct<" + ",".join(f"`{n}`:string" for n in names) + ">>>"
    changed = F.aggregate(
        "all",
        F.array().cast(version),
        lambda versions, s: F.when((F.size(versions) > 0) & (F.element_at(versions, -1)["state"] == s["state"]), versions).otherwise(F.concat(versions, F.array(s))),
    )
    numbered = gathered.select("entity", changed.alias("versions")).select("entity", "versions", F.posexplode("versions").alias("i", "v"))
    ends = F.try_element_at(F.col("versions"), F.col("i") + 2)["at"]
    return numbered.select("entity", (F.col("i") + 1).alias("version_no"), F.col("v.at").alias("valid_from"), ends.alias("valid_to"), *(F.col(f"v.state.`{n}`").alias(n) for n in names))
