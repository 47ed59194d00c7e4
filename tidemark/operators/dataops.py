"""Views on operations: reconciliation by batch and file, freshness, run telemetry, retention."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from pathlib import Path, PurePosixPath

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.times import date_of, utc_day
from tidemark.store import table_exists

#: Verdicts and statuses. (fixed values)
OVER, RECONCILED, GATED, UNEXPLAINED = "over_promoted", "reconciled", "stranded_gated", "stranded_unexplained"
PAUSED, NEVER, NO_AXIS, NO_CADENCE, NO_DATE, OVERDUE, WITHIN = "paused_by_decision", "never_ingested", "no_source_axis", "no_declared_cadence", "source_date_missing", "overdue", "within_cadence"
MEASURED, NOT_YET, TOO_OLD, NONE_ATTRIBUTED = "measured", "not_yet_attributed", "older_than_history", "no_sql_attributed"


def accounts(legs: Sequence[tuple[str, str, DataFrame]], by: Sequence[str]) -> DataFrame:
    """Rows staged, promoted and quarantined per source and `by`, from (source, role, rows) legs, by union and one grouping.

    A batch that only one table holds still appears; nulls group together. Each leg is counted before the shuffle.
    """
    all_ = None
    for source, role, rows in legs:
        counted = rows.select(F.lit(source).alias("source"), *by, *(F.lit(int(role == r)).cast("long").alias(r) for r in ("staged", "promoted", "quarantined")))
        all_ = counted if all_ is None else all_.unionByName(counted)
    sums = all_.groupBy("source", *by).agg(*(F.sum(r).alias(r) for r in ("staged", "promoted", "quarantined")))
    p, q, s = F.col("promoted"), F.col("quarantined"), F.col("staged")
    verdict = F.when(p + q > s, OVER).when(p + q == s, RECONCILED).when(q > 0, GATED).otherwise(UNEXPLAINED)
    return sums.withColumns({"unaccounted": s - p - q, "verdict": verdict})


def batch_accounts(legs: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """Accounts per batch with what resolves a stranding."""
    remedy = F.when(F.col("verdict").isin(GATED, UNEXPLAINED), F.concat(F.lit("promote_batch table="), F.col("source"), F.lit(" batch_id="), F.col("_batch_id")))
    return accounts(legs, ["_batch_id"]).withColumn("remedy", remedy)


def file_accounts(legs: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """Accounts per batch and file; a file whose rows are all accounted for, some of them promoted, may be deleted."""
    p, q, s = F.col("promoted"), F.col("quarantined"), F.col("staged")
    return accounts(legs, ["_batch_id", "_source_file"]).withColumn("reclaimable", (p > 0) & (p + q == s))


def legs_of(spark: SparkSession, tables: Sequence, batch_id: str | None = None) -> list[tuple[str, str, DataFrame]]:
    """The three tables of each landed source as legs; those that don't exist are left out."""
    found = []
    for t in tables:
        for role, name in (("staged", t.staging), ("promoted", t.bronze), ("quarantined", t.quarantine)):
            if table_exists(spark, name):
                rows = spark.table(name)
                found.append((t.name, role, rows.filter(F.col("_batch_id") == batch_id) if batch_id else rows))
    return found


# --- retention ----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Deletion:
    deleted: tuple[str, ...]
    already_gone: tuple[str, ...]
    held_back: tuple[str, ...]


def months_of_batch(rows: DataFrame, batch_id: str) -> list[str]:
    """Months stamped on a batch's rows."""
    return sorted(r[0] for r in rows.filter(F.col("_batch_id") == batch_id).select("_snapshot_month").distinct().collect() if r[0])


def resolve_month(stated: str | None, stamped: Sequence[str]) -> str:
    """The month to reclaim: the stated one, or the only one stamped; a disagreement is refused."""
    if stated and stamped and list(stamped) != [stated]:
        raise ValueError(f"month {stated} stated, {list(stamped)} stamped")
    if not stated and len(stamped) != 1:
        raise ValueError(f"no single month: {list(stamped)}")
    return stated or stamped[0]


def delete_reclaimable(accounts_of_batch: DataFrame, landing: str) -> Deletion:
    """Deletes the proven files of one batch inside its landing directory; everything else is held back."""
    root = Path(landing).resolve()
    deleted, gone, held = [], [], []
    for r in accounts_of_batch.select("_source_file", "reclaimable").collect():  # files of one batch
        path = Path(str(PurePosixPath(r["_source_file"].removeprefix("file:")))) if r["_source_file"] else None
        if not r["reclaimable"] or path is None or root not in path.resolve().parents:
            held.append(str(path))
        elif path.exists():
            path.unlink()
            deleted.append(str(path))
        else:
            gone.append(str(path))
    return Deletion(tuple(deleted), tuple(gone), tuple(held))


# --- freshness ----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Cadence:
    """What is expected of a source: kind is declared, paused, undeclared or no_source_axis; only declared has days."""

    source: str
    kind: str
    days: int | None = None
    note: str = ""

    def __post_init__(self):
        if self.kind not in ("declared", "paused", "undeclared", "no_source_axis") or (self.days is not None) != (self.kind == "declared"):
            raise ValueError(f"{self.source}: cadence {self.kind} with {self.days} days")


#: Expectations of the registered sources; registry snapshots are monthly.
CADENCES = (
    Cadence("lookup", "paused", note="not ingested any more"), Cadence("empresas", "declared", 45), Cadence("estabelecimentos", "declared", 45), Cadence("socios", "declared", 45),
    Cadence("merchant", "undeclared", note="taken on demand"), Cadence("payments", "no_source_axis"), Cadence("ptax", "no_source_axis"),
)


def measured(rows: DataFrame, source: str) -> DataFrame:
    """One row: rows, last ingest, last month, last date the source declares (null where it declares none)."""
    declared = F.max("_snapshot_ref_date") if "_snapshot_ref_date" in rows.columns else F.lit(None).cast("date")
    return rows.agg(F.lit(source).alias("source"), F.count(F.lit(1)).alias("bronze_rows"), F.max("_ingested_at").alias("last_ingested_at"), F.max("_snapshot_month").alias("last_snapshot_month"), declared.alias("last_source_date"))


def freshness(measures: DataFrame, cadences: Sequence[Cadence], today=None) -> DataFrame:
    """Both ages of every source and one status, the first that holds: paused, never, no axis, no cadence, no date, overdue, within."""
    spark = measures.sparkSession
    declared = spark.createDataFrame([(c.source, c.kind, c.days, c.note) for c in cadences], "source string, cadence_kind string, expected_every_days int, cadence_note string")
    day = F.lit(today).cast("date") if today else F.current_date()
    aged = measures.join(F.broadcast(declared), "source").withColumns({"pipeline_age_days": F.datediff(day, date_of(utc_day(F.unix_micros("last_ingested_at")))), "source_age_days": F.datediff(day, F.col("last_source_date"))})
    kind = F.col("cadence_kind")
    status = F.when(kind == "paused", PAUSED).when(F.col("last_ingested_at").isNull(), NEVER).when(kind == "no_source_axis", NO_AXIS).when(kind == "undeclared", NO_CADENCE)
    status = status.when(F.col("last_source_date").isNull(), NO_DATE).when(F.col("source_age_days") > F.col("expected_every_days"), OVERDUE).otherwise(WITHIN)
    return aged.withColumn("source_freshness_status", status)


# --- telemetry ----------------------------------------------------------------------------------------------------


def task_telemetry(timeline: DataFrame, jobs: DataFrame, history: DataFrame) -> DataFrame:
    """One row per task-run attempt: times, end state, job name, the statements attributed to it and how far that can be trusted.

    `history`: run_id of each statement (null for others), end_time, read_rows, written_rows, written_bytes. The
    state is the last one reported; durations are those of the run, not sums over its periods.
    """
    runs = timeline.groupBy("run_id", "job_id", "job_run_id", "task_key").agg(
        F.min("period_start_time").alias("started_at"), F.max("period_end_time").alias("ended_at"), F.max_by("result_state", "period_end_time").alias("result_state"),
        *(F.max(f"{p}_duration_seconds").alias(f"{p}_seconds") for p in ("setup", "execution", "cleanup")), F.count(F.lit(1)).alias("timeline_periods"),
    )
    names = jobs.groupBy("job_id").agg(F.max_by("name", "change_time").alias("job_name"))
    said = history.filter(F.col("run_id").isNotNull()).groupBy("run_id").agg(F.count(F.lit(1)).alias("statements"), *(F.sum(c).alias(c) for c in ("read_rows", "written_rows", "written_bytes")))
    edges = F.broadcast(history.agg(F.min("end_time").alias("__oldest"), F.max("end_time").alias("__newest")))
    joined = runs.join(edges, F.lit(True), "left").join(names, "job_id", "left").join(said, "run_id", "left")
    label = F.when(F.col("statements").isNotNull(), MEASURED).when(F.col("__newest").isNull() | (F.col("ended_at") > F.col("__newest")), NOT_YET).when(F.col("ended_at") < F.col("__oldest"), TOO_OLD).otherwise(NONE_ATTRIBUTED)
    attempt = F.row_number().over(Window.partitionBy("job_run_id", "task_key").orderBy("started_at"))
    return joined.withColumns({"attempt": attempt, "sql_telemetry": label}).drop("__oldest", "__newest")


#: Task runs that the report of the latest shows.
LATEST_RUNS = 200


def latest_runs(telemetry: DataFrame, n: int = LATEST_RUNS) -> DataFrame:
    """The `n` task runs that ended last; ties by run and task."""
    return telemetry.orderBy(F.desc("ended_at"), "run_id", "task_key", "job_run_id", "job_id").limit(n)


def sql_coverage(telemetry: DataFrame) -> DataFrame:
    """Per task: its runs, those whose statements are measured or not yet attributed, those that failed, the last end."""
    count = lambda c: F.count(F.when(c, 1))
    label, state = F.col("sql_telemetry"), F.col("result_state")
    return telemetry.groupBy("task_key").agg(F.count(F.lit(1)).alias("runs"), count(label == MEASURED).alias("measured"), count(label == NOT_YET).alias("not_yet"), count(state == "FAILED").alias("failed"), F.max("ended_at").alias("last_ended_at"))


def file_accounts_of_batch(spark: SparkSession, source: str, legs: dict[str, str], batch_id: str) -> DataFrame:
    """Accounts by file of one batch, by SQL whose batch is a bound parameter; tables that don't exist are left out.

    `legs`: the table of each role (staged, promoted, quarantined).
    """
    parts = [f"SELECT '{role}' AS role, _source_file, count(*) AS n FROM {name} WHERE _batch_id = :batch_id GROUP BY _source_file" for role, name in legs.items() if table_exists(spark, name)]
    if not parts:
        raise ValueError(f"no table of {source} exists")
    sums = ", ".join(f"coalesce(sum(n) FILTER (WHERE role = '{role}'), 0) AS {role}" for role in ("staged", "promoted", "quarantined"))
    return spark.sql(f"""SELECT :source AS source, _source_file, staged, promoted, quarantined, promoted > 0 AND promoted + quarantined = staged AS reclaimable
FROM (SELECT _source_file, {sums} FROM ({" UNION ALL ".join(parts)}) GROUP BY _source_file)""", args={"batch_id": batch_id, "source": source})


def create_views(spark: SparkSession, views: dict[str, DataFrame]) -> list[str]:
    """Registers views under `dataops_` names."""
    for name, rows in views.items():
        rows.createOrReplaceTempView(f"dataops_{name}")
    return [f"dataops_{n}" for n in views]
