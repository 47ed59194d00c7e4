import datetime as dt
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import backfill, dataops, governance
from tidemark.plans import jobs
from tidemark.plans.jobs import Job, JobRefused, Task
from tidemark.store import WriteRefused, append, rows_in

LEG = "_batch_id string, _source_file string"


def legs(spark, staged, promoted, quarantined, source="s"):
    make = lambda d: spark.createDataFrame([(b, f) for b, f, n in d for _ in range(n)], LEG)
    return [(source, "staged", make(staged)), (source, "promoted", make(promoted)), (source, "quarantined", make(quarantined))]


def test_every_verdict(spark):
    got = dataops.batch_accounts(legs(spark, [("ok", "f", 3), ("gated", "f", 3), ("lost", "f", 2), ("over", "f", 1)], [("ok", "f", 2), ("over", "f", 2), ("only", "f", 1)], [("ok", "f", 1), ("gated", "f", 1), (None, None, 1)]))
    v = {r._batch_id: (r.verdict, r.unaccounted, r.remedy is not None) for r in got.collect()}
    assert v == {"ok": ("reconciled", 0, False), "gated": ("stranded_gated", 2, True), "lost": ("stranded_unexplained", 2, True), "over": ("over_promoted", -1, False), "only": ("over_promoted", -1, False), None: ("over_promoted", -1, False)}


def test_only_proven_files_are_deleted(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for name in ("done", "part", "rejected", "gone"):
        (landing / name).write_text("x")
    (tmp_path / "outside").write_text("x")
    path = lambda n: f"file:{landing}/{n}"
    accounts = dataops.file_accounts(legs(spark, [("b", path("done"), 2), ("b", path("part"), 2), ("b", path("rejected"), 1), ("b", path("gone"), 1), ("b", f"file:{tmp_path}/outside", 1)], [("b", path("done"), 1), ("b", path("part"), 1), ("b", path("gone"), 1), ("b", f"file:{tmp_path}/outside", 1)], [("b", path("done"), 1), ("b", path("rejected"), 1)]))
    (landing / "gone").unlink()
    done = dataops.delete_reclaimable(accounts, str(landing))
    assert [Path(p).name for p in done.deleted] == ["done"] and [Path(p).name for p in done.already_gone] == ["gone"]
    assert sorted(p.name for p in landing.iterdir()) == ["part", "rejected"] and (tmp_path / "outside").exists()
    assert dataops.resolve_month(None, ["2027-01"]) == "2027-01"
    for stated, stamped in (("2027-02", ["2027-01"]), (None, ["2027-01", "2027-02"]), (None, [])):
        with pytest.raises(ValueError):
            dataops.resolve_month(stated, stamped)


def test_every_freshness_status(spark):
    day = dt.date(2027, 9, 1)
    c = [dataops.Cadence(s, k, d) for s, k, d in (("paused", "paused", None), ("never", "declared", 1), ("axis", "no_source_axis", None), ("any", "undeclared", None), ("nodate", "declared", 1), ("late", "declared", 5), ("good", "declared", 50))]
    at = dt.datetime(2027, 8, 1)
    m = spark.createDataFrame([(s, 1, None if s in ("never", "paused") else at, "2027-08", None if s in ("nodate",) else dt.date(2027, 8, 20)) for s in ("paused", "never", "axis", "any", "nodate", "late", "good")], "source string, bronze_rows long, last_ingested_at timestamp, last_snapshot_month string, last_source_date date")
    got = {r.source: (r.source_freshness_status, r.source_age_days) for r in dataops.freshness(m, c, day).collect()}
    assert {s: v[0] for s, v in got.items()} == {"paused": "paused_by_decision", "never": "never_ingested", "axis": "no_source_axis", "any": "no_declared_cadence", "nodate": "source_date_missing", "late": "overdue", "good": "within_cadence"} and got["late"][1] == 12
    with pytest.raises(ValueError):
        dataops.Cadence("x", "declared")
    with pytest.raises(ValueError):
        dataops.Cadence("x", "paused", 3)


def test_telemetry(spark):
    t = lambda h: dt.datetime(2027, 1, 1, h)
    timeline = spark.createDataFrame([("r1", 1, 10, "a", t(1), t(2), None, 1, 5, 0), ("r1", 1, 10, "a", t(2), t(3), "FAILED", 1, 9, 0), ("r2", 1, 10, "a", t(4), t(5), "SUCCEEDED", 1, 1, 1), ("r3", 2, 11, "b", t(9), t(10), "SUCCEEDED", 0, 0, 0), ("r0", 1, 9, "a", t(0), t(0), "SUCCEEDED", 0, 0, 0)], "run_id string, job_id int, job_run_id int, task_key string, period_start_time timestamp, period_end_time timestamp, result_state string, setup_duration_seconds long, execution_duration_seconds long, cleanup_duration_seconds long")
    names = spark.createDataFrame([(1, "old", t(0)), (1, "new", t(1))], "job_id int, name string, change_time timestamp")
    history = spark.createDataFrame([("r1", t(2), 5, None, 1), ("r1", t(3), 6, 2, 1), (None, t(1), 1, 1, 1), (None, t(6), 1, 1, 1)], "run_id string, end_time timestamp, read_rows long, written_rows long, written_bytes long")
    got = {r.run_id: (r.attempt, r.result_state, r.job_name, r.execution_seconds, r.timeline_periods, r.sql_telemetry, r.statements, r.read_rows) for r in dataops.task_telemetry(timeline, names, history).collect()}
    assert got == {"r1": (1, "FAILED", "new", 9, 2, "measured", 2, 11), "r2": (2, "SUCCEEDED", "new", 1, 1, "no_sql_attributed", None, None), "r3": (1, "SUCCEEDED", None, 0, 1, "not_yet_attributed", None, None), "r0": (1, "SUCCEEDED", "new", 0, 1, "older_than_history", None, None)}
    assert {r.sql_telemetry for r in dataops.task_telemetry(timeline, names, history.limit(0)).collect()} == {"not_yet_attributed"}


def test_masks(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "i int, nome_socio_razao_social string")
    assert rows(governance.masked(df, ["nome_socio_razao_social"], False)) == [(1, "***"), (2, None)] and rows(governance.masked(df, ["nome_socio_razao_social"], True)) == rows(df)
    with pytest.raises(governance.GovernanceRefused):
        governance.masked(df, ["absent"], False)
    spark.createDataFrame([("nobody", "readers")], "user string, member_group string").createOrReplaceTempView("members")
    df.createOrReplaceTempView("people")
    body = governance.mask_function(spark, "hide", "members", "readers")
    governance.masked_view(spark, "people", "people_masked", ["nome_socio_razao_social"], "hide")
    assert rows(spark.table("people_masked"))[0] == (1, "***")
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW members AS SELECT current_user() AS user, 'readers' AS member_group")
    assert rows(spark.table("people_masked"))[0] == (1, "x")
    governance.assert_predicate(f"  {body}\n", body)
    with pytest.raises(governance.GovernanceRefused):
        governance.assert_predicate("value", body)
    assert governance.tagged(df, "socios").schema["nome_socio_razao_social"].metadata == {"class": "personal"}


def test_grants_and_revision(spark):
    o = spark.createDataFrame([("a", "t", True), ("b", "t", True), ("c", "t", False), (None, "t", True)], "principal string, object string, revocable boolean")
    r = spark.createDataFrame([("a", "t"), ("d", "t"), (None, "t")], "principal string, object string")
    assert rows(governance.grant_plan(o, r)) == [("b", "t", "revoke"), ("c", "t", "escalate"), ("d", "t", "grant")]
    good = "a" * 40
    assert governance.assert_revision(good.upper(), good) == good
    for expected, stamped in ((good, None), (good, "b" * 40), ("abc", good), (good, good + "-dirty"), (None, good)):
        with pytest.raises(governance.GovernanceRefused):
            governance.assert_revision(expected, stamped)


def test_backfill(spark):
    df = spark.createDataFrame([("1", "/l/2027-01/K.D70109"), ("2", "/l/2027-01/K")], "k string, _source_file string")
    append(df, "b_fill")
    assert backfill.missing_columns(df) == list(backfill.COLUMNS)
    assert backfill.backfill(spark.table("b_fill"), "b_fill", "2027-01") == 2
    assert [(r._snapshot_month, r._snapshot_ref_date) for r in spark.table("b_fill").orderBy("k").collect()] == [("2027-01", dt.date(2027, 1, 9)), ("2027-01", None)]
    for month in ("2027-02",):
        with pytest.raises(WriteRefused):
            backfill.backfill(spark.table("b_fill"), "b_fill", month)
    append(df, "b_quar")
    with pytest.raises(WriteRefused):
        backfill.backfill(spark.table("b_fill"), "b_fill", "2027-01", "b_quar")
    assert rows_in(spark, "b_fill") == 2


def test_fingerprints_ignore_order_and_see_everything_else(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", 1)], "x string, y int")
    one = backfill.fingerprint(df).first()
    assert backfill.fingerprint(df.orderBy(F.desc("y")).select("y", "x")).first() == one
    assert backfill.fingerprint(df.distinct()).first() != one and backfill.fingerprint(df.withColumn("x", F.coalesce("x", F.lit("")))).first() != one
    assert backfill.fingerprint(df.limit(0)).first()["rows"] == 0


def test_jobs_run_in_order_and_refuse_circles():
    ran = []
    job = Job("j", [Task("c", lambda: ran.append("c"), ("a", "b")), Task("b", lambda: ran.append("b"), ("a",)), Task("a", lambda: ran.append("a"))])
    job.run()
    assert ran == ["a", "b", "c"]
    for tasks in ([Task("a", print, ("b",)), Task("b", print, ("a",))], [Task("a", print, ("x",))], [Task("a", print), Task("a", print)]):
        with pytest.raises(JobRefused):
            Job("j", tasks).order()


def test_parameters():
    assert jobs.required_months("2027-01, 2027-02") == ["2027-01", "2027-02"] and jobs.optional_flag("true") and not jobs.optional_flag(None)
    for call in (lambda: jobs.required_months("2027-13"), lambda: jobs.required_months("2027-01,2027-01"), lambda: jobs.required_months(""), lambda: jobs.optional_flag("yes"), lambda: jobs.required_instant("2027-01-01T00:00:00"), lambda: jobs.required_spec("nothing", object)):
        with pytest.raises(JobRefused):
            call()


def test_the_dataops_job_makes_its_views(spark):
    assert isinstance(jobs.dataops_job(spark, dt.date(2027, 1, 1)).run()["views"], list)
