"""python -m tidemark JOB [--option value…]: runs a job on the session's cluster and prints what its tasks did."""

from __future__ import annotations

import argparse
import json
import sys

from tidemark.plans import jobs
from tidemark.session import build_session


def parser() -> argparse.ArgumentParser:
    """Command line of the jobs; every value is a text that the job itself checks."""
    p = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    kinds = p.add_subparsers(dest="kind", required=True)
    bronze = kinds.add_parser("bronze", help="ingest, gate and promote a landed source")
    for name in ("table", "root", "month", "batch-id", "record-source"):
        bronze.add_argument(f"--{name}", required=True)
    bronze.add_argument("--reclaim", default="false")
    again = kinds.add_parser("repromote", help="promote a triaged batch")
    for name in ("table", "batch-id"):
        again.add_argument(f"--{name}", required=True)
    vault = kinds.add_parser("vault", help="load one job of the historised model")
    vault.add_argument("--months")
    gold = kinds.add_parser("gold", help="build one job of the dimensional tables")
    for one in (vault, gold):
        one.add_argument("--job", required=True)
        one.add_argument("--load-date", required=True)
    kinds.add_parser("dataops", help="views on operations")
    for one in kinds.choices.values():
        one.add_argument("--expected-revision")
        one.add_argument("--stamped-revision")
    return p


def job_of(spark, a: argparse.Namespace) -> jobs.Job:
    revision = (a.expected_revision, a.stamped_revision)
    if a.kind == "bronze":
        return jobs.bronze_job(spark, a.table, root=a.root, month=a.month, batch_id=a.batch_id, record_source=a.record_source, reclaim=jobs.optional_flag(a.reclaim), revision=revision)
    if a.kind == "repromote":
        return jobs.Job("repromote", [jobs.guard(*revision), jobs.Task("promote", lambda: jobs.repromote(spark, a.table, a.batch_id), ("guard",))])
    if a.kind == "vault":
        return jobs.vault_job(spark, a.job, load_date=a.load_date, months=jobs.required_months(a.months) if a.months else None, revision=revision)
    if a.kind == "gold":
        return jobs.gold_job(spark, a.job, load_date=a.load_date, revision=revision)
    return jobs.dataops_job(spark)


def main(arguments: list[str] | None = None) -> int:
    a = parser().parse_args(arguments)
    results = job_of(build_session(f"tidemark-{a.kind}"), a).run()
    print(json.dumps({name: str(result) for name, result in results.items()}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
