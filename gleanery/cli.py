"""Command line over the operators: ``python -m gleanery.cli COMMAND``. Inputs and outputs are Parquet tables or JSON lines."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators import caps, coverage, dedup, gates, reconcile, score, tasks
from gleanery.session import local_session
from gleanery.sources import files, releases

TASKS = "task_id string, image_sha256 string, correct_taxon string, candidates array<string>, synonyms_accepted array<string>, meta struct<family:string>"
PREDICTIONS = "task_id string, tasks_hash string, image_sha256 string, predictions array<struct<taxon:string,score:double,matched:boolean,raw:string>>, error string, finish_reason string, provider struct<refusal:string>"


def read(spark: SparkSession, path: str, ddl: str | None = None) -> DataFrame:
    if path.endswith((".json", ".jsonl")):
        return files.read_lines(spark, path, ddl) if ddl else spark.read.json(path)
    return files.read_checklist(spark, path) if path.endswith(".csv") else spark.read.parquet(path)


def _scored(spark, a):
    t = read(spark, a.tasks, TASKS).withColumn("family", F.col("meta.family"))
    p = read(spark, a.predictions, PREDICTIONS).withColumn("refusal", F.col("provider.refusal"))
    broken = gates.predictions(t, p).limit(5).collect()
    if broken:
        raise SystemExit("\n".join(f"{b.gate} {b.entity}: {b.message}" for b in broken))
    return t, score.joined(t, p)


def _report(df: DataFrame) -> None:
    for r in df.toLocalIterator():
        print(json.dumps(r.asDict(recursive=True), default=str, sort_keys=True))


def _gate(df: DataFrame) -> None:
    """Print violations; the exit code tells whether there were any."""
    n = 0
    for r in df.toLocalIterator():
        n += 1
        print(f"{r.gate} {r.entity}: {r.message}")
    if n:
        raise SystemExit(1)


def run(argv: list[str] | None = None) -> None:
    top = argparse.ArgumentParser(prog="gleanery")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, *arguments: str, **defaults):
        c = sub.add_parser(name)
        for x in arguments:
            c.add_argument(f"--{x}", required=True)
        for k, v in defaults.items():
            c.add_argument(f"--{k.replace('_', '-')}", default=v, type=type(v) if v is not None else str)
        return c

    command("taxonomy-reconcile", "names", "records", "out", reviewed=None)
    command("audit-licenses", "candidates", profile="research")
    command("audit-coverage", "checklist", "counts", "out")
    command("media-select", "candidates", "out", profile="research")
    command("release-select", "candidates", "out", profile="research")
    command("media-dedup", "media", "out", threshold=6)
    command("release-build", "tables", "out", "version", "built-at")
    command("release-verify", "release", version=None)
    command("release-publish", "release", "target")
    command("suite-publish", "tasks", "objects", "target", "suite")
    command("suite-sync", "target", "suite", "out")
    command("evidence", "sources", claims=None)
    command("assessments", "rows", evidence=None, taxa=None)
    command("build-tasks", "taxa", "media", "out", suite="closed-set")
    command("split", "media", "out", seed=42, per_taxon=4)
    command("sample", "tasks", "out", limit=100, seed=42)
    command("validate", "tasks")
    command("score", "tasks", "predictions")
    command("report", "tasks", "predictions", families=None)
    command("leaderboard", "runs", suite=None, condition="image")
    a = top.parse_args(argv)
    spark = local_session()
    save = lambda df: df.write.mode("errorifexists").parquet(a.out)

    if a.command == "taxonomy-reconcile":
        save(reconcile.reconcile(read(spark, a.names), read(spark, a.records), read(spark, a.reviewed) if a.reviewed else None))
        _report(reconcile.conflict_report(spark.read.parquet(a.out)))
    elif a.command == "audit-licenses":
        _report(caps.license_filter(read(spark, a.candidates), a.profile).groupBy("verdict").count())
    elif a.command == "audit-coverage":
        save(coverage.coverage(read(spark, a.checklist), read(spark, a.counts)))
        _report(coverage.coverage_summary(spark.read.parquet(a.out)))
    elif a.command == "media-select":
        save(caps.select_media(read(spark, a.candidates), a.profile))
        _report(caps.selection_report(spark.read.parquet(a.out)))
    elif a.command == "release-select":
        save(caps.select_release(read(spark, a.candidates), a.profile))
        _report(spark.read.parquet(a.out).groupBy("reason").count())
    elif a.command == "media-dedup":
        save(dedup.clusters(read(spark, a.media), a.threshold))
        _report(dedup.duplicate_report(spark.read.parquet(a.out)))
    elif a.command == "release-build":
        parts = {n: spark.read.parquet(f"{a.tables}/{n}.parquet") for n in files.RELEASE_TABLES}
        print(json.dumps(releases.build_release(parts, a.out, a.version, a.built_at), sort_keys=True))
    elif a.command == "release-verify":
        wrong = releases.verify_release(spark, a.release, a.version).limit(100).collect()
        if wrong:
            raise SystemExit("\n".join(f"{r.name}: {r.problem}" for r in wrong))
        t = {n: spark.read.parquet(f"{a.release}/{n}.parquet") for n in files.RELEASE_TABLES}
        _gate(gates.release(t["taxa"], t["media"], t["attribution"], t["evidence"], t["danger_assessments"]))
    elif a.command == "release-publish":
        print("published" if releases.publish(spark, a.release, a.target) else "published already")
    elif a.command == "suite-publish":
        done = releases.publish_suite(read(spark, a.tasks), spark.read.parquet(a.objects), a.target, a.suite)
        print("published" if done else "published already")
    elif a.command == "suite-sync":
        print(json.dumps(releases.restore_suite(spark, a.target, a.suite, a.out), sort_keys=True))
    elif a.command == "evidence":
        src = files.read_evidence(spark, a.sources)
        _gate(gates.evidence_sources(src) if not a.claims else gates.evidence_sources(src).unionByName(gates.evidence_claims(read(spark, a.claims), src)))
    elif a.command == "assessments":
        _gate(gates.assessments(read(spark, a.rows), files.read_evidence(spark, a.evidence) if a.evidence else None, read(spark, a.taxa) if a.taxa else None))
    elif a.command == "build-tasks":
        save(tasks.build_tasks(read(spark, a.taxa), read(spark, a.media), a.suite))
    elif a.command == "split":
        save(tasks.gallery_query_split(read(spark, a.media), a.per_taxon, a.seed))
        if tasks.split_leaks(spark.read.parquet(a.out)).limit(1).count():
            raise SystemExit("gallery and query share an image or an observation")
    elif a.command == "sample":
        save(tasks.round_robin(read(spark, a.tasks), a.limit, a.seed))
    elif a.command == "validate":
        _gate(gates.suite(read(spark, a.tasks)))
    elif a.command == "score":
        t, s = _scored(spark, a)
        for df in (score.summary(s), score.per_group(s), score.status_counts(s), score.baselines(t)):
            _report(df)
    elif a.command == "report":
        t, s = _scored(spark, a)
        families = read(spark, a.families) if a.families else t.select(F.col("correct_taxon").alias("taxon"), "family").distinct()
        for df in (score.run_report(s, families), score.error_breakdown(s, families)):
            _report(df)
    elif a.command == "leaderboard":
        runs = files.read_runs(spark, a.runs).where(F.coalesce("condition", F.lit("image")) == a.condition)
        runs = runs.where(F.col("suite") == a.suite) if a.suite else runs
        if files.mismatched_runs(runs).limit(1).count() or score.cohorts(runs).count() > 1:
            raise SystemExit("scores of different task snapshots can't be ranked together")
        print(files.leaderboard_markdown([r.asDict() for r in score.leaderboard(runs).orderBy("rank").collect()]))


if __name__ == "__main__":
    run()
