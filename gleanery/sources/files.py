"""File readers and writers: checklists, JSON lines, run folders and the run ledger."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RELEASE_TABLES = {"taxa": ["taxon"], "media": ["sha256"], "attribution": ["sha256"], "evidence": ["id"], "danger_assessments": ["taxon"]}


def read_checklist(spark: SparkSession, path: str, max_records: int | None = None) -> DataFrame:
    """CSV with a header; all columns as text."""
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    first = df.columns[0] if df.columns else ""
    df = df.withColumnRenamed(first, first.lstrip("﻿")) if first.startswith("﻿") else df
    return df.limit(max_records) if max_records is not None else df


def read_lines(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """JSON lines under a declared schema; a malformed line is an error, blank ones are skipped."""
    return spark.read.schema(ddl).option("mode", "FAILFAST").json(path)


def write_lines(df: DataFrame, path: str) -> None:
    """One JSON object a line, never over an existing snapshot."""
    df.select(F.to_json(F.struct(*df.columns))).write.mode("errorifexists").text(path)


def read_candidates(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A JSON list of candidates, or an object that has it under ``candidates`` or ``media``."""
    text = spark.read.option("wholetext", True).text(path)
    item = f"array<struct<{ddl}>>"
    wrapped = F.from_json("value", f"candidates {item}, media {item}")
    rows = F.when(F.trim("value").startswith("["), F.from_json("value", item)).otherwise(F.coalesce(wrapped["candidates"], wrapped["media"]))
    return text.select(F.explode(rows).alias("c")).select("c.*")


def read_evidence(spark: SparkSession, path: str) -> DataFrame:
    """Bibliographic records of a JSON list (or ``sources`` of an object) or of a CSV file."""
    columns = ["id", "title", "authors", "publication_date", "source_type", "doi", "pmid", "isbn", "url", "access_date"]
    if path.endswith(".csv"):
        df = spark.read.option("header", True).csv(path)
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])
    item = "array<struct<" + ",".join(f"{c}:string" for c in columns) + ">>"
    text = spark.read.option("wholetext", True).text(path)
    rows = F.when(F.trim("value").startswith("["), F.from_json("value", item)).otherwise(F.from_json("value", f"sources {item}")["sources"])
    return text.select(F.explode(rows).alias("c")).select("c.*")


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """(run_id, model_id, suite, condition, status, tasks_hash, scores_hash, tasks, top1, macro_species_top1, answer_rate, errors, execution_valid, cost_usd) of
    run folders that hold both a manifest and scores."""
    run_id = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    m = spark.read.option("multiLine", True).schema("model_id string, suite string, condition string, status string, tasks_hash string, estimated_cost_usd double").json(f"{root}/*/manifest.json").withColumn("run_id", run_id)
    s = spark.read.option("multiLine", True).schema("tasks long, tasks_hash string, top1 double, macro_species_top1 double, answer_rate double, errors long, execution_valid boolean").json(f"{root}/*/scores.json").withColumn("run_id", run_id)
    s = s.withColumnRenamed("tasks_hash", "scores_hash")
    return m.join(s, "run_id").withColumnRenamed("estimated_cost_usd", "cost_usd")


def mismatched_runs(runs: DataFrame) -> DataFrame:
    """Runs whose scores belong to another task snapshot than their manifest."""
    return runs.where(~F.col("tasks_hash").eqNullSafe(F.col("scores_hash")))


def latest_run(spark: SparkSession, root: str) -> str | None:
    """The run folder whose predictions changed last."""
    files = [p for p in Path(root).glob("*/predictions.jsonl")]
    return str(max(files, key=lambda p: p.stat().st_mtime).parent) if files else None


def ordered(df: DataFrame, keys: list[str]) -> DataFrame:
    """Columns by name, rows by their keys as text, nothing first."""
    return df.select(*sorted(df.columns)).orderBy(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])


def verified_objects(files: DataFrame, expected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): files (name, sha256, bytes) that match ``expected`` (the same columns), and expected ones that are missing or differ."""
    good = expected.join(files, ["name", "sha256", "bytes"], "left_semi")
    return good, expected.join(files, ["name", "sha256", "bytes"], "left_anti")


def run_hash(tasks_hash: str, adapter: dict, params: dict, code_hash: str) -> str:
    """The fingerprint of a run: what must be the same for it to be gone on with."""
    from gleanery.sources.config import canonical_json

    return hashlib.sha256(canonical_json({"tasks_hash": tasks_hash, "adapter": adapter, "params": params, "code_hash": code_hash}).encode()).hexdigest()


def may_go_on(previous: dict | None, fingerprint: str, resume: bool, has_predictions: bool) -> None:
    """Raise unless a run may start (nothing there) or go on: the same fingerprint, asked for, and not complete."""
    if previous is None:
        if has_predictions:
            raise ValueError("there are predictions without a manifest")
    elif not resume or previous.get("run_hash") != fingerprint:
        raise ValueError("the run exists with another configuration")
    elif previous.get("status") == "complete":
        raise ValueError("the run is complete")


def checked_object(cached: bytes | None, digest: str, fetch) -> tuple[bytes, bool]:
    """(content, repaired) of an object by its digest: the cached copy if it is that, else what ``fetch`` gives, which must be."""
    if not (len(digest) == 64 and set(digest) <= set("0123456789abcdef")):
        raise ValueError(f"no digest: {digest!r}")
    if cached is not None and hashlib.sha256(cached).hexdigest() == digest:
        return cached, False
    content = fetch(digest)
    if hashlib.sha256(content).hexdigest() != digest:
        raise ValueError(f"stored object differs from its digest {digest}")
    return content, True


def append_ledger(rows: DataFrame, path: str) -> None:
    """Append predictions to a run's ledger."""
    rows.write.mode("append").json(path)


def run_pending(tasks: DataFrame, ledger: DataFrame | None, adapter, schema: str) -> DataFrame:
    """Predictions of tasks that the ledger lacks, by an adapter (iterator of pandas frames -> the same) that sees only the task's
    hashed id, image and candidates."""
    from gleanery.operators.upsert import pending

    todo = tasks if ledger is None else pending(tasks, ledger)
    shown = todo.select(F.sha2(F.col("task_id").cast("string"), 256).alias("task_key"), "task_id", *[c for c in ("image_sha256", "candidates", "user_prompt") if c in todo.columns])
    return shown.mapInPandas(adapter, schema)


def perfect_adapter(answers: dict[str, str]):
    """For tests: answers by task id, score 1."""

    def run(batches):
        for pdf in batches:
            yield pdf.assign(taxon=[answers.get(str(t)) for t in pdf["task_id"]])[["task_id", "taxon"]]

    return run


def constant_adapter(name: str):
    """For tests: one answer to everything."""

    def run(batches):
        for pdf in batches:
            yield pdf.assign(taxon=name)[["task_id", "taxon"]]

    return run


def leaderboard_markdown(rows: list) -> str:
    """A leaderboard's collected rows as a table; scores are descriptive."""
    head = ["# Results", "", "| rank | run | tasks | top-1 |", "| --- | --- | --- | --- |"]
    return "\n".join(head + [f"| {r['rank']} | {r['run_id']} | {r['tasks']} | {r['top1']:.4f} |" for r in rows]) + "\n"
