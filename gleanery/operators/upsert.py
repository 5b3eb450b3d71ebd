"""Idempotent writes as relations: first wins, last wins, partial merges, and the download queue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _numbered(existing: DataFrame | None, new: DataFrame, order: str) -> DataFrame:
    tagged = new.withColumn("_new", F.lit(1))
    return tagged if existing is None else existing.withColumn("_new", F.lit(0)).unionByName(tagged, allowMissingColumns=True)


def _whole(df: DataFrame):
    return F.struct(*[F.col(c) for c in df.columns])


def first_wins(existing: DataFrame | None, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The table after inserting ``new`` where no row has its key; of new rows with one key the least ``order`` stays. ``inserted`` marks them.
    One combinable aggregate, so a hot key costs a row a task."""
    rows = _numbered(existing, new, order)
    best = rows.groupBy(*keys).agg(F.min_by(_whole(rows), F.struct("_new", order)).alias("r"))
    return best.select("r.*").withColumnRenamed("_new", "inserted")


def last_wins(existing: DataFrame | None, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The table after upserting ``new``; of rows with one key the greatest ``order`` stays, new before existing."""
    rows = _numbered(existing, new, order)
    best = rows.groupBy(*keys).agg(F.max_by(_whole(rows), F.struct("_new", order)).alias("r"))
    return best.select("r.*").drop("_new")


def coalesce_merge(existing: DataFrame, new: DataFrame, keys: list[str], fill: list[str]) -> DataFrame:
    """Existing rows with the columns ``fill`` taken from ``new`` where that has a value, other columns untouched; keys that aren't there yet are added whole."""
    e, n = existing.alias("e"), new.alias("n")
    on = [F.col(f"e.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    j = e.withColumn("_e", F.lit(True)).alias("e").join(n, on, "full")
    out = []
    for c in existing.columns:
        if c in keys or (c not in fill and c in new.columns):
            first = F.coalesce(F.col(f"e.{c}"), F.col(f"n.{c}")) if c in keys else F.when(F.col("e._e"), F.col(f"e.{c}")).otherwise(F.col(f"n.{c}"))
            out.append(first.alias(c))
        elif c in fill:
            out.append(F.coalesce(F.col(f"n.{c}"), F.col(f"e.{c}")).alias(c))
        else:
            out.append(F.col(f"e.{c}").alias(c))
    return j.select(*out)


def fill_missing(existing: DataFrame, new: DataFrame, keys: list[str], fill: list[str]) -> DataFrame:
    """Existing rows with null columns of ``fill`` taken from ``new``: values that are there stay."""
    add = new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in fill]).dropDuplicates(keys)
    j = existing.join(add, keys, "left")
    return j.select(*[F.coalesce(c, f"_n_{c}").alias(c) if c in fill else F.col(c) for c in existing.columns])


def queue_after(queue: DataFrame, outcomes: DataFrame, max_attempts: int = 3) -> DataFrame:
    """The download queue (url, status, attempts, last_error, sha256) after outcomes (url, ok, sha256, error, transient): done, retry while attempts are left and the
    error may pass, else failed."""
    o = outcomes.select("url", F.col("ok").alias("_ok"), F.col("sha256").alias("_sha"), F.col("error").alias("_err"), F.col("transient").alias("_tr"))
    j = queue.join(o, "url", "left")
    tried = F.col("_ok").isNotNull()
    attempts = F.col("attempts") + F.when(tried, 1).otherwise(0)
    status = F.when(~tried, F.col("status")).when(F.col("_ok"), "done").when(F.col("_tr") & (attempts < max_attempts), "retry").otherwise("failed")
    return j.select("url", status.alias("status"), attempts.alias("attempts"), F.when(tried, F.when(F.col("_ok"), None).otherwise(F.col("_err"))).otherwise(F.col("last_error")).alias("last_error"), F.coalesce("_sha", "sha256").alias("sha256"))


def pending(tasks: DataFrame, done: DataFrame, key: str = "task_id") -> DataFrame:
    """Tasks that the ledger doesn't have yet."""
    return tasks.join(done.select(key).distinct(), key, "left_anti")


def last_lookup(rows: DataFrame, key: str, found: DataFrame, found_key: str, order: str) -> DataFrame:
    """``rows`` left-joined with ``found`` by key, of rows of ``found`` that share one the last in ``order``: a lookup table filled in that order."""
    last = found.where(F.col(found_key).isNotNull()).groupBy(F.col(found_key).alias("_key")).agg(F.max_by(F.struct(*[c for c in found.columns if c != found_key]), order).alias("_found"))
    return rows.join(last, F.col(key) == F.col("_key"), "left").select(*rows.columns, "_found.*")
