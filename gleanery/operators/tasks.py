"""Splits, samples, shortlists and task tables. Seeded order is sha256 of seed, scope and key: the same on every engine."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType


def seeded(seed: int, *parts: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]), 256)


def gallery_query_split(df: DataFrame, per_taxon: int = 4, seed: int = 42, min_width: int = 150) -> DataFrame:
    """Gallery and query rows of ``df`` (taxon, sha256, observation_id, source_media_id, width), marked in ``split``.

    A taxon's gallery row is its first full-size one by media id as text; query rows share neither digest nor observation with it, where two
    unknown observations count as one."""
    order = [F.when(F.coalesce("width", F.lit(0)) >= min_width, 0).otherwise(1), F.coalesce(F.col("source_media_id").cast("string"), F.lit("")), F.col("sha256"), F.to_json(F.struct(*df.columns))]
    by_rank = Window.partitionBy("taxon").orderBy(*order)
    whole = Window.partitionBy("taxon")
    ranked = df.withColumn("_r", F.row_number().over(by_rank))
    first = F.when(F.col("_r") == 1, F.struct("sha256", "observation_id"))
    ranked = ranked.withColumn("_g", F.max(first).over(whole))
    free = (F.col("_r") > 1) & ~F.col("sha256").eqNullSafe(F.col("_g.sha256")) & ~F.col("observation_id").eqNullSafe(F.col("_g.observation_id"))
    shuffled = Window.partitionBy("taxon", "_free").orderBy(seeded(seed, F.col("taxon"), F.col("sha256")), "_r")
    ranked = ranked.withColumn("_free", free).withColumn("_q", F.row_number().over(shuffled))
    split = F.when(F.col("_r") == 1, "gallery").when(F.col("_free") & (F.col("_q") <= per_taxon), "query")
    return ranked.withColumn("split", split).where("split is not null").drop("_r", "_g", "_free", "_q")


def split_leaks(split: DataFrame) -> DataFrame:
    """Query rows whose digest or (known) observation is in the gallery: must be empty."""
    g = split.where("split = 'gallery'")
    q = split.where("split = 'query'")
    by_sha = q.join(g.select("sha256").distinct(), "sha256", "left_semi").select(q.columns)
    by_obs = q.join(g.select("observation_id").where("observation_id is not null").distinct(), "observation_id", "left_semi").select(q.columns)
    return by_sha.unionByName(by_obs).distinct()


def round_robin(df: DataFrame, limit: int | None, seed: int = 42, key: str = "task_id", group: str = "correct_taxon") -> DataFrame:
    """Tasks by turns: the first of every group in seeded order, then the second of each, up to ``limit``; ``turn`` and ``place`` tell the order."""
    if limit is not None and limit <= 0:
        raise ValueError("limit must be positive")
    turn = F.row_number().over(Window.partitionBy(group).orderBy(seeded(seed, F.col(group), F.col(key)), key)) - 1
    out = df.withColumn("turn", turn).withColumn("place", seeded(seed, F.col(group)))
    return out.orderBy("turn", "place", group, key).limit(limit) if limit else out


def _ranked_pool(rows: DataFrame, taxa: DataFrame, seed: int, tier: Column) -> DataFrame:
    """Each row's possible distractors with tier and seeded rank within it. Candidates come from ``taxa`` (name, genus,
    family) as a broadcast list, which the suite bounds (every task shows all of it anyway)."""
    pool = rows.join(F.broadcast(taxa.select(F.col("name").alias("cand"), F.col("genus").alias("cand_genus"), F.col("family").alias("cand_family"))), F.col("cand") != F.col("correct"))
    h = seeded(seed, F.col("row_id"), F.col("cand"))
    return pool.withColumn("tier", tier).withColumn("h", h).withColumn("rank", F.row_number().over(Window.partitionBy("row_id", "tier").orderBy("h", "cand")))


def shortlist(rows: DataFrame, taxa: DataFrame, mode: str, size: int = 20, same_family: int = 9, seed: int = 42) -> DataFrame:
    """(row_id, correct, candidates, n_congener, n_family) for rows (row_id, correct, genus, family).

    ``mixed``: up to ``same_family`` of the family, then others, filled up from the family, in seeded order. ``hard``: congeners,
    then family, then any; ``random``: any; both sorted by name."""
    if not 2 <= size <= 20:
        raise ValueError("size must be 2..20")
    kin = F.coalesce(F.col("cand_family") == F.col("family"), F.lit(False)) & (F.coalesce("family", F.lit("")) != "")
    con = F.coalesce(F.col("cand_genus") == F.col("genus"), F.lit(False))
    tier = {"mixed": F.when(kin, 0).otherwise(1), "hard": F.when(con, 0).when(kin, 1).otherwise(2), "random": F.lit(0)}[mode]
    pool = _ranked_pool(rows, taxa, seed, tier)
    if mode == "mixed":  # family beyond its share only fills up
        pool = pool.withColumn("tier", F.when((F.col("tier") == 0) & (F.col("rank") > min(same_family, size - 1)), 2).otherwise(F.col("tier")))
    place = F.row_number().over(Window.partitionBy("row_id").orderBy("tier", "h", "cand"))
    chosen = pool.withColumn("place", place).where(F.col("place") <= size - 1)
    picked = chosen.groupBy("row_id").agg(F.collect_list(F.struct("h", "cand")).alias("c"), F.count_if(con).alias("n_congener"), F.count_if(kin & ~con).alias("n_family"))
    out = rows.join(picked, "row_id", "left")
    own = F.struct(seeded(seed, F.col("row_id"), F.col("correct")).alias("h"), F.col("correct").alias("cand"))
    every = F.concat(F.coalesce("c", F.array().cast("array<struct<h:string,cand:string>>")), F.array(own))
    names = F.transform(F.array_sort(every), lambda s: s["cand"])
    names = names if mode == "mixed" else F.array_sort(names)
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("row_id", "correct", names.alias("candidates"), zero("n_congener"), zero("n_family"))


def build_tasks(taxa: DataFrame, media: DataFrame, suite: str, imaged_only: bool = True) -> DataFrame:
    """One closed-set task for each taxon: its media row with the least digest; taxa without one are left out, or (``imaged_only`` false)
    come with null media for a gate to report."""
    least = media.where("taxon <> ''").groupBy("taxon").agg(F.min(F.struct("sha256", *[c for c in media.columns if c not in ("taxon", "sha256")])).alias("m"))
    kept = taxa.join(least, "taxon", "inner" if imaged_only else "left")
    task_id = F.concat(F.lit(f"{suite}:"), F.replace("taxon", F.lit(" "), F.lit("_")))
    return kept.select(task_id.alias("task_id"), F.col("taxon").alias("correct_taxon"), "family", "m.*")


def relabel(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Tasks (task_id, correct_taxon, candidates) with every candidate and the answer as ``Common (Latin)`` where a common name is known; ``latin`` keeps the answer's
    own name. ``names``: (taxon, common_name), of repeated taxa the least common name. A join on names of any number: the planner broadcasts them if they are few."""
    known = names.where("common_name <> ''").groupBy(F.col("taxon").alias("_taxon")).agg(F.min("common_name").alias("_common"))
    each = rows.select("task_id", F.posexplode(F.concat(F.array("correct_taxon"), "candidates")).alias("_at", "_name"))
    label = F.coalesce(F.concat("_common", F.lit(" ("), "_name", F.lit(")")), F.col("_name"))
    told = each.join(known, F.col("_name") == F.col("_taxon"), "left").groupBy("task_id").agg(F.array_sort(F.collect_list(F.struct("_at", label.alias("label")))).alias("_all"))
    labels = F.transform("_all", lambda x: x["label"])
    others = [c for c in rows.columns if c not in ("correct_taxon", "candidates")]
    return rows.join(told, "task_id").select(*others, F.get(labels, F.lit(0)).alias("correct_taxon"), F.slice(labels, F.lit(2), F.size("candidates")).alias("candidates"), F.col("correct_taxon").alias("latin"))


def python_order(rows: DataFrame, seed: int, scope: str, items: str, take: int) -> DataFrame:
    """``rows`` with ``picked``: ``take`` of the array ``items`` in the order of Python's generator seeded with ``seed:scope``, over the sorted
    items: exact parity with published row-local shortlists, where the seeded hash order isn't wanted."""
    @F.pandas_udf(ArrayType(StringType()))
    def draw(keys: pd.Series, pools: pd.Series) -> pd.Series:
        out = []
        for k, pool in zip(keys, pools, strict=True):
            own = sorted(pool)
            out.append(random.Random(f"{seed}:{k}").sample(own, min(take, len(own))))
        return pd.Series(out, dtype=object)

    return rows.withColumn("picked", draw(F.col(scope).cast("string"), F.col(items)))
