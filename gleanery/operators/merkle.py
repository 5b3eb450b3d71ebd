"""Digests of whole tables as trees whose depth grows with the table, and the difference of two snapshots by descending where they differ.

A row's digest decides where it lies: equal rows are first counted (map-side, so a row that repeats a third of the table costs one row a
task), then different ones are dealt to 16 ** depth leaves of about LEAF rows by the leading digits of their digests. A node's digest covers its 16 children's.
So a tree is the same however the table is partitioned, no task gathers more than a leaf, and the levels above shrink by 16 each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.session import cut

#: Different rows of a leaf, about.
LEAF = 1024
DEEPEST = 12


def row_digests(df: DataFrame, text: Column) -> DataFrame:
    """(d, n): the digest of each different row text, and how many rows have it. Null texts are told from empty ones."""
    own = F.sha2(F.coalesce(F.concat(F.lit("="), text), F.lit("")), 256)
    return df.select(own.alias("d")).groupBy("d").agg(F.count("*").alias("n"))


def depth_for(rows: int, leaf: int = LEAF) -> int:
    """The least depth at which leaves have ``leaf`` rows or fewer on average."""
    depth = 0
    while rows > leaf * 16**depth and depth < DEEPEST:
        depth += 1
    return depth


def tree(df: DataFrame, text: Column, depth: int | None = None, leaf: int = LEAF) -> DataFrame:
    """(level, prefix, rows, digest) of all nodes, the root at level 0; ``depth`` from the number of different rows unless given. An empty table has a root
    of no rows."""
    own = cut(row_digests(df, text))
    depth = depth_for(own.count(), leaf) if depth is None else depth
    sealed = lambda parts: F.sha2(F.array_join(F.array_sort(F.collect_list(parts)), ","), 256).alias("digest")
    leaves = own.groupBy(F.substring("d", 1, depth).alias("prefix")).agg(F.sum("n").alias("rows"), sealed(F.concat_ws(":", "d", F.col("n").cast("string"))))
    levels = [cut(leaves.select(F.lit(depth).alias("level"), "prefix", "rows", "digest"))]
    for level in range(depth - 1, -1, -1):
        up = levels[-1].groupBy(F.substring("prefix", 1, level).alias("prefix")).agg(F.sum("rows").alias("rows"), sealed(F.concat_ws(":", "prefix", "digest")))
        levels.append(cut(up.select(F.lit(level).alias("level"), "prefix", "rows", "digest")))
    if not levels[-1].limit(1).count():
        spark = df.sparkSession
        levels.append(spark.range(1).select(F.lit(0).alias("level"), F.lit("").alias("prefix"), F.lit(0).cast("long").alias("rows"), F.sha2(F.lit(""), 256).alias("digest")))
    return reduce(DataFrame.unionByName, levels)


def root(nodes: DataFrame) -> DataFrame:
    """(rows, digest) of the whole table."""
    return nodes.where("level = 0").select("rows", "digest")


def differing_leaves(a: DataFrame, b: DataFrame, depth: int) -> DataFrame:
    """(prefix) of leaves that differ between two trees of one depth: level by level, the children of nodes that differ only."""
    left, right = (t.select("level", "prefix", "digest") for t in (a, b))
    found = None
    for level in range(depth + 1):
        x, y = (t.where(F.col("level") == level).select("prefix", "digest") for t in (left, right))
        if found is not None:
            up = found.withColumnRenamed("prefix", "up")
            x, y = (t.join(up, F.substring("prefix", 1, level - 1) == F.col("up"), "left_semi") for t in (x, y))
        both = x.join(y.withColumnRenamed("digest", "other"), "prefix", "full").where(~F.col("digest").eqNullSafe(F.col("other")))
        found = cut(both.select("prefix"))
    return found


def difference(a: DataFrame, b: DataFrame, text: Column, depth: int | None = None, trees: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Rows of ``a`` that ``b`` lacks (side ``a``) and the other way round, as often as the counts differ in ``times``. Only rows of leaves that differ
    are compared; with ``trees`` (of ``depth``) built before, that is all the work."""
    if trees is None:
        # The same depth on both sides, so that leaves can be compared.
        depth = depth_for(max(a.count(), b.count())) if depth is None else depth
        trees = cut(tree(a, text, depth)), cut(tree(b, text, depth))
    leaves = differing_leaves(*trees, depth)
    own = F.sha2(F.coalesce(F.concat(F.lit("="), text), F.lit("")), 256)
    held = lambda df: df.withColumn("_d", own).join(leaves, F.substring("_d", 1, depth) == F.col("prefix"), "left_semi").groupBy(*df.columns).agg(F.count("*").alias("times"), F.first("_d").alias("_d"))
    x, y = cut(held(a)), cut(held(b))

    def more(this: DataFrame, that: DataFrame, side: str) -> DataFrame:
        other = that.select("_d", F.col("times").alias("_t"))
        left = this.join(other, "_d", "left").withColumn("times", F.col("times") - F.coalesce("_t", F.lit(0))).where("times > 0")
        return left.select(F.lit(side).alias("side"), *a.columns, "times")

    return more(x, y, "a").unionByName(more(y, x, "b"))
