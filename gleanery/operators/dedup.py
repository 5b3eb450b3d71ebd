"""Duplicate links, transitive clusters, and the greedy near-duplicate filter."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import chain, combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.media import hamming
from gleanery.operators.components import connected_components
from gleanery.operators.skew import LEAST_ROWS, join_spread
from gleanery.session import cut

METHODS = ("perceptual", "source_link", "sha256")
#: Rows up to which a cell is compared together with others; pairs of a longer one that are compared at once; pairs after which a task thins its links.
SHORT_CELL, BLOCK_PAIRS, HELD_LINKS = 48, 1 << 16, 1 << 20
#: Rows up to which the near-duplicate filter broadcasts a group's places whole: names are long, and there are three groups a round.
FEW_NAMES = 50_000


def stars(df: DataFrame, key: str, value: Column) -> DataFrame:
    """(u, v): each member of a group of equal, non-blank values with the group's least key. Two combinable aggregates: a
    hot value costs one row a task, and no pairs are made."""
    rows = _valued(df, key, value)
    return _star_links(rows, _repeated(rows))


def _valued(df: DataFrame, key: str, value: Column) -> DataFrame:
    return df.select(F.col(key).alias("v"), value.alias("g")).where("g is not null and g <> ''")


def _repeated(rows: DataFrame) -> DataFrame:
    """(g, u, n): of rows (v, g) the values that occur more than once, with their least key and number of rows."""
    return cut(rows.groupBy("g").agg(F.min("v").alias("u"), F.count("*").alias("n")).where("n > 1"))


def _star_links(rows: DataFrame, first: DataFrame) -> DataFrame:
    total = first.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return join_spread(rows, first, "g", "n", total).where("u <> v").select("u", "v")


def near_pairs(df: DataFrame, hashes: list[str], threshold: int, name: str | None = None) -> DataFrame:
    """(a, b, dist): pairs of different hash tuples that are within ``threshold`` bits on every hash, a before b. ``name``: a column of longs without
    nulls, of which a tuple's least stands for it in a and b; it goes along with the hashes, so pairs needn't be joined with names.

    The last hash is cut into threshold + 2 bands (each of every so many bits, since neighbouring ones depend on each other). A pair within the threshold has two bands
    in common on it at least, so the cells of equal choices of two bands hold all pairs; at 6 bits these are 28 cells of 16 bits. The cells' rows are shuffled once, sorted by cell and
    compared where they lie, in numpy; a pair counts in its first common cell only, so nothing is made distinct afterwards. Nothing is broadcast: the planner takes the cells for
    as small as the hashes' file."""
    if name:
        return _met(df, hashes, threshold, name=name).select(F.col(f"a_{name}").alias("a"), F.col(f"b_{name}").alias("b"), "dist")
    a, b = (F.struct(*[F.col(f"{x}_{h}").alias(h) for h in hashes]).alias(x) for x in "ab")
    return _met(df, hashes, threshold).select(a, b, "dist")


def near_links(df: DataFrame, hashes: list[str], threshold: int) -> DataFrame:
    """(a, b, dist): links between different hash tuples of which those are connected, and only those, that pairs of ``near_pairs`` connect; the least ``dist`` of a
    component's links is that of its pairs. A task of cells gives a link for each of its tuples at most (each ``HELD_LINKS`` of them, if there are more), so links don't
    grow with the square of alike hashes as pairs do."""

    def forest(pairs: pd.DataFrame) -> pd.DataFrame:
        """Of pairs (a_*, b_*, dist) a star for each component: a link to each of its tuples but one, with the least ``dist`` of that tuple's pairs. One end of a component's
        nearest pair at least isn't the star's middle, so that pair's ``dist`` stays."""
        ends = pd.DataFrame({h: np.concatenate([pairs[f"{x}_{h}"].to_numpy() for x in "ab"]) for h in hashes})
        number = ends.groupby(hashes, sort=False).ngroup().to_numpy()
        u, v = number[: len(pairs)], number[len(pairs) :]
        n = number.max(initial=-1) + 1
        place, least, root = np.empty(n, int), np.full(n, np.iinfo("int32").max, "int32"), np.arange(n)
        place[number] = np.arange(len(number))
        for side in (u, v):
            np.minimum.at(least, side, pairs["dist"].to_numpy())
        while len(u):
            low, high = np.minimum(root[u], root[v]), np.maximum(root[u], root[v])
            apart = low != high
            u, v = u[apart], v[apart]
            np.minimum.at(root, high[apart], low[apart])  # each root that has a smaller neighbour goes below one
            while (root != (up := root[root])).any():
                root = up
        node = np.flatnonzero(root != np.arange(n))
        a, b = ends.iloc[place[root[node]]], ends.iloc[place[node]]
        return pd.DataFrame({f"a_{h}": a[h].to_numpy() for h in hashes} | {f"b_{h}": b[h].to_numpy() for h in hashes} | {"dist": least[node]})

    def thinned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n > HELD_LINKS:
                held = [forest(pd.concat(held, ignore_index=True))]
                n = len(held[0])
                if n > HELD_LINKS // 2:
                    yield held[0]
                    held, n = [], 0
        if n:
            yield forest(pd.concat(held, ignore_index=True))

    a, b = (F.struct(*[F.col(f"{x}_{h}").alias(h) for h in hashes]).alias(x) for x in "ab")
    return _met(df, hashes, threshold, thinned).select(a, b, "dist")


def _met(df: DataFrame, hashes: list[str], threshold: int, thinned: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] = iter, name: str | None = None) -> DataFrame:
    """(a_*, b_*, dist) of ``near_pairs``, as ``thinned`` leaves them in each task; with ``name``, a_* and b_* are its columns alone."""
    told = [name] if name else hashes
    bands, last = threshold + 2, hashes[-1]
    masks = [sum(1 << bit for bit in range(i, 64, bands)) for i in range(bands)]
    choices = list(combinations(range(bands), 2))
    (first, second), joint = np.array(choices).T, np.array([masks[i] | masks[j] for i, j in choices], "uint64").view("int64")
    # A row holds its hashes and the number of its choice; the cell's bits are worked out where they are needed.
    tuples = df.select(*hashes, *[name] * bool(name)).dropna(subset=hashes)
    tuples = tuples.groupBy(*hashes).agg(F.min(name).cast("long").alias(name)) if name else tuples.distinct()
    cells = tuples.select("*", F.explode(F.array(*[F.lit(c).cast("tinyint") for c in range(len(choices))])).alias("c"))
    at = F.col(last).bitwiseAND(F.element_at(F.array(*[F.lit(m).cast("long") for m in joint.tolist()]), F.col("c") + 1))
    ordered = cells.repartition("c", at).sortWithinPartitions("c", at)

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = None  # rows of the last cell, of which more may follow
        for batch in chain(batches, [None]):
            rows = left if batch is None else batch if left is None else pd.concat([left, batch], ignore_index=True)
            if rows is None or rows.empty:
                continue
            c = rows["c"].to_numpy()
            bits = rows[last].to_numpy() & joint[c]
            starts = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (bits[1:] != bits[:-1])])
            whole = len(rows) if batch is None else starts[-1]
            left = rows.iloc[whole:]
            ends = np.repeat(np.r_[starts[1:], len(rows)], np.diff(np.r_[starts, len(rows)]))[:whole]
            value = {h: rows[h].to_numpy()[:whole] for h in dict.fromkeys([*hashes, *told])}
            for x, y in within_cells(value[last], starts[starts < whole], ends):
                yield close(value, first[c], second[c], x, y)

    def within_cells(bits: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions whose last hashes are near: long cells in blocks, in short ones each row against the one ``step`` rows on."""
        long, found, n = starts[ends[starts] - starts > SHORT_CELL], [], 0
        for start in long:
            end = ends[start]
            few = max(1, BLOCK_PAIRS // (end - start))
            for at in range(start, end, few):
                x, y = np.nonzero(np.bitwise_count((bits[at : min(at + few, end), None] ^ bits[None, at:end]).view(np.uint64)) <= threshold)
                found.append((at + x[x < y], at + y[x < y]))
                n += len(x)
                if n > 16 * BLOCK_PAIRS:
                    yield tuple(np.concatenate(side) for side in zip(*found, strict=True))
                    found, n = [], 0
        skip = np.zeros(len(ends), bool)
        for start in long:
            skip[start : ends[start]] = True
        own, step = np.flatnonzero(~skip), 0
        while len(own):
            step += 1
            own = own[own + step < ends[own]]
            x = own[np.bitwise_count((bits[own] ^ bits[own + step]).view(np.uint64)) <= threshold]
            found.append((x, x + step))
        if found:
            yield tuple(np.concatenate(side) for side in zip(*found, strict=True))

    def close(value: dict, i: np.ndarray, j: np.ndarray, x: np.ndarray, y: np.ndarray) -> pd.DataFrame:
        """Of pairs whose last hashes are near those that are near on the others, in their first common cell."""
        good = np.ones(len(x), bool)
        apart = {h: (value[h][x] ^ value[h][y]).view(np.uint64) for h in hashes}
        for h in hashes[:-1]:
            good &= np.bitwise_count(apart[h]) <= threshold
        for band, mask in enumerate(masks):
            good &= ~((j[x] > band) & (i[x] != band) & (apart[last] & np.uint64(mask) == 0))
        x, y = x[good], y[good]
        dist = np.max([np.bitwise_count(apart[h][good]) for h in hashes], axis=0).astype("int32")
        swap = np.zeros(len(x), bool)
        for h in reversed(hashes):
            swap = np.where(value[h][x] == value[h][y], swap, value[h][x] > value[h][y])
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        return pd.DataFrame({f"a_{h}": value[h][x] for h in told} | {f"b_{h}": value[h][y] for h in told} | {"dist": dist})

    return ordered.mapInPandas(lambda batches: thinned(compared(batches)), ", ".join(f"{x}_{h} long" for x in "ab" for h in told) + ", dist int")


def duplicate_links(df: DataFrame, threshold: int = 6, source_identity: Column | None = None) -> DataFrame:
    """(u, v): links between keys whose components are the duplicate groups, from a table (key, sha256, ahash, dhash). Perceptual
    hashes are signed 64-bit. Rows with equal hashes link to the group's least key, near ones through those keys."""
    return _links_and_proof(df, threshold, source_identity)[0]


def _links_and_proof(df: DataFrame, threshold: int, source_identity: Column | None) -> tuple[DataFrame, DataFrame]:
    """The links (u, v) and, for each group of equal values and each bundle of near ones, the evidence (u, m, s) that it gives to the group of its key u: the method's
    place in ``METHODS`` and the score. Only near links and groups of two or more are joined; rows that nobody equals are shuffled for the aggregates alone."""
    proof = lambda found, m, s: found.select("u", F.lit(m).alias("m"), s.alias("s"))
    links, proofs = [], []
    for m, score, value in ((2, 1.0, F.lower("sha256")), (1, 0.9, source_identity)):
        if value is not None:
            rows = _valued(df, "key", value)
            first = _repeated(rows)
            links.append(_star_links(rows, first))
            proofs.append(proof(first, m, F.lit(score)))
    hashed = df.where("ahash is not null and dhash is not null")
    looks = cut(hashed.groupBy("ahash", "dhash").agg(F.min("key").alias("u"), F.count("*").alias("n")))
    same = looks.where("n > 1").select(F.struct("ahash", "dhash").alias("g"), "u", "n")
    links.append(_star_links(hashed.select(F.col("key").alias("v"), F.struct("ahash", "dhash").alias("g")), same))
    proofs.append(proof(same, 0, F.lit(1.0)))
    at = looks.select(F.struct("ahash", "dhash").alias("h"), "u")
    # The planner takes links and looks for as small as the hashes' file; by a shuffle they don't pass the driver.
    near = near_links(looks, ["ahash", "dhash"], threshold).hint("merge").join(at.toDF("a", "u"), "a").hint("merge").join(at.toDF("b", "v"), "b")
    near = cut(near.select("u", "v", "dist"))
    links.append(near.select("u", "v"))
    proofs.append(proof(near.groupBy("u").agg(F.min("dist").alias("d")), 0, 1 - F.col("d") / 64.0))
    return reduce(DataFrame.unionByName, links), reduce(DataFrame.unionByName, proofs)


def clusters(df: DataFrame, threshold: int = 6, source_identity: Column | None = None) -> DataFrame:
    """(key, cluster, canonical, method, score): every member of a group of two or more.

    The method is the strongest direct evidence in the group; a digest scores 1.0, a source link 0.9, a perceptual one the
    best 1 - distance / 64 of its pairs. The canonical member has the largest area, then the least key. Evidence is
    aggregated by value and by bundles of near hashes, never by all pairs of members."""
    links, proof = _links_and_proof(df, threshold, source_identity)
    groups = cut(connected_components(links).withColumnRenamed("component", "cluster"))
    area = F.coalesce(F.when((F.col("width") != 0) & (F.col("height") != 0), F.col("width").cast("long") * F.col("height")), F.lit(0))
    member = cut(df.select("key", area.alias("area")).join(groups, F.col("key") == F.col("node")).drop("node"))
    best = member.groupBy("cluster").agg(F.min_by("key", F.struct(-F.col("area"), "key")).alias("canonical"))
    strongest = proof.join(groups, F.col("u") == F.col("node")).groupBy("cluster").agg(F.max(F.struct("m", "s")).alias("e"))
    told = best.join(strongest, "cluster").select("cluster", "canonical", F.element_at(F.array(*[F.lit(m) for m in METHODS]), F.col("e.m") + 1).alias("method"), F.col("e.s").alias("score"))
    return member.select("key", "cluster").join(told, "cluster")


def best_canonical(members: DataFrame, group: str, key: str, width: str, height: str) -> DataFrame:
    """(group, canonical): of each group the member of the largest area (0 if unknown), of those the least key."""
    area = F.coalesce(F.col(width).cast("long") * F.col(height), F.lit(0))
    return members.groupBy(group).agg(F.min_by(key, F.struct(-area, key)).alias("canonical"))


def group_rows(found: DataFrame) -> DataFrame:
    """One row for each group, with the key under which it is stored: its place by first member, method and canonical member."""
    groups = found.groupBy("cluster", "canonical", "method", "score").agg(F.count("*").alias("members"))
    return placed(groups, "cluster").withColumn("group_key", F.format_string("g%06d-%s-%s", F.col("_place"), F.col("method"), F.col("canonical"))).drop("_place")


def duplicate_report(found: DataFrame) -> DataFrame:
    """(method, groups, members)."""
    return found.groupBy("method").agg(F.count_distinct("cluster").alias("groups"), F.count("*").alias("members"))


def placed(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``_place``: its rows numbered from 0 in the order given. Rows are dealt by range and numbered within each part; only
    the parts' sizes go to the driver. ``order`` must tell rows apart, else the parts' numbering isn't stable."""
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = cut(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    sizes = dict(parts.groupBy("_part").agg(F.count("*")).collect())  # one row for each part
    before, total = [], 0
    for k in sorted(sizes):
        before += [F.lit(k), F.lit(total).cast("long")]
        total += sizes[k]
    start = F.element_at(F.create_map(*before), F.col("_part")) if before else F.lit(0)
    return parts.withColumn("_place", start + F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1).drop("_part")


def _look_links(looks: DataFrame, aspect: float, threshold: int) -> DataFrame:
    """(t, other), both ways: different looks (t, dhash, ahash, aspect) that are near. Aspects meet by shares as wide as the bound."""
    h = F.struct("dhash", "ahash")
    near = near_pairs(looks.select("dhash", "ahash"), ["dhash", "ahash"], threshold).select("a", "b")
    both = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b")))
    share = F.floor(F.col("aspect") / aspect)
    mine = looks.select(h.alias("a"), "t", F.col("aspect").alias("w"), F.explode(F.array(share - 1, share, share + 1)).alias("share"))
    theirs = looks.select(h.alias("b"), F.col("t").alias("other"), F.col("aspect").alias("x"), share.alias("share"))
    # The planner takes the looks' three shares for as small as their file; by a shuffle they don't pass the driver.
    same = mine.withColumn("b", F.col("a")).hint("merge").join(theirs, ["b", "share"])
    across = mine.hint("merge").join(both, "a").hint("merge").join(theirs, ["b", "share"])
    close = (F.abs(F.col("w") - F.col("x")) < aspect) & (F.col("t") != F.col("other"))
    return same.select("t", "other", "w", "x").unionByName(across.select("t", "other", "w", "x")).where(close).select("t", "other")


def near_dup_filter(df: DataFrame, seed: str = "42", aspect: float = 0.02, threshold: int = 3, compat_order: str | None = None, least: int = LEAST_ROWS, few: int = FEW_NAMES) -> DataFrame:
    """``df`` (key, observation, pixels, aspect, ahash, dhash) with ``reason``: null if kept, else duplicate_observation,
    duplicate_pixels or possible_near_duplicate, each against rows kept before it in seeded order (sha256 of seed and key, or the column ``compat_order``; ties
    by key, which tells rows apart).

    A row is kept if no neighbour before it is: the first independent set in that order. It is found in rounds. A row is kept once all its neighbours before it are
    rejected, and rejected once one of them is kept; both show from the least places of undecided and kept rows with its observation, its pixels, its look (hashes and
    aspect) and the looks near that. So a group of rows that are all alike costs aggregates that combine map-side, no pairs; a
    kept row leaves after the round in which it has rejected its neighbours. In random order rounds grow with the logarithm of the rows. Null
    and blank observations and pixels are nobody's, and looks need both hashes and an aspect."""
    rank = F.col(compat_order) if compat_order else F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    known = lambda c: F.when(F.trim(F.col(c).cast("string")) != "", F.col(c).cast("string"))
    rows = placed(df.select("key", rank.alias("_rank"), known("observation").alias("o"), known("pixels").alias("p"), "dhash", "ahash", F.col("aspect").cast("double").alias("aspect")), "_rank", "key")
    rows = cut(rows.withColumn("_look", F.struct("dhash", "ahash", "aspect")))
    # A look is named by the first place that has it.
    complete = F.col("dhash").isNotNull() & F.col("ahash").isNotNull() & F.col("aspect").isNotNull() & ~F.isnan("aspect")
    looks = cut(rows.where(complete).groupBy("dhash", "ahash", "aspect").agg(F.min("_place").alias("t"), F.count("*").alias("n")))
    total = rows.count()
    links = cut(_look_links(looks.drop("n"), aspect, threshold).distinct())
    named = looks.select(F.struct("dhash", "ahash", "aspect").alias("_look"), "t", "n")
    with_look = join_spread(rows.where(complete), named, "_look", "n", total, least, few=few)
    # What nobody shares has a name of its own, so that every row meets all three groups.
    alone = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.concat(F.lit("#"), F.col("_place").cast("string")))
    rows = with_look.select("key", "_place", "o", "p", "t").unionByName(rows.where(~F.coalesce(complete, F.lit(False))).select("key", "_place", "o", "p", F.col("_place").alias("t")))
    rows = cut(rows.select("key", "_place", alone("o").alias("o"), alone("p").alias("p"), "t"))

    def told(now: DataFrame) -> DataFrame:
        """``now`` with the least place of undecided or kept rows (m) and of kept ones (k) in each of its groups: m_o, k_o, m_p, k_p, m_t, k_t."""
        kept = F.min(F.when(F.col("s") == 1, F.col("_place")))
        size = now.count()
        for g in ("o", "p", "t"):
            own = now.groupBy(g).agg(F.min("_place").alias(f"m_{g}"), kept.alias(f"k_{g}"), F.count("*").alias("n"))
            if g == "t":
                near = links.join(own.drop("n").withColumnRenamed("t", "other"), "other").groupBy("t").agg(F.min("m_t").alias("m"), F.min("k_t").alias("k"))
                own = own.join(near, "t", "left").select("t", F.least("m_t", "m").alias("m_t"), F.least("k_t", "k").alias("k_t"), "n")
            now = cut(join_spread(now, cut(own), g, "n", size, least, few=few))
        return now

    now, kept_all = rows.withColumn("s", F.lit(0)), []
    while now.where("s = 0").limit(1).count():
        seen = told(now)
        gone = F.least("k_o", "k_p", "k_t") < F.col("_place")
        state = F.when(gone, -1).when(F.col("_place") == F.least("m_o", "m_p", "m_t"), 1).otherwise(0)
        new = cut(seen.where("s = 0").withColumn("s", state).where("s >= 0").select(rows.columns + ["s"]))
        kept_all.append(new.where("s = 1").select(rows.columns))
        now = new
    if not kept_all:
        return df.withColumn("reason", F.lit(None).cast("string"))
    kept = cut(reduce(DataFrame.unionByName, kept_all).select("_place").withColumn("s", F.lit(1)))
    marked = told(cut(rows.join(kept, "_place", "left").withColumn("s", F.coalesce("s", F.lit(0)))))
    why = F.when(F.col("s") == 1, None)
    for g, reason in (("o", "duplicate_observation"), ("p", "duplicate_pixels"), ("t", "possible_near_duplicate")):
        why = why.when(F.col(f"k_{g}") < F.col("_place"), reason)
    return df.join(marked.select("key", why.alias("reason")), "key", "left")
