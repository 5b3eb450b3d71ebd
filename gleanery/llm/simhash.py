"""SimHash near-dedup with vantage-point trees.

A document's 64-bit fingerprint is the majority, bit by bit, of the XXH64 values of its 3-word shingles. Two
fingerprints link at RADIUS or fewer differing bits; groups are the connected components of those links.

Search. Equal fingerprints are collapsed first, so copies cost nothing. A pair within RADIUS bits differs in at
most RADIUS // 2 bits in one half of the fingerprint, so two vantage-point trees, one over each 32-bit half,
see every pair with a radius of 1 instead of 3. A tree node holds a vantage value and a threshold: fingerprints
at most that far from it go inside, the others outside. By the triangle inequality a pair that the node parts
has its outer member at most ``radius`` beyond the threshold, so only that boundary shell is also sent inside,
as guests. Trees are fitted on a bounded sample and only route: whatever the sample, every pair meets in a leaf.

A leaf holds the fingerprints of one shard; where the sample's trees leave it large, trees of its own split it on. It searches them by their full distance to a vantage point of its own,
comparing only those whose distances differ by RADIUS or less, in blocks of bounded memory, and returns a forest
of links (at most one link per member and part), never all pairs.

Nulls, ids that repeat, empty tables and other columns: see ``near_duplicates``. Long texts are read whole, 65,536 hashes at a time; a bit that is set in exactly half of
the hashes is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import small_batches, table, uniform
from gleanery.operators.components import connected_components
from gleanery.operators.skew import join_spread
from gleanery.session import cut

RADIUS = 3
SHINGLE = 3
#: Distinct fingerprints that fit the trees, at most (about): a bound on what the driver gets.
TREE_SAMPLE = 20_000
#: Fingerprints that a leaf should hold, and the share of a shard up to which a part of it counts as smaller.
LEAF, SHRINK = 1024, 0.8
_POWERS = (1 << np.arange(63, -1, -1, dtype=np.uint64)).astype(np.uint64)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """0 for a text without words; the hash of the whole sequence for one of fewer than ``size`` words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return digest(b" ".join(words), 42)
    if size == 3:
        hashes = [digest(b"%b %b %b" % t, 42) for t in zip(words, words[1:], words[2:], strict=False)]
    else:
        hashes = [digest(b" ".join(words[i : i + size]), 42) for i in range(len(words) - size + 1)]
    n = len(hashes)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        block = np.array(hashes[at : at + 65536], dtype=">u8").view(np.uint8)
        ones += np.unpackbits(block.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(_POWERS[ones * 2 > n].sum())


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, text: str = "text"):
    """A bigint column: the fingerprint's 64 bits, as a signed number."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(_signed(np.fromiter((fingerprint(t) for t in s), np.uint64, len(s))))

    return run(F.col(text))


@dataclass
class Node:
    """``inner`` is None in a leaf, which then has its number in ``leaf``."""

    leaf: int = -1
    vantage: int = 0
    reach: int = 0
    inner: Node | None = None
    outer: Node | None = None


def build_tree(halves: np.ndarray, leaf: float, seed: int = 11) -> tuple[Node, int]:
    """A vantage-point tree over sampled 32-bit values; ``leaf`` is the sample size at which a node is split no more."""
    rng = np.random.default_rng(seed)
    count = 0

    def grow(values: np.ndarray) -> Node:
        nonlocal count
        if len(values) > leaf and len(np.unique(values)) > 1:
            best = None
            for v in rng.choice(values, min(12, len(values)), replace=False):
                d = np.bitwise_count(values ^ v).astype(np.int64)
                for reach in np.unique(np.quantile(d, (0.4, 0.5, 0.6)).astype(np.int64)):
                    inside = (d <= reach).sum()
                    if 0 < inside < len(values):
                        cost = max(inside, len(values) - inside) + 1.5 * (d == reach + 1).sum()
                        if best is None or cost < best[0]:
                            best = cost, int(v), int(reach), d
            if best is not None:
                _, v, reach, d = best
                return Node(vantage=v, reach=reach, inner=grow(values[d <= reach]), outer=grow(values[d > reach]))
        count += 1
        return Node(leaf=count - 1)

    root = grow(np.asarray(halves, np.uint32))
    return root, count


def route(root: Node, halves: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, leaf, home) of every visit: one home leaf each, and the leaves to go to as a guest."""
    at, leaves, homes = [], [], []

    def down(node: Node, index: np.ndarray, home: np.ndarray) -> None:
        if not len(index):
            return
        if node.inner is None:
            at.append(index)
            leaves.append(np.full(len(index), node.leaf))
            homes.append(home)
            return
        d = np.bitwise_count(halves[index] ^ np.uint32(node.vantage)).astype(np.int64)
        near, shell = d <= node.reach, (d > node.reach) & (d <= node.reach + radius)
        down(node.inner, np.concatenate([index[near], index[shell]]), np.concatenate([home[near], np.zeros(shell.sum(), bool)]))
        down(node.outer, index[~near], home[~near])

    down(root, np.arange(len(halves)), np.ones(len(halves), bool))
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return np.concatenate(at), np.concatenate(leaves), np.concatenate(homes)


def link_forest(values: np.ndarray, radius: int = RADIUS, block: int = 1 << 22) -> np.ndarray:
    """Links (i, j), at most len - 1, whose components are those of all pairs within ``radius`` bits.

    Members are sorted by their distance to a vantage point and tested only against the run whose distance differs by
    ``radius`` or less: the triangle inequality rules out the rest."""
    n = len(values)
    if n < 2:
        return np.zeros((0, 2), np.int64)
    d = np.bitwise_count(values ^ values[0]).astype(np.int64)
    order = np.argsort(d, kind="stable")
    v, d = values[order], d[order]
    end = np.searchsorted(d, d + radius, side="right")
    group, links, lo = np.arange(n), [], 0
    while lo < n - 1:
        hi = min(n, lo + max(1, block // max(1, int(end[lo]) - lo)))
        for start in range(lo, int(end[hi - 1]), block):  # one row alone may be longer than a block
            stop = min(int(end[hi - 1]), start + block)
            close = np.bitwise_count(v[lo:hi, None] ^ v[None, start:stop]) <= radius
            for i in np.nonzero(close.sum(axis=1) > 1)[0] if start == lo else range(hi - lo):
                near = start + np.nonzero(close[i])[0]
                others, first = np.unique(group[near], return_index=True)
                apart = others != group[lo + i]
                if apart.any():
                    links += [(order[lo + i], order[k]) for k in near[first[apart]]]
                    group[np.isin(group, others)] = others.min()
        lo = hi
    return np.array(links, np.int64).reshape(-1, 2)


def shard_links(values: np.ndarray, shift: int, radius: int = RADIUS, leaf: int = LEAF, sizes: list[int] | None = None) -> np.ndarray:
    """Links (i, j) whose components are those of all pairs within ``radius`` bits that differ in radius // 2 bits or less of the half at
    ``shift``.

    A shard of over 4 x leaf values is split again by trees of its own: first over that half, and what no such tree parts any more, equal or near halves,
    over the other half, in which a pair differs in ``radius`` bits at most. So time grows with the shard's size, not its square. ``sizes`` collects
    the sizes that were searched."""
    out, todo = [], [(np.arange(len(values)), shift, radius // 2, False)]
    while todo:
        index, at, reach, other = todo.pop()
        parts = []
        if len(index) > 4 * leaf:
            half = (values[index] >> np.uint64(at)).astype(np.uint32)
            some = half if len(half) <= TREE_SAMPLE else np.random.default_rng(len(half)).choice(half, TREE_SAMPLE, replace=False)
            tree, _ = build_tree(some, max(2.0, leaf * len(some) / len(half)))
            where, leaves, _ = route(tree, half, reach)
            order = np.argsort(leaves, kind="stable")
            parts = [index[p] for p in np.split(where[order], np.nonzero(np.diff(leaves[order]))[0] + 1)]
            if max(map(len, parts)) > SHRINK * len(index):  # hardly parted
                parts = []
                if not other:
                    todo.append((index, 32 - at, radius, True))
                    continue
        if parts:
            todo += [(p, at, reach, other) for p in parts]
        else:
            got = link_forest(values[index], radius)
            out.append(index[got])
            if sizes is not None:
                sizes.append(len(index))
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def links(prints: DataFrame, radius: int = RADIUS, leaf: int = LEAF, sample: int = TREE_SAMPLE) -> DataFrame:
    """(u, v): links between distinct fingerprints (column ``fp``, bigint, distinct) with the components of all pairs
    within ``radius`` bits."""
    spark = prints.sparkSession
    n = prints.count()
    drawn = [r.fp for r in prints.where(uniform(F.col("fp")) < min(1.0, sample / max(n, 1))).select("fp").collect()]
    some = np.array(sorted(drawn), np.int64).view(np.uint64)
    least = max(2.0, leaf * len(some) / max(n, 1))
    trees = [build_tree((some >> np.uint64(shift)).astype(np.uint32), least, seed)[0] for shift, seed in ((0, 3), (32, 5))]
    shared = spark.sparkContext.broadcast(trees)
    half = radius // 2

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = pdf["fp"].to_numpy(np.int64)
            bits = fp.view(np.uint64)
            for t, tree in enumerate(shared.value):
                at, leaves, home = route(tree, (bits >> np.uint64(32 * t)).astype(np.uint32), half)
                yield pd.DataFrame({"tree": np.full(len(at), t, np.int32), "leaf": leaves.astype(np.int32), "home": home, "fp": fp[at]})

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        # Guests needn't be told from residents: a link between two guests is true as well.
        fp = np.unique(pdf["fp"].to_numpy(np.int64))
        got = shard_links(fp.view(np.uint64), 32 * int(pdf["tree"].iloc[0]), radius, leaf)
        return pd.DataFrame({"u": fp[got[:, 0]], "v": fp[got[:, 1]]})

    sent = prints.select("fp").mapInPandas(visits, "tree int, leaf int, home boolean, fp long")
    return sent.groupBy("tree", "leaf").applyInPandas(search, "u long, v long")


def components(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component): the group of each distinct fingerprint of ``prints``, by its least linked one."""
    distinct = cut(prints.select("fp").distinct())
    groups = connected_components(cut(links(distinct, radius).distinct()))
    return distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): one row per document; component_id is the least doc_id of its group.

    Documents without words share fingerprint 0 and link like any other. Null texts count as empty; repeated rows
    come out as often as they go in; a null doc_id keeps its fingerprint and gets its group's id. Other columns are never read, whatever
    their names. Empty in, empty out. A graph whose components don't settle in 60 rounds (a path of some 2 ** 60 links) raises an error."""
    prints = cut(docs.select("doc_id", fingerprints(docs, text).alias("fp")))
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    groups = connected_components(cut(links(distinct, radius).distinct()))
    # Each fingerprint's group, then the least document of each group.
    of = distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", "n", F.coalesce("component", "fp").alias("component"))
    name = of.groupBy("component").agg(F.min("least").alias("component_id"))
    named = cut(of.join(name, "component").select("fp", "component_id", "n"))
    # A fingerprint that very many documents share stays with its rows.
    return join_spread(prints, named, "fp", "n", prints.count()).select("doc_id", "fp", "component_id")


def op10_simhash(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
