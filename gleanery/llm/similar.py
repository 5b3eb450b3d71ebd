"""SimHash near-dedup of 5-word shingles at a Jaccard similarity of LEAST or more: op10's links, confirmed, and what they lack.

Texts with the same set of shingles are one key, so copies cost nothing. Candidates come from op10's search: keys whose
64-bit fingerprints (of the set's shingles) lie within RADIUS bits, found by its vantage-point trees. At 0.8 fingerprints lie about ten bits apart,
where no tree over 64 bits prunes; so links are completed by the sets' least hashes, and every candidate is confirmed by the whole
sets.

Least hashes: shingles have one order, those that are common in a sample last and hashes ascending otherwise. A text of n shingles has a
head, the first of them. With the first n - ceil(0.8 n) + 1, two texts at 0.8 or more must share one of their heads'. Less will do: of r
shingles that aren't common, at most d = n - ceil(0.8 n) differ, so h least hashes all differ with a chance of (d / r)^h at
most. The head ends where that is below MISS, 13 shingles if none is common; where d isn't below r it is the full one. Passages that many texts hold are
common and so lie in few heads.

A shingle's place in a head bounds what two texts share if it is the first that they do: no more than the shingles from there on. Pairs that
this keeps under 0.8 are left out; a true pair's first common shingle never does. So texts with many shingles of their own meet nobody.

Of each head shingle's keys, all are first compared with the one in whose head it stands first. Then those follow that are in different components
still, all but those of the shingle's largest component with each other: a group of near copies of one text costs about as many pairs as it has
members. What is left is the square of texts in one family that hold the same shingles early but aren't linked. Before whole sets are compared, sketches of the SKETCH least hashes are: pairs that look less than MAYBE alike go (a pair
at 0.8 does with a chance under 1e-7).

Null texts count as empty; texts without words are one key, as are texts of fewer than five words with the same words. Rows that repeat are one text. No
table, no rows: no result. Input columns with other names are never read, so none can clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm import simhash
from gleanery.llm.common import small_batches, uniform
from gleanery.operators.components import connected_components
from gleanery.operators.skew import join_spread
from gleanery.session import cut

SHINGLE = 5
#: 0.8 as a fraction of whole numbers.
LEAST = (4, 5)
#: Texts that the order is made from (about, and as a share if that is more), shingles that it puts last at most, and texts of the sample that hold such a one.
SAMPLE, SAMPLE_SHARE, COMMON, OFTEN = 5_000, 0.01, 100_000, 4
#: Chance that a text's head holds none of the shingles that it shares with a text at LEAST.
MISS = 1e-9
#: Hashes of a sketch, and the estimated similarity from which sets are compared.
SKETCH, MAYBE = 64, 0.5
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes; one of the whole sequence for a text of fewer than SHINGLE words, none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # as in simhash.fingerprint
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 7)] if words else [], np.uint64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(w) - SHINGLE + 1
    h = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        h += w[k : k + n] * _ODD[k]
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(32)
    return np.unique(h)


def head(shingles: np.ndarray, common: np.ndarray) -> np.ndarray:
    n, (a, b) = len(shingles), LEAST
    if not n:
        return shingles
    late = np.isin(shingles, common) if len(common) else np.zeros(n, bool)
    differ = n + (-a * n) // b
    r, size = n - int(late.sum()), differ + 1
    if 0 < differ < r:
        size = min(size, math.ceil(math.log(MISS) / math.log(differ / r)))
    return np.concatenate([shingles[~late], shingles[late]])[:size]


def key_of(shingles: np.ndarray) -> int:
    return int(np.array([xxhash.xxh64_intdigest(shingles.tobytes(), 3)], np.uint64).view(np.int64)[0])


def fingerprint_of(shingles: np.ndarray) -> int:
    """SimHash of the set, as a signed number: a bit is 1 if set in over half of its hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(shingles), 65536):
        ones += np.unpackbits(shingles[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(shingles), bitorder="little").view(np.int64)[0])


def sketch_of(shingles: np.ndarray) -> bytes:
    return (shingles[:SKETCH] >> np.uint64(32)).astype("<u4").tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """The estimated Jaccard similarity of two sketches; 1 for two empty ones."""
    x, y = np.unique(np.frombuffer(a, "<u4")), np.unique(np.frombuffer(b, "<u4"))
    least = np.union1d(x, y)[:SKETCH]
    if not len(least):
        return 1.0
    both = np.intersect1d(x, y, assume_unique=True)
    return float(np.searchsorted(both, least[-1], side="right")) / len(least)


def common_shingles(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Of a sample of texts, at most COMMON of the shingles that several hold, sorted."""
    share = max(SAMPLE_SHARE, SAMPLE / max(docs.count(), 1))
    some = docs.where(uniform(F.xxhash64(text)) < min(1.0, share)).select(F.col(text).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [shingle_set(t) for t in pdf["text"]]
            s, n = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64), return_counts=True)
            yield pd.DataFrame({"s": s.view(np.int64), "n": n})

    often = some.mapInPandas(run, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).where(F.col("n") >= OFTEN)
    return np.sort(np.array([r.s for r in often.orderBy(F.desc("n"), "s").limit(COMMON).collect()], np.int64).view(np.uint64))


def described(docs: DataFrame, text: str = "text") -> Column:
    """struct(key, n, fp, head, sketch) of each text: its set's hash, size, fingerprint, head and sketch."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, text))

    @F.pandas_udf("key long, n int, fp long, head array<long>, sketch binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            sets = [shingle_set(t) for t in s]
            columns = {"key": [key_of(x) for x in sets], "n": [len(x) for x in sets], "fp": [fingerprint_of(x) for x in sets]}
            yield pd.DataFrame(columns | {"head": [head(x, shared.value).view(np.int64) for x in sets], "sketch": [sketch_of(x) for x in sets]})

    return run(F.col(text))


def _maybe(pairs: DataFrame, keys: DataFrame) -> DataFrame:
    """Those of ``pairs`` (u, v) whose sketches are MAYBE alike or more."""

    @F.pandas_udf("boolean")
    def close(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([likeness(x, y) >= MAYBE for x, y in zip(a, b, strict=True)], dtype=bool)

    put = lambda side: keys.select(F.col("key").alias(side), F.col("sketch").alias(f"s{side}"))
    return pairs.join(put("v"), "v").join(put("u"), "u").where(close("su", "sv")).select("u", "v")


def _confirmed(pairs: DataFrame, keys: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (u, v) of keys that are LEAST alike or more, by the whole sets of one text of each key."""
    a, b = LEAST
    pairs = cut(_maybe(pairs, keys))

    @F.pandas_udf("binary")
    def whole(s: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t).tobytes() for t in s], dtype=object)

    @F.pandas_udf("boolean")
    def alike(x: pd.Series, y: pd.Series) -> pd.Series:
        sets = [(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)) for p, q in zip(x, y, strict=True)]
        both = [len(np.intersect1d(p, q, assume_unique=True)) for p, q in sets]
        return pd.Series([b * k >= a * (len(p) + len(q) - k) for (p, q), k in zip(sets, both, strict=True)], dtype=bool)

    named = pairs.select(F.explode(F.array("u", "v")).alias("key")).distinct()
    at = cut(keys.select("key", "doc_id", "t").join(named, "key"))
    # Several rows may have the id and the text.
    sets = cut(docs.join(at, ["doc_id", "t"]).dropDuplicates(["key"]).select("key", whole("text").alias("w")))
    put = lambda side: sets.withColumnsRenamed({"key": side, "w": f"w{side}"})
    return pairs.join(put("v"), "v").join(put("u"), "u").where(alike("wu", "wv")).select("u", "v")


def _reach(n: Column, i: Column, m: Column, j: Column) -> Column:
    """Whether sets of sizes ``n`` and ``m`` can be LEAST alike if the first shingle that they share is at ``i`` in one and ``j`` in the other."""
    a, b = LEAST
    return F.lit(a + b) * F.least(n - i, m - j) >= F.lit(a) * (n + m)


def _simhash_pairs(keys: DataFrame) -> DataFrame:
    """(u, v): of each fingerprint, the least key with the others, and the least keys of fingerprints that op10's search links."""
    least = cut(keys.groupBy("fp").agg(F.min("key").alias("low"), F.count("*").alias("n")))
    same = join_spread(keys.select("key", "fp"), least, "fp", "n", least.agg(F.sum("n")).first()[0] or 0).where("key > low")
    found = simhash.links(least.select("fp"))
    for side in ("u", "v"):
        found = found.join(least.select(F.col("fp").alias(side), F.col("low").alias(f"k{side}")), side)
    return same.select(F.col("low").alias("u"), F.col("key").alias("v")).unionByName(found.select(F.col("ku").alias("u"), F.col("kv").alias("v")))


def links(keys: DataFrame, docs: DataFrame) -> DataFrame:
    """(u, v): links between keys with the components of all pairs at LEAST or more. ``keys`` has (key, doc_id, t, n, fp, head, sketch), a row
    for each key; ``docs`` the texts by (doc_id, t)."""
    each = keys.select("key", "n", F.posexplode("head").alias("i", "s"))
    hubs = cut(each.groupBy("s").agg(F.min(F.struct("i", "key", "n")).alias("hub"), F.count("*").alias("c")).where("c > 1"))
    total = hubs.agg(F.sum("c")).first()[0] or 0
    met = cut(join_spread(each, hubs, "s", "c", total).select("s", "key", "n", "i", "hub"))

    first = met.where((F.col("key") != F.col("hub.key")) & _reach(F.col("n"), F.col("i"), F.col("hub.n"), F.col("hub.i")))
    first = first.select(F.least("key", "hub.key").alias("u"), F.greatest("key", "hub.key").alias("v"))
    near = _simhash_pairs(keys).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    tried = cut(first.unionByName(near).distinct())
    found = cut(_confirmed(tried, keys, docs))

    part = connected_components(found).withColumnRenamed("node", "key")
    left = cut(met.drop("hub").join(part, "key", "left").select("s", "key", "n", "i", F.coalesce("component", "key").alias("c")))
    parts = left.groupBy("s", "c").agg(F.count("*").alias("k")).groupBy("s").agg(F.count("*").alias("cs"), F.sum("k").alias("k"), F.max_by("c", F.struct("k", "c")).alias("most"))
    open_ = cut(parts.where("cs > 1"))
    x = cut(join_spread(left, open_.drop("cs"), "s", "k", open_.agg(F.sum("k")).first()[0] or 0))
    few = x.where("c <> most").select("s", F.col("key").alias("a"), F.col("n").alias("an"), F.col("i").alias("ai"), F.col("c").alias("ac"))
    more = x.join(few, "s").where((F.col("c") != F.col("ac")) & ((F.col("c") == F.col("most")) | (F.col("key") < F.col("a"))) & _reach(F.col("n"), F.col("i"), F.col("an"), F.col("ai")))
    more = more.select(F.least("key", "a").alias("u"), F.greatest("key", "a").alias("v")).distinct().join(tried, ["u", "v"], "left_anti")
    return found.unionByName(_confirmed(more, keys, docs))


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, t, component) of each different row with an id: ``t`` is xxhash64 of its text, ``component`` the same for all rows of one group of near
    copies."""
    own = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = cut(own.select("doc_id", F.xxhash64("text").alias("t"), described(own).alias("d")).select("doc_id", "t", "d.*"))
    keys = cut(rows.groupBy("key").agg(F.min(F.struct("doc_id", "t", "n", "fp", "head", "sketch")).alias("r")).select("key", "r.*"))
    group = connected_components(cut(links(keys, own.withColumn("t", F.xxhash64("text"))).distinct())).withColumnRenamed("node", "key")
    of = cut(keys.select("key").join(group, "key", "left").select("key", F.coalesce("component", "key").alias("component")))
    counts = of.join(rows.groupBy("key").agg(F.count("*").alias("n")), "key")
    return join_spread(rows.select("doc_id", "t", "key"), counts, "key", "n", rows.count()).select("doc_id", "t", "component").distinct()
