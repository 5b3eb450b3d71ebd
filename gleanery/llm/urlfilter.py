"""URL filters by a cascade of Bloom filters, with DataFrame functions only.

Rules are keys ``host + path prefix``. A URL's candidate keys are all suffixes of its host at label borders, each
with the prefixes of its path at the lengths that rule paths have; its rule is the longest candidate that is listed.

Membership is exact without a join. Level 1 encodes the listed keys. Over the complete universe of candidate keys
in the corpus, the unlisted ones that level 1 lets through are level 2's keys, the listed ones that level 2 lets
through are level 3's, and so on until none are left. A key belongs to the list if the first level that lacks it
has an even number, or if no level lacks it and the number of levels is odd. One cascade holds the blocked keys and one the
allowed ones.

A level's rate of false positives follows from how many keys it must keep out, so that about as many pass as it encodes: a cascade has some
1.5 bits a listed key for each doubling of the universe, whatever the corpus's size. It travels as literals. Lists whose cascades would pass
MAX_FILTER_BYTES are dealt into parts by key, each with cascades of its own and a pass over the pages, so there is no size at which a join takes over.

Null, malformed and very long URLs, repeated rows and empty tables: see ``judge``. Of a key that is listed twice the first verdict by text counts.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import fresh, table
from gleanery.session import cut

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Hashes of a level at least and at most; each takes 1.5 bits a key.
HASHES = (4, 30)
#: Literals of one pass, in all (about).
MAX_FILTER_BYTES = 16 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host is after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path goes on up to
    ``?``, ``#`` or the end. Both are empty for null and for a URL without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + F.lit(3), F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(raw) + F.lit(1), F.length(rest)), r"^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def candidates(host: Column, path: Column, lengths: list[int]) -> Column:
    """All keys under which a rule for this URL could be listed."""
    labels = F.split(host, r"\.", -1)
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    paths = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]), lambda p: p.isNotNull())
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))
    return F.when(host != "", keys).otherwise(F.array().cast("array<string>"))


def _positions(key: Column, bits: int, level: int, hashes: int) -> list[Column]:
    a = F.pmod(F.xxhash64(key, F.lit(2 * level)), F.lit(bits))
    b = F.pmod(F.xxhash64(key, F.lit(2 * level + 1)), F.lit(bits - 1)) + 1
    return [F.pmod(a + F.lit(j) * b, F.lit(bits)) for j in range(hashes)]


@dataclass
class Level:
    bits: int
    hashes: int
    words: list[int]

    def has(self, key: Column, number: int) -> Column:
        array = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")  # folded into one literal
        hit = F.lit(True)
        for p in _positions(key, self.bits, number, self.hashes):
            hit = hit & (F.call_function("getbit", F.get(array, F.shiftright(p, 6).cast("int")), F.pmod(p, F.lit(64)).cast("int")) == 1)
        return hit


def _encode(keys: DataFrame, n: int, against: int, number: int) -> Level:
    """The level numbered ``number`` of ``n`` keys, about as many of ``against`` others passing. Later levels have more hashes, so the keys run out."""
    hashes = min(HASHES[1], max(HASHES[0], math.ceil(math.log2(1 + against / n))) + number // 4)
    bits = -(-int(n * hashes * 1.5 + 64) // 64) * 64
    spread = keys.select(F.explode(F.array(*_positions(F.col("key"), bits, number, hashes))).alias("p"))
    mask = F.expr("shiftleft(1L, cast(p % 64 as int))")
    rows = spread.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(mask).alias("m")).collect()  # bits / 64 rows at most
    words = [0] * (bits // 64)
    for r in rows:
        words[r.w] = r.m
    return Level(bits, hashes, words)


def build_cascade(universe: DataFrame) -> list[Level]:
    """Levels for a table (key, listed) that holds every key that will be asked for, once each."""
    levels: list[Level] = []
    inside, outside = universe.where("listed"), universe.where("not listed")
    n, against = inside.count(), outside.count()
    while n:
        level = _encode(inside, n, against, len(levels))
        inside, outside = outside.where(level.has(F.col("key"), len(levels))), inside
        levels.append(level)
        n, against = inside.count(), n
    return levels


def member(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed."""
    out = F.lit(len(levels) % 2 == 1)
    for number in range(len(levels) - 1, -1, -1):
        out = F.when(~levels[number].has(key, number), F.lit(number % 2 == 1)).otherwise(out)
    return out


def _kept(keys: Column, levels: list[Level]) -> Column:
    return F.filter(keys, lambda k: member(levels, k))


def _longest(keys: Column) -> Column:
    """The longest key of an array, null for none; keys of one URL that are equally long are told apart by text."""
    return F.array_max(F.transform(keys, lambda k: F.struct(F.length(k).alias("n"), k.alias("k")))).getField("k")


def judge(pages: DataFrame, rules=RULES, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (null if none fits) and verdict. ``rules`` is a list of (verdict, key) or, for
    lists that don't fit the driver, a DataFrame of them. A rule fits its host and all subdomains if the path starts with its path;
    the longest wins. URLs that no rule fits get ``default``. All rows are kept as they are, repeated ones and those with very long URLs too; of input
    columns with these four names, the new ones replace them, all others stay. Null and malformed URLs have an empty host and path and so
    no rule."""
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        one = F.array(*[F.struct(F.lit(v).alias("verdict"), F.lit(k).alias("key")) for v, k in rules] or [F.struct(F.lit(None).cast("string").alias("verdict"), F.lit(None).cast("string").alias("key"))])
        rules = spark.range(1).select(F.explode(one).alias("r")).select("r.*")
    listed = rules.toDF("verdict", "key").where("key is not null").groupBy("key").agg(F.min("verdict").alias("verdict"))
    lengths, n = sorted(r.n for r in listed.select((F.length("key") - F.instr("key", "/") + 1).alias("n")).distinct().collect()), listed.count()
    host, path = url_parts(F.col(url))
    if not lengths:
        return pages.withColumns({"host": host, "path": path, "rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    seen = pages.select(host.alias("h"), F.substring(path, 1, max(lengths)).alias("p")).distinct()
    universe = seen.select(F.explode(candidates(F.col("h"), F.col("p"), lengths)).alias("key")).select("key", F.lit(None).cast("string").alias("verdict"))
    universe = cut(universe.unionByName(listed.select("key", "verdict")).groupBy("key").agg(F.max("verdict").alias("verdict")))
    parts = max(1, math.ceil(n * 1.5 * math.log2(2 + universe.count() / n) / 8 / MAX_FILTER_BYTES))
    part = lambda key: F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(parts))
    (best,) = fresh(pages, "best")
    out = pages.withColumn(best, F.lit(None).cast("struct<n: int, k: string, v: string>"))
    for number in range(parts):
        mine = universe.where(part(F.col("key")) == number) if parts > 1 else universe
        cascades = {v: build_cascade(mine.select("key", F.coalesce(F.col("verdict") == v, F.lit(False)).alias("listed"))) for v in ("block", "allow")}
        keys = candidates(host, path, lengths)
        keys = F.filter(keys, lambda k: part(k) == number) if parts > 1 else keys  # noqa: B023  called at once
        found = {v: _longest(_kept(keys, c)) for v, c in cascades.items()}
        hits = F.array(F.col(best), *[F.struct(F.length(k).alias("n"), k.alias("k"), F.lit(v).alias("v")) for v, k in found.items()])
        out = out.withColumn(best, F.array_max(F.filter(hits, lambda s: s["k"].isNotNull())))
        out = cut(out) if parts > 1 else out
    out = out.withColumns({"host": host, "path": path, "rule": F.col(best)["k"], "verdict": F.coalesce(F.col(best)["v"], F.lit(default))})
    return out.drop(best)


def op2_urlfilter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = r"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM u),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM r),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
f AS (SELECT page_id, host, path, CASE
        WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM f
"""
