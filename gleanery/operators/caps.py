"""Greedy capped selection: rows are taken in order, and a row that one cap rejects uses up no other.

``select`` is exact at any size. Where every unit of work (a group whose counters no other group shares) is at most
``in_memory`` rows, one ordered pass per group does it. Otherwise rows are dealt by ranges of their order into parts of about ``part_rows``, which are
settled side by side, each from the counters of its keys that the parts before it leave. These are first taken to be nothing; then what the parts took is added up, key by
key over the parts, and parts to which some counter, up to its cap, comes otherwise than they had it are settled again, until none is. The first part is right from the
start, and each round at least the next one that was wrong; then counters and rows agree all along, which only the plain loop's result does. Keys whose
cap is full tell no more, so it mostly takes a few rounds. No task holds more than a part, whatever key its rows have.

Rows are shuffled when they are dealt, when each part's keys are numbered and when their reasons come back; in between a round moves only arrays, of the keys' numbers in each wrong part and of counters. In a
part a row to which a full counter comes needs no pass: it can't be taken, and its reason is the first cap whose key filled before it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gleanery.functions import licenses, media
from gleanery.session import cut, uncut

#: Rows of a group that one ordered pass may take; those of a selection whose caps run across all groups; rows of a part.
IN_MEMORY_ROWS, ALONE_ROWS, PART_ROWS = 100_000, 20_000, 1_000_000
#: Rows that an ordered pass over several small groups should take.
PASS_ROWS = 20_000
#: Rows of a part whose reasons come back in one row.
TOLD_ROWS = 256


def select(df: DataFrame, order: list[str], caps: dict[str, tuple[list[str], int]], within: list[str] | None = None, in_memory: int | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """``df`` with ``reason``: null for rows taken, else the first cap (in the order given) that was full.

    ``caps``: name -> (key columns, most rows taken for each key). Key columns are compared as text, null as a key of its
    own. ``within``: columns that every cap's key contains, so that groups by them are independent. Rows that tie on ``order`` are
    taken by all their columns' text."""
    keys = {f"_k{i}": F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in cols]) for i, (cols, _) in enumerate(caps.values())}
    biggest, total = (df.groupBy(*within).count() if within else df.groupBy().count()).agg(F.max("count"), F.sum("count")).first()
    limits = [n for _, n in caps.values()]
    names = list(caps)
    # Rows that tie have the columns of ``order`` in common, so the others' text tells them apart as all columns' would.
    rest = F.to_json(F.struct(*[F.col(c) for c in df.columns if c not in order] or [F.lit(0)]), {"ignoreNullFields": "false"})
    if in_memory is None:
        in_memory = IN_MEMORY_ROWS if within else ALONE_ROWS
    if (biggest or 0) <= in_memory:
        # Small groups go several to a pass: their counters have keys of their own.
        return _in_groups(df, keys, rest, order, names, limits, within or [], 1 + (total or 0) // PASS_ROWS)
    kinds = dict(df.dtypes)
    if all(len(cols) == 1 and kinds.get(cols[0]) in ("tinyint", "smallint", "int", "bigint") for cols, _ in caps.values()):
        keys = {f"_k{i}": F.col(cols[0]).cast("long") for i, (cols, _) in enumerate(caps.values())}  # as different as their text
    return _in_parts(df, keys, rest, order, names, limits, total, part_rows)


def _in_groups(df: DataFrame, keys: dict[str, Column], rest: Column, order: list[str], names: list[str], limits: list[int], within: list[str], passes: int) -> DataFrame:
    """The rows are shuffled once, as they are; keys and text are added, and rows sorted, where they have come to."""

    def greedy(table: pa.Table) -> pa.Table:
        used = [Counter() for _ in limits]
        reasons = []
        for own in zip(*[table[k].to_pylist() for k in own_keys], strict=True):
            full = next((i for i, k in enumerate(own) if used[i][k] >= limits[i]), None)
            if full is None:
                for i, k in enumerate(own):
                    used[i][k] += 1
            reasons.append(None if full is None else names[full])
        return table.select(columns).append_column("reason", pa.array(reasons, pa.string()))

    columns, own_keys = df.columns, list(keys)
    share = F.pmod(F.xxhash64(*within), F.lit(passes)) if within else F.lit(0)
    dealt = df.withColumn("_pass", share.cast("long")).repartition("_pass").withColumns(keys | {"_rest": rest}).sortWithinPartitions("_pass", *order, "_rest")
    return dealt.groupBy("_pass").applyInArrow(greedy, StructType([*df.schema.fields, StructField("reason", StringType())]))


def _in_parts(df: DataFrame, keys: dict[str, Column], rest: Column, order: list[str], names: list[str], limits: list[int], total: int, part_rows: int) -> DataFrame:
    n, caps = 1 + (total - 1) // part_rows, range(len(limits))
    lists = lambda sizes, values: pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), values)
    flat = lambda column: pa.concat_arrays([c.flatten() for c in column.chunks])

    def dealt(source: DataFrame, *by: str | Column) -> DataFrame:
        """Rows in order, with part and place in it as one number ``_at``."""
        return cut(source.repartitionByRange(n, *by).sortWithinPartitions(*order, rest).select(*df.columns, F.monotonically_increasing_id().alias("_at")))

    part, place = F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND((1 << 33) - 1)
    rows = dealt(df, *order)
    if rows.groupBy(part).count().agg(F.max("count")).first()[0] > 2 * part_rows:
        # Many rows tie: they are dealt by their text as well, and copies of a row as they come.
        uncut(rows)
        rows = dealt(df.withColumn("_uid", F.monotonically_increasing_id()), *order, rest, "_uid")

    def numbered(table: pa.Table) -> pa.Table:
        """A part: of each cap its rows' keys as numbers (c), the keys (k) sorted by the bucket in which their counters are added up, and how many there are in each bucket (s)."""
        table = table.sort_by("_at")
        out = {"_part": table["_part"].slice(0, 1)}
        for i in caps:
            coded = table[f"_k{i}"].combine_chunks().dictionary_encode(null_encoding="encode")
            known = coded.dictionary.fill_null(0) if pa.types.is_integer(coded.dictionary.type) else coded.dictionary
            bucket = (pd.util.hash_array(known.to_numpy(zero_copy_only=False), categorize=False) % n).astype(int)
            by_bucket = np.argsort(bucket, kind="stable")
            number = np.empty(len(bucket), "int32")
            number[by_bucket] = np.arange(len(bucket))
            sizes = np.bincount(bucket, minlength=n)
            out |= {f"c{i}": lists([len(table)], pa.array(number[coded.indices.to_numpy()])), f"k{i}": lists([len(bucket)], coded.dictionary.take(pa.array(by_bucket))), f"s{i}": lists([n], pa.array(sizes, pa.int32()))}
        return pa.table(out)

    def settled(own: pa.Table, before: pa.Table) -> pa.Table:
        """A part's rows in order, from the counters that come to it: what it took of each key, by cap (i) and bucket (b), and its rows' reasons (cap -1, bucket: ``TOLD_ROWS`` rows)."""
        before = before.sort_by([("i", "ascending"), ("b", "ascending")])
        codes = [flat(own[f"c{i}"]).to_numpy() for i in caps]
        size = len(codes[0])
        come, room, filled = [], [], []  # filled: the place of the row that took a key's last
        for i in caps:
            got = before.filter(pc.equal(before["i"], i))["n"]
            come.append(flat(got).to_numpy() if len(got) else np.zeros(len(flat(own[f"k{i}"])), "int32"))
            room.append(np.maximum(limits[i] - come[i], 0))
            filled.append(np.where(room[i] > 0, size, -1))
        may = np.flatnonzero(np.logical_and.reduce([room[i][codes[i]] > 0 for i in caps]))
        left, last = [r.tolist() for r in room], [f.tolist() for f in filled]
        for start in range(0, len(may), 1 << 16):
            at = may[start : start + (1 << 16)]
            for p, *ks in zip(at.tolist(), *[c[at].tolist() for c in codes], strict=True):
                for r, k in zip(left, ks):  # noqa: B905
                    if not r[k]:
                        break
                else:
                    for r, f, k in zip(left, last, ks):  # noqa: B905
                        r[k] -= 1
                        if not r[k]:
                            f[k] = p
        reasons = np.full(size, len(limits), "uint8")
        for i in reversed(caps):
            reasons[np.array(last[i])[codes[i]] < np.arange(size)] = i
        out = []
        for i in caps:
            sizes = flat(own[f"s{i}"]).to_numpy()
            b = np.flatnonzero(sizes)
            took = lists(sizes[b], pa.array(room[i] - np.array(left[i]), pa.int32()))
            out.append({"i": pa.array(np.full(len(b), i), pa.int32()), "b": pa.array(b, pa.int32()), "key": lists(sizes[b], flat(own[f"k{i}"])), "had": lists(sizes[b], pa.array(come[i], pa.int32())), "n": took, "told": pa.nulls(len(b), pa.binary())})
        told = [reasons[k : k + TOLD_ROWS].tobytes() for k in range(0, size, TOLD_ROWS)]
        out.append({"i": pa.array(np.full(len(told), -1), pa.int32()), "b": pa.array(np.arange(len(told)), pa.int32())} | {k: pa.nulls(len(told), out[0][k].type) for k in ("key", "had", "n")} | {"told": pa.array(told, pa.binary())})
        mine = own["_part"][0].as_py()
        return pa.concat_tables([pa.table({"_part": pa.array(np.full(len(x["b"]), mine), pa.int64())} | x) for x in out])

    def added(table: pa.Table) -> pa.Table:
        """Of a bucket's keys what the parts before each part took of them, up to the cap; wrong: not what the part had."""
        table = table.sort_by("_part")
        sizes = pc.list_value_length(table["key"]).to_numpy()
        code = flat(table["key"]).dictionary_encode(null_encoding="encode").indices.to_numpy()
        by_key = np.argsort(code, kind="stable")
        took = flat(table["n"]).to_numpy()[by_key].astype("int64")
        earlier, first = np.cumsum(took) - took, np.flatnonzero(np.r_[True, np.diff(code[by_key]) != 0])
        earlier -= np.repeat(earlier[first], np.diff(np.r_[first, len(code)]))
        n = np.empty(len(code), "int32")
        n[by_key] = np.minimum(earlier, max(0, limits[table["i"][0].as_py()]))
        wrong = np.logical_or.reduceat(n != flat(table["had"]).to_numpy(), np.cumsum(sizes) - sizes)
        return table.select(["_part", "i", "b"]).append_column("n", lists(sizes, pa.array(n))).append_column("wrong", pa.array(wrong))

    kind = "long" if all(c == "bigint" for c in dict(df.select(*[c.alias(k) for k, c in keys.items()]).dtypes).values()) else "string"
    parts = cut(rows.select(part, "_at", *[c.alias(k) for k, c in keys.items()]).groupBy("_part").applyInArrow(numbered, "_part long, " + ", ".join(f"c{i} array<int>, k{i} array<{kind}>, s{i} array<int>" for i in caps)))
    came = "_part long, i int, b int, n array<int>"
    settle = lambda own, before: own.groupBy("_part").cogroup(before.groupBy("_part")).applyInArrow(settled, f"_part long, i int, b int, key array<{kind}>, had array<int>, n array<int>, told binary")
    now = cut(settle(parts, df.sparkSession.createDataFrame([], came)))
    while True:
        before = cut(now.where("i >= 0").drop("told").groupBy("i", "b").applyInArrow(added, f"{came}, wrong boolean"))
        wrong = [r[0] for r in before.where("wrong").select("_part").distinct().collect()]  # a number for each part_rows rows
        if not wrong:
            break
        again = F.col("_part").isin(wrong)
        new = cut(now.where(~again).unionByName(settle(parts.where(again), before.where(again).drop("wrong"))))
        uncut(now)
        uncut(before)
        now = new
    told = now.where("i < 0").select("_part", F.col("b").cast("long").alias("_told"), "told")
    mine = rows.select("*", part, F.shiftright(place, TOLD_ROWS.bit_length() - 1).alias("_told")).join(told.hint("shuffle_hash"), ["_part", "_told"])
    reason, at = F.lit(None).cast("string"), F.substring("told", (place % TOLD_ROWS + 1).cast("int"), F.lit(1))
    for i, name in enumerate(names):
        reason = F.when(at == F.lit(bytearray([i])), name).otherwise(reason)
    return mine.select(*df.columns, reason.alias("reason"))


def per_taxon(df: DataFrame, caps: dict[str, int] | None = None, **kw) -> DataFrame:
    """Media selection: columns taxon, order_key, observation, observer, location and season; all counters lie within
    the taxon, and missing keys count together."""
    most = {"cap_taxon": 50, "cap_observation": 2, "cap_observer": 10, "cap_location": 10, "cap_season": 15} | (caps or {})
    keys = {"cap_taxon": ["taxon"], **{f"cap_{k}": ["taxon", k] for k in ("observation", "observer", "location", "season")}}
    return select(df, ["taxon", "order_key"], {k: (cols, most[k]) for k, cols in keys.items()}, within=["taxon"], **kw)


def license_filter(df: DataFrame, profile: str, license_col: str = "license") -> DataFrame:
    """``df`` with ``verdict`` of its normalised license."""
    return df.withColumn("verdict", licenses.verdict(licenses.identifier_license(F.col(license_col)), profile))


def select_release(df: DataFrame, profile: str, max_taxon: int = 50, max_observation: int = 4, max_observer: int = 10, **kw) -> DataFrame:
    """Release selection: ``df`` (taxon, sha256, license, observation_id, source_record, observer, license_review_ok) with ``reason``.

    Rows without taxon or digest, or whose license isn't accepted (or not yet reviewed), drop out before any cap. Observation
    and observer counters run across taxa; a missing observation is its source record or digest, a missing observer ``unknown``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    verdict = licenses.verdict(F.col("license"), profile)
    why = F.when((text("taxon") == "") | (text("sha256") == ""), "missing_key").when(verdict == "rejected", "license_rejected")
    why = why.when((verdict == "review_required") & ~F.coalesce(F.col("license_review_ok"), F.lit(False)), "license_review_required")
    obs = F.coalesce(*[F.nullif(text(c), F.lit("")) for c in ("observation_id", "source_record", "sha256")])
    staged = cut(df.withColumns({"_why": why, "_obs": obs, "_observer": F.coalesce(F.nullif(text("observer"), F.lit("")), F.lit("unknown"))}))
    chosen = select(staged.where("_why is null"), ["taxon", "sha256"], {"cap_taxon": (["taxon"], max_taxon), "cap_observation": (["_obs"], max_observation), "cap_observer": (["_observer"], max_observer)}, **kw)
    out = chosen.select(*df.columns, "reason").unionByName(staged.where("_why is not null").select(*df.columns, F.col("_why").alias("reason")))
    return out


def select_media(df: DataFrame, profile: str = "research", **kw) -> DataFrame:
    """Per-taxon selection of accepted media: ``reason`` is null for those taken, ``license`` for those not accepted."""
    season = media.season(F.col("month"), F.col("season")) if "month" in df.columns else F.col("season")
    marked = license_filter(df, profile).withColumn("season", season)
    chosen = per_taxon(marked.where("verdict = 'accepted'"), **kw)
    return chosen.unionByName(marked.where("verdict <> 'accepted'").withColumn("reason", F.lit("license")))


def selection_report(selected: DataFrame) -> DataFrame:
    """One row: input, licensed, rejected_license, selected, skipped_caps."""
    is_license = F.col("reason").eqNullSafe("license")
    return selected.agg(
        F.count("*").alias("input"), F.count_if(~is_license).alias("licensed"), F.count_if(is_license).alias("rejected_license"),
        F.count_if(F.col("reason").isNull()).alias("selected"), F.count_if(F.col("reason").isNotNull() & ~is_license).alias("skipped_caps"),
    )


def greedy_reference(rows: Iterator[dict], caps: dict[str, tuple[list[str], int]]) -> list[str | None]:
    """The same in plain Python over ordered rows: what tests compare with."""
    used, out = {name: Counter() for name in caps}, []
    for r in rows:
        keys = {name: tuple(r[c] for c in cols) for name, (cols, _) in caps.items()}
        full = next((name for name, (_, n) in caps.items() if used[name][keys[name]] >= n), None)
        if full is None:
            for name, k in keys.items():
                used[name][k] += 1
        out.append(full)
    return out
