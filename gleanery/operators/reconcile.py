"""Name reconciliation: reviewed decisions, unique names, synonyms, authorship, then fuzzy candidates."""

from __future__ import annotations

import difflib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.names import blank_to_null, normalize_authorship, normalize_name
from gleanery.session import cut

CUTOFF, LIMIT = 0.85, 5
#: Letters of a signature, and the length from which on names have single letters as signatures.
TOGETHER, LONG = 4, 40
#: Letters, commonest first.
COMMON = "aeisrounltcmdphgbvyfxkzqwj "


def name_index(records: DataFrame) -> DataFrame:
    """(norm, rec): every record under its own and its accepted name, once for each different key."""
    own, accepted = normalize_name(F.coalesce("scientific_name", F.lit(""))), normalize_name(F.coalesce("accepted_name", F.lit("")))
    synonym = (accepted != "") & (own != accepted)
    rec = F.struct("scientific_name", "authorship", "accepted_name", "wsc_id", synonym.alias("synonym"), normalize_authorship(F.col("authorship")).alias("author"))
    return records.select(F.explode(F.array_distinct(F.array(own, accepted))).alias("norm"), rec.alias("rec")).where("norm <> ''")


def reconcile(names: DataFrame, records: DataFrame, reviewed: DataFrame | None = None, cutoff: float = CUTOFF, limit: int = LIMIT) -> DataFrame:
    """(original_name, authorship, normalized_name, match_type, accepted_name, n_candidates, needs_review, note), one row for each input
    row (original_name, authorship). ``reviewed``: (original_name, accepted_name). ``n_candidates`` is that of records offered."""
    index = cut(name_index(records))
    asked = names.select("original_name", "authorship", normalize_name(F.coalesce("original_name", F.lit(""))).alias("normalized_name")).withColumn("_id", F.monotonically_increasing_id())
    asked = asked.withColumn("_author", normalize_authorship(F.col("authorship")))
    if reviewed is not None:
        said = reviewed.select("original_name", F.col("accepted_name").alias("_kept"), F.lit(True).alias("_reviewed")).dropDuplicates(["original_name"])
        asked = asked.join(said, "original_name", "left")
    else:
        asked = asked.withColumns({"_kept": F.lit(None).cast("string"), "_reviewed": F.lit(None).cast("boolean")})
    asked = cut(asked)
    hits = asked.join(index, F.col("normalized_name") == F.col("norm"))
    same = F.col("_author").eqNullSafe(F.col("rec.author"))
    counted = hits.groupBy("_id").agg(F.count("*").alias("n"), F.count_if(same).alias("n_auth"), F.min("rec").alias("one"), F.min(F.when(same, F.col("rec"))).alias("by_author"))
    joined = asked.join(counted, "_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    open_ = joined.where("n = 0 and _reviewed is null").select("normalized_name").distinct()
    close = fuzzy(open_, index, cutoff, limit).withColumnRenamed("name", "normalized_name")
    joined = joined.join(close, "normalized_name", "left")
    kept = F.col("_reviewed").isNotNull()
    rec = F.when(F.col("n") == 1, F.col("one")).when((F.col("n") > 1) & (F.col("n_auth") == 1), F.col("by_author"))
    fuzzy_ = F.coalesce(F.col("n_close"), F.lit(0)) > 0
    kind = F.when(kept, "kept_reviewed").when(rec.isNotNull() & rec["synonym"], "synonym").when(rec.isNotNull(), "exact").when(F.col("n") > 1, "conflict").when(fuzzy_, "fuzzy").otherwise("unresolved")
    name = F.when(kept, F.col("_kept")).when(rec.isNotNull(), F.when(rec["synonym"] | ((F.col("n") > 1) & blank_to_null(rec["accepted_name"]).isNotNull()), rec["accepted_name"]).otherwise(rec["scientific_name"]))
    offered = F.when(kept, 0).when(rec.isNotNull(), 1).when(F.col("n") > 1, F.col("n")).otherwise(F.coalesce(F.col("n_close"), F.lit(0)))
    note = F.when(kept, "kept prior reviewed decision").when(rec.isNotNull() & (F.col("n") > 1), "disambiguated by authorship").when(kind == "synonym", "synonym resolved to accepted name")
    note = note.when(kind == "conflict", "several records share this name").when(kind == "fuzzy", "fuzzy candidates").when(kind == "unresolved", "no match").otherwise("")
    return joined.select("original_name", "authorship", "normalized_name", kind.alias("match_type"), name.alias("accepted_name"), offered.cast("long").alias("n_candidates"), kind.isin("conflict", "fuzzy", "unresolved").alias("needs_review"), note.alias("note"))


def _rarity(cutoff_places: int = 8) -> dict[str, float]:
    """How often, about, a name of twenty letters has a letter k times: the order in which tokens are taken, rarest first. Any order is right; this one is quick."""
    out = {}
    for place, c in enumerate(COMMON):
        mean, term, below = 2.2 * 0.87**place, 1.0, 0.0
        for k in range(1, cutoff_places + 1):
            below += term
            out[f"{c}{k}"] = 1 - below * math.exp(-mean)
            term *= mean / k
    return out


RARITY = _rarity()


def shortest_partner(n: int, cutoff: float) -> int:
    """The length below which no name reaches ``cutoff`` with one of length n: all its letters would not do."""
    return math.ceil(cutoff * n / (2 - cutoff) - 1e-9)


def shared_letters(n: int, cutoff: float) -> int:
    """Letters, counted as often as they occur in both, that any name within ``cutoff`` shares with one of length n."""
    return math.ceil(cutoff * (n + shortest_partner(n, cutoff)) / 2 - 1e-9)


def signatures(name: str, cutoff: float = CUTOFF) -> list[str]:
    """What two names within ``cutoff`` have in common, at least one of each other's.

    A name is the set of its letters, each numbered by its occurrence. Two that share o of these also share j among the first n - o + j of each in any
    fixed order, rarest first. So names of middling length have all choices of j = TOGETHER among their n - o + j rarest letters as signatures; very
    short ones, which may share fewer, and long ones, which would have too many, have single letters, as have those that may be near such."""
    n = len(name)
    if not n:
        return []
    seen: Counter = Counter()
    letters = []
    for c in name:
        seen[c] += 1
        letters.append(f"{c}{seen[c]}")
    letters.sort(key=lambda t: (RARITY.get(t, 0.0), t))
    least, stretch = shared_letters(n, cutoff), (2 - cutoff) / cutoff
    short = next(k for k in range(1, 1000) if shared_letters(k, cutoff) >= TOGETHER)  # from here on, so many are shared
    out = []
    if n < short * stretch or n * stretch >= LONG:
        out += letters[: n - least + 1]
    if n >= short and n <= LONG:
        out += ["|".join(t) for t in combinations(letters[: n - least + TOGETHER], TOGETHER)]
    return out


#: Each numbered letter's place in the four whole numbers that hold a name's letters; others are only counted.
PLACES = {t: k for k, t in enumerate(RARITY)}
WORDS = -(-len(PLACES) // 63)


def letter_bits(name: str) -> list[int]:
    """The name's numbered letters as bits of WORDS numbers, and how many letters have no place there."""
    out, seen = [0] * (WORDS + 1), Counter()
    for c in name:
        seen[c] += 1
        at = PLACES.get(f"{c}{seen[c]}")
        if at is None:
            out[WORDS] += 1
        else:
            out[at // 63] |= 1 << at % 63
    return out


def signed(names: DataFrame, column: str, cutoff: float) -> DataFrame:
    """(column, sig, bits) for each signature of each different name."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            each = [(name, s, bits) for name in pdf[column] for bits in [letter_bits(name)] for s in signatures(name, cutoff)]
            yield pd.DataFrame({k: pd.Series([x[i] for x in each], dtype=object) for i, k in enumerate((column, "sig", "bits"))})

    return names.mapInPandas(run, f"{column} string, sig string, bits array<long>")


def fuzzy_candidates(names: DataFrame, known: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """(name, cand): pairs of different names ``name`` and ``cand`` that share a signature and have the letters in common that the cutoff asks for: all pairs within
    it, and few others. An equi-join whose rows are checked where they meet, by a few operations on whole numbers; a signature that very many names share is split by adaptive execution."""
    sides = []
    for df, column in ((names, "name"), (known, "cand")):
        bits = [F.col("bits")[k].alias(f"{column}_{k}") for k in range(WORDS + 1)]
        sides.append(signed(df.select(column), column, cutoff).select(column, "sig", F.length(column).alias(f"{column}_n"), *bits))
    common = F.least(F.col(f"name_{WORDS}"), F.col(f"cand_{WORDS}"))  # letters without a place might all be the same
    for k in range(WORDS):
        common = common + F.bit_count(F.col(f"name_{k}").bitwiseAND(F.col(f"cand_{k}")))
    # Rounded down: the exact ratio decides.
    near = 2 * common >= cutoff * (F.col("name_n") + F.col("cand_n")) - 1e-9
    return sides[0].join(sides[1], "sig").where(near).select("name", "cand").distinct()


def fuzzy(names: DataFrame, index: DataFrame, cutoff: float = CUTOFF, limit: int = LIMIT) -> DataFrame:
    """(name, close, n_close) for names with a match: the ``limit`` index names of greatest Ratcliff-Obershelp ratio from ``cutoff``
    on (ties: greater name first), and the number of their records, ``limit`` at most. Empty names match nothing; no name goes through the driver."""
    sizes = index.groupBy("norm").agg(F.count("*").alias("k"))
    pairs = fuzzy_candidates(names.select(F.col("normalized_name").alias("name")).distinct(), sizes.select(F.col("norm").alias("cand")), cutoff)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = difflib.SequenceMatcher()
        for pdf in batches:
            out, before = [], None
            for name, cand in sorted(zip(pdf["name"], pdf["cand"], strict=True)):
                if name != before:
                    before = name
                    matcher.set_seq2(name)
                matcher.set_seq1(cand)
                if (ratio := matcher.ratio()) >= cutoff:
                    out.append((name, cand, ratio))
            yield pd.DataFrame(out, columns=["name", "cand", "ratio"]).astype({"name": object, "cand": object, "ratio": float})

    near = pairs.mapInPandas(run, "name string, cand string, ratio double")
    best = near.withColumn("place", F.row_number().over(Window.partitionBy("name").orderBy(F.desc("ratio"), F.desc("cand")))).where(F.col("place") <= limit)
    told = best.join(sizes.withColumnRenamed("norm", "cand"), "cand")
    ranked = told.groupBy("name").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "cand"))), lambda s: s["cand"]).alias("close"), F.sum("k").alias("k"))
    return ranked.select("name", "close", F.least(F.col("k"), F.lit(limit).cast("long")).alias("n_close"))


def conflict_report(found: DataFrame) -> DataFrame:
    """(match_type, n, needs_review)."""
    return found.groupBy("match_type").agg(F.count("*").alias("n"), F.count_if("needs_review").alias("needs_review"))
