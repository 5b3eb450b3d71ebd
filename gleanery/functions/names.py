"""Name, authorship and rank normalisation as columns."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Rank abbreviations and the ranks they stand for.
RANKS = {
    "species": "sp sp. species spec.",
    "subspecies": "subsp subsp. ssp ssp. subspecies",
    "variety": "var var. variety",
    "form": "f f. form",
    "genus": "gen gen. genus",
    "family": "fam fam. family",
    "order": "ord ord. order",
}


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def compatible(text: Column) -> Column:
    """NFKC, which Spark lacks: Python sees the rows that aren't plain ASCII only if ``text`` has any."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), _nfkc(F.when(text.rlike(r"[^\x00-\x7F]"), text))).otherwise(text)


def one_space(text: Column) -> Column:
    """Any run of Unicode white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def plain_name(text: Column) -> Column:
    """Matching form without NFKC: lower case, one space. What a JVM-only plan needs for text already composed."""
    return one_space(F.lower(text))


def normalize_name(text: Column) -> Column:
    """Canonical matching form: NFKC, lower case, one space; what stands in parentheses stays."""
    return plain_name(compatible(text))


def normalize_authorship(text: Column) -> Column:
    """Spacing tidied around parentheses and commas, case kept; null for nothing."""
    t = one_space(compatible(text))
    t = F.regexp_replace(F.regexp_replace(t, r"\(\s*", "("), r"\s*\)", ")")
    return F.nullif(F.regexp_replace(t, r"\s*,\s*", ", "), F.lit(""))


def canonical_rank(rank: Column) -> Column:
    """The rank that an abbreviation stands for; other tokens in lower case; null for nothing."""
    key = F.nullif(one_space(F.lower(rank)), F.lit(""))
    known = F.create_map(*[F.lit(x) for full, short in RANKS.items() for s in short.split() for x in (s, full)])
    return F.coalesce(F.try_element_at(known, key), key)


def genus(name: Column) -> Column:
    """The first word, null for none."""
    return F.nullif(F.get(F.split(one_space(name), " "), F.lit(0)), F.lit(""))


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def first_text(*texts: Column) -> Column:
    """The first that is neither null nor empty (untrimmed), as sources with several fields for one thing need."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts])
