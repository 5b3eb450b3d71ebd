"""License normalisation, classification and attribution as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# License codes of photo records, identifiers by spelling, templates in the order they are looked for,
# words that call for a review, and which identifiers each profile accepts or sends to review.
CODES = {"CC0": "cc0", "CC-BY": "cc-by", "CC-BY-NC": "cc-by-nc", "CC-BY-SA": "cc-by-sa", "CC-BY-NC-SA": "cc-by-nc-sa", "CC-BY-ND": "cc-by-nd", "CC-BY-NC-ND": "cc-by-nc-nd"}
IDENTIFIERS = {
    "cc0": "CC0-1.0", "cc0-1.0": "CC0-1.0", "cc-by": "CC-BY-4.0", "cc by": "CC-BY-4.0", "cc-by-3.0": "CC-BY-3.0", "cc-by-4.0": "CC-BY-4.0",
    "cc by 3.0": "CC-BY-3.0", "cc by 4.0": "CC-BY-4.0", "cc-by-nc": "CC-BY-NC-4.0", "cc-by-nc-3.0": "CC-BY-NC-3.0", "cc-by-nc-4.0": "CC-BY-NC-4.0",
    "cc-by-sa": "CC-BY-SA-4.0", "cc-by-sa-3.0": "CC-BY-SA-3.0", "cc-by-sa-4.0": "CC-BY-SA-4.0", "cc-by-nc-sa-3.0": "CC-BY-NC-SA-3.0", "cc-by-nc-sa-4.0": "CC-BY-NC-SA-4.0",
}
TEMPLATES = [
    ("cc-zero", "cc0"), ("cc0", "cc0"), ("cc-by-1.0", "cc-by"), ("cc-by-2.0", "cc-by"), ("cc-by-2.5", "cc-by"), ("cc-by-3.0", "cc-by"), ("cc-by-4.0", "cc-by"),
    ("cc-by-sa-1.0", "cc-by-sa"), ("cc-by-sa-2.0", "cc-by-sa"), ("cc-by-sa-2.5", "cc-by-sa"), ("cc-by-sa-3.0", "cc-by-sa"), ("cc-by-sa-4.0", "cc-by-sa"),
    ("cc-by-nc", "cc-by-nc"), ("cc-by-nc-sa", "cc-by-nc-sa"), ("gfdl", "gfdl"),
]
REVIEW_WORDS = (
    "cc-by-nc-nd", "cc-by-nd", "copyrighted", "dual", "fair", "fair-use", "fairuse", "gfdl", "multi-license", "pd", "permission", "public-domain", "self", "unknown",
)
PROFILES = {
    "conservative": (("CC0-1.0", "CC-BY-4.0", "CC-BY-3.0"), ()),
    "research": (("CC0-1.0", "CC-BY-4.0", "CC-BY-3.0", "CC-BY-NC-4.0", "CC-BY-NC-3.0"), ("CC-BY-SA-4.0", "CC-BY-NC-SA-4.0", "CC-BY-SA-3.0", "CC-BY-NC-SA-3.0")),
}


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for p in pairs.items() for x in p]), key)


def code_license(code: Column) -> Column:
    """Lower-case code of a photo record's license, other values in lower case, null for nothing."""
    return F.nullif(F.trim(F.lower(code)), F.lit(""))


def identifier_license(value: Column) -> Column:
    """SPDX-like identifier of any usual spelling; unknown spellings trimmed, null for null."""
    key = F.replace(F.replace(F.lower(F.trim(value)), F.lit("_"), F.lit("-")), F.lit("creative commons "), F.lit("cc-"))
    return F.coalesce(_lookup(IDENTIFIERS, key), F.trim(value))


def template_license(short: Column, usage: Column, url: Column, first_wins: bool = False) -> Column:
    """License that the text of a file page names. The longest template named wins; ``first_wins`` takes the first in
    table order instead, under which non-commercial share-alike text reads as non-commercial."""
    low = F.regexp_replace(F.lower(F.concat_ws(" ", F.coalesce(short, F.lit("")), F.coalesce(usage, F.lit("")), F.coalesce(url, F.lit("")))), "[ _]", "-")
    order = TEMPLATES if first_wins else sorted(TEMPLATES, key=lambda t: -len(t[0]))
    found = F.coalesce(*[F.when(low.contains(k), v) for k, v in order])
    return F.coalesce(found, F.when(F.replace(low, F.lit("-"), F.lit("")).contains("cc0"), "cc0"))


def review_reason(blob: Column, license_: Column, templates: Column | None = None) -> Column:
    """Why a file's license needs a person's eye, null if it doesn't: unknown, then several, then GFDL beside another,
    then words that leave it open, then several license templates."""
    low = F.lower(F.coalesce(blob, F.lit("")))
    hits = F.filter(F.array(*[F.when(low.contains(w), w) for w in REVIEW_WORDS]), lambda w: w.isNotNull())
    marks = F.concat(F.lit("markers=['"), F.array_join(hits, "', '"), F.lit("']"))
    kinds = F.size(F.array_distinct(F.regexp_extract_all(low, F.lit("cc-by(?:-nc)?(?:-sa)?|cc-zero|cc0|gfdl"), F.lit(0))))
    several = (kinds > 1) | low.contains("multi-license") | low.contains("dual")
    vague = F.arrays_overlap(hits, F.array(*[F.lit(w) for w in ("fairuse", "fair-use", "permission", "unknown")]))
    with_marks = lambda text: F.when(F.size(hits) > 0, F.concat(F.lit(text + " "), marks)).otherwise(text)
    reason = F.when(license_.isNull(), with_marks("unknown-license")).when(several, with_marks("multi-license"))
    reason = reason.when(low.contains("gfdl") & (license_ != "gfdl"), "gfdl-dual-license").when(vague, F.concat(F.lit("ambiguous "), marks))
    if templates is not None:
        names = F.transform(templates, lambda t: F.trim(F.element_at(F.split(F.lower(t), ":"), -1)))
        listed = F.array_sort(F.array_distinct(F.filter(names, lambda t: t.rlike("cc-|cc0") & ~t.endswith("-layout") & ~t.contains("cc-country-flags"))))
        reason = reason.when(F.size(listed) > 1, F.concat(F.lit("multi-license templates=['"), F.array_join(listed, "', '"), F.lit("']")))
    return reason


def verdict(license_: Column, profile: str) -> Column:
    """``accepted``, ``review_required`` or ``rejected`` of an identifier under a profile; null is rejected."""
    if profile not in PROFILES:
        raise ValueError(f"unknown license profile {profile!r}")
    accept, review = PROFILES[profile]
    out = F.when(license_.isin(*accept), "accepted")
    return (out.when(license_.isin(*review), "review_required") if review else out).otherwise("rejected")


def attribution(creator: Column, license_: Column, license_url: Column, source_url: Column, title: Column) -> Column:
    """Attribution text; null where creator or license is missing, which a gate then reports."""
    has = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    work = F.when(has(title), F.concat(F.lit("“"), title, F.lit("” by "))).otherwise("")
    terms = F.when(has(license_url), F.concat(F.trim(license_), F.lit(" ("), F.trim(license_url), F.lit(")"))).otherwise(F.trim(license_))
    parts = F.concat_ws(", ", F.concat(work, F.trim(creator)), F.concat(F.lit("licensed under "), terms), F.when(has(source_url), F.concat(F.lit("source: "), F.trim(source_url))))
    return F.when(has(creator) & has(license_), F.concat(parts, F.lit(".")))
