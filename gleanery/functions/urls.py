"""URL predicates, object keys and text clean-up as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OBSERVATION_MARK = "inaturalist.org/observations/"


def host_of(url: Column) -> Column:
    """Lower-case host, empty for URLs that can't be parsed."""
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit(""))


def host_allowed(url: Column, hosts: list[str]) -> Column:
    """Whether the host is listed or a subdomain of a listed one."""
    host = host_of(url)
    ok = F.lit(False)
    for h in hosts:
        ok = ok | (host == h.lower()) | host.endswith("." + h.lower())
    return ok


def first_offender(hops: Column, hosts: list[str]) -> Column:
    """The first URL of a redirect chain whose host isn't allowed, null for none."""
    return F.get(F.filter(hops, lambda u: ~host_allowed(u, hosts)), F.lit(0))


def observation_id(*fields: Column) -> Column:
    """Observation number in the first field that links to one: the digits up to the next /, ? or #. A first linking field
    without digits gives null; later fields aren't tried."""
    digits = lambda f: F.nullif(F.regexp_replace(F.regexp_extract(f, r"inaturalist\.org/observations/([^/?#]*)", 1), "[^0-9]", ""), F.lit(""))
    out = None
    for f in fields:
        hit = F.coalesce(f.contains(OBSERVATION_MARK), F.lit(False))
        value = digits(f).try_cast("bigint")
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def republished(*fields: Column) -> Column:
    """Whether any of the fields names the photo platform that other sources republish."""
    return F.lower(F.concat_ws("|", *fields)).contains("inaturalist")


def large_photo(url: Column) -> Column:
    """The platform's photo URLs in their large size: of square, small and medium the first kind found is replaced."""
    out = F.when(~url.contains("inaturalist"), url)
    for size in ("/square.", "/small.", "/medium."):
        out = out.when(url.contains(size), F.replace(url, F.lit(size), F.lit("/large.")))
    return out.otherwise(url)


def strip_html(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "<[^>]+>", ""))


def extension(ext: Column) -> Column:
    """Lower case without a dot; jpeg as jpg."""
    low = F.regexp_replace(F.lower(F.trim(ext)), r"^\.", "")
    return F.when(low == "jpeg", "jpg").otherwise(low)


def content_key(prefix: str, sha: Column, ext: Column) -> Column:
    """Key of content-addressed media: two levels of the digest's first digits."""
    return F.concat(F.lit(prefix + "media/sha256/"), F.substring(sha, 1, 2), F.lit("/"), F.substring(sha, 3, 2), F.lit("/"), sha, F.lit("."), extension(ext))


def is_digest(text: Column) -> Column:
    return F.coalesce(text.rlike("^[0-9a-f]{64}$"), F.lit(False))


def is_suite_name(text: Column) -> Column:
    """Whether a suite's name is one folder's name."""
    return F.coalesce((text != "") & ~text.isin(".", "..") & ~text.rlike(r"[/\\]"), F.lit(False))


def search_variants(name: Column) -> Column:
    """Quoted full name, and the quoted first two words of longer names."""
    words = F.split(F.trim(F.regexp_replace(name, r"\s+", " ")), " ")
    quote = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    return F.when(F.size(words) > 2, F.array(quote(name), quote(F.array_join(F.slice(words, 1, 2), " ")))).otherwise(F.array(quote(name)))


def source_identity(source: Column, source_id: Column, url: Column) -> Column:
    """``source:id`` if both are known, else the URL without trailing slashes, else null."""
    both = (F.coalesce(source, F.lit("")) != "") & (F.coalesce(source_id, F.lit("")) != "")
    return F.when(both, F.concat(source, F.lit(":"), source_id)).otherwise(F.nullif(F.regexp_replace(url, "/+$", ""), F.lit("")))
