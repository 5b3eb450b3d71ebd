"""Coverage audits and photo pickers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.licenses import code_license, identifier_license
from gleanery.functions.names import first_text
from gleanery.functions.urls import large_photo


def coverage(checklist: DataFrame, counts: DataFrame) -> DataFrame:
    """(taxon, n, has_candidate, image_status) for every different name of the checklist, 0 where ``counts`` (taxon, n) has none."""
    j = checklist.select("taxon").distinct().join(counts.groupBy("taxon").agg(F.max("n").alias("n")), "taxon", "left")
    n = F.coalesce("n", F.lit(0))
    return j.select("taxon", n.cast("long").alias("n"), (n > 0).alias("has_candidate"), F.when(n > 0, "candidate").otherwise("no_image").alias("image_status"))


def coverage_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("species_total"), F.count_if("has_candidate").alias("with_candidates"), F.count_if(~F.col("has_candidate")).alias("no_image"))


def only_missing(taxa: DataFrame, have: DataFrame, key: str = "taxon") -> DataFrame:
    return taxa.join(have.select(key).distinct(), key, "left_anti")


def pick_photos(observations: DataFrame, accept: list[str], n: int = 10, seen: DataFrame | None = None) -> DataFrame:
    """Up to ``n`` photos of each asked taxon from different observations, research grade first, then in source order.

    observations: asked, place (order in the source's answer), id, quality_grade, taxon struct(name, rank), user struct(login, name), photos array. An
    observation counts with its first photo of an accepted license; the name returned must be the one asked, of species rank or below. ``seen``: observation ids
    (column id) to leave out, after the choice of n + 10, as a collector that asks for spares does."""
    fit = observations.where((F.col("taxon.name") == F.col("asked")) & F.col("taxon.rank").isin("species", "subspecies"))
    return pick_photo_rows(fit.select("asked", "place", "id", "quality_grade", F.col("user.login").alias("observer"), F.posexplode("photos").alias("pos", "p")), accept, n, seen)


def pick_photo_rows(photos: DataFrame, accept: list[str], n: int = 10, seen: DataFrame | None = None) -> DataFrame:
    """The same from a row for each photo of a fitting observation: asked, place, id, quality_grade, observer, pos (order within the observation), p struct. No observation's photos are
    gathered; those of other licenses go before anything is shuffled."""
    photo = photos.withColumn("research", F.col("quality_grade") == "research")
    url = first_text(F.col("p.original_url"), F.col("p.large_url"), F.col("p.url"))
    photo = photo.withColumns({"license": code_license(F.col("p.license_code")), "url": large_photo(url)})
    photo = photo.where(F.coalesce(F.col("license").isin(*accept), F.lit(False)) & F.col("url").isNotNull())
    best = photo.groupBy("asked", "id").agg(F.min(F.struct(F.when(F.col("research"), 0).otherwise(1).alias("grade"), "place", "pos", "url", "license", "observer", F.col("p.id").alias("photo_id"))).alias("b"))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("asked").orderBy("b.grade", "b.place", "id")))
    out = ranked.where(F.col("rank") <= (n + 10 if seen is not None else n)).select("asked", "id", "rank", "b.url", "b.license", "b.observer", "b.photo_id", (F.col("b.grade") == 0).alias("research"))
    if seen is None:
        return out
    left = out.join(seen.select("id").distinct(), "id", "left_anti")
    return left.withColumn("rank", F.row_number().over(Window.partitionBy("asked").orderBy("rank"))).where(F.col("rank") <= n)


def eligibility(rows: DataFrame, accept: list[str]) -> DataFrame:
    """``rows`` (correct_taxon, source, source_observation_id, source_media_id, observation struct or null) with ``reason``: the first eligibility rule broken, null for none."""
    o = F.col("observation")
    photo = F.get(F.filter(o["photos"], lambda p: p["id"].cast("string") == F.col("source_media_id").cast("string")), F.lit(0))
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    why = F.when(~F.coalesce(F.col("source") == "inaturalist", F.lit(False)) | o.isNull(), "source_requires_manual_label_review")
    why = why.when(text(o["id"]) != text(F.col("source_observation_id")), "observation_id_mismatch").when(text(o["taxon"]["name"]) != text(F.col("correct_taxon")), "source_label_mismatch")
    why = why.when(~F.coalesce(o["taxon"]["rank"].isin("species", "subspecies"), F.lit(False)), "source_not_species_level").when(text(o["quality_grade"]) != "research", "not_research_grade")
    why = why.when(F.coalesce(o["captive"], F.lit(False)), "captive_observation").when(photo.isNull(), "photo_not_in_observation")
    return rows.withColumn("reason", why.when(~F.coalesce(identifier_license(photo["license_code"]).isin(*accept), F.lit(False)), "photo_license_not_allowed"))


def upgradable(media: DataFrame, min_width: int = 150) -> DataFrame:
    """Accepted media of unknown or small width: for each taxon the one of least media id as text ("10" before "9")."""
    small = media.where((F.col("validation_status") == "accepted") & (F.col("width").isNull() | (F.col("width") < min_width)))
    return small.groupBy("source_taxon").agg(F.min(F.col("source_media_id").cast("string")).alias("source_media_id"))


def common_names(taxa: DataFrame, found: DataFrame) -> DataFrame:
    """``taxa`` (taxon) with ``common_name`` from lookup results (taxon, place, name, common_name): that of the result whose name equals the taxon but for case, else the
    first result's, else null. A null is never replaced by a guess."""
    same = F.lower("name") == F.lower("taxon")
    best = found.groupBy("taxon").agg(F.min_by("common_name", F.when(same, F.col("place"))).alias("exact"), F.max(same).alias("any_exact"), F.min_by("common_name", "place").alias("first"))
    return taxa.join(best.select("taxon", F.when(F.col("any_exact"), F.col("exact")).otherwise(F.col("first")).alias("common_name")), "taxon", "left")


def photo_codes(accept: list[str]) -> str:
    """License codes for a photo query, from accepted codes or identifiers."""
    from gleanery.functions.licenses import CODES, IDENTIFIERS

    upper = {v: k for k, v in CODES.items()}
    usual = {c: {c, IDENTIFIERS.get(c, "").lower(), f"{c}-4.0"} for c in ("cc0", "cc-by", "cc-by-nc", "cc-by-sa", "cc-by-nc-sa")}
    codes = {upper[c] for c, forms in usual.items() if any(a.lower() in forms for a in accept)}
    return ",".join(sorted(codes)) or "cc0,cc-by,cc-by-nc"
