"""Nested source records as flat tables: observations, occurrences, wiki files, checklists, catalogs. Schemas are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions import licenses, urls
from gleanery.functions.names import canonical_rank, first_text, normalize_name

PHOTO = "struct<id:bigint,license_code:string,attribution:string,url:string,original_url:string,large_url:string,medium_url:string,small_url:string,user:struct<id:bigint,login:string>>"
OBSERVATION = f"""id bigint, uuid string, observed_on string, observed_on_string string, created_at string, updated_at string, quality_grade string, captive boolean,
 license_code string, description string, uri string, geoprivacy string, coordinates_obscured boolean, positional_accuracy bigint, latitude double, longitude double,
 place_guess string, geojson struct<type:string,coordinates:array<double>>, user struct<id:bigint,login:string,name:string>,
 taxon struct<id:bigint,name:string,rank:string,preferred_common_name:string>, photos array<{PHOTO}>"""
OCCURRENCE = """key bigint, gbifID bigint, datasetKey string, publishingOrgKey string, datasetName string, publisher string, scientificName string, taxonKey bigint, country string,
 eventDate string, basisOfRecord string, occurrenceID string, occurrenceRemarks string, references string, reference string, institutionCode string, collectionCode string,
 catalogNumber string, recordNumber string, license string, rightsHolder string,
 media array<struct<identifier:string,format:string,type:string,creator:string,license:string,rightsHolder:string,references:string>>"""
FILE = """pageid bigint, ns bigint, title string, lastrevid bigint, missing string, categories array<struct<title:string>>, templates array<struct<title:string>>,
 imageinfo array<struct<timestamp:string,user:string,url:string,thumburl:string,descriptionurl:string,size:bigint,width:bigint,height:bigint,sha1:string,mime:string,revid:bigint,
 extmetadata:map<string,struct<value:string>>>>"""
CHECKLIST_STATUSES = ("present", "doubtful", "disputed", "historical", "introduced", "uncertain", "absent")
CATALOG_STATUSES = ("accepted", "synonym", "doubtful", "disputed")


def _empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def observations(raw: DataFrame, snapshot: str) -> DataFrame:
    """One row for each observation, with its photos as an array ``media``."""
    oid = F.col("id")
    user = F.col("user")

    def photo(p: Column) -> Column:
        lic = licenses.code_license(p["license_code"])
        return F.struct(
            F.lit("inaturalist").alias("source"), oid.alias("observation_id"), p["id"].alias("photo_id"), lic.alias("license"),
            F.coalesce(F.nullif(F.when(p["user"].isNotNull(), p["user"]["login"]).otherwise(user["login"]), F.lit("")), user["name"]).alias("creator"),
            user["login"].alias("observer_login"), first_text(p["url"], p["original_url"]).alias("media_url"), p["large_url"].alias("large_url"),
            F.when(p["id"].isNotNull(), F.concat(F.lit("https://www.inaturalist.org/photos/"), p["id"].cast("string"))).alias("source_url"), p["attribution"].alias("attribution"),
        )

    page = F.when(oid.isNotNull(), F.concat(F.lit("https://www.inaturalist.org/observations/"), oid.cast("string")))
    return raw.select(
        F.lit("inaturalist").alias("source"), oid.alias("observation_id"), "uuid", user["id"].alias("observer_id"), user["login"].alias("observer_login"), "quality_grade", "captive",
        first_text(F.col("observed_on"), F.col("observed_on_string")).alias("observed_on"), licenses.code_license(F.col("license_code")).alias("license"),
        F.col("taxon.id").alias("source_taxon_id"), F.col("taxon.name").alias("source_taxon_name"), F.col("taxon.rank").alias("source_taxon_rank"),
        F.coalesce(F.nullif("uri", F.lit("")), page).alias("source_url"), "latitude", "longitude", "geoprivacy", "coordinates_obscured", "positional_accuracy", "place_guess",
        F.size(F.coalesce("photos", F.array().cast(f"array<{PHOTO}>"))).alias("photos_count"), F.lit(snapshot).alias("snapshot_date"),
        F.transform(F.coalesce("photos", F.array().cast(f"array<{PHOTO}>")), photo).alias("media"),
    )


def media_rows(records: DataFrame) -> DataFrame:
    """The photos of flattened records, one row each."""
    return records.select(F.explode("media").alias("m")).select("m.*")


def occurrences(raw: DataFrame, snapshot: str) -> DataFrame:
    """One row for each occurrence, with identity keys across sources, a flag for republished observations, and ``media``."""
    key = F.coalesce("key", "gbifID")
    oid = urls.observation_id(F.col("references"), F.col("reference"), F.col("occurrenceID"), F.col("occurrenceRemarks"))
    again = urls.republished(*[F.col(c) for c in ("datasetName", "publisher", "references", "reference", "occurrenceID", "datasetKey")]) | oid.isNotNull()
    identity = F.struct(
        key.alias("gbif_id"), F.col("occurrenceID").alias("occurrence_id"), F.col("institutionCode").alias("institution_code"), F.col("collectionCode").alias("collection_code"),
        F.col("catalogNumber").alias("catalog_number"), F.col("recordNumber").alias("record_number"), F.coalesce(first_text(F.col("references"), F.col("reference")), F.lit("")).alias("references"),
        F.col("datasetKey").alias("dataset_key"), F.col("publishingOrgKey").alias("publishing_org_key"), oid.alias("inaturalist_observation_id"),
    )
    item = lambda m: F.struct(F.lit("gbif").alias("source"), key.alias("gbif_id"), m["identifier"].alias("media_url"), m["format"].alias("format"), m["type"].alias("type"), m["creator"].alias("creator"), m["license"].alias("license"), m["rightsHolder"].alias("rights_holder"), m["references"].alias("references"))
    none = F.array().cast(raw.schema["media"].dataType)
    return raw.select(
        F.lit("gbif").alias("source"), key.alias("gbif_id"), F.col("scientificName").alias("scientific_name"), F.col("taxonKey").alias("taxon_key"), "country", F.col("eventDate").alias("event_date"),
        F.col("basisOfRecord").alias("basis_of_record"), F.when(F.col("key").isNotNull(), F.concat(F.lit("https://www.gbif.org/occurrence/"), F.col("key").cast("string"))).alias("source_url"),
        F.size(F.coalesce("media", none)).alias("media_count"), identity.alias("identity"), F.coalesce(again, F.lit(False)).alias("is_inaturalist_republication"), "license",
        F.col("rightsHolder").alias("rights_holder"), F.lit(snapshot).alias("snapshot_date"), F.transform(F.coalesce("media", none), item).alias("media"),
    )


def files(raw: DataFrame, snapshot: str, first_wins: bool = False) -> DataFrame:
    """One row for each wiki file page that exists, with license and whether a person must look at it."""
    info = F.get("imageinfo", F.lit(0))
    meta = lambda k: _empty(F.try_element_at(info["extmetadata"], F.lit(k))["value"])
    short, usage = urls.strip_html(meta("LicenseShortName")), urls.strip_html(meta("UsageTerms"))
    lic = licenses.template_license(short, usage, meta("LicenseUrl"), first_wins)
    artist, credit = F.nullif(urls.strip_html(meta("Artist")), F.lit("")), F.nullif(urls.strip_html(meta("Credit")), F.lit(""))
    titles = lambda c: F.transform(F.coalesce(c, F.array().cast("array<struct<title:string>>")), lambda x: _empty(x["title"]))
    blob = F.concat_ws(" ", F.coalesce(F.to_json(info["extmetadata"]), F.lit("")), F.array_join(titles(F.col("categories")), " "), F.array_join(titles(F.col("templates")), " "), short)
    why = licenses.review_reason(blob, lic, titles(F.col("templates")))
    page = F.when(_empty(F.col("title")) != "", F.concat(F.lit("https://commons.wikimedia.org/wiki/"), F.replace("title", F.lit(" "), F.lit("_"))))
    return raw.where("missing is null").select(
        F.lit("commons").alias("source"), "pageid", "title", F.regexp_replace("title", "^[^:]*:", "").alias("file_name"), F.coalesce(info["revid"], F.col("lastrevid")).alias("revid"),
        info["timestamp"].alias("file_timestamp"), info["sha1"].alias("sha1"), info["size"].alias("size"), info["width"].alias("width"), info["height"].alias("height"), info["mime"].alias("mime"),
        info["url"].alias("media_url"), info["thumburl"].alias("thumb_url"), F.coalesce(F.nullif(info["descriptionurl"], F.lit("")), page).alias("description_url"), page.alias("file_page_url"), artist.alias("creator"),
        F.coalesce(credit, artist).alias("attribution"), lic.alias("license"), F.nullif(short, F.lit("")).alias("license_short"), F.nullif(meta("LicenseUrl"), F.lit("")).alias("license_url"),
        F.nullif(usage, F.lit("")).alias("usage_terms"), titles(F.col("categories")).alias("categories"), why.isNotNull().alias("needs_review"), why.alias("review_reason"), F.lit(snapshot).alias("snapshot_date"),
    )


def _any(df: DataFrame, *names: str) -> Column:
    there = [F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in df.columns]
    return F.coalesce(*there) if there else F.lit(None).cast("string")


def checklist(raw: DataFrame) -> DataFrame:
    """Checklist rows with a name: original and normalised name, authorship, membership status (unknown ones as uncertain), notes."""
    name = F.trim(_any(raw, "original_name", "name", "scientific_name"))
    status = F.trim(F.lower(F.coalesce(_any(raw, "membership_status", "status"), F.lit("present"))))
    out = raw.select(name.alias("original_name"), normalize_name(name).alias("normalized_name"), _any(raw, "authorship").alias("authorship"), F.when(status.isin(*CHECKLIST_STATUSES), status).otherwise("uncertain").alias("membership_status"), _any(raw, "notes").alias("notes"))
    return out.where("original_name <> ''")


def catalog(raw: DataFrame, snapshot: str) -> DataFrame:
    """Catalog rows with a name: rank in full, known status, synonyms as an array."""
    name = F.trim(_any(raw, "scientific_name", "name", "accepted_name"))
    status = F.lower(F.coalesce(_any(raw, "taxonomic_status", "status"), F.lit("accepted")))
    if "synonyms" not in raw.columns:
        syn = F.array().cast("array<string>")
    elif raw.schema["synonyms"].dataType.typeName() == "array":
        syn = F.coalesce("synonyms", F.array().cast("array<string>"))
    else:
        syn = F.filter(F.transform(F.split(_empty(F.col("synonyms")), ";"), lambda t: F.trim(t)), lambda x: x != "")
    return raw.select(
        name.alias("scientific_name"), _any(raw, "authorship").alias("authorship"), F.coalesce(canonical_rank(F.coalesce(_any(raw, "rank"), F.lit("species"))), F.lit("species")).alias("rank"), _any(raw, "family").alias("family"),
        _any(raw, "genus").alias("genus"), _any(raw, "wsc_id", "id", "taxon_id").alias("wsc_id"), F.lit(snapshot).alias("snapshot_id"), F.when(status.isin(*CATALOG_STATUSES), status).otherwise("accepted").alias("taxonomic_status"), syn.alias("synonyms"), _any(raw, "accepted_name").alias("accepted_name"),
    ).where("scientific_name <> ''")


def reduced_snapshot(raw: DataFrame, fetched_at: str) -> DataFrame:
    """What a suite freezes of its observations: label, grade, captivity, license and photos, without precise coordinates."""
    return raw.select("id", "uuid", "quality_grade", "captive", "license_code", "taxon", "photos", F.col("user.id").alias("observer_id"), F.lit(fetched_at).alias("fetched_at"))
