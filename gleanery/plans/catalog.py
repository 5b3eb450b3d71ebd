"""Source transforms and text predicates over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.functions import media, names, urls
from gleanery.plans.registry import register, table


@register("json_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint").getField("k").alias("k"))


@register("nested_explode", "SELECT conv_id, turn, role, length(text) AS n FROM conversations")
def nested_explode(spark, d):
    """Conversations gathered as nested records, then flattened as the source transforms do."""
    c = table(spark, d, "conversations")
    nested = c.groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role", F.length("text").cast("long").alias("n"))).alias("media"))
    return nested.select("conv_id", F.explode("media").alias("m")).select("conv_id", "m.*")


@register(
    "observation_media",
    """SELECT CAST(o_orderkey AS BIGINT) AS observation_id, CAST(l_linenumber AS BIGINT) AS photo_id, CASE l_returnflag WHEN 'A' THEN 'cc-by' WHEN 'R' THEN 'cc0' END AS license, concat('https://www.inaturalist.org/photos/', l_linenumber) AS source_url, coalesce(nullif(CASE WHEN l_linestatus = 'F' THEN 'u' ELSE '' END, ''), 'n') AS creator
FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",
)
def observation_media(spark, d):
    """Orders with their lines as observations with photos, through the observation transform."""
    from gleanery.sources import transforms

    li = table(spark, d, "lineitem")
    blank = F.lit(None).cast("string")
    user = F.struct(F.lit(None).cast("bigint").alias("id"), F.when(F.col("l_linestatus") == "F", "u").otherwise("").alias("login"))
    photo = F.struct(F.col("l_linenumber").cast("bigint").alias("id"), F.when(F.col("l_returnflag") == "A", "CC-BY").when(F.col("l_returnflag") == "R", "CC0").alias("license_code"), *[blank.alias(c) for c in ("attribution", "url", "original_url", "large_url", "medium_url", "small_url")], user.alias("user"))
    obs = li.select("l_orderkey", photo.alias("p")).groupBy("l_orderkey").agg(F.collect_list("p").alias("photos"))
    raw = table(spark, d, "orders").join(obs, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_orderkey").alias("id"), "photos", F.struct(F.lit(1).cast("bigint").alias("id"), F.lit("").alias("login"), F.lit("n").alias("name")).alias("user"))
    return transforms.media_rows(transforms.observations(_with_schema(raw, transforms.OBSERVATION), "2020-01-01")).select("observation_id", "photo_id", "license", "source_url", "creator")


def _with_schema(df, ddl: str):
    """``df`` with the declared columns that it lacks as nulls."""
    from pyspark.sql.types import StructType

    want = StructType.fromDDL(ddl)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in want.fields])


@register(
    "occurrence_flags",
    """WITH o AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN concat('https://www.inaturalist.org/observations/', page_id, '?x=1') WHEN 1 THEN 'https://inaturalist.org/observations/none' WHEN 2 THEN url END AS r FROM pages)
SELECT page_id AS gbif_id, CASE WHEN page_id % 4 = 0 THEN page_id END AS inaturalist_observation_id, coalesce(r LIKE '%inaturalist%', FALSE) AS is_inaturalist_republication FROM o""",
)
def occurrence_flags(spark, d):
    from gleanery.sources import transforms

    k = F.col("page_id") % 4
    ref = F.when(k == 0, F.concat(F.lit("https://www.inaturalist.org/observations/"), F.col("page_id").cast("string"), F.lit("?x=1"))).when(k == 1, "https://inaturalist.org/observations/none").when(k == 2, F.col("url"))
    raw = table(spark, d, "pages").select(F.col("page_id").alias("key"), ref.alias("references"))
    return transforms.occurrences(_with_schema(raw, transforms.OCCURRENCE), "2020-01-01").select("gbif_id", "identity.inaturalist_observation_id", "is_inaturalist_republication")


@register("checklist_rows", """SELECT trim(c_name) AS original_name, lower(trim(c_name)) AS normalized_name, CASE WHEN lower(c_mktsegment) IN ('building') THEN 'present' ELSE 'uncertain' END AS membership_status FROM customer WHERE trim(c_name) <> ''""")
def checklist_rows(spark, d):
    from gleanery.sources import transforms

    raw = table(spark, d, "customer").select(F.concat(F.lit(" "), "c_name").alias("name"), F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("status"))
    return transforms.checklist(raw).select("original_name", "normalized_name", "membership_status")


@register("catalog_synonyms", "SELECT p_name AS scientific_name, 'subspecies' AS rank, unnest([p_type, p_brand]) AS synonym FROM part")
def catalog_synonyms(spark, d):
    from gleanery.sources import transforms

    raw = table(spark, d, "part").select(F.col("p_name").alias("name"), F.lit(" Ssp. ").alias("rank"), F.concat("p_type", F.lit(" ; ; "), "p_brand").alias("synonyms"))
    return transforms.catalog(raw, "s").select("scientific_name", "rank", F.explode("synonyms").alias("synonym"))


@register("extract_url_id", r"SELECT page_id, TRY_CAST(nullif(regexp_replace(regexp_extract(concat('http://inaturalist.org/observations/', regexp_replace(url, '^.*/([a-z]+)/', '')), 'observations/([^/?#]*)', 1), '[^0-9]', '', 'g'), '') AS BIGINT) AS obs_id FROM pages")
def extract_url_id(spark, d):
    link = F.concat(F.lit("http://inaturalist.org/observations/"), F.regexp_replace("url", "^.*/([a-z]+)/", ""))
    return table(spark, d, "pages").select("page_id", urls.observation_id(F.lit(None).cast("string"), link).alias("obs_id"))


@register("host_allowlist", r"WITH h AS (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host FROM pages) SELECT page_id, host, host = 'example.org' OR ends_with(host, '.example.org') OR host = 'therha.example.net' OR ends_with(host, '.therha.example.net') AS allowed FROM h")
def host_allowlist(spark, d):
    hosts = ["example.org", "therha.example.net"]
    return table(spark, d, "pages").select("page_id", urls.host_of(F.col("url")).alias("host"), urls.host_allowed(F.col("url"), hosts).alias("allowed"))


@register("html_sniff", "SELECT page_id, page_id % 3 <> 1 AS html FROM pages")
def html_sniff(spark, d):
    body = F.when(F.col("page_id") % 3 == 0, F.col("html")).when(F.col("page_id") % 3 == 1, F.lit("plain text")).otherwise(F.concat(F.lit("\n x"), F.col("html")))
    return table(spark, d, "pages").select("page_id", media.html_like(body).alias("html"))


@register("strip_html", "SELECT page_id, trim(regexp_replace(html, '<[^>]+>', '', 'g')) AS text FROM pages")
def strip_html(spark, d):
    return table(spark, d, "pages").select("page_id", urls.strip_html(F.col("html")).alias("text"))


@register("season_counts", "SELECT CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) < 6 THEN 'spring' WHEN month(o_orderdate) < 9 THEN 'summer' ELSE 'autumn' END AS season, count(*) AS n FROM orders GROUP BY 1")
def season_counts(spark, d):
    return table(spark, d, "orders").groupBy(media.season(F.month("o_orderdate")).alias("season")).agg(F.count("*").alias("n"))


@register("content_keys", "SELECT doc_id, concat('p/media/sha256/', sha256(text)[1:2], '/', sha256(text)[3:4], '/', sha256(text), '.jpg') AS key FROM documents")
def content_keys(spark, d):
    return table(spark, d, "documents").select("doc_id", urls.content_key("p/", F.sha2("text", 256), F.lit(".JPEG")).alias("key"))


@register("search_variants", """SELECT p_partkey, unnest(CASE WHEN len(string_split(concat(p_name, ' ', p_brand), ' ')) > 2 THEN ['"' || p_name || ' ' || p_brand || '"', '"' || array_to_string(string_split(concat(p_name, ' ', p_brand), ' ')[1:2], ' ') || '"'] ELSE ['"' || p_name || ' ' || p_brand || '"'] END) AS variant FROM part""")
def search_variants(spark, d):
    return table(spark, d, "part").select("p_partkey", F.explode(urls.search_variants(F.concat_ws(" ", "p_name", "p_brand"))).alias("variant"))


@register("canonical_ranks", "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'species' WHEN 1 THEN 'variety' WHEN 2 THEN lower(p_brand) END AS rank FROM part")
def canonical_ranks(spark, d):
    k = F.col("p_size") % 4
    raw = F.when(k == 0, " Spec. ").when(k == 1, "VAR").when(k == 2, F.col("p_brand")).otherwise("  ")
    return table(spark, d, "part").select("p_partkey", names.canonical_rank(raw).alias("rank"))
