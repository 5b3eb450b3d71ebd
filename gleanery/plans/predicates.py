"""Columns, filters and counts of curation over the driver's tables, one query for each."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.functions import answers, licenses, media, names, urls
from gleanery.operators import coverage, dedup, gates, score, upsert
from gleanery.plans.registry import register, table
from gleanery.session import scratch_dir
from gleanery.sources import files, transforms


def pick(key, *values):
    """A column: the value at key mod the number of values; None for null."""
    out = None
    for k, v in enumerate(values):
        v = v if not isinstance(v, str) and v is not None else F.lit(v).cast("string")
        hit = F.pmod(key, F.lit(len(values))) == k
        out = F.when(hit, v) if out is None else out.when(hit, v)
    return out


@register(
    "wiki_files",
    """SELECT page_id AS pageid, concat('Ab c ', page_id, '.jpg') AS file_name, concat('author ', page_id) AS creator, CASE page_id % 5 WHEN 0 THEN 'cc-by-sa' WHEN 1 THEN 'cc-by' WHEN 2 THEN 'gfdl' WHEN 4 THEN 'cc0' END AS license,
page_id % 5 = 3 AS needs_review, concat('https://commons.wikimedia.org/wiki/File:Ab_c_', page_id, '.jpg') AS file_page_url FROM pages WHERE page_id % 7 <> 0""",
)
def wiki_files(spark, d):
    """Pages as wiki file pages with license texts, through the file transform."""
    from gleanery.plans.catalog import _with_schema

    k = F.col("page_id")
    value = lambda c: F.struct(c.alias("value"))
    meta = F.create_map(F.lit("LicenseShortName"), value(pick(k, "CC BY-SA 4.0", "CC <b>BY 4.0</b>", "GFDL", "Public domain", "CC0")), F.lit("Artist"), value(F.concat(F.lit("<a href=x>author "), k.cast("string"), F.lit("</a>"))))
    info = F.array(F.struct(F.lit("u").alias("url"), F.lit(5).cast("bigint").alias("width"), meta.alias("extmetadata")))
    title = F.concat(F.lit("File:Ab c "), k.cast("string"), F.lit(".jpg"))
    raw = table(spark, d, "pages").select(k.alias("pageid"), title.alias("title"), F.when(k % 7 == 0, "").alias("missing"), info.alias("imageinfo"))
    schema = transforms.FILE
    from pyspark.sql.types import StructType

    want = StructType.fromDDL(schema)["imageinfo"].dataType.elementType
    full = F.transform("imageinfo", lambda x: F.struct(*[(x[f.name] if f.name in ("url", "width", "extmetadata") else F.lit(None)).cast(f.dataType).alias(f.name) for f in want.fields]))
    return transforms.files(_with_schema(raw.withColumn("imageinfo", full), schema), "2020-01-01").select("pageid", "file_name", "creator", "license", "needs_review", "file_page_url")


@register("json_lines", "SELECT doc_id, lang, source, n_chars FROM documents")
def json_lines(spark, d):
    """A raw snapshot written as JSON lines and read back under its declared schema."""
    import uuid

    path = f"{scratch_dir(spark)}/lines-{uuid.uuid4().hex}"
    files.write_lines(table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars"), path)
    return files.read_lines(spark, path, "doc_id long, lang string, source string, n_chars long")


@register("reduced_snapshot", "SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'research' ELSE 'needs_id' END AS quality_grade, o_custkey AS observer_id, '2020-01-01' AS fetched_at FROM orders")
def reduced_snapshot(spark, d):
    from gleanery.plans.catalog import _with_schema

    user = F.struct(F.col("o_custkey").alias("id"), F.lit("u").alias("login"), F.lit("n").alias("name"))
    raw = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", "research").otherwise("needs_id").alias("quality_grade"), user.alias("user"), F.lit(50.1).alias("latitude"))
    out = transforms.reduced_snapshot(_with_schema(raw, transforms.OBSERVATION), "2020-01-01")
    assert not {"latitude", "longitude", "geojson"} & set(out.columns)
    return out.select("id", "quality_grade", "observer_id", "fetched_at")


@register("large_photos", "SELECT page_id, concat(CASE page_id % 4 WHEN 3 THEN 'http://other.org/' ELSE 'http://static.inaturalist.org/' END, page_id, CASE page_id % 4 WHEN 3 THEN '/square.' ELSE '/large.' END, 'jpg') AS url FROM pages")
def large_photos(spark, d):
    k = F.col("page_id")
    url = F.concat(F.when(k % 4 == 3, "http://other.org/").otherwise("http://static.inaturalist.org/"), k.cast("string"), pick(k, "/square.", "/small.", "/medium.", "/square."), F.lit("jpg"))
    return table(spark, d, "pages").select("page_id", urls.large_photo(url).alias("url"))


@register("normalize_authorships", "SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN concat('(', c_name, ', ', c_custkey, ')') END AS authorship FROM customer")
def normalize_authorships(spark, d):
    k = F.col("c_custkey")
    raw = F.when(k % 4 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" ( "), "c_name", F.lit(" ,\t"), k.cast("string"), F.lit("  ) ")))
    return table(spark, d, "customer").select("c_custkey", names.normalize_authorship(raw).alias("authorship"))


@register(
    "license_reviews",
    """SELECT p_partkey, CASE p_size % 7 WHEN 0 THEN 'unknown-license' WHEN 1 THEN 'multi-license markers=[''gfdl'']' WHEN 2 THEN 'gfdl-dual-license' WHEN 3 THEN 'ambiguous markers=[''permission'', ''unknown'']' WHEN 5 THEN 'multi-license templates=[''cc-by-3.0'', ''cc-by-sa-3.0'']' END AS reason FROM part""",
)
def license_reviews(spark, d):
    k = F.col("p_size")
    blob = pick(k, "nothing known about it", "CC-BY-SA or GFDL", "gfdl", "by Permission of the Unknown", "plain cc-by", "plain text", "cc-by")
    lic = pick(k, None, "cc-by", "cc-by", "cc-by", "cc-by", "cc-by", "cc-by")
    cards = F.when(F.pmod(k, F.lit(7)) == 5, F.array(F.lit("Template:Cc-by-sa-3.0"), F.lit("Template:Cc-by-3.0"), F.lit("Template:Cc-by-layout"))).otherwise(F.array(F.lit("Template:Cc-by-3.0")))
    return table(spark, d, "part").select("p_partkey", licenses.review_reason(blob, lic, cards).alias("reason"))


@register(
    "attributions",
    """SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN concat(CASE WHEN p_size % 3 = 0 THEN concat('“', p_name, '” by ') ELSE '' END, p_brand, ', licensed under CC-BY-4.0', CASE WHEN p_size % 2 = 0 THEN ' (https://l)' ELSE '' END, ', source: https://s/', p_partkey, '.') END AS attribution FROM part""",
)
def attributions(spark, d):
    k = F.col("p_size")
    out = licenses.attribution(F.when(k % 5 == 0, " ").otherwise(F.concat(F.lit(" "), "p_brand")), F.lit(" CC-BY-4.0 "), F.when(k % 2 == 0, "https://l"), F.concat(F.lit("https://s/"), F.col("p_partkey").cast("string")), F.when(k % 3 == 0, F.col("p_name")))
    return table(spark, d, "part").select("p_partkey", out.alias("attribution"))


@register("difference_hash", "WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings) SELECT vec_id, list_reduce(list_transform(list_filter(range(1, 64), lambda i: i % 8 <> 0), lambda i: CASE WHEN v[i] > v[i + 1] THEN '1' ELSE '0' END), lambda a, b: a || b) AS dhash FROM e")
def difference_hash(spark, d):
    e = table(spark, d, "embeddings")
    return e.select("vec_id", F.lpad(F.bin(media.difference_hash(F.col("embedding"), 8)), 56, "0").alias("dhash"))


@register("image_formats", "SELECT page_id, CASE page_id % 8 WHEN 0 THEN 'PNG' WHEN 1 THEN 'JPEG' WHEN 2 THEN 'WEBP' WHEN 3 THEN 'GIF' WHEN 4 THEN 'BMP' WHEN 5 THEN 'OTHER' END AS format FROM pages")
def image_formats(spark, d):
    head = pick(F.col("page_id"), "89504E470D0A1A0A00000000", "FFD8FFE000104A4649460001", "524946460000000057454250", "474946383961000000000000", "424D00000000000000000000", "49492A000000000000000000", "3C21444F4354595045206874", "524946460000000057415645")
    return table(spark, d, "pages").select("page_id", media.sniff(F.unhex(head)).alias("format"))


@register(
    "payload_checks",
    """SELECT l_orderkey, l_linenumber, CASE l_partkey % 9 WHEN 0 THEN 'corrupt' WHEN 1 THEN 'html_error_page' WHEN 2 THEN 'unsupported_format' WHEN 3 THEN 'tiny_bytes' WHEN 4 THEN 'mime_mismatch' WHEN 5 THEN 'decode_error'
WHEN 6 THEN 'tiny' ELSE CASE WHEN l_linenumber = 1 THEN 'near_empty' ELSE 'ok' END END AS verdict FROM lineitem""",
)
def payload_checks(spark, d):
    k = F.col("l_partkey") % 9
    body = lambda head, n: F.unhex(F.rpad(F.lit(head), 2 * n, "0"))
    jpeg = body("FFD8", 300)
    data = F.when(k == 0, F.unhex(F.lit(""))).when(k == 1, F.lit(" <html><body>no</body>").cast("binary")).when(k == 2, body("424D", 300)).when(k == 3, body("FFD8", 199)).otherwise(jpeg)
    said = F.when(k == 4, "image/png").when(k == 5, "").otherwise("Image/JPG; q=1")
    width, grey = F.when(k == 5, None).when(k == 6, 149).otherwise(150), F.when(F.col("l_linenumber") == 1, 2).otherwise(3)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", media.validate(data, said, width, F.lit(150), grey).alias("verdict"))


@register(
    "image_policy",
    """WITH m AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN 2 ELSE 1 END AS f, l_suppkey * 7 % 4000 + 100 AS w, l_partkey % 900 + 200 AS h, l_orderkey % 4000000 AS s FROM lineitem),
n AS (SELECT *, least(1.0, 1536 / CAST(greatest(w, h) AS DOUBLE)) AS k FROM m)
SELECT l_orderkey, l_linenumber, CASE WHEN f <> 1 THEN 'animated_or_multiframe' WHEN least(w, h) < 320 THEN 'source_resolution_below_320' WHEN least(greatest(1, round(w * k)), greatest(1, round(h * k))) < 320 THEN 'aspect_ratio_too_extreme'
WHEN s > 3000000 THEN 'normalized_image_exceeds_3MB' END AS reason FROM n""",
)
def image_policy(spark, d):
    frames = F.when(F.col("l_linenumber") == 7, 2).otherwise(1)
    reason = media.image_policy(frames, F.col("l_suppkey") * 7 % 4000 + 100, F.col("l_partkey") % 900 + 200, F.col("l_orderkey") % 4_000_000)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", reason.alias("reason"))


@register(
    "billed_tokens",
    "SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 AND o_custkey % 5 <> 0 THEN greatest(o_orderkey % 50, o_custkey % 90 - o_orderkey % 20) ELSE o_orderkey % 50 END AS billed FROM orders",
)
def billed_tokens(spark, d):
    c, o = F.col("o_custkey"), F.col("o_orderkey")
    host = F.when(c % 3 == 0, "https://generativelanguage.googleapis.com/v1").otherwise("https://other/")
    return table(spark, d, "orders").select("o_orderkey", answers.billed_output(host, o % 20, o % 50, F.when(c % 5 != 0, c % 90)).alias("billed"))


@register(
    "transient_errors",
    "SELECT event_id, event_id % 6 IN (0, 1, 3, 4) AS call, event_id % 6 IN (0, 2, 4) AS download FROM events",
)
def transient_errors(spark, d):
    k = F.col("event_id")
    kind = pick(k, "ReadTimeout", "ServiceError", "ConnectError", "ServiceError", "Oops", "ValueError")
    message = pick(k, "", "Model is OVERLOADED", "refused", "HTTP 502", "please try again", "bad request 400")
    return table(spark, d, "events").select("event_id", answers.transient_call(kind, message).alias("call"), answers.transient_download(kind, message).alias("download"))


@register("photo_codes", "SELECT 'cc-by,cc-by-nc,cc0' AS research, 'cc-by,cc0' AS conservative, 'cc0,cc-by,cc-by-nc' AS other")
def photo_codes(spark, d):
    codes = {name: coverage.photo_codes(list(licenses.PROFILES[name][0])) for name in ("research", "conservative")}
    return spark.range(1).select(*[F.lit(",".join(sorted(c.lower().split(",")))).alias(n) for n, c in codes.items()], F.lit(coverage.photo_codes(["none of these"])).alias("other"))


@register("display_ordinals", "SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 END AS ordinal FROM customer")
def display_ordinals(spark, d):
    return table(spark, d, "customer").select("c_custkey", gates.display_ordinal(pick(F.col("c_custkey"), *gates.CATEGORIES, "invented")).cast("int").alias("ordinal"))


@register(
    "name_guards",
    """WITH x AS (SELECT page_id, substr(url, 1 + page_id % 9, page_id % 5) AS name, CASE WHEN page_id % 4 = 0 THEN upper(sha256(url)) ELSE substr(sha256(url), 1 + page_id % 3) END AS said FROM pages)
SELECT page_id, coalesce(name <> '' AND name NOT IN ('.', '..') AND NOT regexp_matches(name, '[/\\\\]'), false) AS suite, coalesce(regexp_matches(said, '^[0-9a-f]{64}$'), false) AS digest FROM x""",
)
def name_guards(spark, d):
    """Pieces of URLs as suite names, their digests whole, cut and in capitals."""
    k, digest = F.col("page_id"), F.sha2("url", 256)
    name = F.expr("substring(url, cast(1 + page_id % 9 as int), cast(page_id % 5 as int))")
    said = F.when(k % 4 == 0, F.upper(digest)).otherwise(F.substring(digest, (1 + k % 3).cast("int"), F.lit(64)))
    return table(spark, d, "pages").select("page_id", urls.is_suite_name(name).alias("suite"), urls.is_digest(said).alias("digest"))


ELIGIBLE = """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 OR l_orderkey % 11 = 0 THEN 'source_requires_manual_label_review' WHEN l_partkey % 13 = 0 THEN 'observation_id_mismatch' WHEN l_partkey % 7 = 0 THEN 'source_label_mismatch'
WHEN l_suppkey % 5 = 0 THEN 'source_not_species_level' WHEN l_returnflag = 'N' THEN 'not_research_grade' WHEN l_linestatus = 'O' OR l_suppkey % 3 = 0 THEN 'captive_observation' WHEN l_partkey % 17 = 0 THEN 'photo_not_in_observation'
WHEN l_quantity > 40 THEN 'photo_license_not_allowed' END AS reason FROM lineitem"""


def eligible(spark, d):
    part, supp, key = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey")
    taxon = F.struct(F.when(part % 7 == 0, "x").otherwise("sp").alias("name"), F.when(supp % 5 == 0, "genus").otherwise("species").alias("rank"))
    photos = F.array(F.struct(F.lit(99).cast("bigint").alias("id"), F.lit("cc0").alias("license_code")), F.struct(F.when(part % 17 == 0, 98).otherwise(F.col("l_linenumber")).cast("bigint").alias("id"), F.when(F.col("l_quantity") > 40, "none").otherwise("CC-BY").alias("license_code")))
    observation = F.struct(F.when(part % 13 == 0, key + 1).otherwise(key).alias("id"), taxon.alias("taxon"), F.when(F.col("l_returnflag") == "N", "needs_id").otherwise("research").alias("quality_grade"), ((F.col("l_linestatus") == "O") | (supp % 3 == 0)).alias("captive"), photos.alias("photos"))
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.lit("sp").alias("correct_taxon"), F.when(F.col("l_linenumber") == 7, "gbif").otherwise("inaturalist").alias("source"), key.cast("string").alias("source_observation_id"),
        F.col("l_linenumber").cast("string").alias("source_media_id"), F.when(key % 11 != 0, observation).alias("observation"),
    )
    return coverage.eligibility(rows, ["CC-BY-4.0", "CC0-1.0"])


@register("eligibility", ELIGIBLE)
def eligibility(spark, d):
    return eligible(spark, d).select("l_orderkey", "l_linenumber", "reason")


@register("exclusion_counts", f"SELECT reason, count(*) AS n FROM ({ELIGIBLE}) WHERE reason IS NOT NULL GROUP BY reason")
def exclusion_counts(spark, d):
    return score.counts_by(eligible(spark, d).where("reason is not null"), F.col("reason"), "reason")


@register("shortlist_sizes", "SELECT size, count(*) AS n FROM (SELECT p_type, CAST(count(DISTINCT p_name) AS INT) AS size FROM part GROUP BY p_type) GROUP BY size")
def shortlist_sizes(spark, d):
    tasks = table(spark, d, "part").groupBy("p_type").agg(F.collect_set("p_name").alias("candidates"))
    return score.counts_by(tasks, F.size("candidates"), "size")


@register("ordered_rows", "SELECT * FROM nation")
def ordered_rows(spark, d):
    out = files.ordered(table(spark, d, "nation"), ["n_regionkey", "n_nationkey"])
    assert out.columns == sorted(out.columns)
    return out


@register("best_canonical", "SELECT l_partkey AS taxon, arg_min(l_orderkey * 10 + l_linenumber, (-coalesce(CASE WHEN l_linenumber <> 3 THEN l_suppkey END * l_linenumber, 0), l_orderkey * 10 + l_linenumber)) AS canonical FROM lineitem GROUP BY 1")
def best_canonical(spark, d):
    li = table(spark, d, "lineitem")
    rows = li.select(F.col("l_partkey").alias("taxon"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"), F.when(F.col("l_linenumber") != 3, F.col("l_suppkey")).alias("width"), F.col("l_linenumber").alias("height"))
    return dedup.best_canonical(rows, "taxon", "key", "width", "height")


@register(
    "gate_claims",
    """SELECT 'claim' AS gate, concat('c', o_orderkey) AS entity, 'lacks geography' AS message FROM orders WHERE o_orderkey % 9 = 0
UNION ALL SELECT 'claim_evidence', concat('c', o_orderkey), concat('evidence_id unknown: ', o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 4 <> 0)""",
)
def gate_claims(spark, d):
    claims = table(spark, d, "orders").select(F.concat(F.lit("c"), F.col("o_orderkey").cast("string")).alias("id"), F.col("o_custkey").cast("string").alias("evidence_id"), F.lit("t").alias("taxon"), F.when(F.col("o_orderkey") % 9 == 0, " ").otherwise("PL").alias("geography"), F.lit("x").alias("claim"))
    return gates.evidence_claims(claims, table(spark, d, "customer").where("c_custkey % 4 <> 0").select(F.col("c_custkey").cast("string").alias("id")))


@register(
    "gate_assessments",
    """WITH r AS (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS taxon FROM customer)
SELECT 'category' AS gate, taxon AS entity, 'invalid category harmless' AS message FROM r WHERE c_custkey % 6 = 1 UNION ALL SELECT 'status', taxon, 'invalid status done' FROM r WHERE c_custkey % 6 = 2
UNION ALL SELECT 'assessment', taxon, 'lacks rationale' FROM r WHERE c_custkey % 6 = 3 UNION ALL SELECT 'review_date', taxon, 'not an ISO date' FROM r WHERE c_custkey % 6 = 4
UNION ALL SELECT 'evidence_ids', taxon, 'empty evidence reference' FROM r WHERE c_custkey % 6 = 5 UNION ALL SELECT 'evidence_ids', taxon, concat('ref unknown: ', taxon) FROM r WHERE c_custkey % 6 <> 5 AND c_custkey % 10 = 0
UNION ALL SELECT 'taxon', taxon, concat('taxon unknown: ', taxon) FROM r WHERE c_custkey % 15 = 0""",
)
def gate_assessments(spark, d):
    k = F.col("c_custkey")
    me = k.cast("string")
    bad = lambda n, wrong, right: F.when(k % 6 == n, wrong).otherwise(right)
    rows = table(spark, d, "customer").select(
        me.alias("taxon"), bad(1, "harmless", "uncertain").alias("category"), bad(2, "done", "draft").alias("status"), F.lit("PL").alias("geographic_scope"), bad(3, "", "r").alias("rationale"), F.lit("w").alias("reviewer"),
        bad(4, "soon", "2020-02-01").alias("review_date"), F.when(k % 6 == 5, F.array(F.lit(" "))).otherwise(F.array(me)).alias("evidence_ids"),
    )
    known = table(spark, d, "customer")
    blank = spark.range(1).select(F.lit(" ").alias("id"))
    sources = known.where("c_custkey % 10 <> 0").select(me.alias("id")).unionByName(blank)
    return gates.assessments(rows, sources, known.where("c_custkey % 15 <> 0").select(me.alias("taxon")))


@register(
    "media_observations",
    "WITH o AS (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS status, arg_max(o_totalprice, o_orderkey) AS price FROM orders GROUP BY 1) SELECT c_custkey, status, price FROM customer LEFT JOIN o ON o_custkey = c_custkey",
)
def media_observations(spark, d):
    """Media with the last observation under their digest (results with their candidate by URL are the same lookup)."""
    rows = table(spark, d, "customer").select("c_custkey", F.sha2(F.col("c_custkey").cast("string"), 256).alias("sha256"))
    found = table(spark, d, "orders").select(F.sha2(F.col("o_custkey").cast("string"), 256).alias("sha"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), "o_orderkey")
    return upsert.last_lookup(rows, "sha256", found, "sha", "o_orderkey").select("c_custkey", "status", "price")


@register("run_summary", "SELECT count(DISTINCT user_id) AS tasks, count(*) AS wrote, count_if(event_type = 'refund') AS errors, count_if(event_id % 4 > 1) AS retried FROM events")
def run_summary(spark, d):
    e = table(spark, d, "events")
    return score.run_summary(e.select(F.col("user_id").alias("task_id"), F.when(F.col("event_type") == "refund", "timeout").otherwise("").alias("error"), (F.col("event_id") % 4).alias("attempts")))


RELEASED = {"taxa": "part", "media": "orders", "attribution": "customer", "evidence": "supplier", "danger_assessments": "nation"}


@register("release_counts", " UNION ALL ".join(f"SELECT '{name}' AS artifact, count(*) AS rows FROM {t}" for name, t in RELEASED.items()))
def release_counts(spark, d):
    return score.release_counts({name: table(spark, d, t) for name, t in RELEASED.items()})


ESCAPED = r"""CASE WHEN text IS NULL THEN 'null' ELSE concat('"', array_to_string(list_transform(string_split(text, ''), lambda c: CASE WHEN c = '' THEN '' WHEN c = '"' THEN '\"' WHEN c = '\' THEN '\\' WHEN c = chr(10) THEN '\n' WHEN c = chr(13) THEN '\r' WHEN c = chr(9) THEN '\t'
WHEN unicode(c) BETWEEN 32 AND 127 THEN c WHEN unicode(c) < 65536 THEN printf('\u%04x', unicode(c)) ELSE printf('\u%04x\u%04x', 55296 + (unicode(c) - 65536) // 1024, 56320 + (unicode(c) - 65536) % 1024) END), ''), '"') END"""


def canonical_rows(df, key):
    return score.canonical_json(**{key: F.col(key).cast("string"), "text": score.canonical_text(F.col("text"))})


@register("canonical_json", f"""SELECT doc_id, sha256(concat('{{"doc_id": ', doc_id, ', "text": ', {ESCAPED}, '}}')) AS digest FROM documents""")
def canonical_json(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(canonical_rows(None, "doc_id"), 256).alias("digest"))


@register("suite_hash", f"""SELECT count(*) AS rows, sha256(string_agg(concat('{{"item_id": ', item_id, ', "text": ', {ESCAPED}, '}}'), '' ORDER BY item_id)) AS digest FROM benchmark""")
def suite_hash(spark, d):
    """The digest of a suite's tasks: sha256 over their canonical rows in order of id."""
    return score.rows_hash(table(spark, d, "benchmark"), "item_id", canonical_rows(None, "item_id"))


@register(
    "gate_suite_rows",
    """WITH t AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS entity FROM orders)
SELECT 'suite_row' AS gate, entity, 'other shortlist' AS message FROM t WHERE k % 10 IN (1, 9) UNION ALL SELECT 'suite_row', entity, 'other prompt' FROM t WHERE k % 10 = 2 UNION ALL SELECT 'suite_row', entity, 'other image' FROM t WHERE k % 10 IN (3, 4, 9)
UNION ALL SELECT 'suite_row', entity, 'other source snapshot' FROM t WHERE k % 10 IN (5, 9) UNION ALL SELECT 'suite_row', entity, 'source: captive_observation' FROM t WHERE k % 10 = 6
UNION ALL SELECT 'manifest', '', 'other tasks_hash'""",
)
def gate_suite_rows(spark, d):
    """Orders as tasks against shortlists, prompts, images and snapshots computed anew, and against a manifest of another digest."""
    k = F.col("o_orderkey") % 10
    names = F.array(F.col("o_orderpriority"), F.lit("b"), F.lit("a"))
    digest = F.sha2(F.col("o_orderkey").cast("string"), 256)
    orders = table(spark, d, "orders")
    tasks = orders.select(
        F.col("o_orderkey").alias("task_id"), F.when(k == 1, F.reverse(names)).otherwise(names).alias("candidates"), F.when(k == 1, answers.user_prompt(F.reverse(names))).when(k == 2, "who?").otherwise(answers.user_prompt(names)).alias("user_prompt"),
        F.when(k == 3, "x").otherwise(digest).alias("image_sha256"), F.when(k == 5, "x").otherwise(digest).alias("source_snapshot_sha256"), F.when(k == 6, "captive_observation").alias("reason"),
    )
    expected = orders.where(k != 9).select(F.col("o_orderkey").alias("task_id"), names.alias("candidates"), digest.alias("image_digest"), F.when(k == 4, 3_000_001).otherwise(99).alias("image_bytes"), digest.alias("snapshot_digest"))
    n = orders.count()
    return gates.suite_rows(tasks, expected, answers.user_prompt(F.col("candidates"))).unionByName(gates.suite_manifest(tasks, {"protocol_version": 5, "tasks_hash": "a", "tasks": n}, "b"))
