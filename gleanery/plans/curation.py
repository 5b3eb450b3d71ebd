"""Selection, duplicates, reconciliation, gates, upserts and audits over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.functions import media
from gleanery.operators import caps, coverage, dedup, gates, merkle, reconcile, upsert
from gleanery.plans.registry import register, table
from gleanery.session import cut

SEASON = "CASE WHEN month({0}) IN (12, 1, 2) THEN 'winter' WHEN month({0}) < 6 THEN 'spring' WHEN month({0}) < 9 THEN 'summer' ELSE 'autumn' END"


def capped_rows(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(
        F.col("l_partkey").alias("taxon"), F.struct("l_orderkey", "l_linenumber", "l_suppkey").alias("order_key"), F.col("l_orderkey").alias("observation"), F.col("l_suppkey").alias("observer"),
        F.year("l_shipdate").alias("location"), media.season(F.month("l_shipdate")).alias("season"),
    )


CAPS = {"cap_taxon": 10, "cap_observation": 2, "cap_observer": 4, "cap_location": 3, "cap_season": 4}


@register(
    "caps_per_taxon",
    f"""WITH RECURSIVE r AS (SELECT l_partkey AS p, l_orderkey AS o, l_linenumber AS n, l_suppkey AS s, CAST(year(l_shipdate) AS INT) AS y, {SEASON.format("l_shipdate")} AS e,
  row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, year(l_shipdate), {SEASON.format("l_shipdate")}) AS rn FROM lineitem),
w AS (SELECT p, CAST(0 AS BIGINT) AS rn, CAST([] AS STRUCT(o BIGINT, s BIGINT, y INT, e VARCHAR)[]) AS acc, CAST(NULL AS BIGINT) AS o, CAST(NULL AS INT) AS n, CAST(NULL AS BIGINT) AS s, CAST(NULL AS INT) AS y, CAST(NULL AS VARCHAR) AS e, FALSE AS ok FROM (SELECT DISTINCT p FROM r)
UNION ALL
SELECT p, rn, CASE WHEN ok THEN list_append(acc, {{'o': o, 's': s, 'y': y, 'e': e}}) ELSE acc END, o, n, s, y, e, ok FROM (
  SELECT r.p, r.rn, w.acc, r.o, r.n, r.s, r.y, r.e, len(w.acc) < 10 AND len(list_filter(w.acc, lambda x: x.o = r.o)) < 2 AND len(list_filter(w.acc, lambda x: x.s = r.s)) < 4 AND len(list_filter(w.acc, lambda x: x.y = r.y)) < 3 AND len(list_filter(w.acc, lambda x: x.e = r.e)) < 4 AS ok
  FROM w JOIN r ON r.p = w.p AND r.rn = w.rn + 1))
SELECT p AS taxon, o AS observation, s AS observer, y AS location, e AS season FROM w WHERE ok""",
)
def caps_per_taxon(spark, d):
    return caps.per_taxon(capped_rows(spark, d), CAPS).where("reason is null").select("taxon", "observation", "observer", "location", "season")


@register("caps_global")
def caps_global(spark, d):
    """Observation and observer counters run across taxa: sequential by nature, so SQL has no workable form of it."""
    rows = capped_rows(spark, d)
    return caps.select(rows, ["taxon", "order_key"], {"cap_taxon": (["taxon"], 10), "cap_observation": (["observation"], 2), "cap_observer": (["observer"], 40)}).select("taxon", "observation", "observer", "reason")


VERDICT = """CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'accepted' WHEN o_orderpriority = '3-MEDIUM' THEN 'review_required' ELSE 'rejected' END"""


def licensed(spark, d):
    code = F.when(F.col("o_orderpriority") == "1-URGENT", "CC BY 4.0").when(F.col("o_orderpriority") == "2-HIGH", "cc_by-nc").when(F.col("o_orderpriority") == "3-MEDIUM", "Creative Commons by-sa").otherwise("all rights reserved")
    return caps.license_filter(table(spark, d, "orders").select("o_orderkey", code.alias("license")), "research")


@register("license_classify", f"SELECT o_orderkey, {VERDICT} AS verdict FROM orders")
def license_classify(spark, d):
    return licensed(spark, d).select("o_orderkey", "verdict")


@register("license_filter_counts", f"SELECT {VERDICT} AS verdict, count(*) AS n FROM orders GROUP BY 1")
def license_filter_counts(spark, d):
    return licensed(spark, d).groupBy("verdict").agg(F.count("*").alias("n"))


def prints(spark, d):
    """Each document with the hashes of its 64-bin token histogram, as if that were an image of 64 grey values. Histograms are counted where the texts lie;
    only those of an id that several rows have are summed over these."""
    docs = table(spark, d, "documents").where("doc_id is not null")
    words = F.filter(F.split(F.lower("text"), r"\s+"), lambda w: w != "")
    bins = F.transform(words, lambda w: (F.conv(F.substring(F.md5(w.cast("binary")), 1, 2), 16, 10).cast("int") % 64).cast("tinyint"))
    own = docs.select("doc_id", F.sha2("text", 256).alias("sha256"), "source", F.length("text").alias("n"), media.histogram_hashes(media.bin_counts(bins)).alias("h"))
    own = cut(own.select("doc_id", "sha256", "source", "n", "h.ahash", "h.dhash"))
    again = cut(own.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    known = own.where("ahash is not null")
    if again.isEmpty():
        return known
    binned = docs.join(again, "doc_id", "left_semi").select("doc_id", F.explode(bins).alias("b"))
    summed = binned.groupBy("doc_id").agg(F.array(*[F.count_if(F.col("b") == i) for i in range(64)]).alias("px"))
    shared = summed.select("doc_id", media.histogram_hashes(F.col("px")).alias("h")).select("doc_id", "h.*")
    return known.join(again, "doc_id", "left_anti").unionByName(own.drop("ahash", "dhash").join(shared, "doc_id"))


PRINTS = r"""WITH RECURSIVE w AS (SELECT doc_id, unnest(list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> '')) AS t FROM documents),
h AS (SELECT doc_id, CAST(concat('0x', md5(t)[1:2]) AS INT) % 64 AS b, count(*) AS c FROM w GROUP BY ALL),
m AS (SELECT doc_id, map_from_entries(list((b, c))) AS m, CAST(sum(c) AS BIGINT) AS tot FROM h GROUP BY doc_id),
v AS (SELECT doc_id, tot, list_transform(range(64), lambda i: coalesce(m[CAST(i AS INT)], 0)) AS px FROM m),
p AS (SELECT doc_id, list_reduce(list_transform(px, lambda x: CASE WHEN x * 64 > tot THEN '1' ELSE '0' END), lambda a, b: a || b) AS ahash,
      list_reduce(list_transform(range(64), lambda i: CASE WHEN px[i + 1] > px[(i + 1) % 64 + 1] THEN '1' ELSE '0' END), lambda a, b: a || b) AS dhash FROM v),
q AS (SELECT doc_id, CAST(ahash AS BIT) AS ahash, CAST(dhash AS BIT) AS dhash FROM p), """


@register("hamming_pairs", PRINTS + "u AS (SELECT ahash, dhash, min(doc_id) AS k FROM q GROUP BY ALL) SELECT x.k AS a, y.k AS b, CAST(greatest(bit_count(xor(x.ahash, y.ahash)), bit_count(xor(x.dhash, y.dhash))) AS INT) AS dist FROM u x JOIN u y ON x.k < y.k WHERE bit_count(xor(x.ahash, y.ahash)) <= 6 AND bit_count(xor(x.dhash, y.dhash)) <= 6")
def hamming_pairs(spark, d):
    rep = cut(prints(spark, d).groupBy("ahash", "dhash").agg(F.min("doc_id").alias("k")))
    found = dedup.near_pairs(rep, ["ahash", "dhash"], 6, name="k")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "dist")


@register(
    "duplicate_components",
    PRINTS
    + """u AS (SELECT ahash, dhash, min(doc_id) AS k FROM q GROUP BY ALL),
e AS (SELECT x.k AS a, y.k AS b FROM u x JOIN u y ON x.k <> y.k WHERE bit_count(xor(x.ahash, y.ahash)) <= 6 AND bit_count(xor(x.dhash, y.dhash)) <= 6
  UNION SELECT q.doc_id, u.k FROM q JOIN u USING (ahash, dhash) UNION SELECT u.k, q.doc_id FROM q JOIN u USING (ahash, dhash)),
c AS (SELECT doc_id AS node, doc_id AS reach FROM q UNION SELECT c.node, e.b FROM c JOIN e ON c.reach = e.a)
SELECT node AS key, min(reach) AS cluster FROM c GROUP BY node HAVING count(*) > 1""",
)
def duplicate_components(spark, d):
    return clustered(spark, d).select("key", "cluster")


def clustered(spark, d):
    rows = prints(spark, d).withColumnRenamed("doc_id", "key").withColumns({"width": F.col("n"), "height": F.lit(1)})
    return dedup.clusters(rows, 6)


#: Members of duplicate groups with their group, then each group's method and score.
GROUPS = (
    PRINTS
    + """u AS (SELECT ahash, dhash, min(doc_id) AS k FROM q GROUP BY ALL),
n AS (SELECT x.k AS a, y.k AS b, greatest(bit_count(xor(x.ahash, y.ahash)), bit_count(xor(x.dhash, y.dhash))) AS dist FROM u x JOIN u y ON x.k <> y.k WHERE bit_count(xor(x.ahash, y.ahash)) <= 6 AND bit_count(xor(x.dhash, y.dhash)) <= 6),
e AS (SELECT a, b FROM n UNION SELECT q.doc_id, u.k FROM q JOIN u USING (ahash, dhash) UNION SELECT u.k, q.doc_id FROM q JOIN u USING (ahash, dhash)),
c AS (SELECT doc_id AS node, doc_id AS reach FROM q UNION SELECT c.node, e.b FROM c JOIN e ON c.reach = e.a),
member AS (SELECT node AS key, min(reach) AS cluster FROM c GROUP BY node HAVING count(*) > 1),
whole AS (SELECT key, cluster, sha256(text) AS sha, length(text) AS n, ahash, dhash FROM member JOIN documents ON documents.doc_id = key JOIN q ON q.doc_id = key),
ex AS (SELECT DISTINCT cluster FROM (SELECT cluster, sha, count(*) AS n FROM whole GROUP BY ALL) WHERE n > 1), zero AS (SELECT DISTINCT cluster FROM (SELECT cluster, ahash, dhash, count(*) AS n FROM whole GROUP BY ALL) WHERE n > 1),
near AS (SELECT cluster, min(dist) AS dist FROM n JOIN member ON key = a GROUP BY cluster),
told AS (SELECT cluster, arg_min(key, (-n, key)) AS canonical, CASE WHEN cluster IN (SELECT cluster FROM ex) THEN 'sha256' ELSE 'perceptual' END AS method,
  CASE WHEN cluster IN (SELECT cluster FROM ex) OR cluster IN (SELECT cluster FROM zero) THEN 1.0 ELSE 1 - (SELECT dist FROM near WHERE near.cluster = whole.cluster) / 64.0 END AS score, count(*) AS members FROM whole GROUP BY cluster) """
)


@register("dedup_report", GROUPS + "SELECT method, count(*) AS groups, CAST(sum(members) AS BIGINT) AS members FROM told GROUP BY method")
def dedup_report(spark, d):
    return dedup.duplicate_report(clustered(spark, d))


@register("duplicate_groups", GROUPS + "SELECT format('g{:06d}-{}-{}', row_number() OVER (ORDER BY cluster) - 1, method, canonical) AS group_key, cluster, canonical, method, CAST(score AS DOUBLE) AS score, members FROM told")
def duplicate_groups(spark, d):
    return dedup.group_rows(cut(clustered(spark, d))).select("group_key", "cluster", "canonical", "method", "score", "members")


@register("dedup_exact", "SELECT sha256(text) AS sha256, min(doc_id) AS first, count(*) AS members FROM documents GROUP BY 1 HAVING count(*) > 1")
def dedup_exact(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    return docs.groupBy("sha256").agg(F.min("doc_id").alias("first"), F.count("*").alias("members")).where("members > 1")


@register("dedup_source_identity", "SELECT doc_id AS member, first FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY source, n_chars) AS first FROM documents) WHERE doc_id <> first")
def dedup_source_identity(spark, d):
    from gleanery.functions.urls import source_identity

    docs = table(spark, d, "documents")
    links = dedup.stars(docs, "doc_id", source_identity(F.col("source"), F.col("n_chars").cast("string"), F.lit("")))
    return links.select(F.col("v").alias("member"), F.col("u").alias("first"))


@register("near_dup_greedy")
def near_dup_greedy(spark, d):
    """Greedy over components in seeded order; tests compare it with a plain loop."""
    rows = prints(spark, d).select(F.col("doc_id").alias("key"), F.col("doc_id").alias("observation"), F.col("sha256").alias("pixels"), (F.col("n") / 1000.0).alias("aspect"), "ahash", "dhash")
    return dedup.near_dup_filter(rows).select("key", "reason")


@register("average_hash", "WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), m AS (SELECT vec_id, v, list_reduce(v, lambda a, b: a + b) / 64 AS mean FROM e) SELECT vec_id, list_reduce(list_transform(v, lambda x: CASE WHEN x > mean THEN '1' ELSE '0' END), lambda a, b: a || b) AS ahash FROM m")
def average_hash(spark, d):
    e = table(spark, d, "embeddings")
    return e.select("vec_id", F.lpad(F.bin(media.average_hash(F.col("embedding"))), 64, "0").alias("ahash"))


@register("nearest_hamming", """WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), m AS (SELECT vec_id, label, v, list_reduce(v, lambda a, b: a + b) / 64 AS mean FROM e),
h AS (SELECT vec_id, label, CAST(list_reduce(list_transform(v, lambda x: CASE WHEN x > mean THEN '1' ELSE '0' END), lambda a, b: a || b) AS BIT) AS h FROM m)
SELECT a.vec_id, CAST(min(bit_count(xor(a.h, b.h))) AS INT) AS dist FROM h a JOIN h b ON a.label = b.label AND a.vec_id <> b.vec_id GROUP BY a.vec_id""")
def nearest_hamming(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", "label", media.average_hash(F.col("embedding")).alias("h"))
    j = e.join(e.toDF("o", "label", "oh"), "label").where("vec_id <> o")
    return j.groupBy("vec_id").agg(F.min(media.hamming(F.col("h"), F.col("oh"))).cast("int").alias("dist"))


@register("normalize_names", r"SELECT p_partkey, trim(regexp_replace(lower(concat('  ', p_name, chr(9), p_type, ' ')), '\s+', ' ', 'g')) AS norm FROM part")
def normalize_names(spark, d):
    from gleanery.functions.names import normalize_name

    return table(spark, d, "part").select("p_partkey", normalize_name(F.concat(F.lit("  "), "p_name", F.lit("\t"), "p_type", F.lit(" "))).alias("norm"))


def reconcile_inputs(spark, d):
    part = table(spark, d, "part")
    records = part.groupBy(F.col("p_name").alias("scientific_name"), F.col("p_brand").alias("authorship")).agg(F.min("p_partkey").cast("string").alias("wsc_id")).withColumn("accepted_name", F.lit(None).cast("string"))
    return part, records


@register(
    "reconcile_exact",
    """WITH n AS (SELECT p_name, count(DISTINCT p_brand) AS k FROM part GROUP BY p_name)
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'unresolved' WHEN k = 1 OR p_size % 2 = 0 THEN 'exact' ELSE 'conflict' END AS match_type, CASE WHEN p_size % 5 = 0 OR (k > 1 AND p_size % 2 = 1) THEN NULL ELSE p_name END AS accepted_name FROM part JOIN n USING (p_name)""",
)
def reconcile_exact(spark, d):
    part, records = reconcile_inputs(spark, d)
    name = F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz "), "p_name")).otherwise(F.upper("p_name"))
    author = F.when(F.col("p_size") % 2 == 0, F.col("p_brand"))
    asked = part.select("p_partkey", name.alias("original_name"), author.alias("authorship"))
    # Part keys with one name and authorship are one question: reconcile those, then hand the answer to each part.
    found = reconcile.reconcile(asked.select("original_name", "authorship").distinct(), records).select(F.col("original_name").alias("o"), F.col("authorship").alias("a"), "match_type", "accepted_name")
    return asked.join(found, (F.col("original_name") == F.col("o")) & F.col("authorship").eqNullSafe(F.col("a"))).select("p_partkey", "match_type", "accepted_name")


@register("reconcile_fuzzy")
def reconcile_fuzzy(spark, d):
    """Ratcliff-Obershelp isn't SQL: tests compare it with the standard library."""
    part, records = reconcile_inputs(spark, d)
    asked = part.select(F.concat("p_name", F.lit("x")).alias("original_name"), F.lit(None).cast("string").alias("authorship")).distinct()
    return reconcile.reconcile(asked, records).select("original_name", "match_type", "n_candidates", "needs_review")


@register("conflict_report", """WITH n AS (SELECT p_name, count(DISTINCT p_brand) AS k FROM part GROUP BY p_name) SELECT CASE WHEN k = 1 THEN 'exact' ELSE 'conflict' END AS match_type, count(*) AS n, CAST(count_if(k > 1) AS BIGINT) AS needs_review FROM n GROUP BY 1""")
def conflict_report(spark, d):
    part, records = reconcile_inputs(spark, d)
    return reconcile.conflict_report(reconcile.reconcile(part.select(F.col("p_name").alias("original_name"), F.lit(None).cast("string").alias("authorship")).distinct(), records))


def event_rows(spark, d):
    return table(spark, d, "events").select("user_id", "event_type", "event_id", "value")


@register("upsert_first_wins", "SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY ALL")
def upsert_first_wins(spark, d):
    e = event_rows(spark, d)
    return upsert.first_wins(None, e, ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id", "value")


@register("upsert_last_wins", "SELECT user_id, event_type, coalesce(max(CASE WHEN event_id % 3 = 0 THEN event_id END), max(event_id)) AS event_id FROM events GROUP BY ALL")
def upsert_last_wins(spark, d):
    e = event_rows(spark, d)
    return upsert.last_wins(e.where("event_id % 3 <> 0"), e.where("event_id % 3 = 0"), ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id")


@register(
    "coalesce_merge",
    """WITH a AS (SELECT o_custkey AS k, min(o_orderkey) AS x, max(o_totalprice) AS y FROM orders GROUP BY 1), b AS (SELECT c_custkey AS k, CASE WHEN c_nationkey % 2 = 0 THEN -c_custkey END AS x, c_acctbal AS y FROM customer)
SELECT coalesce(a.k, b.k) AS k, coalesce(b.x, a.x) AS x, CASE WHEN a.k IS NOT NULL THEN a.y ELSE b.y END AS y FROM a FULL JOIN b ON a.k = b.k""",
)
def coalesce_merge(spark, d):
    a = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderkey").alias("x"), F.max("o_totalprice").alias("y"))
    b = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.when(F.col("c_nationkey") % 2 == 0, -F.col("c_custkey")).alias("x"), F.col("c_acctbal").alias("y"))
    return upsert.coalesce_merge(a, b, ["k"], ["x"])


@register("fill_missing", "SELECT n_nationkey, n_name, coalesce(CASE WHEN n_nationkey % 2 = 0 THEN n_regionkey END, s.k) AS region FROM nation LEFT JOIN (SELECT s_nationkey, max(s_suppkey) AS k FROM supplier GROUP BY 1) s ON s_nationkey = n_nationkey")
def fill_missing(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", "n_name", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_regionkey").cast("long")).alias("region"))
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.max("s_suppkey").alias("region"))
    return upsert.fill_missing(n, s, ["n_nationkey"], ["region"])


@register(
    "download_queue",
    """SELECT CAST(c_custkey AS VARCHAR) AS url, CASE WHEN o.k IS NULL THEN 'pending' WHEN o.k % 3 = 0 THEN 'done' WHEN o.k % 2 = 0 AND c_nationkey % 4 + 1 < 3 THEN 'retry' ELSE 'failed' END AS status,
CAST(c_nationkey % 4 + CASE WHEN o.k IS NULL THEN 0 ELSE 1 END AS INT) AS attempts FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS k FROM orders GROUP BY 1) o ON o_custkey = c_custkey""",
)
def download_queue(spark, d):
    q = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("url"), F.lit("pending").alias("status"), (F.col("c_nationkey") % 4).alias("attempts"), F.lit(None).cast("string").alias("last_error"), F.lit(None).cast("string").alias("sha256"))
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("url")).agg(F.max("o_orderkey").alias("k"))
    out = o.select("url", (F.col("k") % 3 == 0).alias("ok"), F.when(F.col("k") % 3 == 0, "aa").alias("sha256"), F.when(F.col("k") % 3 != 0, "timeout").alias("error"), (F.col("k") % 2 == 0).alias("transient"))
    return upsert.queue_after(q, out).select("url", "status", "attempts")


@register("coverage_audit", "SELECT p.taxon, coalesce(n, 0) AS n, coalesce(n, 0) > 0 AS has_candidate, CASE WHEN coalesce(n, 0) > 0 THEN 'candidate' ELSE 'no_image' END AS image_status FROM (SELECT DISTINCT p_partkey AS taxon FROM part) p LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_quantity > 45 GROUP BY 1) l ON l_partkey = taxon")
def coverage_audit(spark, d):
    counts = table(spark, d, "lineitem").where("l_quantity > 45").groupBy(F.col("l_partkey").alias("taxon")).agg(F.count("*").alias("n"))
    return coverage.coverage(table(spark, d, "part").select(F.col("p_partkey").alias("taxon")), counts)


@register("only_missing", "SELECT p_partkey AS taxon FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def only_missing(spark, d):
    return coverage.only_missing(table(spark, d, "part").select(F.col("p_partkey").alias("taxon")), table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("taxon")))


@register("min_text_media", "SELECT l_partkey AS source_taxon, min(CAST(l_orderkey AS VARCHAR)) AS source_media_id FROM lineitem WHERE l_returnflag = 'A' AND l_quantity < 15 GROUP BY 1")
def min_text_media(spark, d):
    li = table(spark, d, "lineitem")
    m = li.select(F.col("l_partkey").alias("source_taxon"), F.col("l_orderkey").alias("source_media_id"), F.when(F.col("l_returnflag") == "A", "accepted").otherwise("pending").alias("validation_status"), (F.col("l_quantity") * 10).alias("width"))
    return coverage.upgradable(m)


@register("gate_missing", "SELECT 'order' AS gate, CAST(o_orderkey AS VARCHAR) AS entity, 'lacks priority' AS message FROM orders WHERE o_orderpriority = '5-LOW'")
def gate_missing(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).otherwise(" ").alias("priority"))
    return gates.missing_fields(o, "order", "o_orderkey", ["status", "priority"])


@register("gate_orphan", "SELECT 'line' AS gate, CAST(l_orderkey AS VARCHAR) AS entity, concat('l_suppkey unknown: ', l_suppkey) AS message FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def gate_orphan(spark, d):
    return gates.orphans(table(spark, d, "lineitem").select("l_orderkey", "l_suppkey"), "line", "l_suppkey", table(spark, d, "supplier").where("s_acctbal > 0"), "s_suppkey", "l_orderkey")


@register("gate_duplicate", "SELECT 'customer_order' AS gate, CAST(o_custkey AS VARCHAR) AS entity, concat('occurs ', count(*), ' times') AS message FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def gate_duplicate(spark, d):
    return gates.repeated(table(spark, d, "orders").select("o_custkey"), "customer_order", "o_custkey")


@register("gate_enum", "SELECT 'segment' AS gate, CAST(c_custkey AS VARCHAR) AS entity, concat('invalid c_mktsegment ', c_mktsegment) AS message FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
def gate_enum(spark, d):
    return gates.not_among(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "segment", "c_custkey", "c_mktsegment", ("BUILDING", "MACHINERY"))


@register(
    "gate_release",
    """WITH m AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS sha, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'c' END AS creator, CAST(o_custkey % 30 AS VARCHAR) AS taxon FROM orders)
SELECT 'media' AS gate, '' AS entity, 'media row missing sha256' AS message FROM m WHERE sha = ''
UNION ALL SELECT 'media_duplicate', sha, concat('occurs ', count(*), ' times') FROM m WHERE sha <> '' GROUP BY sha HAVING count(*) > 1
UNION ALL SELECT 'media', sha, 'lacks creator' FROM m WHERE sha <> '' AND creator IS NULL
UNION ALL SELECT 'media_taxon', sha, concat('taxon unknown: ', taxon) FROM m WHERE sha <> '' AND taxon NOT IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation)
UNION ALL SELECT 'attribution', sha, 'missing attribution row' FROM m WHERE sha NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)
UNION ALL SELECT 'attribution', sha, 'attribution text empty' FROM m JOIN customer ON sha = CAST(c_custkey AS VARCHAR) WHERE c_mktsegment = 'BUILDING'""",
)
def gate_release(spark, d):
    taxa = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("taxon"))
    o = table(spark, d, "orders")
    m = o.select(F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.col("o_custkey").cast("string")).alias("sha256"), F.when(F.col("o_orderkey") % 5 != 0, "c").alias("creator"), (F.col("o_custkey") % 30).cast("string").alias("taxon"), *[F.lit("x").alias(c) for c in ("s3_uri", "license", "source_record")])
    att = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("sha256"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("attribution"))
    evidence = spark.createDataFrame([("e1", "1", "10.1/x", "", "", "")], "id string, taxon string, doi string, pmid string, isbn string, url string")
    danger = spark.createDataFrame([("1", "none_known", "PL", "r", ["e1"], "w", "2020-01-01", "draft")], "taxon string, category string, geographic_scope string, rationale string, evidence_ids array<string>, reviewer string, review_date string, status string")
    return gates.release(taxa, m, att, evidence, danger)


@register(
    "adjudicate_reviews",
    """WITH e AS (SELECT user_id, bool_or(event_type = 'refund') AS no, CAST(count_if(event_type = 'purchase') AS BIGINT) AS yes, count(*) AS n FROM events WHERE event_type <> 'click' GROUP BY 1)
SELECT c_custkey AS taxon, CASE WHEN c_nationkey % 2 = 0 THEN 2 ELSE 1 END AS required, coalesce(yes, 0) AS approvals,
CASE WHEN coalesce(no, FALSE) THEN 'rejected' WHEN coalesce(yes, 0) >= CASE WHEN c_nationkey % 2 = 0 THEN 2 ELSE 1 END THEN 'approved' WHEN coalesce(n, 0) > 0 THEN 'in_review' ELSE 'draft' END AS adjudicated
FROM customer LEFT JOIN e ON user_id = c_custkey""",
)
def adjudicate_reviews(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("taxon"), F.when(F.col("c_nationkey") % 2 == 0, "medically_significant").otherwise("none_known").alias("category"), F.lit("").alias("exposure_context"))
    decision = F.when(F.col("event_type") == "refund", "reject").when(F.col("event_type") == "purchase", "approve").otherwise("comment")
    return gates.adjudicate(rows, table(spark, d, "events").where("event_type <> 'click'").select(F.col("user_id").alias("entity_id"), decision.alias("decision")))


@register(
    "review_transitions",
    """WITH s AS (SELECT event_id, user_id, ['draft', 'in_review', 'approved', 'rejected', 'superseded'] AS st FROM events), t AS (SELECT user_id, st[event_id % 5 + 1] AS a, st[(event_id // 5) % 5 + 1] AS b FROM s)
SELECT 'transition' AS gate, CAST(user_id AS VARCHAR) AS entity, concat('illegal ', a, ' -> ', b) AS message FROM t WHERE a <> b AND concat(a, '>', b) NOT IN ('draft>in_review', 'in_review>approved', 'in_review>rejected', 'in_review>draft', 'approved>superseded', 'rejected>draft')""",
)
def review_transitions(spark, d):
    st = F.array(*[F.lit(s) for s in gates.STATUSES])
    at = lambda i: F.get(st, (i % 5).cast("int"))
    ev = table(spark, d, "events").select(F.col("user_id").alias("entity_id"), at(F.col("event_id")).alias("previous_status"), at(F.floor(F.col("event_id") / 5)).alias("new_status"), F.lit("comment").alias("decision"))
    return gates.transitions(ev)


ORDER_TEXT = "concat(o_orderkey, '|', o_custkey, '|', coalesce(o_orderstatus, ''), '|', o_orderdate)"


@register(
    "snapshot_root",
    f"""WITH d AS (SELECT sha256('=' || {ORDER_TEXT}) AS d, count(*) AS n FROM orders GROUP BY 1),
leaf AS (SELECT left(d, 2) AS p, sum(n) AS r, sha256(string_agg(d || ':' || n, ',' ORDER BY d || ':' || n)) AS h FROM d GROUP BY 1),
up AS (SELECT left(p, 1) AS p, sum(r) AS r, sha256(string_agg(p || ':' || h, ',' ORDER BY p || ':' || h)) AS h FROM leaf GROUP BY left(p, 1))
SELECT CAST(sum(r) AS BIGINT) AS rows, sha256(string_agg(p || ':' || h, ',' ORDER BY p || ':' || h)) AS digest FROM up""",
)
def snapshot_root(spark, d):
    """The digest of a table as the root of a tree of two levels."""
    return merkle.root(merkle.tree(table(spark, d, "orders"), F.expr(ORDER_TEXT), 2))


@register(
    "snapshot_diff",
    """WITH b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 997 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_custkey % 211 <> 0)
SELECT 'a' AS side, o_orderkey, o_orderstatus, count(*) AS times FROM (SELECT o_orderkey, o_orderstatus FROM orders EXCEPT ALL SELECT * FROM b) GROUP BY ALL UNION ALL
SELECT 'b', o_orderkey, o_orderstatus, count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT o_orderkey, o_orderstatus FROM orders) GROUP BY ALL""",
)
def snapshot_diff(spark, d):
    """Rows changed and lost between two snapshots, found by descending where their trees differ."""
    a = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    b = a.where("o_custkey % 211 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 997 == 0, "X").otherwise(F.col("o_orderstatus")))
    text = F.to_json(F.struct("o_orderkey", "o_orderstatus"), {"ignoreNullFields": "false"})
    return merkle.difference(a.drop("o_custkey"), b.drop("o_custkey"), text)
