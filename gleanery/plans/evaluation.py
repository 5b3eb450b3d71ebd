"""Scoring, leaderboard, breakdown, cost, splits, samples and shortlists over the driver's tables.

Documents stand for tasks (source = species, lang = family) and labels for predictions: none is a missing one, quality 1 a right
answer, toxic 1 a refusal."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.functions import answers
from gleanery.operators import gates, score, tasks, upsert
from gleanery.plans.registry import register, table


def task_table(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    return docs.select(F.col("doc_id").alias("task_id"), F.col("source").alias("correct_taxon"), F.col("lang").alias("family"), F.array().cast("array<string>").alias("synonyms_accepted"))


def prediction_table(spark, d):
    labels = table(spark, d, "labels")
    docs = table(spark, d, "documents").select("doc_id", "source")
    guess = F.when(F.col("quality") == 1, F.upper("source")).otherwise(F.concat(F.lit("not "), F.col("source")))
    ranked = F.array(F.struct(guess.alias("taxon"), F.lit(True).alias("matched"), guess.alias("raw")))
    return labels.join(docs, "doc_id").select(
        F.col("doc_id").alias("task_id"), ranked.alias("predictions"), F.lit(None).cast("string").alias("error"), F.when(F.col("toxic") == 1, "refusal").otherwise("stop").alias("finish_reason"), F.lit(None).cast("string").alias("refusal")
    )


def scored(spark, d):
    return score.joined(task_table(spark, d), prediction_table(spark, d))


SCORED = """WITH s AS (SELECT d.doc_id, d.source AS species, d.lang AS family, l.quality,
  CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN l.toxic = 1 THEN 'refused' ELSE 'answered' END AS status,
  CASE WHEN l.toxic = 0 AND l.quality = 1 THEN 1 ELSE 0 END AS hit
  FROM documents d LEFT JOIN labels l USING (doc_id)) """


@register(
    "score_summary",
    SCORED
    + """, m AS (SELECT avg(h) AS macro FROM (SELECT species, sum(hit) / count(*) AS h FROM s GROUP BY species))
SELECT count(*) AS tasks, CAST(count_if(status <> 'missing') AS BIGINT) AS scored, count_if(status = 'missing') = 0 AS complete, CAST(count_if(status = 'missing') AS BIGINT) AS missing,
  CAST(count_if(status = 'refused') AS BIGINT) AS errors, CAST(0 AS BIGINT) AS transport_errors, CAST(0 AS BIGINT) AS missing_stop_reasons, count_if(status = 'missing') = 0 AS execution_valid,
  sum(hit) / count(*) AS top1, count_if(status = 'answered') / count(*) AS answer_rate, sum(hit) / CAST(count_if(status = 'answered') AS BIGINT) AS top1_answered_only,
  any_value(macro) AS macro_species_top1 FROM s, m""",
)
def score_summary(spark, d):
    return score.summary(scored(spark, d))


@register("score_per_family", SCORED + "SELECT coalesce(family, 'unknown') AS family, count(*) AS n, CAST(sum(hit) AS BIGINT) AS correct, sum(hit) / count(*) AS top1 FROM s GROUP BY 1")
def score_per_family(spark, d):
    return score.per_group(scored(spark, d))


@register("score_macro", SCORED + "SELECT count(*) AS species, avg(h) AS macro_species_top1 FROM (SELECT sum(hit) / count(*) AS h FROM s GROUP BY species)")
def score_macro(spark, d):
    per = score.per_group(scored(spark, d), "correct_taxon")
    return per.agg(F.count("*").alias("species"), F.avg("top1").alias("macro_species_top1"))


@register("score_status_counts", SCORED + "SELECT status, count(*) AS n FROM s GROUP BY status")
def score_status_counts(spark, d):
    return score.status_counts(scored(spark, d))


@register(
    "error_breakdown",
    """WITH s AS (SELECT p.p_partkey, p.p_name AS correct, p.p_type AS fam, g.p_name AS guess, g.p_type AS gfam, p.p_size % 10 AS k FROM part p
  LEFT JOIN part g ON g.p_partkey = p.p_partkey % 50 + 1 WHERE TRUE)
SELECT CASE WHEN k = 0 OR guess IS NULL THEN 'failed' WHEN k < 4 THEN 'exact' WHEN split_part(guess, ' ', 1) = split_part(correct, ' ', 1) AND split_part(guess, ' ', 1) <> '' THEN 'same_genus' WHEN gfam = fam THEN 'same_family' ELSE 'other_family' END AS bucket,
  count(*) AS n FROM s GROUP BY 1""",
)
def error_breakdown(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_size")
    other = part.select(F.col("p_partkey").alias("g"), F.col("p_name").alias("guess"), F.col("p_type").alias("gfam"))
    j = part.join(other, F.col("g") == F.col("p_partkey") % 50 + 1, "left")
    status = F.when((F.col("p_size") % 10 == 0) | F.col("guess").isNull(), "failed_run").otherwise("answered")
    bucket = score.error_bucket(status, F.col("p_size") % 10 < 4, F.col("guess"), F.col("p_name"), F.col("gfam"), F.col("p_type"))
    return j.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


@register(
    "run_report",
    SCORED + "SELECT count(*) AS n, CAST(sum(hit) AS BIGINT) AS top1, CAST(0 AS BIGINT) AS genus, CAST(sum(hit) AS BIGINT) AS family, CAST(sum(hit) AS BIGINT) AS family_known, CAST(count_if(status = 'answered') AS BIGINT) AS valid, CAST(count_if(status <> 'answered') AS BIGINT) AS failures FROM s WHERE TRUE",
)
def run_report(spark, d):
    docs = task_table(spark, d).withColumn("family", F.col("correct_taxon"))
    fams = docs.select(F.col("correct_taxon").alias("taxon"), "family").distinct()
    return score.run_report(score.joined(docs, prediction_table(spark, d)), fams)


RUNS = """WITH runs AS (SELECT n_name AS run_id, count(*) AS tasks, count_if(o_orderstatus = 'F') / count(*) AS top1 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name) """


def runs(spark, d):
    cust = table(spark, d, "customer").select("c_custkey", "c_nationkey").join(table(spark, d, "nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    o = table(spark, d, "orders").select("o_custkey", "o_orderstatus").join(cust, F.col("o_custkey") == F.col("c_custkey"))
    return o.groupBy(F.col("n_name").alias("run_id")).agg(F.count("*").alias("tasks"), (F.count_if(F.col("o_orderstatus") == "F") / F.count("*")).alias("top1"))


@register("leaderboard_rank", RUNS + "SELECT run_id, tasks, top1, row_number() OVER (ORDER BY top1 DESC, run_id) AS rank FROM runs")
def leaderboard_rank(spark, d):
    return score.leaderboard(runs(spark, d))


@register("run_cohorts", "SELECT o_orderstatus AS tasks_hash, coalesce(nullif(o_orderpriority, '5-LOW'), 'image') AS condition, count(*) AS n FROM orders GROUP BY ALL")
def run_cohorts(spark, d):
    return score.cohorts(table(spark, d, "orders").select(F.col("o_orderstatus").alias("tasks_hash"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("condition")))


def part_tasks(spark, d):
    """A task for each part: the candidates are the names of its type."""
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_type")
    names = part.groupBy("p_type").agg(F.array_sort(F.collect_set("p_name")).alias("candidates"))
    return part.join(names, "p_type").select(F.col("p_partkey").alias("task_id"), F.col("p_name").alias("correct_taxon"), F.col("p_type").alias("family"), "candidates")


@register(
    "candidate_baselines",
    """WITH n AS (SELECT DISTINCT p_type, p_name, split_part(p_name, ' ', 1) AS g FROM part), c AS (SELECT p_type, g, count(*) AS k FROM n GROUP BY ALL),
b AS (SELECT p_type, max(k) AS top, sum(k) AS size, max(k) * CAST(count_if(k = m) AS BIGINT) AS pool FROM (SELECT *, max(k) OVER (PARTITION BY p_type) AS m FROM c) GROUP BY p_type)
SELECT avg(1.0::DOUBLE / b.size) AS uniform_candidate, avg(CASE WHEN c.k = b.top THEN 1.0::DOUBLE / b.pool ELSE 0 END) AS largest_genus_candidate_only
FROM part p JOIN b USING (p_type) JOIN c ON c.p_type = p.p_type AND c.g = split_part(p.p_name, ' ', 1)""",
)
def candidate_baselines(spark, d):
    return score.baselines(part_tasks(spark, d))


@register(
    "cost_estimate",
    """WITH u AS (SELECT l_returnflag AS model_id, CAST(count_if(l_linestatus = 'F') AS BIGINT) AS requests, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS input_tokens, CAST(sum(CAST(l_linenumber AS BIGINT)) AS BIGINT) AS cached_tokens, CAST(sum(CAST(l_suppkey AS BIGINT)) AS BIGINT) AS output_tokens FROM lineitem GROUP BY 1),
p(model_id, p_request, p_in, p_cached, p_out) AS (VALUES ('A', 0.5::DOUBLE, 0.002::DOUBLE, 0.001::DOUBLE, 0.008::DOUBLE), ('N', 0.0, 0.003, NULL, 0.015), ('R', 1.0, 0.001, 0.0005, 0.004))
SELECT model_id, requests, input_tokens, cached_tokens, output_tokens, round(requests / 1000 * p_request + greatest(input_tokens - cached_tokens, 0) / 1000 * p_in + cached_tokens / 1000 * coalesce(p_cached, p_in) + output_tokens / 1000 * p_out, 4) AS cost FROM u LEFT JOIN p USING (model_id)""",
)
def cost_estimate(spark, d):
    li = table(spark, d, "lineitem")
    ledger = li.select(F.col("l_returnflag").alias("model_id"), F.when(F.col("l_linestatus") == "F", None).otherwise("x").alias("error"), F.col("l_quantity").cast("long").alias("input_tokens"), F.col("l_linenumber").cast("long").alias("cached_tokens"), F.col("l_suppkey").alias("output_tokens"))
    prices = spark.createDataFrame([("A", 0.5, 0.002, 0.001, 0.008), ("N", 0.0, 0.003, None, 0.015), ("R", 1.0, 0.001, 0.0005, 0.004)], "model_id string, p_request double, p_in double, p_cached double, p_out double")
    return score.usage_cost(ledger, prices)


@register(
    "answer_parse",
    r"""WITH c AS (SELECT conv_id, turn, role, ['user', 'assistant', 'system'] AS cands, CASE turn % 3 WHEN 0 THEN concat('I say <Answer> ', upper(role), '  </ answer >.') WHEN 1 THEN concat(' ', role, ' ') ELSE concat('<answer>user</answer><answer>', role, '</answer>') END AS text FROM conversations),
t AS (SELECT *, regexp_extract_all(text, '<\s*answer\s*>(.*?)<\s*/\s*answer\s*>', 1, 'is') AS f FROM c),
a AS (SELECT *, CASE WHEN len(f) > 1 THEN text WHEN len(f) = 1 THEN trim(f[1]) ELSE trim(text) END AS answer FROM t)
SELECT conv_id, turn, CASE WHEN len(f) <= 1 AND list_contains(cands, lower(answer)) THEN lower(answer) ELSE answer END AS taxon, len(f) <= 1 AND list_contains(cands, lower(answer)) AS matched FROM a""",
)
def answer_parse(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", "role")
    text = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("I say <Answer> "), F.upper("role"), F.lit("  </ answer >."))).when(F.col("turn") % 3 == 1, F.concat(F.lit(" "), F.col("role"), F.lit(" "))).otherwise(F.concat(F.lit("<answer>user</answer><answer>"), F.col("role"), F.lit("</answer>")))
    cands = F.array(F.lit("user"), F.lit("assistant"), F.lit("system"))
    return c.withColumn("a", answers.match_candidate(text, cands)).select("conv_id", "turn", "a.taxon", "a.matched")


def split_rows(spark, d):
    li = table(spark, d, "lineitem")
    sha = F.sha2(F.concat_ws(":", "l_partkey", "l_orderkey", "l_linenumber", "l_suppkey"), 256)
    return li.select(F.col("l_partkey").alias("taxon"), sha.alias("sha256"), F.col("l_orderkey").alias("observation_id"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("source_media_id"), (F.col("l_quantity") * 10).cast("int").alias("width"))


SPLIT = """WITH r AS (SELECT l_partkey AS taxon, sha256(concat_ws(':', l_partkey, l_orderkey, l_linenumber, l_suppkey)) AS sha, l_orderkey AS obs, concat_ws('-', l_orderkey, l_linenumber) AS mid, CAST(l_quantity * 10 AS INT) AS width FROM lineitem),
o AS (SELECT *, row_number() OVER (PARTITION BY taxon ORDER BY CASE WHEN width >= 150 THEN 0 ELSE 1 END, mid, sha, width) AS rn FROM r),
g AS (SELECT taxon, sha AS gsha, obs AS gobs FROM o WHERE rn = 1),
f AS (SELECT o.*, row_number() OVER (PARTITION BY o.taxon ORDER BY sha256(concat_ws(':', '42', o.taxon, o.sha)), o.rn) AS q FROM o JOIN g USING (taxon) WHERE rn > 1 AND sha IS DISTINCT FROM gsha AND obs IS DISTINCT FROM gobs),
x AS (SELECT taxon, sha AS sha256, obs AS observation_id, mid AS source_media_id, width, 'gallery' AS split FROM o WHERE rn = 1 UNION ALL SELECT taxon, sha, obs, mid, width, 'query' FROM f WHERE q <= 4) """


@register("gallery_query_split", SPLIT + "SELECT * FROM x")
def gallery_query_split(spark, d):
    return tasks.gallery_query_split(split_rows(spark, d))


@register("split_leakage_check", SPLIT + "SELECT DISTINCT q.* FROM x q JOIN x g ON g.split = 'gallery' AND q.split = 'query' AND (q.sha256 = g.sha256 OR q.observation_id = g.observation_id)")
def split_leakage_check(spark, d):
    """Over all taxa at once, an order of one taxon's gallery may be another taxon's query: the check must find those."""
    from gleanery.session import cut

    return tasks.split_leaks(cut(tasks.gallery_query_split(split_rows(spark, d))))


@register(
    "round_robin_sample",
    "SELECT doc_id AS task_id, source AS correct_taxon, CAST(turn AS INT) AS turn, place FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha256(concat_ws(':', '42', source, doc_id)), doc_id) - 1 AS turn, sha256(concat_ws(':', '42', source)) AS place FROM documents) ORDER BY turn, place, correct_taxon, task_id LIMIT 150",
)
def round_robin_sample(spark, d):
    return tasks.round_robin(table(spark, d, "documents").select(F.col("doc_id").alias("task_id"), F.col("source").alias("correct_taxon")), 150)


def shortlist_inputs(spark, d):
    """Rows for every supplier and customer nation; the taxa are part names, of which there is a fixed vocabulary."""
    part = table(spark, d, "part")
    taxa = part.groupBy(F.col("p_name").alias("name")).agg(F.min("p_brand").alias("family")).withColumn("genus", F.get(F.split("name", " "), F.lit(0)))
    rows = part.groupBy("p_type", "p_size").agg(F.min("p_name").alias("correct")).join(taxa.withColumnRenamed("name", "correct"), "correct")
    return rows.select(F.concat_ws("/", "p_type", "p_size").alias("row_id"), "correct", "genus", "family"), taxa


SHORT = """WITH t AS (SELECT p_name AS name, min(p_brand) AS family, split_part(p_name, ' ', 1) AS genus FROM part GROUP BY p_name),
r AS (SELECT concat_ws('/', p_type, p_size) AS row_id, min(p_name) AS correct FROM part GROUP BY p_type, p_size),
p AS (SELECT row_id, correct, c.name AS cand, sha256(concat_ws(':', '42', row_id, c.name)) AS h, c.family = o.family AS kin, c.genus = o.genus AS con FROM r JOIN t o ON o.name = correct JOIN t c ON c.name <> correct), """


@register(
    "mixed_shortlist",
    SHORT
    + """k AS (SELECT *, row_number() OVER (PARTITION BY row_id, kin ORDER BY h, cand) AS rk FROM p),
q AS (SELECT *, CASE WHEN kin AND rk <= 9 THEN 0 WHEN kin THEN 2 ELSE 1 END AS tier FROM k), z AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY tier, h, cand) AS place FROM q)
SELECT row_id, correct, list(cand ORDER BY h) AS candidates, CAST(count_if(own = 0 AND con) AS BIGINT) AS n_congener, CAST(count_if(own = 0 AND kin AND NOT con) AS BIGINT) AS n_family FROM (
SELECT row_id, correct, cand, h, kin, con, 0 AS own FROM z WHERE place <= 19 UNION ALL SELECT row_id, correct, correct, sha256(concat_ws(':', '42', row_id, correct)), FALSE, FALSE, 1 FROM r) GROUP BY row_id, correct""",
)
def mixed_shortlist(spark, d):
    return tasks.shortlist(*shortlist_inputs(spark, d), mode="mixed")


@register(
    "hard_shortlist",
    SHORT
    + """q AS (SELECT *, CASE WHEN con THEN 0 WHEN kin THEN 1 ELSE 2 END AS tier FROM p), z AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY tier, h, cand) AS place FROM q)
SELECT row_id, correct, list(cand ORDER BY cand) AS candidates, CAST(count_if(own = 0 AND con) AS BIGINT) AS n_congener, CAST(count_if(own = 0 AND kin AND NOT con) AS BIGINT) AS n_family FROM (
SELECT row_id, correct, cand, kin, con, 0 AS own FROM z WHERE place <= 19 UNION ALL SELECT row_id, correct, correct, FALSE, FALSE, 1 FROM r) GROUP BY row_id, correct""",
)
def hard_shortlist(spark, d):
    return tasks.shortlist(*shortlist_inputs(spark, d), mode="hard")


@register(
    "random_shortlist",
    SHORT
    + """z AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY h, cand) AS place FROM p)
SELECT row_id, correct, list(cand ORDER BY cand) AS candidates FROM (SELECT row_id, correct, cand FROM z WHERE place <= 9 UNION ALL SELECT row_id, correct, correct FROM r) GROUP BY row_id, correct""",
)
def random_shortlist(spark, d):
    return tasks.shortlist(*shortlist_inputs(spark, d), mode="random", size=10).select("row_id", "correct", "candidates")


@register(
    "build_min_media_tasks",
    """SELECT concat('suite:', replace(n_name, ' ', '_')) AS task_id, n_name AS correct_taxon, CAST(n_regionkey AS VARCHAR) AS family, min(sha256(c_name)) AS sha256 FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name, n_regionkey""",
)
def build_min_media_tasks(spark, d):
    nation = table(spark, d, "nation")
    media = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("taxon"), F.sha2("c_name", 256).alias("sha256"))
    return tasks.build_tasks(nation.select(F.col("n_name").alias("taxon"), F.col("n_regionkey").cast("string").alias("family")), media, "suite")


@register("prompts", "SELECT p_type AS family, concat('<CANDIDATES>' || chr(10), string_agg('- ' || p_name, chr(10) ORDER BY p_name), chr(10) || '</CANDIDATES>' || chr(10) || 'Name the subject of this photograph.') AS user_prompt FROM (SELECT DISTINCT p_type, p_name FROM part) GROUP BY p_type")
def prompts(spark, d):
    names = table(spark, d, "part").groupBy(F.col("p_type").alias("family")).agg(F.array_sort(F.collect_set("p_name")).alias("c"))
    return names.select("family", answers.user_prompt(F.col("c")).alias("user_prompt"))


@register("ledger_pending", "SELECT doc_id AS task_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def ledger_pending(spark, d):
    return upsert.pending(table(spark, d, "documents").select(F.col("doc_id").alias("task_id")), table(spark, d, "labels").select(F.col("doc_id").alias("task_id")))


@register("canonical_hash", "SELECT count(*) AS rows, sha256(string_agg(concat_ws('|', n_nationkey, n_name, n_regionkey), '' ORDER BY n_nationkey)) AS digest FROM nation")
def canonical_hash(spark, d):
    return score.rows_hash(table(spark, d, "nation"), "n_nationkey", F.concat_ws("|", "n_nationkey", "n_name", "n_regionkey"))


@register(
    "table_hash",
    """WITH o AS (SELECT sha256(CAST(o_orderkey AS VARCHAR)) AS k, sha256(concat_ws('|', o_orderkey, o_custkey, o_orderstatus)) AS t FROM orders),
e AS (SELECT CAST(concat('0x', k[1:8]) AS BIGINT) % 1024 AS b, count(*) AS n, sha256(string_agg(k || t, '' ORDER BY k || t)) AS d FROM o GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS rows, sha256(string_agg(d, '' ORDER BY b)) AS digest FROM e""",
)
def table_hash(spark, d):
    return score.tree_hash(table(spark, d, "orders"), F.col("o_orderkey"), F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus"))


@register(
    "gate_predictions",
    """SELECT 'prediction' AS gate, CAST(o_custkey AS VARCHAR) AS entity, concat('occurs ', count(*), ' times') AS message FROM orders GROUP BY o_custkey HAVING count(*) > 1
UNION ALL SELECT 'prediction_task', CAST(o_custkey AS VARCHAR), concat('task_id unknown: ', o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey <> 3)
UNION ALL SELECT 'tasks_hash', CAST(o_custkey AS VARCHAR), 'other snapshot' FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT 'image', CAST(o_custkey AS VARCHAR), 'other image' FROM orders JOIN customer ON o_custkey = c_custkey AND c_nationkey <> 3 WHERE o_orderpriority <> c_mktsegment""",
)
def gate_predictions(spark, d):
    t = table(spark, d, "customer").where("c_nationkey <> 3").select(F.col("c_custkey").alias("task_id"), F.col("c_mktsegment").alias("image_sha256"))
    p = table(spark, d, "orders").select(F.col("o_custkey").alias("task_id"), F.col("o_orderstatus").alias("tasks_hash"), F.col("o_orderpriority").alias("image_sha256"))
    return gates.predictions(t, p, "F")
