"""Quality gates: each rule is a filter, a group or an anti-join that returns violations (gate, entity, message)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Categories, statuses and their transitions, source types, decisions.
CATEGORIES = ("none_known", "minor_local_effects", "medically_significant", "uncertain")
STATUSES = ("draft", "in_review", "approved", "rejected", "superseded")
TRANSITIONS = {"draft": ("in_review",), "in_review": ("approved", "rejected", "draft"), "approved": ("superseded",), "rejected": ("draft",), "superseded": ()}
SOURCE_TYPES = ("journal_article", "case_report", "review", "poison_center_bulletin", "public_health_report", "clinical_reference", "toxicology_reference", "expert_statement", "book", "other")
DECISIONS = ("approve", "reject", "request_changes", "comment")


def blank(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(F.coalesce(c.cast("string"), F.lit(""))) == ""


def found(df: DataFrame, gate: str, entity: Column, message: Column | str) -> DataFrame:
    return df.select(F.lit(gate).alias("gate"), entity.cast("string").alias("entity"), (message if isinstance(message, Column) else F.lit(message)).alias("message"))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def missing_fields(df: DataFrame, gate: str, entity: str, fields: list[str]) -> DataFrame:
    """One violation for each blank field of each row: one pass, whatever the number of fields."""
    lacks = F.filter(F.array(*[F.when(blank(f), f) for f in fields]), lambda x: x.isNotNull())
    return found(df.select(entity, F.explode(lacks).alias("_f")), gate, F.col(entity), F.concat(F.lit("lacks "), F.col("_f")))


def repeated(df: DataFrame, gate: str, key: str) -> DataFrame:
    return found(df.where(~blank(key)).groupBy(key).count().where("count > 1"), gate, F.col(key), F.concat(F.lit("occurs "), F.col("count").cast("string"), F.lit(" times")))


def orphans(df: DataFrame, gate: str, key: str, known: DataFrame, known_key: str, entity: str | None = None) -> DataFrame:
    """Rows whose non-blank key ``known`` doesn't have."""
    out = df.where(~blank(key)).join(known.select(F.col(known_key).alias(key)).distinct(), key, "left_anti")
    return found(out, gate, F.col(entity or key), F.concat(F.lit(f"{key} unknown: "), F.col(key).cast("string")))


def not_among(df: DataFrame, gate: str, entity: str, column: str, values: tuple) -> DataFrame:
    return found(df.where(~F.coalesce(F.col(column).isin(*values), F.lit(False))), gate, F.col(entity), F.concat(F.lit(f"invalid {column} "), F.coalesce(F.col(column).cast("string"), F.lit(""))))


def refs_of(d: DataFrame) -> Column:
    """References as an array: ``evidence_ids``, else ``evidence_refs``, either an array or text with commas."""

    def one(c: str) -> Column:
        if c not in d.columns:
            return F.lit(None).cast("array<string>")
        if d.schema[c].dataType.typeName() == "array":
            return F.when(F.size(c) > 0, F.col(c))
        parts = F.filter(F.transform(F.split(F.col(c), ","), lambda t: F.trim(t)), lambda x: x != "")
        return F.when(F.size(parts) > 0, parts)

    return F.coalesce(one("evidence_ids"), one("evidence_refs"), F.array().cast("array<string>"))


def release(taxa: DataFrame, media: DataFrame, attribution: DataFrame, evidence: DataFrame, danger: DataFrame) -> DataFrame:
    """All violations of a release's five tables."""
    have_taxa = taxa.limit(1).count() > 0
    m = media.where(~blank("sha256"))
    parts = [
        found(media.where(blank("sha256")), "media", F.lit(""), "media row missing sha256"),
        repeated(m, "media_duplicate", "sha256"),
        missing_fields(m, "media", "sha256", ["s3_uri", "creator", "license", "source_record", "taxon"]),
    ]
    if have_taxa:
        parts += [orphans(m, "media_taxon", "taxon", taxa, "taxon", "sha256"), orphans(danger, "danger_taxon", "taxon", taxa, "taxon")]
    last = attribution.groupBy("sha256").agg(F.max(F.coalesce("attribution", F.lit(""))).alias("_text"))
    told = media.select(F.coalesce("sha256", F.lit("")).alias("sha256")).join(last, "sha256", "left")
    parts.append(found(told.where(F.col("_text").isNull()), "attribution", F.col("sha256"), "missing attribution row"))
    parts.append(found(told.where(F.col("_text").isNotNull() & blank("_text")), "attribution", F.col("sha256"), "attribution text empty"))
    parts.append(not_among(danger, "danger", "taxon", "category", CATEGORIES))
    parts.append(missing_fields(danger, "danger", "taxon", ["geographic_scope", "rationale", "reviewer", "review_date", "status"]))
    refs = danger.withColumn("_refs", refs_of(danger))
    parts.append(found(refs.where(F.size("_refs") == 0), "danger", F.col("taxon"), "missing evidence references"))
    located = evidence.select(F.col("id").cast("string").alias("_ref"), F.col("taxon").alias("_taxon"), (~(blank("doi") & blank("pmid") & blank("isbn") & blank("url"))).alias("_ok"))
    each = refs.select("taxon", "category", F.explode("_refs").alias("_ref")).join(located, "_ref", "left")
    parts.append(found(each.where(F.col("_ok").isNull()), "danger", F.col("taxon"), F.concat(F.lit("unsupported evidence reference "), F.col("_ref"))))
    parts.append(found(each.where(~F.col("_ok")), "danger", F.col("taxon"), F.concat(F.lit("no locator for evidence "), F.col("_ref"))))
    backed = evidence.where(~blank("taxon")).select("taxon").distinct()
    bare = refs.where("category = 'none_known'").join(backed, "taxon", "left_anti")
    parts.append(found(bare.where(F.size("_refs") == 0), "danger", F.col("taxon"), "missing evidence represented as none_known"))
    other = each.where("category = 'none_known' and _ok is not null").join(backed, "taxon", "left_anti").groupBy("taxon").agg(F.bool_or(F.col("_taxon") == F.col("taxon")).alias("own"))
    parts.append(found(other.where(~F.coalesce("own", F.lit(False))), "danger", F.col("taxon"), "none_known but evidence is on other taxa"))
    return union(parts)


def suite(tasks: DataFrame, n_shortlist: int = 20) -> DataFrame:
    """Violations of a suite (task_id, image_sha256, pixel_sha256, observation_id, correct_taxon, candidates)."""
    parts = [repeated(tasks, f"unique_{k}", k) for k in ("task_id", "image_sha256", "pixel_sha256", "observation_id")]
    parts.append(found(tasks.where(~F.coalesce(F.array_contains("candidates", F.col("correct_taxon")), F.lit(False))), "candidates", F.col("task_id"), "correct name is no candidate"))
    parts.append(found(tasks.where(F.size(F.array_distinct("candidates")) < F.size("candidates")), "candidates", F.col("task_id"), "repeated candidate"))
    parts.append(found(tasks.where((F.size("candidates") < 2) | (F.size("candidates") > n_shortlist)), "candidates", F.col("task_id"), "shortlist size"))
    return union(parts)


def suite_manifest(tasks: DataFrame, manifest: dict, digest: str, protocol: int = 5) -> DataFrame:
    """Violations of a suite's manifest (protocol_version, tasks_hash, tasks) by its tasks; ``digest`` is that of their canonical rows (``score.rows_hash``)."""
    n = tasks.agg(F.count("*").alias("n"))
    rules = F.array(
        F.when(F.lit(manifest.get("protocol_version") != protocol), "other protocol"), F.when(F.lit(manifest.get("tasks_hash") != digest), "other tasks_hash"),
        F.when((F.col("n") == 0) | (F.col("n") != F.lit(manifest.get("tasks") or 0)), "other number of tasks"),
    )
    return found(n.select(F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("m")), "manifest", F.lit(""), F.col("m"))


def suite_rows(tasks: DataFrame, expected: DataFrame, prompt: Column, max_bytes: int = 3_000_000) -> DataFrame:
    """Violations of tasks (task_id, candidates, user_prompt, image_sha256, source_snapshot_sha256, reason) by what they must be: ``expected`` (task_id,
    candidates, image_digest, image_bytes, snapshot_digest) has the shortlist computed anew and the stored objects' digests, ``prompt`` is the prompt that the
    task's columns give, ``reason`` the first rule of eligibility that its source breaks."""
    want = expected.select("task_id", F.col("candidates").alias("_c"), F.col("image_digest").alias("_i"), F.col("image_bytes").alias("_b"), F.col("snapshot_digest").alias("_s"))
    j = tasks.withColumn("_prompt", prompt).join(want, "task_id", "left")
    differs = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    rules = F.array(
        F.when(differs("candidates", "_c"), "other shortlist"), F.when(differs("user_prompt", "_prompt"), "other prompt"),
        F.when(differs("image_sha256", "_i") | (F.coalesce("_b", F.lit(0)) > max_bytes), "other image"), F.when(differs("source_snapshot_sha256", "_s"), "other source snapshot"),
        F.when(F.col("reason").isNotNull(), F.concat(F.lit("source: "), F.col("reason"))),
    )
    return found(j.select("task_id", F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("m")), "suite_row", F.col("task_id"), F.col("m"))


def normalize_doi(raw: Column) -> Column:
    return F.nullif(F.regexp_replace(F.trim(raw), r"(?i)^(?:https?://doi\.org/|doi:)", ""), F.lit(""))


def normalize_isbn(raw: Column) -> Column:
    return F.nullif(F.regexp_replace(raw, r"[-\s]", ""), F.lit(""))


def evidence_sources(src: DataFrame) -> DataFrame:
    """Violations of bibliographic records (id, title, source_type, doi, pmid, isbn, url)."""
    s = src.withColumns({"_doi": normalize_doi(F.col("doi")), "_isbn": normalize_isbn(F.col("isbn"))})
    bad = lambda c, pattern: ~blank(c) & ~F.col(c).rlike(pattern)
    rules = F.array(
        F.when(blank("title"), "lacks title"), F.when(~F.coalesce(F.col("source_type").isin(*SOURCE_TYPES), F.lit(False)), "unknown source_type"),
        F.when(blank("_doi") & blank("pmid") & blank("_isbn") & blank("url"), "no locator"), F.when(bad("_doi", r"(?i)^10\.\d{4,9}/\S+$"), "malformed DOI"),
        F.when(bad("pmid", r"^\d+$"), "malformed PMID"), F.when(bad("_isbn", r"^\w+$"), "malformed ISBN"), F.when(bad("url", r"^https?://\S+"), "malformed url"),
    )
    broken = s.select("id", F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("_m"))
    return union([found(src.where(blank("id")), "evidence", F.lit(""), "lacks id"), found(broken, "evidence", F.col("id"), F.col("_m")), repeated(src, "evidence_id", "id")])


def evidence_claims(claims: DataFrame, src: DataFrame) -> DataFrame:
    """Violations of claims (id, evidence_id, taxon, geography, claim)."""
    return union([missing_fields(claims, "claim", "id", ["id", "evidence_id", "taxon", "geography", "claim"]), repeated(claims, "claim_id", "id"), orphans(claims, "claim_evidence", "evidence_id", src, "id", "id")])


def assessments(rows: DataFrame, src: DataFrame | None = None, taxa: DataFrame | None = None) -> DataFrame:
    """Violations of assessments; an absent category is one, never a default."""
    parts = [
        not_among(rows, "category", "taxon", "category", CATEGORIES), not_among(rows, "status", "taxon", "status", STATUSES),
        missing_fields(rows, "assessment", "taxon", ["taxon", "geographic_scope", "rationale", "reviewer", "review_date"]),
        found(rows.where(~blank("review_date") & F.col("review_date").try_cast("date").isNull()), "review_date", F.col("taxon"), "not an ISO date"),
    ]
    refs = rows.withColumn("_refs", refs_of(rows))
    parts.append(found(refs.where((F.size("_refs") == 0) | F.exists("_refs", blank)), "evidence_ids", F.col("taxon"), "empty evidence reference"))
    if src is not None:
        parts.append(orphans(refs.select("taxon", F.explode("_refs").alias("ref")), "evidence_ids", "ref", src, "id", "taxon"))
    if taxa is not None:
        parts.append(orphans(rows, "taxon", "taxon", taxa, "taxon"))
    return union(parts)


def display_ordinal(category: Column, strict: bool = False) -> Column:
    """Display order of a category, uncertain last; null for unknown ones, which a gate reports. With ``strict`` an unknown one, null too, is an
    error when it is met."""
    place = F.nullif(F.array_position(F.array(*[F.lit(c) for c in CATEGORIES]), category) - 1, F.lit(-1))
    return F.coalesce(place, F.raise_error(F.concat(F.lit("unknown category "), F.coalesce(category, F.lit("null")))).cast("bigint")) if strict else place


def transitions(events: DataFrame) -> DataFrame:
    """Events (entity_id, previous_status, new_status, decision) whose change of status isn't allowed or whose decision is unknown."""
    allowed = F.lit(False)
    for a, targets in TRANSITIONS.items():
        if targets:
            allowed = allowed | ((F.col("previous_status") == a) & F.col("new_status").isin(*targets))
    moved = events.where(~blank("previous_status") & ~blank("new_status") & (F.col("previous_status") != F.col("new_status")))
    message = F.concat(F.lit("illegal "), F.col("previous_status"), F.lit(" -> "), F.col("new_status"))
    return union([found(moved.where(~allowed), "transition", F.col("entity_id"), message), not_among(events, "decision", "entity_id", "decision", DECISIONS)])


def adjudicate(rows: DataFrame, events: DataFrame) -> DataFrame:
    """(taxon, required, approvals, adjudicated): any rejection rejects; enough approvals approve, two where effects are medically significant or
    disputed; any other event means review; none means draft."""
    e = events.groupBy(F.col("entity_id").alias("taxon")).agg(F.bool_or(F.col("decision") == "reject").alias("no"), F.count_if(F.col("decision") == "approve").alias("yes"), F.count("*").alias("n"))
    two = (F.col("category") == "medically_significant") | (F.col("category") == "uncertain") & (F.col("exposure_context") == "disputed")
    j = rows.join(e, "taxon", "left").withColumn("required", F.when(F.coalesce(two, F.lit(False)), 2).otherwise(1)).withColumn("approvals", F.coalesce("yes", F.lit(0)))
    out = F.when(F.coalesce("no", F.lit(False)), "rejected").when(F.col("approvals") >= F.col("required"), "approved").when(F.coalesce("n", F.lit(0)) > 0, "in_review").otherwise("draft")
    return j.select("taxon", "required", "approvals", out.alias("adjudicated"))


def predictions(tasks: DataFrame, preds: DataFrame, tasks_hash: str | None = None) -> DataFrame:
    """Violations of a run: repeated tasks and predictions, unknown tasks, other snapshots, other images."""
    parts = [repeated(tasks, "task", "task_id"), repeated(preds, "prediction", "task_id"), orphans(preds, "prediction_task", "task_id", tasks, "task_id")]
    if tasks_hash is not None:
        parts.append(found(preds.where(~blank("tasks_hash") & (F.col("tasks_hash") != tasks_hash)), "tasks_hash", F.col("task_id"), "other snapshot"))
    images = preds.where(~blank("image_sha256")).select("task_id", F.col("image_sha256").alias("_i")).join(tasks.select("task_id", "image_sha256"), "task_id")
    parts.append(found(images.where("_i <> image_sha256"), "image", F.col("task_id"), "other image"))
    return union(parts)
