"""Scoring of runs: strict denominators, macro and per-group accuracy, baselines, leaderboard, error breakdown, cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.answers import cost, is_correct, response_status
from gleanery.functions.names import genus

STATUSES = ("answered", "missing", "transport_error", "truncated", "refused", "empty", "invalid_answer")


def joined(tasks: DataFrame, predictions: DataFrame, topk: tuple[int, ...] = (1,)) -> DataFrame:
    """Every task with its prediction's status and ``hit{k}``; a task without one is ``missing`` and wrong.

    tasks: task_id, correct_taxon, synonyms_accepted, family, candidates. predictions: task_id, predictions (ranked structs taxon,
    matched, raw), error, finish_reason, refusal."""
    p = predictions.select("task_id", F.lit(True).alias("_there"), F.col("predictions").alias("ranked"), "error", "finish_reason", "refusal")
    top = F.get("ranked", F.lit(0))
    status = F.when(F.col("_there").isNull(), "missing").otherwise(response_status(F.col("error"), F.col("finish_reason"), F.col("refusal"), top["raw"], top["taxon"], top["matched"]))
    out = tasks.join(p, "task_id", "left").withColumn("status", status)
    for k in topk:
        right = F.exists(F.slice(F.coalesce("ranked", F.array().cast(p.schema["ranked"].dataType)), 1, k), lambda r: is_correct(r["taxon"], F.col("correct_taxon"), F.col("synonyms_accepted")))
        out = out.withColumn(f"hit{k}", F.coalesce((F.col("status") == "answered") & right, F.lit(False)))
    return out


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def summary(scored: DataFrame, topk: tuple[int, ...] = (1,)) -> DataFrame:
    """One row of the run's scores; all shares are of all tasks but ``top1_answered_only``.

    Two aggregates over one pass each: by species (for the macro mean), then over species."""
    s = F.col("status")
    n_if = lambda c, name: F.count_if(c).alias(name)
    stop = s.isin("missing") | (F.coalesce("error", F.lit("")) != "") | (F.coalesce("finish_reason", F.lit("")) != "")
    per = scored.groupBy("correct_taxon").agg(
        F.count("*").alias("n"), n_if(s == "answered", "answered"), n_if(s == "missing", "missing"), n_if(s == "transport_error", "transport_errors"),
        n_if(~stop, "missing_stop_reasons"), *[n_if(F.col(f"hit{k}"), f"h{k}") for k in topk],
    )
    total = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tasks"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("answered", "missing", "transport_errors", "missing_stop_reasons", *[f"h{k}" for k in topk])], F.coalesce(F.avg(F.col("h1") / F.col("n")), F.lit(0.0)).alias("macro_species_top1"))
    n = F.col("tasks")
    return total.select(
        "tasks", (n - F.col("missing")).alias("scored"), (F.col("missing") == 0).alias("complete"), "missing", (n - F.col("missing") - F.col("answered")).alias("errors"),
        "transport_errors", "missing_stop_reasons", ((n > 0) & (F.col("missing") == 0) & (F.col("transport_errors") == 0) & (F.col("missing_stop_reasons") == 0)).alias("execution_valid"),
        *[_share(F.col(f"h{k}"), n).alias(f"top{k}") for k in topk], _share(F.col("answered"), n).alias("answer_rate"), _share(F.col("h1"), F.col("answered")).alias("top1_answered_only"), "macro_species_top1",
    )


def per_group(scored: DataFrame, by: str = "family") -> DataFrame:
    """(group, n, correct, top1); a null group is ``unknown``."""
    g = scored.groupBy(F.coalesce(F.col(by), F.lit("unknown")).alias(by)).agg(F.count("*").alias("n"), F.count_if("hit1").alias("correct"))
    return g.withColumn("top1", F.col("correct") / F.col("n"))


def status_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("status").agg(F.count("*").alias("n"))


def baselines(tasks: DataFrame) -> DataFrame:
    """One row: the expected top-1 of a uniform guess, and of a guess among the candidates of the largest genera."""
    # Tasks with the same candidates and answer count together, so a family's candidates are looked at once for each of its taxa.
    alike = tasks.groupBy("candidates", "correct_taxon").agg(F.count("*").alias("_tasks"))
    # ``let`` works a value out once; as a column of its own it would be put in wherever it is named, for each element anew.
    let = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))
    genera = F.transform("candidates", lambda c: F.get(F.split(c, " "), F.lit(0)))
    sizes = let(genera, lambda g: F.transform(g, lambda x: F.size(F.filter(g, lambda y: y == x))))
    pool = let(sizes, lambda n: let(F.array_max(n), lambda top: F.filter("candidates", lambda c, i: (F.get(n, i) == top) & c.isNotNull())))
    hit = let(pool, lambda p: F.when(F.array_contains(p, F.col("correct_taxon")), 1.0 / F.size(p)).otherwise(0.0))
    told = alike.select("_tasks", (1.0 / F.size("candidates")).alias("u"), hit.alias("h"))
    mean = lambda c: F.sum(F.col("_tasks") * F.col(c)) / F.sum(F.when(F.col(c).isNotNull(), F.col("_tasks")))
    return told.agg(mean("u").alias("uniform_candidate"), mean("h").alias("largest_genus_candidate_only"))


def error_bucket(status: Column, hit: Column, guess: Column, correct: Column, guess_family: Column, family: Column) -> Column:
    """exact, same_genus, same_family, other_family or failed: the first that holds, failures before all."""
    out = F.when(status != "answered", "failed").when(hit, "exact").when(genus(guess) == genus(correct), "same_genus")
    return out.when(guess_family == family, "same_family").otherwise("other_family")


def error_breakdown(scored: DataFrame, families: DataFrame) -> DataFrame:
    """(bucket, n) over all tasks; ``families``: (taxon, family) of names that may be guessed."""
    known = families.select(F.col("taxon").alias("_guess"), F.col("family").alias("_guess_family")).dropDuplicates(["_guess"])
    guess = F.get("ranked", F.lit(0))["taxon"]
    j = scored.withColumn("_guess", guess).join(known, "_guess", "left")
    return j.groupBy(error_bucket(F.col("status"), F.col("hit1"), F.col("_guess"), F.col("correct_taxon"), F.col("_guess_family"), F.col("family")).alias("bucket")).agg(F.count("*").alias("n"))


def run_report(scored: DataFrame, families: DataFrame) -> DataFrame:
    """One row of a run report's numbers: genus includes exact answers; family counts over answered rows whose both families are known."""
    known = families.select(F.lower("taxon").alias("_low"), F.col("family").alias("_gf")).dropDuplicates(["_low"])
    top = F.get("ranked", F.lit(0))
    j = scored.withColumn("_guess", F.coalesce(top["taxon"], F.lit(""))).withColumn("_matched", F.coalesce(top["matched"], F.col("_guess") != "")).withColumn("_low", F.lower("_guess")).join(known, "_low", "left")
    ok = F.col("status") == "answered"
    both = ok & (F.coalesce("family", F.lit("")) != "") & (F.coalesce("_gf", F.lit("")) != "")
    count = lambda c, name: F.count_if(F.coalesce(c, F.lit(False))).alias(name)
    return j.agg(F.count("*").alias("n"), count(ok & F.col("_matched") & F.col("hit1"), "top1"), count(ok & (genus(F.col("_guess")) == genus(F.col("correct_taxon"))), "genus"), count(both & (F.col("_gf") == F.col("family")), "family"), count(both, "family_known"), count(ok & F.col("_matched"), "valid"), count(~ok, "failures"))


def leaderboard(runs: DataFrame) -> DataFrame:
    """Runs with ``rank``: by top-1, ties by run_id. Runs of different task snapshots or conditions are an error: ``cohorts`` tells."""
    return runs.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("top1"), "run_id")).cast("long"))


def cohorts(runs: DataFrame) -> DataFrame:
    """(tasks_hash, condition, n): more than one row means that the runs can't be ranked together."""
    return runs.groupBy("tasks_hash", F.coalesce("condition", F.lit("image")).alias("condition")).agg(F.count("*").alias("n"))


def usage_cost(ledger: DataFrame, prices: DataFrame) -> DataFrame:
    """(model_id, requests, tokens, cost) of a ledger's rows without error, under (model_id, p_request, p_in, p_cached, p_out)."""
    used = ledger.groupBy("model_id").agg(F.count_if(F.col("error").isNull()).alias("requests"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("input_tokens", "cached_tokens", "output_tokens")])
    priced = used.join(prices, "model_id", "left")
    return priced.select("model_id", "requests", "input_tokens", "cached_tokens", "output_tokens", F.round(cost(F.col("requests"), F.col("input_tokens"), F.col("cached_tokens"), F.col("output_tokens"), F.col("p_request"), F.col("p_in"), F.col("p_cached"), F.col("p_out")), 4).alias("cost"))


def rows_hash(df: DataFrame, key: str, text: Column) -> DataFrame:
    """One row (rows, digest): sha256 over the concatenated row texts in key order. Suites are small; large tables take ``tree_hash``."""
    parts = df.select(F.struct(F.col(key).alias("k"), text.alias("t")).alias("s")).agg(F.count("*").alias("rows"), F.array_sort(F.collect_list("s")).alias("a"))
    return parts.select("rows", F.sha2(F.array_join(F.transform("a", lambda s: s["t"]), ""), 256).alias("digest"))


def tree_hash(df: DataFrame, key: Column, text: Column, buckets: int = 1024) -> DataFrame:
    """One row (rows, digest) for tables of any size: sha256 over the digests of ``buckets`` shares of the rows, dealt by the key's own digest,
    each over its rows' sorted digests. Independent of partitioning and row order."""
    own = df.select(F.sha2(key.cast("string"), 256).alias("k"), F.sha2(text, 256).alias("t"))
    share = own.withColumn("b", F.conv(F.substring("k", 1, 8), 16, 10).cast("long") % buckets)
    each = share.groupBy("b").agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat("k", "t"))), ""), 256).alias("d"))
    return each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "d"))), lambda s: s["d"]), ""), 256).alias("digest"))


def canonical_text(text: Column) -> Column:
    """A JSON string as sorted-key dumps write it: ASCII only, other characters as UTF-16 escapes; ``null`` for null."""
    four = lambda n: F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(n), 4, "0")))
    pair = lambda n: F.concat(four(F.floor((n - 0x10000) / 0x400) + 0xD800), four(F.pmod(n - 0x10000, F.lit(0x400)) + 0xDC00))
    short = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}

    def one(c: Column) -> Column:
        n = F.ascii(c)
        out = F.when((n >= 32) & (n < 128) & ~c.isin('"', "\\"), c)
        for sign, escape in short.items():
            out = out.when(c == sign, escape)
        return out.when(n < 0x10000, four(n)).otherwise(pair(n))

    plain = F.when(text.rlike(r'[^ !#-\[\]-\x7F]'), F.array_join(F.transform(F.split(text, ""), one), "")).otherwise(text)
    return F.coalesce(F.concat(F.lit('"'), plain, F.lit('"')), F.lit("null"))


def canonical_json(**fields: Column) -> Column:
    """One JSON object with keys in order, as sorted-key dumps write it, of columns that are text already in JSON (numbers as text, ``canonical_text``)."""
    parts = [F.concat(F.lit(f'"{k}": '), v) for k, v in sorted(fields.items())]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def run_summary(ledger: DataFrame) -> DataFrame:
    """One row of a run's numbers from its ledger (task_id, error, attempts): tasks, wrote, errors, retried."""
    failed = F.coalesce(F.col("error"), F.lit("")) != ""
    return ledger.agg(F.count_distinct("task_id").alias("tasks"), F.count("*").alias("wrote"), F.count_if(failed).alias("errors"), F.count_if(F.col("attempts") > 1).alias("retried"))


def counts_by(df: DataFrame, what: Column, name: str) -> DataFrame:
    """(name, n): exclusions by reason, a histogram of shortlist sizes."""
    return df.groupBy(what.alias(name)).agg(F.count("*").alias("n"))


def release_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(artifact, rows) of a release's tables."""
    from functools import reduce

    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("artifact"), "rows") for name, df in tables.items()])
