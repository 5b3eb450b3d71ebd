"""Answers of evaluated models: parsing, status, correctness, prompts and cost as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.names import plain_name

# Finish reasons by what they mean.
CUT_OFF = ("length", "max_tokens", "model_context_window_exceeded")
DECLINED = ("content_filter", "guardrail_intervened", "content_filtered", "refusal")


def answer_form(text: Column) -> Column:
    """Comparison form of an answer; empty for null."""
    return F.coalesce(plain_name(text), F.lit(""))


def tagged_answer(text: Column, tag: str) -> tuple[Column, Column]:
    """(answer, single): what stands between the one pair of tags, or the whole text without any; ``single`` is false where
    several pairs leave it open."""
    text = F.coalesce(text, F.lit(""))
    found = F.regexp_extract_all(text, F.lit(rf"(?is)<\s*{tag}\s*>(.*?)<\s*/\s*{tag}\s*>"), F.lit(1))
    one = F.regexp_replace(F.when(F.size(found) == 1, F.get(found, F.lit(0))).otherwise(text), r"(?U)^\s+|\s+$", "")
    return F.when(F.size(found) > 1, text).otherwise(one), F.size(found) <= 1


def match_candidate(text: Column, candidates: Column, tag: str = "answer") -> Column:
    """struct(taxon, matched): the candidate that the answer equals in comparison form, in the candidate's own spelling (of
    equal forms the last); else the answer as given, unmatched. Names within prose don't count."""
    answer, single = tagged_answer(text, tag)
    same = F.filter(candidates, lambda c: answer_form(c) == answer_form(answer))
    hit = single & (F.size(same) > 0)
    return F.struct(F.when(hit, F.element_at(F.when(hit, same), -1)).otherwise(answer).alias("taxon"), F.coalesce(hit, F.lit(False)).alias("matched"))


def response_status(error: Column, finish: Column, refusal: Column, raw: Column, taxon: Column, matched: Column) -> Column:
    """Status of a prediction by its first ranked answer; null ``raw`` stands for an absent one and falls back to the taxon."""
    out = F.when(F.coalesce(error, F.lit("")) != "", "transport_error").when(finish.isin(*CUT_OFF), "truncated")
    out = out.when((F.coalesce(refusal, F.lit("")) != "") | finish.isin(*DECLINED), "refused")
    out = out.when(F.trim(F.coalesce(raw, taxon, F.lit(""))) == "", "empty")
    return out.when(matched.eqNullSafe(F.lit(False)) | (F.coalesce(taxon, F.lit("")) == ""), "invalid_answer").otherwise("answered")


def is_correct(taxon: Column, correct: Column, synonyms: Column) -> Column:
    """Whether a non-blank answer equals the correct name or an accepted synonym in comparison form."""
    valid = F.array_append(F.transform(F.filter(F.coalesce(synonyms, F.array().cast("array<string>")), lambda s: F.coalesce(s, F.lit("")) != ""), answer_form), answer_form(correct))
    return (answer_form(taxon) != "") & F.array_contains(valid, answer_form(taxon))


def user_prompt(candidates: Column, list_tag: str = "CANDIDATES", question: str = "Name the subject of this photograph.") -> Column:
    """The candidate list as bullets between tags, then the question."""
    bullets = F.array_join(F.transform(candidates, lambda c: F.concat(F.lit("- "), c)), "\n")
    return F.concat(F.lit(f"<{list_tag}>\n"), bullets, F.lit(f"\n</{list_tag}>\n{question}"))


def cost(requests: Column, tokens_in: Column, cached: Column, tokens_out: Column, p_request: Column, p_in: Column, p_cached: Column, p_out: Column) -> Column:
    """Estimated price, all prices per thousand; cached tokens without a price of their own cost as fresh ones."""
    fresh = F.greatest(tokens_in - cached, F.lit(0))
    return requests / 1000 * p_request + fresh / 1000 * p_in + cached / 1000 * F.coalesce(p_cached, p_in) + tokens_out / 1000 * p_out


def billed_output(base_url: Column, prompt: Column, completion: Column, total: Column, host: str = "https://generativelanguage.googleapis.com/") -> Column:
    """Billed output tokens: one host leaves thinking out of its completion count, so there it is the total less the prompt if that is more."""
    return F.when(base_url.startswith(host) & total.isNotNull() & prompt.isNotNull(), F.greatest(completion, total - prompt)).otherwise(completion)


# What marks an error of a model call, and of a download by its type or message, as worth another attempt.
CALL_MARKERS = ("429", "500", "503", "502", "504", "timeout", "timed out", "connection reset", "overloaded", "rate limit", "try again", "temporarily")
DOWNLOAD_TYPES = ("timeout", "connect", "network")
DOWNLOAD_MARKERS = ("timeout", "connection reset", "temporary failure", "try again", "429", "503")


def _names_any(text: Column, words: tuple[str, ...]) -> Column:
    return F.coalesce(F.lower(text).rlike("|".join(words)), F.lit(False))


def transient_call(kind: Column, message: Column) -> Column:
    """Whether a model call's error, told by its type and message together, is worth another attempt."""
    return _names_any(F.concat_ws(" ", kind, message), CALL_MARKERS)


def transient_download(kind: Column, message: Column) -> Column:
    """Whether a download's error is: by words in its type, else by others in its message."""
    return _names_any(kind, DOWNLOAD_TYPES) | _names_any(message, DOWNLOAD_MARKERS)


def transient(message: Column) -> Column:
    """Whether an error of unknown origin is worth another attempt."""
    return F.lower(message).rlike("timeout|timed out|temporar|connection|429|500|502|503|504|rate limit|throttl")
