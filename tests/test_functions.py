"""Column functions against small expectations."""

import pytest
from pyspark.sql import functions as F

from gleanery.functions import answers, licenses, media, names, urls


def one(spark, column, **values):
    ddl = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'boolean' if isinstance(v, bool) else 'bigint' if isinstance(v, int) else 'binary' if isinstance(v, bytes) else 'string'}" for k, v in values.items())
    row = spark.createDataFrame([tuple(values.values())], ddl) if values else spark.range(1)
    return row.select(column.alias("x")).first().x


def test_names(spark):
    rows = [("  Pardosa (Acantholycosa)  LUGUBRIS ", "pardosa (acantholycosa) lugubris"), ("Ｆｕｌｌ ﬁne", "full fine"), ("", ""), (None, None)]
    df = spark.createDataFrame([(a,) for a, _ in rows], "a string")
    assert [r.x for r in df.select(names.normalize_name(F.col("a")).alias("x")).collect()] == [b for _, b in rows]
    assert one(spark, names.normalize_authorship(F.col("a")), a=" ( Clerck ,1757 ) ") == "(Clerck, 1757)"
    assert one(spark, names.normalize_authorship(F.col("a")), a="  ") is None
    for raw, want in [("sp.", "species"), (" SSP ", "subspecies"), ("Tribe", "tribe"), (" ", None), ("f", "form")]:
        assert one(spark, names.canonical_rank(F.col("a")), a=raw) == want


def test_licenses(spark):
    for raw, want in [("cc_by", "CC-BY-4.0"), ("CC BY 3.0", "CC-BY-3.0"), ("Creative Commons by-sa", "CC-BY-SA-4.0"), ("own terms ", "own terms"), ("cc-by-nc-sa-4.0", "CC-BY-NC-SA-4.0")]:
        assert one(spark, licenses.identifier_license(F.col("a")), a=raw) == want
    text = dict(a="CC BY-NC-SA 4.0", b="", c="")
    cols = (F.col("a"), F.col("b"), F.col("c"))
    assert one(spark, licenses.template_license(*cols), **text) == "cc-by-nc-sa" and one(spark, licenses.template_license(*cols, first_wins=True), **text) == "cc-by-nc"
    assert one(spark, licenses.template_license(*cols), a="CC0", b="", c="") == "cc0" and one(spark, licenses.template_license(*cols), a="??", b="", c="") is None
    assert one(spark, licenses.verdict(F.lit("CC-BY-SA-4.0"), "research")) == "review_required" and one(spark, licenses.verdict(F.lit("CC-BY-NC-4.0"), "conservative")) == "rejected"
    assert one(spark, licenses.verdict(F.lit(None).cast("string"), "research")) == "rejected"
    with pytest.raises(ValueError):
        licenses.verdict(F.lit("x"), "nobody")
    full = licenses.attribution(F.col("a"), F.lit("CC0-1.0"), F.lit(""), F.lit("http://x"), F.lit("T"))
    assert one(spark, full, a=" Ann ") == "“T” by Ann, licensed under CC0-1.0, source: http://x." and one(spark, full, a=" ") is None
    for blob, lic, want in [("gfdl and cc-by", "cc-by", "multi-license markers=['gfdl']"), ("cc-by", None, "unknown-license"), ("cc-by", "cc-by", None), ("permission cc-by", "cc-by", "ambiguous markers=['permission']")]:
        assert one(spark, licenses.review_reason(F.col("a"), F.lit(lic).cast("string")), a=blob) == want


def test_urls(spark):
    mark = "https://www.inaturalist.org/observations/"
    obs = urls.observation_id(F.col("a"), F.col("b"))
    assert one(spark, obs, a=mark + "12x3?y", b="") == 123 and one(spark, obs, a=mark, b=mark + "5") is None and one(spark, obs, a="x", b=mark + "5/6") == 5
    assert one(spark, urls.host_allowed(F.col("a"), ["b.org"]), a="http://A.B.org/x") and not one(spark, urls.host_allowed(F.col("a"), ["b.org"]), a="http://ab.org") and not one(spark, urls.host_allowed(F.col("a"), ["b.org"]), a="::bad::")
    assert one(spark, urls.first_offender(F.col("a"), ["b.org"]), a=["http://b.org", "http://evil.com", "http://c.org"]) == "http://evil.com"
    assert one(spark, urls.large_photo(F.col("a")), a="http://inaturalist.org/1/square.jpg") == "http://inaturalist.org/1/large.jpg" and one(spark, urls.large_photo(F.col("a")), a="http://x/square.jpg") == "http://x/square.jpg"
    assert one(spark, urls.content_key("p/", F.lit("abcdef"), F.lit(".JPEG"))) == "p/media/sha256/ab/cd/abcdef.jpg"
    assert one(spark, urls.search_variants(F.col("a")), a="A b c") == ['"A b c"', '"A b"'] and one(spark, urls.search_variants(F.col("a")), a="A b") == ['"A b"']
    assert one(spark, urls.source_identity(F.lit("s"), F.lit("1"), F.lit("u"))) == "s:1" and one(spark, urls.source_identity(F.lit("s"), F.lit(""), F.lit("u//"))) == "u"


def test_media(spark):
    assert one(spark, media.from_hex(F.lit("ffffffffffffffff"))) == -1 and one(spark, media.to_hex(F.lit(-1).cast("bigint"))) == "f" * 16 and one(spark, media.to_hex(media.from_hex(F.lit("0000000000000a01")))) == "0000000000000a01"
    assert one(spark, media.hamming(F.lit(-1).cast("bigint"), F.lit(0).cast("bigint"))) == 64
    for m, want in [("12", "winter"), ("4", "spring"), ("13", None), ("May", "May")]:
        assert one(spark, media.season(F.col("a")), a=m) == want
    assert one(spark, media.season(F.lit("5"), F.lit("monsoon"))) == "monsoon"
    png, jpg = bytes.fromhex("89504E470D0A1A0A") + b"x" * 300, b"\xff\xd8" + b"y" * 300
    v = lambda d, t="image/png", w=200, h=200, g=99: one(spark, media.validate(F.col("d"), F.col("t"), F.lit(w).cast("int"), F.lit(h).cast("int"), F.lit(g)), d=d, t=t)
    assert [v(png), v(b""), v(b"<html>" + b"x" * 300), v(b"GIF89a" + b"z" * 300), v(b"?" * 300), v(png[:50]), v(jpg), v(jpg, "image/jpg; q=1"), v(png, w=None), v(png, w=100), v(png, g=2)] == [
        "ok", "corrupt", "html_error_page", "unsupported_format", "unsupported_format", "tiny_bytes", "mime_mismatch", "ok", "decode_error", "tiny", "near_empty",
    ]
    p = lambda f, w, h, s: one(spark, media.image_policy(F.lit(f), F.lit(w), F.lit(h), F.lit(s)))
    assert [p(1, 400, 400, 10), p(2, 400, 400, 10), p(1, 300, 900, 10), p(1, 400, 9000, 10), p(1, 400, 400, 4_000_000)] == [None, "animated_or_multiframe", "source_resolution_below_320", "aspect_ratio_too_extreme", "normalized_image_exceeds_3MB"]
    px = F.array(*[F.lit(x) for x in range(72)])
    assert one(spark, media.difference_hash(px)) == 0 and one(spark, media.average_hash(F.array(*[F.lit(float(x)) for x in range(64)]))) == 0xFFFFFFFF


def test_answers(spark):
    cands = F.array(F.lit("Aa bb"), F.lit("Cc dd"))
    for text, want in [("<answer> aa  BB </answer>", ("Aa bb", True)), ("aa bb", ("Aa bb", True)), ("I think Aa bb", ("I think Aa bb", False)), ("<answer>Aa bb</answer><answer>Cc dd</answer>", ("<answer>Aa bb</answer><answer>Cc dd</answer>", False)), (None, ("", False))]:
        got = spark.createDataFrame([(text,)], "t string").select(answers.match_candidate(F.col("t"), cands).alias("m")).first().m
        assert (got.taxon, got.matched) == want
    rows = [("boom", "stop", None, "r", "t", True, "transport_error"), (None, "max_tokens", None, "r", "t", True, "truncated"), (None, "stop", "no", "r", "t", True, "refused"), (None, "refusal", None, "r", "t", True, "refused"), (None, "stop", None, " ", "t", True, "empty"), (None, "stop", None, None, None, None, "empty"), (None, "stop", None, "r", "t", False, "invalid_answer"), (None, "stop", None, "r", None, None, "invalid_answer"), (None, None, None, None, "t", None, "answered")]
    df = spark.createDataFrame(rows, "e string, f string, r string, w string, t string, m boolean, want string")
    assert all(r.x == r.want for r in df.select("want", answers.response_status(*[F.col(c) for c in "efrwtm"]).alias("x")).collect())
    assert one(spark, answers.is_correct(F.lit(" SYN  one"), F.lit("other"), F.array(F.lit("syn one")))) and not one(spark, answers.is_correct(F.lit(" "), F.lit(""), F.array().cast("array<string>")))
    b = lambda *v: one(spark, answers.billed_output(F.lit(v[0]), *[F.lit(x).cast("long") for x in v[1:]]))
    g = "https://generativelanguage.googleapis.com/v1"
    assert [b(g, 10, 5, 40), b(g, 10, 50, 40), b("https://x", 10, 5, 40), b(g, 10, 5, None)] == [30, 50, 5, 5]
