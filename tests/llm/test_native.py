"""URL filters, line dedup and fingerprints against plain versions; none may run Python on executors."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from gleanery.llm import fingerprint, linededup, urlfilter


def no_python(df):
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def slow_judge(url, rules):
    url = url or ""
    host, path = "", ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(raw) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
    best = None
    for verdict, key in rules:
        h, _, p = key.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and host and (best is None or len(key) > len(best[1])):
            best = verdict, key
    return host, path, best[1] if best else None, best[0] if best else "allow"


URLS = [
    None, "", "no scheme", "://", "http://", "http://a.net", "http://A.NET/", "https://x.example.net/en/1?q#f", "https://x.example.net/enx", "http://example.com/de/", "http://example.com/de", "http://notexample.com/de/x",
    "http://m.example.com/DE/x", "http://b.org/fr/a", "http://b.org/fr?x", "http://org/fr/", "http://net/", "http://.net/x", "http://a..net/x", "ftp://é.NET/é", "http://a.net?x=://b.org/fr/", "http://a.net#/en/", "HTTP://Q.Example.Net/en/", "http://a.net/\nb",
]


def test_urls_match_a_plain_loop(spark, monkeypatch):
    rng = random.Random(3)
    hosts = [f"h{k}.example.{t}" for k in range(40) for t in ("net", "com", "org", "io")]
    urls = URLS + [f"http://{rng.choice(['', 'm.'])}{rng.choice(hosts)}/{rng.choice(['en', 'de', 'fr'])}/{k}" for k in range(400)]
    df = spark.createDataFrame([(k, u, "x") for k, u in enumerate(urls)], "page_id long, url string, host string")
    rules = list(urlfilter.RULES) + [(rng.choice(["block", "allow"]), f"{h}/{rng.choice(['', 'en', 'de/1'])}") for h in rng.sample(hosts, 60)]
    out = urlfilter.judge(df, rules)
    no_python(out)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    first = {k: min(v for v, other in rules if other == k) for _, k in reversed(rules)}
    assert got == {k: slow_judge(u, [(v, key) for key, v in first.items()]) for k, u in enumerate(urls)}
    monkeypatch.setattr(urlfilter, "MAX_FILTER_BYTES", 30)  # several parts, a pass for each
    clash = df.withColumns({n: F.lit("x") for n in ("best", "_best", "key", "listed", "rule", "best_")})
    parted = urlfilter.judge(clash, spark.createDataFrame(rules, "verdict string, key string").dropDuplicates(["key"]))
    assert {r.page_id: (r.host, r.path, r.rule) for r in parted.collect()} == {k: v[:3] for k, v in got.items()}
    row = parted.first()
    assert [row[n] for n in ("best", "_best", "key", "listed", "best_")] == ["x"] * 5
    assert urlfilter.judge(df, []).where("rule is not null or verdict <> 'allow'").count() == 0
    long = spark.createDataFrame([(1, "http://a.example.net/en/" + "x" * 1_000_000), (2, "http://" + "a." * 300 + "net/")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urlfilter.judge(long).collect()} == {1: "allow", 2: "block"}
    assert urlfilter.judge(df.limit(0)).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    keys = [(f"k{i}", i % 3 == 0) for i in range(3000)]
    df = spark.createDataFrame(keys, "key string, listed boolean")
    levels = urlfilter.build_cascade(df)
    assert len(levels) > 1
    wrong = df.where(urlfilter.member(levels, F.col("key")) != F.col("listed")).count()
    assert wrong == 0 and urlfilter.build_cascade(df.where("not listed")) == []


def slow_dedup(docs):
    def keys(line):
        w = [("<*>" if re.search("[0-9]", x) else x) for x in re.split(r"[ \t\r\f\x0B]+", line) if x]
        n = len(w)
        if n < linededup.MIN_TOKENS:
            return [("as it stands", *[x for x in re.split(r"[ \t\r\f\x0B]+", line) if x])] if n else []
        if n < linededup.MIN_FIELDS:
            return [(n, tuple(w))]
        r = n - 3
        a, b = r // 3, r * 2 // 3
        lead, parts = tuple(w[:3]), [tuple(w[3 : 3 + a]), tuple(w[3 + a : 3 + b]), tuple(w[3 + b :])]
        return [(n, lead, k, *parts[:k], *parts[k + 1 :]) for k in range(3)]

    first = {}
    for d, t in docs:
        for line in (t or "").split("\n") if d is not None and t is not None else ():
            for k in keys(line):
                first[k] = min(first.get(k, d), d)
    return [(d, t if d is None or t is None else "\n".join(x for x in t.split("\n") if not any(first[k] < d for k in keys(x)))) for d, t in docs]


def test_lines_match_a_plain_loop(spark):
    rng = random.Random(5)
    pool = ["Posted by user123 on 2020", "All rights reserved.", "ab cd", "x", "", " ", *(" ".join(rng.choice("abcdefgh") * 3 for _ in range(rng.randrange(3, 25))) for _ in range(40))]
    docs = []
    for d in range(120):
        lines = []
        for _ in range(rng.randrange(0, 12)):
            line = rng.choice(pool)
            if rng.random() < 0.3 and len(line.split()) > 8:
                w = line.split()
                w[rng.randrange(3, len(w))] = f"new{rng.randrange(9)}"
                line = " ".join(w)
            lines.append(line if rng.random() < 0.7 else f"own{d} line{d} number{d}x of{d}y")
        docs.append((d, "\n".join(lines)))
    docs += [(None, "All rights reserved."), (500, None), (501, ""), (3, docs[3][1]), (502, "Posted by user9 on 1999\n" * 3), (503, ("word " * 30_000 + "\n") * 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"k": F.lit(1), "n_chars": F.length("text").cast("long"), "t": F.lit("x"), "_drop": F.lit("y"), "_k": F.lit("z"), "drop": F.lit("w"), "_n_lines": F.lit(-1)})
    out = linededup.drop_lines(df)
    no_python(out)
    got = out.select("doc_id", "text", "n_chars", "_n_lines", "_n_dropped").collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(slow_dedup(docs), key=str)
    assert {(r.k, r.t, r._drop, r._k, r["drop"]) for r in out.collect()} == {(1, "x", "y", "z", "w")}
    assert all(r._n_lines == (0 if r.text is None else r._n_lines) and r._n_lines >= 0 for r in got)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)
    assert linededup.drop_lines(df.limit(0)).count() == 0


def slow_sketch(text):
    words = [w for w in re.split(r"[ \t-\r]+", text) if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def test_fingerprints_match_sets(spark):
    rng = random.Random(7)
    vocab = [f"v{k}" for k in range(60)] + ["é", "中"]
    docs = [(d * 3, " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 110)))) for d in range(60)]
    docs += [(500, None), (501, ""), (502, "a\tb\n c"), (503, "a b c d e"), (600, "z " * 40_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("sketch", F.lit(0))
    out = fingerprint.edited_pairs(df.repartition(5))
    no_python(out)
    got = {r.doc_id: r for r in out.withColumns({"e": fingerprint.resemblance(F.col("sketch"), F.col("edited_sketch")), "n": fingerprint.resemblance(F.col("sketch"), F.col("next_sketch")), "m": F.length("text"), "c": fingerprint.containment(F.col("sketch"), F.col("edited_sketch"))}).collect()}
    text = {d: t or "" for d, t in docs}
    ids = sorted(text)
    jac = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for d, nxt in zip(ids, ids[1:] + ids[:1], strict=True):
        k = len(text[d]) // 4
        edited = text[d][: len(text[d]) - k] + text[nxt][:k]
        assert got[d].edited == edited
        a, b = slow_sketch(text[d]), slow_sketch(edited)
        close = 1e-9 if len(a | b) <= fingerprint.K else 0.15
        assert got[d].e == pytest.approx(jac(a, b), abs=close)
        assert got[d].n == pytest.approx(jac(slow_sketch(text[d]), slow_sketch(text[nxt])), abs=0.15)
        assert got[d].c == pytest.approx(len(a & b) / len(a) if a else 1.0, abs=max(close, 1e-6) * 1.5)
    odd = spark.createDataFrame([(None, "no id a b c d"), (1, "x y z"), (1, "x y z"), (2, "q")], "doc_id long, text string")
    rows = fingerprint.edited_pairs(odd).collect()
    assert len(rows) == 4 and fingerprint.edited_pairs(odd.limit(0)).count() == 0


def test_sketches_merge(spark):
    a, b = " ".join(f"a{i}" for i in range(400)), " ".join(f"b{i}" for i in range(300))
    df = spark.createDataFrame([(a, b)], "a string, b string")
    s = {c: fingerprint.sketch(F.col(c)) for c in "ab"}
    row = df.select(fingerprint.merge(s["a"], s["b"]).alias("m"), fingerprint.distinct_shingles(fingerprint.merge(s["a"], s["b"])).alias("n"), fingerprint.as_text(s["a"]).alias("t")).first()
    assert len(row.m) == fingerprint.K and row.m == sorted(row.m) and abs(row.n - 692) < 250 and len(row.t) == 8 * fingerprint.K
    assert hashlib.sha256(row.t.encode()).hexdigest() == hashlib.sha256(df.select(fingerprint.as_text(s["a"]).alias("t")).first().t.encode()).hexdigest()
