"""Rules, votes and the weighing of them against plain versions, and against labels that the method never sees."""

import math
import random
import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F
from test_native import no_python

from gleanery.llm import qualityrules as rules

DATA = "/root/testdata/sf0.01"


def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_base_matches_a_plain_version(spark):
    rng = random.Random(4)
    texts = [None, "", " ", "\n\n", "one", "a b c d e f g h", "a b c d e f g h i", "a " * 8, "a " * 9, "a " * 17, "a b " * 9 + "c", "x\x85y z # < é  \x0b\x0c q", "l\nl\n l\nl \n\nl\r\nl\r"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(200)]
    texts += ["\n".join(" ".join(rng.choice(["eins", "zwei", "drei|", "vier"]) for _ in range(rng.randrange(12))) for _ in range(rng.randrange(20))) for _ in range(100)]
    texts += [" ".join(map(str, range(60_000))) + " 1 2 3 4 5 6 7 8 9", "so " * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({c: F.lit("x") for c in ("_w", "n_words", "votes")})
    out = rules.features(df, "text", "doc_id")
    no_python(out)
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out.collect()}
    assert got == {k: plain_base(t) for k, t in enumerate(texts)}


def plain_estimate(seen):
    share, good, bad = rules.START[0], [rules.START[1]] * len(rules.RULES), [rules.START[2]] * len(rules.RULES)

    def posterior(v):
        odds = math.log(share / (1 - share))
        for j, x in enumerate(v):
            odds += 0 if x == "-" else math.log(good[j] / (1 - bad[j])) if x == "1" else math.log((1 - good[j]) / bad[j])
        return 1 / (1 + math.exp(-odds))

    for _ in range(rules.ROUNDS):
        p = {v: posterior(v) for v in seen}
        right, wrong = rules.PRIOR
        fit = lambda j, w, x: (sum(n * w(v) for v, n in seen.items() if v[j] == x) + right) / (sum(n * w(v) for v, n in seen.items() if v[j] != "-") + right + wrong)
        share = (sum(n * p[v] for v, n in seen.items()) + 1) / (sum(seen.values()) + 2)
        good, bad = [fit(j, lambda v: p[v], "1") for j in range(len(good))], [fit(j, lambda v: 1 - p[v], "0") for j in range(len(bad))]
    return {v: posterior(v) for v in seen}


def test_posteriors_match_a_plain_estimate(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = rules.judge(rules.features(docs, "text", "doc_id"))
    no_python(out)
    got = out.collect()
    want = plain_estimate(Counter(r.votes for r in got))
    assert all(abs(r.posterior - want[r.votes]) < 1e-9 for r in got)
    assert all(r.kept == (not r.base_failed and r.posterior >= rules.KEEP) for r in got)
    again = {r.doc_id: r.posterior for r in rules.judge(rules.features(docs.repartition(7), "text", "doc_id")).collect()}
    assert again == {r.doc_id: r.posterior for r in got}
    # Labels were never shown: the verdict agrees with nearly all of them.
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{DATA}/labels.parquet'").fetchall())
    kept = {r.doc_id: r.kept for r in got if not r.base_failed}
    good, bad = ([kept[i] for i, q in labels.items() if q == x and i in kept] for x in (1, 0))
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_weights_find_the_better_rules(spark):
    """Simulated votes of known accuracy: the estimate finds them, and beats a majority."""
    rng = random.Random(9)
    right = [0.95, 0.9, 0.9, 0.8, 0.8, 0.6, 0.55, 0.55, 0.55, 0.55]
    assert len(right) == len(rules.RULES)
    truth, votes = [], []
    for _ in range(4000):
        y = rng.random() < 0.7
        truth.append(y)
        votes.append("".join("-" if rng.random() < 0.2 else str(int(y == (rng.random() < a))) for a in right))
    df = spark.createDataFrame([(v,) for v in votes], "votes string")
    state = rules.estimate(df).first().state
    assert all(abs(a - b) < 0.06 for a, b in zip(state.good, right, strict=True)) and abs(state.share - 0.7) < 0.05
    post = {r.votes: r.posterior for r in rules.posteriors(df).collect()}
    weighed = sum((post[v] >= 0.5) == y for v, y in zip(votes, truth, strict=True))
    majority = sum((v.count("1") >= v.count("0")) == y for v, y in zip(votes, truth, strict=True))
    assert weighed > majority


def test_empty_and_repeated(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert rules.judge(rules.features(none, "text", "doc_id")).count() == 0
    same = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None), (None, "")], "doc_id long, text string")
    got = rules.judge(rules.features(same, "text", "doc_id")).collect()
    assert len(got) == 4 and all(r.base_failed and not r.kept for r in got) and {r.votes for r in got} == {"-" * len(rules.RULES)}
