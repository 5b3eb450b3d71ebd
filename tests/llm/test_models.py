"""Quality, toxicity and language ID: equality with plain versions, held-out accuracy, odd rows."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm import langid, quality, toxicity
from gleanery.llm.common import fold


def prose(rng, vocab, n):
    return " ".join(rng.choice(vocab) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(6)
    good, bad = [f"word{k}" for k in range(80)], [f"w%%{k}" for k in range(80)]
    rude = ["idiot", "moron", "scum"]
    docs, labels = [], []
    for d in range(900):
        q, t = int(rng.random() < 0.7), int(rng.random() < 0.25)
        words = prose(rng, good if q else bad, rng.randrange(20, 60)).split()
        for _ in range(rng.randrange(3, 7) if t else 0):
            words.insert(rng.randrange(len(words)), rng.choice(rude))
        docs.append((d, " ".join(words), None, "s"))
        labels.append((d, q, t))
    odd = [(None, "no id", None, "s"), (2000, None, None, None), (2001, "", "en", "s"), (2001, "", "en", "s"), (2002, "x" * 50_000, None, "s"), (2003, "\n\t ", None, "s")]
    return spark.createDataFrame(docs + odd, "doc_id long, text string, lang string, source string").withColumn("score", F.lit("clash")), spark.createDataFrame(labels + [(None, 1, 1), (5, None, None), (7777, 1, 0)], "doc_id long, quality int, toxic int")


def held_out(docs, labels, column, label, of, held):
    rows = docs.select("doc_id", column.alias("p")).join(labels, "doc_id").where((fold(F.col("doc_id"), of) == held) & F.col(label).isNotNull()).collect()
    assert len(rows) > 80
    return rows


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    model = quality.fit(docs, labels)
    rows = held_out(docs, labels, quality.score(docs, model), "quality", 5, 0)
    assert sum((r.p >= 0.3) == r.quality for r in rows) / len(rows) > 0.97
    every = docs.select(quality.score(docs, model).alias("p")).collect()
    assert len(every) == docs.count() and all(0 <= r.p <= 1 for r in every)


def test_quality_scorer_equals_the_plain_average():
    rng = np.random.default_rng(0)
    model = quality.QualityModel(rng.normal(size=quality.BUCKETS).astype(np.float32), 0.3)
    texts = ["a b b ccc déjà vu", "one", "", None, "x y " * 40, "long" * 300]
    got = quality.Scorer(model)(texts)
    for t, p in zip(texts, got, strict=True):
        idx, w = quality.features(t or "")
        z = model.bias + float(w @ model.gain[idx]) if len(idx) else model.bias
        assert p == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-4)


def test_quality_without_labels(tables):
    docs, labels = tables
    model = quality.fit(docs, labels.limit(0))
    assert {r.p for r in docs.select(quality.score(docs, model).alias("p")).collect()} == {0.5}
    assert docs.limit(0).select(quality.score(docs.limit(0), model)).count() == 0


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    lexicon = toxicity.fit(docs, labels)
    assert {"idiot", "moron", "scum"} <= set(lexicon.weights)
    rows = held_out(docs, labels, toxicity.score(docs, lexicon), "toxic", 3, 1)
    assert sum((r.p >= 0.7) == r.toxic for r in rows) / len(rows) > 0.97


def test_folding_undoes_disguise():
    lex = toxicity.learn([])
    m = toxicity.Matcher(lex)
    plain = m.mass("you idiot and moron stupid")
    for t in ["you 1d10t and m0r0n $tupid", "you ІDІОТ and mоrоn ѕtupid", "you ídîöt, and: moron! stüpid?", "YOU ＩＤＩＯＴ AND MORON STUPID"]:
        assert m.mass(t) == plain, t
    assert m.mass("that is not stupid")[0] == 0 < m.mass("that is stupid")[0]
    assert m.mass("idiotic scummy")[0] == 0
    assert m.mass(None) == m.mass("") == m.mass(" . ") == (0.0, 0)
    assert m.score("idiot") > m.score("idiot " + "fine " * 200) > m.score("fine " * 200)


def slow_bits(texts, order, text):
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    for x in texts:
        seq = [None] * order + list(x.encode())
        for i in range(order, len(seq)):
            for k in range(order + 1):
                counts[k][tuple(seq[i - k : i])][seq[i]] += 1
    seq, bits = [None] * order + list(text.encode()), 0.0
    for i in range(order, len(seq)):
        for k in range(order, -1, -1):
            c = counts[k].get(tuple(seq[i - k : i]))
            if not c:
                continue
            n, kinds = sum(c.values()), len(c)
            if seq[i] in c:
                bits -= math.log2(c[seq[i]] / (n + kinds))
                break
            bits -= math.log2(kinds / (n + kinds))
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact(monkeypatch):
    texts = {"en": ["the cat sat on the mat", "hello there"], "de": ["der hund und die katze", "für ä"]}
    asked = ["the katze", "xyz ü the", "", "a", "für für", "\x00\x01", "the cat " * 30]
    for order in (1, 2, 3, 4):
        model = langid.train(texts, order)
        for chunk in (1 << 20, 16):
            monkeypatch.setattr(langid, "CHUNK", chunk)
            got = langid.code_lengths(model, asked)
            for t, row in zip(asked, got, strict=True):
                assert row == pytest.approx([slow_bits(texts[x], order, t) for x in model.languages], abs=1e-3)


def test_languages_on_held_out_rows(spark):
    rng = random.Random(9)
    vocab = {"en": "the of and that with house tree".split(), "de": "der die und das mit haus baum schön".split(), "fr": "le la et que avec maison arbre été".split()}
    rows = [(d, prose(rng, vocab[x], rng.randrange(5, 40)), x) for d, x in enumerate(rng.choice(list(vocab)) for _ in range(400))]
    odd = [(1000, None, "en"), (1001, "12 34 !!", "de"), (1002, "", None), (None, "the house", "en"), (1003, "der baum " * 40_000, None)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert model.languages == ["de", "en", "fr"]
    got = df.select("doc_id", "lang", langid.identify(df, model).alias("f")).collect()
    test = [r for r in got if r.doc_id is not None and r.doc_id < 1000]
    assert sum(r.f.lang == r.lang for r in test) / len(test) > 0.97
    by = {r.doc_id: r.f for r in got}
    assert by[1000].lang == by[1001].lang == by[1002].lang == "und" and by[1003].lang == "de" and all(0 <= r.f.score <= 1 for r in got)
    nothing = langid.fit(df.limit(0))
    assert {r.f.lang for r in df.select(langid.identify(df, nothing).alias("f")).collect()} == {"und"}


def test_lexicon_hits_equal_a_plain_scan():
    rng = random.Random(2)
    lex = toxicity.Lexicon({"bad": 1.0, "worse thing": 2.5, "ad": 0.25}, ["not bad", "bad hair day", "worse"], 0.5, 3.0, -1.0)
    matcher = toxicity.Matcher(lex)
    for _ in range(400):
        text = " ".join(rng.choice(["bad", "B4D", "not", "hair", "day", "worse", "thing", "ad", "bаd", "x"]) for _ in range(rng.randrange(0, 25)))
        folded = toxicity.fold_text(text)
        spans = lambda word: [(k, k + len(toxicity.fold_text(word))) for k in range(len(folded)) if folded.startswith(toxicity.fold_text(word), k)]
        excused = [s for e in lex.exceptions for s in spans(e)]
        want = sum(w for word, w in lex.weights.items() for a, b in spans(word) if not any(x <= a and b <= y for x, y in excused))
        mass, words = matcher.mass(text)
        assert abs(mass - want) < 1e-9 and words == len(folded.split())


def test_long_texts_full_of_exceptions_take_time_in_proportion():
    import time

    matcher = toxicity.Matcher(toxicity.Lexicon({"bad": 1.0}, ["not bad"]))
    began = time.perf_counter()
    assert matcher.mass("not bad " * 200_000) == (0.0, 400_000)
    assert matcher.mass("not bad " * 1000 + "bad " * 7)[0] == 7.0
    assert time.perf_counter() - began < 30
