import random

import numpy as np

from gleanery.llm import decontaminate as D


def slow_align(item, text):
    h = [[0] * (len(text) + 1) for _ in range(len(item) + 1)]
    best = 0
    for i in range(1, len(item) + 1):
        for j in range(1, len(text) + 1):
            same = D.MATCH if item[i - 1] == text[j - 1] else D.OTHER
            h[i][j] = max(0, h[i - 1][j - 1] + same, h[i - 1][j] + D.GAP, h[i][j - 1] + D.GAP)
            best = max(best, h[i][j])
    return best


def test_alignment_matches_the_plain_table():
    rng = random.Random(2)
    for _ in range(60):
        item = np.array([rng.randrange(1, 6) for _ in range(rng.randrange(1, 15))])
        text = np.array([rng.randrange(1, 6) for _ in range(rng.randrange(0, 30))], np.int64)
        assert D.align(item, text)[0] == slow_align(item, text)


def test_query_matches_brute_force(spark):
    rng = random.Random(8)
    vocab = [f"w{k}" for k in range(150)]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.randrange(12, 40)))) for k in range(25)]
    docs = []
    for d in range(160):
        words = [rng.choice(vocab) for _ in range(rng.randrange(0, 120))]
        if d % 2:
            leak = items[rng.randrange(25)][1].split()
            for _ in range(rng.choice([0, 0, 1, 3, 6])):
                k = rng.randrange(len(leak))
                leak[k : k + 1] = rng.choice([[], ["xx"], ["yy", leak[k]]])
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w.upper() + rng.choice(["", ",", "."]) for w in leak]
        docs.append((d, " ".join(words)))
    docs += [(900, ""), (901, None), (902, items[3][1]), (902, items[3][1]), (None, items[4][1])]
    items += [(50, "too short"), (51, None), (52, ""), (None, items[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "1 as score", "2 as item_id")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((str(r.doc_id), str(r.h.item_id), round(r.h.score, 9)) for r in df.select("doc_id", D.F.explode(D.held_items(df, bench)).alias("h")).collect())
    want = []
    for d, t in docs:
        for i, x in items:
            own, text = D.words_of(x), D.words_of(t)
            if len(own) >= 3 and (s := slow_align(own, text) / (2 * len(own))) >= D.THRESHOLD:
                want.append((str(d), str(i), round(s, 9)))
    assert got == sorted(want) and len(want) > 60
    assert df.limit(0).select(D.held_items(df.limit(0), bench)).count() == 0
    assert df.select(D.F.size(D.held_items(df, bench.limit(0))).alias("n")).where("n > 0").count() == 0


def test_large_benchmarks_go_in_blocks(spark, monkeypatch):
    rng = random.Random(6)
    items = [(k, " ".join(f"w{rng.randrange(500)}" for _ in range(30))) for k in range(40)]
    docs = [(d, "lead words " + items[d % 40][1] + " and the rest") for d in range(60)]
    bench, df = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    ids = lambda: {r.doc_id: sorted(h.item_id for h in r.h) for r in df.select("doc_id", D.held_items(df, bench).alias("h")).collect()}
    whole = ids()
    monkeypatch.setattr(D, "BLOCK_WORDS", 300)
    assert ids() == whole and all(d % 40 in whole[d] for d in whole)


def test_edited_copies_match_brute_force():
    rng = random.Random(3)
    vocab = [f"w{k}" for k in range(90)]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.randrange(3, 40)))) for k in range(40)]
    block = D.block_of(items)
    texts = []
    for _, t in items:
        own = t.split()
        texts += [[w if k % every < every - 1 else "xx" for k, w in enumerate(own)] for every in (3, 4)]  # runs of two and three words
        texts.append([x for w in own for x in (w, "yy")][:-1])  # no two words in a row
        texts.append([w for k, w in enumerate(own) if k % 3])
    found = 0
    for words in texts:
        words = [rng.choice(vocab) for _ in range(rng.randrange(0, 50))] + words + [rng.choice(vocab) for _ in range(rng.randrange(0, 50))]
        got = {k: round(score, 9) for k, score, _ in D.matches(block, words)}
        numbers = block.numbers(words)
        want = {k: round(D.align(own, numbers)[0] / (2 * len(own)), 9) for k, own in enumerate(block.items)}
        assert got == {k: x for k, x in want.items() if x >= D.THRESHOLD}
        found += len(got)
    assert found > 140


def test_items_of_one_or_two_words():
    block = D.block_of([(1, "Lone"), (2, "two words"), (3, "a a"), (4, ""), (5, "w1 w2 w3")])
    held = lambda t: D.matches(block, D.words_of(t))
    assert held("so lone, two. Words a b") == [(0, 1.0, 2), (1, 1.0, 4)] and held("words two a b a") == [] == held("")
    assert held("lone") == [(0, 1.0, 1)] and held("x a a a") == [(2, 1.0, 3)] and held("w1 w2 w3")[0][0] == 4
