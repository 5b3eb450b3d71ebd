"""Planted cases through the pipeline's stages, each judged on its own input."""

import random

import numpy as np
import pytest

import corpus_pipeline as P
from gleanery.llm import decontaminate, simhash, similar, toxicity
from gleanery.session import cut


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(3000)]
    line = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    text = lambda: "\n".join(line(rng.randrange(20, 60)) for _ in range(rng.randrange(3, 7)))
    docs, labels = [(d, text()) for d in range(200)], []
    bench = [(k, line(rng.randrange(15, 40))) for k in range(20)]
    rude = ["idiot", "moron", "stupid", "scum"]

    def plant(t, words):
        w = t.split(" ")
        for x in words:
            w.insert(rng.randrange(len(w)), x)
        return " ".join(w)

    for d in range(200, 320):
        docs.append((d, plant(text(), [rng.choice(rude) for _ in range(9)])))
    labels = [(d, 1, int(d >= 200)) for d in range(320)]
    docs += [(1000 + k, plant(text(), [x.replace("i", "1").replace("o", "0") for x in rude * 3])) for k in range(5)]
    docs += [(1100 + k, docs[k][1]) for k in range(5)]  # exact copies
    near = docs[10][1].split(" ")
    near += (text() + text() + text()).split(" ")
    docs.append((20_000, " ".join(near)))
    docs += [(1200 + k, " ".join(near[:k] + near[k + 1 :])) for k in (0, len(near) - 1)]
    docs += [(1300 + k, text() + "\n" + bench[k][1]) for k in range(5)]
    edited = bench[9][1].split()
    edited[5] = "other"
    docs += [(1305, text() + "\n" + " ".join(edited) + "\n" + text())]
    shared = line(60)
    docs += [(1400 + k, text() + "\n" + shared + "\n" + text()) for k in range(4)]
    docs += [(1500, ""), (1501, None), (None, "nothing known"), (1502, "said once more"), (1502, "said once more")]
    at = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(d, t, "en", "s", None if t is None else len(t)) for d, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, shared, docs


def test_stages_on_planted_cases(spark, folder):
    at, shared, _ = folder
    seen, docs = {}, spark.read.parquet(f"{at}/documents.parquet")
    for name, stage in P.STAGES:
        before, docs = docs, cut(stage(spark, docs, at))
        seen[name] = (before, docs)
        if name != "bpe":
            assert docs.columns == before.columns
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    before, after = seen["toxicity"]
    assert ids(before) - ids(after) == set(range(200, 320)) | set(range(1000, 1005))
    before, after = seen["line_dedup"]
    assert ids(before) == ids(after) and before.count() == after.count()
    assert sum(shared in (r.text or "") for r in before.collect()) == 4 and sum(shared in (r.text or "") for r in after.collect()) == 1
    old, new = ({r.doc_id: r.text for r in x.collect()} for x in (before, after))
    assert all(old[d] == new[d] for d in range(200)) and all(new[1100 + k] == "" for k in range(5))
    before, after = seen["simhash_near_dedup"]
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(before).collect()}
    assert ids(after) == {d for d, c in groups.items() if d == c} | {None} and after.where("doc_id = 1502").count() == 1
    before, after = seen["decontamination"]
    gone = ids(before) - ids(after)
    assert gone == set(range(1300, 1306))
    assert seen["bpe"][1].count() == after.count()


def test_near_dedup_of_copies_alone(spark, folder):
    at, _, docs = folder
    own = [(d, t) for d, t in docs if d is not None and (d < 20 or 1100 <= d < 1300 or d == 20_000)]
    left = {r.doc_id for r in P.dedup_documents(spark, spark.createDataFrame(own, "doc_id long, text string"), at).collect()}
    group = {d: d for d, _ in own}
    prints = {d: simhash.fingerprint(t) for d, t in own}
    for _ in own:
        for d in group:
            group[d] = min(group[e] for e in group if (prints[d] ^ prints[e]).bit_count() <= 3)
    assert left == {d for d, g in group.items() if d == g} and left.isdisjoint(range(1100, 1105))


def test_pipeline_of_nothing(spark, folder, tmp_path):
    at, _, _ = folder
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{at}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
    assert decontaminate.THRESHOLD == 0.4 and toxicity.THRESHOLD == 0.7


def test_near_dedup_finds_every_pair_at_four_fifths(spark, folder):
    at, _, _ = folder
    rng = random.Random(5)
    vocab = [f"v{k}" for k in range(4000)]
    common, docs = [rng.choice(vocab) for _ in range(60)], []
    for d in range(60):
        words = [rng.choice(vocab) for _ in range(rng.randrange(60, 200))] + (common if d % 3 == 0 else [])
        docs.append((d, words))
        for c in range(1, 4):  # words inserted, deleted and replaced: about 0.6 to 1
            new = list(words)
            for _ in range(rng.randrange(1, 2 + len(new) // 40)):
                k = rng.randrange(len(new))
                new[k : k + 1] = rng.choice([[], ["x"], ["y", new[k]]])
            docs.append((100 * c + d, new))
    texts = [(d, " ".join(w)) for d, w in docs] + [(1000, "one two"), (1001, "One  two"), (1002, "one three"), (1003, ""), (1004, None), (None, docs[1][1][0])]
    sets = {d: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for d, w in docs}
    group = {d: d for d, _ in docs}
    close = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    for _ in range(6):
        for a, b in close:
            group[a] = group[b] = min(group[a], group[b])
    left = {r.doc_id for r in P.dedup_documents(spark, spark.createDataFrame(texts, "doc_id long, text string"), at).collect()}
    assert left == {d for d, g in group.items() if d == g} | {1000, 1002, 1003, None}
    prints = {d: similar.fingerprint_of(similar.shingle_set(t)) for d, t in texts}
    assert sum(((prints[a] ^ prints[b]) % 2**64).bit_count() > 3 for a, b in close) > 50


def test_heads_and_sketches_meet_as_promised():
    rng = random.Random(9)
    none = np.zeros(0, np.uint64)
    for _ in range(300):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(1, 400))]
        new = [w for w in words if rng.random() > 0.02]
        a, b = (similar.shingle_set(" ".join(w)) for w in (words, new))
        common = np.sort(np.array(rng.sample(a.tolist(), len(a) // rng.choice([2, 3, 50])), np.uint64))
        j = len(np.intersect1d(a, b)) / max(1, len(np.union1d(a, b)))
        if j >= 0.8:
            assert similar.likeness(similar.sketch_of(a), similar.sketch_of(b)) >= similar.MAYBE
            for c in (none, common):
                assert np.intersect1d(similar.head(a, c), similar.head(b, c)).size
    assert len(similar.head(np.arange(100_000, dtype=np.uint64), none)) == 13
    assert similar.shingle_set(None).size == similar.shingle_set(" \n").size == 0 and similar.likeness(b"", b"") == 1


def test_groups_without_a_hub_are_found_by_components(spark, monkeypatch):
    """Texts that all hold one passage, in groups of near copies of their own: links within the groups only."""
    rng = random.Random(4)
    passage, docs = " ".join(f"p{k}" for k in range(60)), []
    for g in range(6):
        own = [f"g{g}x{k}" for k in range(200)]
        for c in range(5):
            words = list(own)
            words[rng.randrange(200)] = f"edit{c}"
            docs.append((g * 10 + c, passage + " " + " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: r.component for r in similar.near_copies(df).collect()}
    assert all((found[a] == found[b]) == (a // 10 == b // 10) for a in found for b in found) and len(found) == 30
    assert similar.near_copies(df.limit(0)).count() == 0


def test_near_dedup_keeps_columns_that_clash(spark, folder):
    at, _, _ = folder
    docs = [(1, "one two three four five six", "a", "b", 3), (2, "one two three four five six", "c", "d", 4)]
    left = P.dedup_documents(spark, spark.createDataFrame(docs, "doc_id long, text string, t string, _t string, component int"), at)
    assert [tuple(r) for r in left.collect()] == [docs[0]]


def test_line_dedup_takes_short_lines(spark, folder):
    at, _, _ = folder
    unspaced = "\u5de5" * 50
    docs = [(1, f"Contents\n\n{unspaced}7\n12\nRead on"), (2, f"Contents\n\n{unspaced}8\n13\nRead  on\nown"), (3, f"x\n{unspaced}7\n12"), (None, "x")]
    out = P.dedup_lines(spark, spark.createDataFrame(docs, "doc_id long, text string"), at)
    assert {r.doc_id: r.text for r in out.collect()} == {1: docs[0][1], 2: f"\n{unspaced}8\n13\nown", 3: "x", None: "x"}


def test_near_dedup_tells_texts_of_one_id_apart(spark, folder):
    at, _, _ = folder
    docs = [(1, "first text of all"), (5, "first text of all"), (5, "another one stands here"), (5, "another one stands here"), (7, "quite different words again"), (7, "nothing in common with it")]
    left = P.dedup_documents(spark, spark.createDataFrame(docs, "doc_id long, text string"), at).collect()
    assert sorted((r.doc_id, r.text) for r in left) == sorted({docs[0], docs[2], docs[4], docs[5]})
