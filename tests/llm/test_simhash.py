import random

import numpy as np
import xxhash

from gleanery.llm import simhash as S


def slow_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_matches_the_definition():
    for t in ["", "  \n\t", "one", "Zwei Wörter", "a b c", "a b a b a b a b", "ÄÖ A\x0bB\x0cC d e f g", "x " * 500]:
        assert S.fingerprint(t) == slow_fingerprint(t)
    assert S.fingerprint(None) == 0


def brute_components(pairs):
    ids = [d for d, _ in pairs]
    comp = dict(zip(ids, ids))
    changed = True
    while changed:
        changed = False
        for a, x in pairs:
            for b, y in pairs:
                if bin(x ^ y).count("1") <= 3 and comp[a] != comp[b]:
                    comp[a] = comp[b] = min(comp[a], comp[b])
                    changed = True
    return comp


def test_leaf_search_finds_every_component():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    values = np.unique(np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) for _ in range(6)]))
    got = S.link_forest(values, block=500)
    want = brute_components([(i, int(v)) for i, v in enumerate(values)])
    comp = list(range(len(values)))
    for _ in range(20):
        for i, j in got:
            comp[i] = comp[j] = min(comp[i], comp[j])
    assert comp == [want[i] for i in range(len(values))] and len(got) == len(values) - len(set(want.values()))


def test_every_near_pair_meets_in_a_leaf():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    flips = [np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64) for _ in range(3)]
    b = a ^ flips[0] ^ flips[1] ^ flips[2]
    values = np.concatenate([a, b])
    met = np.zeros(2000, bool)
    for shift in (0, 32):
        halves = (values >> np.uint64(shift)).astype(np.uint32)
        tree, n = S.build_tree(halves[::3], 40)
        assert n > 8
        at, leaf, home = S.route(tree, halves, 1)
        assert sorted(at[home]) == list(range(4000))
        where = [set() for _ in range(4000)]
        for i, x in zip(at, leaf):
            where[i].add(x)
        met |= np.array([bool(where[i] & where[i + 2000]) for i in range(2000)])
    assert met.all()


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(60):
        words = [rng.choice(vocab) for _ in range(150)]
        for _ in range(rng.choice([1, 1, 2, 4])):
            w = list(words)
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(150)] = rng.choice(vocab)
            rows.append((len(rows) + 5, " ".join(w)))
    rows += [(900, ""), (901, None), (902, " \n"), (903, "solo"), (904, "Solo")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", __import__("pyspark").sql.functions.lit("clash"))
    got = {r.doc_id: r.component_id for r in S.near_duplicates(df).collect()}
    assert got == brute_components([(d, S.fingerprint(t)) for d, t in rows])
    assert S.near_duplicates(df.limit(0)).count() == 0
    again = S.near_duplicates(df.where("doc_id = 903").unionByName(df.where("doc_id = 903")))
    assert [r.component_id for r in again.collect()] == [903, 903]


def test_large_shards_are_split_without_losing_a_pair():
    rng = np.random.default_rng(7)
    flip = lambda v: v ^ (np.uint64(1) << rng.integers(0, 64, len(v)).astype(np.uint64))
    wide = rng.integers(0, 2**64, 6000, dtype=np.uint64)
    same_half = (rng.integers(0, 2**32, 3000, dtype=np.uint64) << np.uint64(32)) | np.uint64(77)
    dense = np.full(2000, 12345678901234567, np.uint64)
    for _ in range(7):
        dense = flip(dense)
    for values in (wide, same_half, dense, np.zeros(1, np.uint64), np.zeros(0, np.uint64)):
        v = np.unique(np.concatenate([values, flip(flip(values[:600])), flip(flip(flip(values[600:900])))]))
        sizes = []
        got = np.concatenate([S.shard_links(v, shift, leaf=64, sizes=sizes) for shift in (0, 32)])
        comp = [list(range(len(v))) for _ in range(2)]
        for c, pairs in zip(comp, (got, S.link_forest(v))):
            while any(c[i] != c[j] for i, j in pairs):
                for i, j in pairs:
                    c[i] = c[j] = min(c[i], c[j])
        assert comp[0] == comp[1]
        assert all(bin(int(v[i] ^ v[j])).count("1") <= 3 for i, j in got)
        if values is wide:
            assert max(sizes) <= 4 * 64
