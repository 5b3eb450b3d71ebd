"""Operators against plain loops and small expectations."""

import decimal
import difflib
import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from gleanery.operators import caps, coverage, dedup, gates, reconcile, score, tasks, upsert
from gleanery.plans import curation
from gleanery.plans.registry import ORACLE_SQL, QUERIES


def test_caps_in_memory_in_rounds_and_plain(spark):
    rng = random.Random(3)
    rows = [(i, rng.randrange(12), rng.randrange(40), rng.choice([None, *range(8)])) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, taxon int, obs int, observer int")
    limits = {"t": (["taxon"], 20), "o": (["obs"], 6), "p": (["observer"], 30)}
    want = dict(zip([r[0] for r in sorted(rows, key=lambda r: (r[1], r[0]))], caps.greedy_reference([dict(zip(("k", "taxon", "obs", "observer"), r)) for r in sorted(rows, key=lambda r: (r[1], r[0]))], limits)))
    for in_memory in (10_000, 0):
        got = {r.k: r.reason for r in caps.select(df, ["taxon", "k"], limits, in_memory=in_memory, part_rows=70).collect()}
        assert got == want and len(set(want.values())) == 4


def test_caps_across_groups_with_a_hot_key(spark):
    """A third of all rows have one observer: no window holds more of them than a part, and the result is the plain loop's."""
    rng = random.Random(6)
    rows = [(i, rng.randrange(300), rng.randrange(900), "unknown" if i % 3 == 0 else f"p{rng.randrange(40)}") for i in range(6000)]
    df = spark.createDataFrame(rows, "k int, taxon int, obs int, observer string").repartition(5)
    limits = {"t": (["taxon"], 12), "o": (["obs"], 4), "p": (["observer"], 90)}
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    want = dict(zip([r[0] for r in ordered], caps.greedy_reference([dict(zip(("k", "taxon", "obs", "observer"), r)) for r in ordered], limits)))
    got = {r.k: r.reason for r in caps.select(df, ["taxon", "k"], limits, in_memory=0, part_rows=400).collect()}
    assert got == want and len(set(want.values())) == 4
    assert caps.select(df.limit(0), ["taxon", "k"], limits, in_memory=0).count() == 0


def test_caps_across_groups_settle_in_few_rounds(spark):
    """45,000 rows whose counters run on from row to row are one part: settled at once, not in rounds of small ones."""
    from gleanery import session

    rows = [(k, k // 30, k * 7 % 45_000 // 4, k % 50) for k in range(45_000)]
    df = spark.range(45_000).selectExpr("id as k", "id div 30 as taxon", "id * 7 % 45000 div 4 as obs", "id % 50 as observer")
    limits = {"t": (["taxon"], 10), "o": (["obs"], 2), "p": (["observer"], 100)}
    want = dict(enumerate(caps.greedy_reference([dict(zip(("k", "taxon", "obs", "observer"), r)) for r in rows], limits)))
    before = len(session._written)
    assert {r.k: r.reason for r in caps.select(df, ["taxon", "k"], limits).collect()} == want
    assert len(session._written) - before <= 6


def test_caps_across_groups_write_rows_once(spark, monkeypatch):
    """However many rounds the parts take, rows are written when they are dealt and not again; keys with nulls, and rows that tie, which go to several parts."""
    written = []

    def counted(df, real=caps.cut):
        out = real(df)
        written.append((out, out.count()))
        return out

    monkeypatch.setattr(caps, "cut", counted)
    rows = [(k, k // 30, None if k % 7 == 0 else k * 7 % 6000 // 4, k % 50) for k in range(6000)]
    df = spark.createDataFrame(rows, "k int, taxon int, obs long, observer int").repartition(3)
    limits = {"t": (["taxon"], 10), "o": (["obs"], 2), "p": (["observer"], 30)}
    want = dict(enumerate(caps.greedy_reference([dict(zip(("k", "taxon", "obs", "observer"), r)) for r in rows], limits)))
    assert {r.k: r.reason for r in caps.select(df, ["taxon", "k"], limits, in_memory=0, part_rows=1000).collect()} == want
    assert len(written) > 4 and sum(n for _, n in written) < 2 * len(rows)
    written.clear()
    tied = df.selectExpr("0 as taxon", "k div 2 as obs", "k % 50 as observer").unionByName(df.selectExpr("0 as taxon", "7 as obs", "7 as observer"))
    limits = {"o": (["obs"], 1), "p": (["observer"], 30)}
    alone, parts = ([tuple(r) for r in caps.select(tied, ["taxon"], limits, in_memory=m, part_rows=1000).collect()] for m in (100_000, 0))
    assert sorted(map(repr, parts)) == sorted(map(repr, alone)) and len({r[-1] for r in alone}) == 3
    dealt = next(w for w, _ in reversed(written) if "_at" in w.columns)
    assert max(n for _, n in dealt.groupBy(F.shiftright("_at", 33)).count().collect()) < 3000


def test_caps_within_groups_shuffle_rows_once(spark):
    """No join brings the reasons back, and values, nulls, structs and copies come through as they are."""
    rows = [(t, (k, 2 - k % 2), k // 2, None if k % 3 else 2**60 + 1, 1.5, None) for t in (1, 2) for k in range(9)] * 2
    df = spark.createDataFrame(rows, "taxon int, order_key struct<a:int,b:int>, observation int, observer long, location double, season string")
    found = caps.per_taxon(df, {"cap_taxon": 7, "cap_observer": 3})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    ordered = sorted(rows, key=lambda r: (r[0], r[1]))
    named = [dict(zip(("taxon", "order_key", "observation", "observer", "location", "season"), r)) for r in ordered]
    limits = {"cap_taxon": (["taxon"], 7), **{f"cap_{k}": (["taxon", k], n) for k, n in (("observation", 2), ("observer", 3), ("location", 10), ("season", 15))}}
    want = sorted(repr((*r, w)) for r, w in zip(ordered, caps.greedy_reference(named, limits)))
    assert sorted(repr((r[0], tuple(r[1]), *r[2:])) for r in found.collect()) == want


def test_release_selection_filters_before_caps(spark):
    rows = [("a", "s1", "CC-BY-4.0", "o1", None, "p", None), ("a", "s2", "CC-BY-SA-4.0", "o1", None, "p", None), ("a", "s3", "CC-BY-SA-4.0", "o1", None, "p", True), ("", "s4", "CC0-1.0", None, None, None, None), ("b", "s5", "nope", None, None, None, None), ("b", "s6", "CC0-1.0", None, "r", None, None), ("b", "s7", "CC0-1.0", None, "r", None, None), ("c", "s8", "CC0-1.0", None, None, None, None)]
    df = spark.createDataFrame(rows, "taxon string, sha256 string, license string, observation_id string, source_record string, observer string, license_review_ok boolean")
    got = {r.sha256: r.reason for r in caps.select_release(df, "research", max_observation=1, max_observer=2).collect()}
    assert got == {"s1": None, "s2": "license_review_required", "s3": "cap_observation", "s4": "missing_key", "s5": "license_rejected", "s6": None, "s7": "cap_observation", "s8": None}


def test_clusters(spark):
    rows = [("a", "S1", 0, 0, 10, 10), ("b", "s1", None, None, 20, 20), ("c", None, 3, 1, 5, 5), ("d", None, 3, 1 + 2 + 4 + 8, 5, 5), ("e", None, -1, -1, 1, 1), ("f", "s9", -1, -2, None, None), ("g", None, 0x0FFF, 0x0FFF000, 9, 9)]
    df = spark.createDataFrame(rows, "key string, sha256 string, ahash bigint, dhash bigint, width int, height int")
    got = {r.key: (r.cluster, r.canonical, r.method, r.score) for r in dedup.clusters(df, 6).collect()}
    assert got == {"a": ("a", "b", "sha256", 1.0), "b": ("a", "b", "sha256", 1.0), "c": ("a", "b", "sha256", 1.0), "d": ("a", "b", "sha256", 1.0), "e": ("e", "e", "perceptual", 1 - 1 / 64), "f": ("e", "e", "perceptual", 1 - 1 / 64)}
    groups = dedup.group_rows(dedup.clusters(df, 6)).orderBy("cluster").collect()
    assert [g.group_key for g in groups] == ["g000000-sha256-b", "g000001-perceptual-e"]


def test_near_pairs_find_all(spark):
    rng = random.Random(8)
    base = [rng.getrandbits(64) for _ in range(60)]
    values = base + [b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(1, 9))) & (2**64 - 1) for b in base]
    signed = [v - 2**64 if v >= 2**63 else v for v in (x & (2**64 - 1) for x in values)]
    df = spark.createDataFrame([(v,) for v in signed], "h bigint").distinct()
    got = {(r.a.h, r.b.h) for r in dedup.near_pairs(df, ["h"], 6).collect()}
    u = sorted(set(signed))
    want = {(a, b) for i, a in enumerate(u) for b in u[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 6}
    assert got == want and want


def test_near_pairs_of_long_cells_without_broadcast(spark):
    """Cells of more rows than are compared together, and of more than a batch; the cells are never sent through the driver."""
    rng = random.Random(9)
    signed = lambda v: v - 2**64 if v >= 2**63 else v
    few = lambda n: sum(1 << rng.randrange(64) for _ in range(n)) & (2**64 - 1)
    rows = sorted({(signed(few(rng.randrange(9))), signed(few(rng.randrange(7)))) for _ in range(500)})
    df = spark.createDataFrame([*rows, *rows[:20], (None, 1)], "x bigint, y bigint")
    found = dedup.near_pairs(df, ["x", "y"], 6)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    far = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
    want = {(a, b, max(far(a[0], b[0]), far(a[1], b[1]))) for i, a in enumerate(rows) for b in rows[i + 1 :]}
    want = sorted(t for t in want if t[2] <= 6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        assert sorted((tuple(r.a), tuple(r.b), r.dist) for r in found.collect()) == want and len(want) > 1000
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_near_pairs_carry_names_and_nothing_is_broadcast(spark, monkeypatch):
    """Pairs come with their documents' ids, without a join with the hashes; where links are joined, no side goes through the driver."""
    rng = random.Random(12)
    rows = [(2**53 + 1 + 2 * k, sum(1 << rng.randrange(64) for _ in range(3)) - 2**63, 1 << rng.randrange(60)) for k in range(150)]
    rows += [(k + 1, a ^ 1, d) for k, a, d in rows[:40]] + [(k + 1001, a, d) for k, a, d in rows[:40]]
    df = spark.createDataFrame(rows, "doc_id long, ahash long, dhash long")
    monkeypatch.setattr(curation, "prints", lambda spark, d: df)
    found = curation.hamming_pairs(spark, "")
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    least = {}
    for k, *h in sorted(rows):
        least.setdefault(tuple(h), k)
    far = lambda x, y: max(((p ^ q) & (2**64 - 1)).bit_count() for p, q in zip(x, y))
    want = sorted((min(k, m), max(k, m), far(x, y)) for (x, k), (y, m) in itertools.combinations(least.items(), 2) if far(x, y) <= 6)
    assert sorted(tuple(r) for r in found.collect()) == want and len(want) >= 40
    plans = []
    monkeypatch.setattr(dedup, "cut", lambda df, real=dedup.cut: plans.append((df.columns, df._jdf.queryExecution().executedPlan().toString())) or real(df))
    dedup.duplicate_links(df.selectExpr("doc_id as key", "cast(doc_id as string) as sha256", "ahash", "dhash"))
    (near,) = [plan for columns, plan in plans if columns == ["u", "v", "dist"]]
    assert "Broadcast" not in near


def test_near_dup_filter_matches_a_loop(spark):
    rng = random.Random(4)
    rows = [(k, rng.randrange(60), f"p{rng.randrange(70)}", rng.choice([1.0, 1.01, 2.0]), rng.choice([0, 1, 3, 255]), rng.choice([0, 2, 7, 4095])) for k in range(90)]
    df = spark.createDataFrame(rows, "key int, observation int, pixels string, aspect double, ahash bigint, dhash bigint").withColumn("r", F.col("key") * 37 % 90)
    got = {r.key: r.reason for r in dedup.near_dup_filter(df, compat_order="r").collect()}
    kept, want = [], {}
    for x in sorted(rows, key=lambda r: r[0] * 37 % 90):
        why = "duplicate_observation" if any(x[1] == y[1] for y in kept) else "duplicate_pixels" if any(x[2] == y[2] for y in kept) else "possible_near_duplicate" if any(abs(x[3] - y[3]) < 0.02 and (x[4] ^ y[4]).bit_count() <= 3 and (x[5] ^ y[5]).bit_count() <= 3 for y in kept) else None
        want[x[0]] = why
        if not why:
            kept.append(x)
    assert got == want and len(set(want.values())) == 4


def test_cells_are_shuffled_once(spark):
    """28 cells a hash tuple at 6 bits go through one exchange; they aren't joined with themselves."""
    df = spark.createDataFrame([(0, 0), (1, 1)], "ahash bigint, dhash bigint")
    plan = dedup.near_pairs(df, ["ahash", "dhash"], 6)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan  # that of the distinct tuples and that of the cells


@pytest.mark.parametrize("held", [1 << 20, 500])
def test_near_links_are_fewer_than_pairs_and_connect_the_same(spark, held, monkeypatch):
    """Alike hashes cost links by their number, not its square; components and their least distances are those of all pairs."""
    monkeypatch.setattr(dedup, "HELD_LINKS", held)
    rng = random.Random(11)
    few = lambda n: sum(1 << b for b in rng.sample(range(62), n))
    base = [(rng.getrandbits(63), rng.getrandbits(63)) for _ in range(40)]
    rows = {(few(rng.randrange(3)), few(rng.randrange(4))) for _ in range(300)} | {(x ^ few(rng.randrange(1, 6)), -1 - (y ^ few(rng.randrange(1, 6)))) for x, y in base for _ in range(2)}
    df = spark.createDataFrame(sorted(rows), "x bigint, y bigint").repartition(3)

    def told(found):
        group = {r: r for r in rows}

        def top(r):
            while group[r] != r:
                r = group[r]
            return r

        for a, b, _ in found:
            a, b = sorted((top(a), top(b)))
            group[b] = a
        least = {}
        for a, _, dist in found:
            least[top(a)] = min(dist, least.get(top(a), 64))
        return {r: (top(r), least.get(top(r))) for r in rows}

    plain = lambda df: [(tuple(r.a), tuple(r.b), r.dist) for r in df.collect()]
    pairs, links = plain(dedup.near_pairs(df, ["x", "y"], 6)), plain(dedup.near_links(df, ["x", "y"], 6))
    assert told(links) == told(pairs) and len(set(told(pairs).values())) > 20
    assert len(pairs) > 30 * len(rows) and len(links) <= 28 * len(rows)
    if held > 500:
        assert len(links) <= 4 * len(rows)  # four tasks at most, each with a link for a tuple
    assert dedup.near_links(df.limit(0), ["x", "y"], 6).count() == 0


def odd_documents(spark, folder):
    """Texts with near copies, a crowd of them, nulls, blanks, and ids that several rows have."""
    rng = random.Random(12)
    word = lambda: f"w{rng.randrange(400)}"
    texts = [" ".join(word() for _ in range(rng.randrange(1, 300))) for _ in range(30)]
    texts += [t + "\n" + "\tW1" * k for t in texts[:6] for k in (1, 2)] + ["ab " * 500 + " ".join(word() for _ in range(k % 4)) for k in range(60)]
    rows = [(k, t) for k, t in enumerate(texts + texts[3:9] + [None, "", " \n", "x", "É é"])]
    rows += [(2, texts[2]), (31, "other words here"), (31, None), (500, None), (500, texts[7]), (501, ""), (501, None)]
    spark.createDataFrame([(k, t, "s", 0 if t is None else len(t)) for k, t in rows], "doc_id bigint, text string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_histograms_are_counted_where_texts_lie(spark, tmp_path):
    """No word and no histogram is shuffled; rows of one id share the histogram of all their words."""
    at = odd_documents(spark, tmp_path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{at}/documents.parquet/*.parquet')")
    want = {k: (int(a, 2), int(d, 2)) for k, a, d in con.sql(curation.PRINTS.rstrip(", ") + " SELECT doc_id, CAST(ahash AS VARCHAR), CAST(dhash AS VARCHAR) FROM q").fetchall()}
    found = curation.prints(spark, at)
    assert {r.doc_id: (r.ahash % 2**64, r.dhash % 2**64) for r in found.collect()} == want
    assert found.count() == len(want) + 4  # two rows of 2, three of 31, two of 500
    for name in ("dedup_report", "duplicate_groups"):
        df = QUERIES[name](spark, at)
        cols = sorted(df.columns)
        rows = lambda found: sorted(repr(tuple(float(v) if isinstance(v, (float, decimal.Decimal)) else v for v in r)) for r in found)
        assert rows(df.select(*cols).collect()) == rows(con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE_SQL[name]})").fetchall()), name
    single = curation.prints(spark, "/root/testdata/sf0.001")
    assert "Exchange" not in single._jdf.queryExecution().executedPlan().toString() and single.count() > 0


def test_looks_meet_without_broadcast(spark):
    looks = spark.createDataFrame([(0, 0, 0, 1.0), (1, 1, 0, 1.01), (2, 1, 0, 1.04), (3, -1, 0, 1.0), (4, 0, 0, 1.019)], "t long, dhash long, ahash long, aspect double")
    links = dedup._look_links(looks, 0.02, 3)
    assert "Broadcast" not in links._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in links.collect()} == {(0, 1), (1, 0), (0, 4), (4, 0), (1, 4), (4, 1)}


def plain_filter(rows):
    """(key, observation, pixels, aspect, ahash, dhash) in order -> reason by key."""
    far = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
    kept, out = [], {}
    for x in rows:
        looks = None not in x[3:]
        same = lambda k, x=x: any(x[k] == y[k] for y in kept) if x[k] not in (None, "") else False
        near = looks and any(None not in y[3:] and abs(x[3] - y[3]) < 0.02 and far(x[4], y[4]) <= 3 and far(x[5], y[5]) <= 3 for y in kept)
        out[x[0]] = "duplicate_observation" if same(1) else "duplicate_pixels" if same(2) else "possible_near_duplicate" if near else None
        if not out[x[0]]:
            kept.append(x)
    return out


@pytest.mark.parametrize("how", [{}, {"least": 3, "few": 0}])
def test_near_dup_filter_of_one_large_component(spark, how):
    """Rows that hang together, with a hot observation, hot pixels, a hot look, nulls and signed hashes."""
    rng = random.Random(5)
    rows = []
    for k in range(2500):
        hot = k % 3 == 0
        a, d = (0, 0) if hot and k % 2 else (rng.choice([1, 3, 7, 15, -1, -2, 1 << 40]), rng.choice([0, 5, 2**63 - 1, -(2**63)]) ^ (1 << rng.randrange(62)))
        rows.append((k, "hot" if hot and k % 4 else rng.choice([None, "", f"o{rng.randrange(900)}"]), "px" if k % 50 == 7 else rng.choice([None, f"p{rng.randrange(1500)}"]), rng.choice([1.0, 1.019, 1.02, 1.04, -0.5, None]), rng.choice([a, a, a, None]), d))
    df = spark.createDataFrame(rows, "key int, observation string, pixels string, aspect double, ahash bigint, dhash bigint").withColumn("r", F.col("key") * 1237 % 2500)
    got = {r.key: r.reason for r in dedup.near_dup_filter(df.repartition(5), compat_order="r", **how).collect()}
    want = plain_filter(sorted(rows, key=lambda r: r[0] * 1237 % 2500))
    assert got == want and len(set(want.values())) == 4
    assert dedup.near_dup_filter(df.limit(0)).count() == 0


def test_split_treats_unknown_observations_as_one(spark):
    rows = [("a", "s1", None, "10", 200), ("a", "s2", None, "9", 200), ("a", "s3", 5, "91", 200), ("a", "s4", 5, "92", 100), ("b", "t1", 7, "1", 10)]
    df = spark.createDataFrame(rows, "taxon string, sha256 string, observation_id bigint, source_media_id string, width int")
    got = {r.sha256: r.split for r in tasks.gallery_query_split(df).collect()}
    assert got == {"s1": "gallery", "s3": "query", "s4": "query", "t1": "gallery"}  # "10" < "9"; s2 shares the unknown observation
    assert tasks.split_leaks(tasks.gallery_query_split(df)).count() == 0


def test_round_robin_and_shortlists(spark):
    df = spark.createDataFrame([(f"t{k}", "ab"[k % 5 == 0]) for k in range(20)], "task_id string, correct_taxon string")
    first = tasks.round_robin(df, 6).collect()
    assert sorted(r.correct_taxon for r in first[:2]) == ["a", "b"] and [r.turn for r in first] == [0, 0, 1, 1, 2, 2]
    assert {r.task_id for r in tasks.round_robin(df, 6, seed=7).collect()} != {r.task_id for r in first}
    with pytest.raises(ValueError):
        tasks.round_robin(df, 0)
    taxa = spark.createDataFrame([(f"G{k % 7} s{k}", f"G{k % 7}", f"F{k % 3}") for k in range(60)], "name string, genus string, family string")
    rows = taxa.limit(5).selectExpr("name as row_id", "name as correct", "genus", "family")
    fam = {r.name: r.family for r in taxa.collect()}
    for r in tasks.shortlist(rows, taxa, "mixed").collect():
        assert len(r.candidates) == len(set(r.candidates)) == 20 and r.correct in r.candidates and sum(fam[c] == fam[r.correct] for c in r.candidates) == 10
    for r in tasks.shortlist(rows, taxa, "hard", size=12).collect():
        same = [c for c in r.candidates if c.split()[0] == r.correct.split()[0]]
        assert r.candidates == sorted(r.candidates) and len(r.candidates) == 12 and len(same) == r.n_congener + 1 == sum(c.split()[0] == r.correct.split()[0] for c in fam)


def test_score_uses_all_tasks(spark):
    t = spark.createDataFrame([(k, "G a", ["G syn"], "F") for k in range(4)], "task_id int, correct_taxon string, synonyms_accepted array<string>, family string")
    p = spark.createDataFrame([(0, [("g  SYN", True, "x")], None, "stop", None), (1, [("", None, "")], None, "stop", None), (2, [("G a", True, "x")], "boom", None, None)], "task_id int, predictions array<struct<taxon:string,matched:boolean,raw:string>>, error string, finish_reason string, refusal string")
    row = score.summary(score.joined(t, p)).first()
    assert (row.tasks, row.scored, row.missing, row.errors, row.top1, row.execution_valid, row.answer_rate, row.top1_answered_only, row.complete) == (4, 3, 1, 2, 0.25, False, 0.25, 1.0, False)
    empty = score.summary(score.joined(t.limit(0), p.limit(0))).first()
    assert (empty.tasks, empty.top1, empty.execution_valid, empty.macro_species_top1) == (0, 0.0, False, 0.0)


def test_baselines(spark):
    t = spark.createDataFrame([("A x", ["A x", "A y", "B z", "C w"]), ("B z", ["A x", "A y", "B z", "C w"])], "correct_taxon string, candidates array<string>")
    row = score.baselines(t).first()
    assert row.uniform_candidate == 0.25 and row.largest_genus_candidate_only == 0.25


def test_baselines_look_at_equal_candidates_once(spark):
    tasks_of = lambda n: spark.range(n).selectExpr("'B z' as correct_taxon", "array('A x', 'A y', 'B z', 'B w', null) as candidates")
    t = tasks_of(3).unionByName(spark.createDataFrame([("A x", ["A x", "A y", "B z", "C w"]), (None, ["A x"]), ("A x", None)], "correct_taxon string, candidates array<string>"))
    row = score.baselines(t).first()
    assert abs(row.uniform_candidate - (3 / 5 + 1 / 4 + 1) / 5) < 1e-12 and abs(row.largest_genus_candidate_only - (3 / 4 + 1 / 2) / 6) < 1e-12
    plan = score.baselines(t)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 2 and "Aggregate [candidates" in plan


def test_reconcile_tiers(spark):
    records = spark.createDataFrame([("Araneus diadematus", "Clerck, 1757", None, "1"), ("Old name", "X", "Araneus diadematus", "2"), ("Same name", "A, 1", None, "3"), ("Same name", "B, 2", None, "4"), ("Lone species", None, None, "5")], "scientific_name string, authorship string, accepted_name string, wsc_id string")
    asked = spark.createDataFrame([("old  NAME", None), ("Same name", "B , 2"), ("Same name", None), ("Lone specis", None), ("Zzz", None), ("Lone species", None), ("Kept", None)], "original_name string, authorship string")
    reviewed = spark.createDataFrame([("Kept", "Chosen")], "original_name string, accepted_name string")
    got = {(r.original_name, r.authorship): (r.match_type, r.accepted_name, r.n_candidates) for r in reconcile.reconcile(asked, records, reviewed).collect()}
    assert got == {("old  NAME", None): ("synonym", "Araneus diadematus", 1), ("Same name", "B , 2"): ("exact", "Same name", 1), ("Same name", None): ("conflict", None, 2), ("Lone specis", None): ("fuzzy", None, 1), ("Zzz", None): ("unresolved", None, 0), ("Lone species", None): ("exact", "Lone species", 1), ("Kept", None): ("kept_reviewed", "Chosen", 0)}


def test_fuzzy_equals_the_standard_library(spark):
    rng = random.Random(1)
    known = sorted({"".join(rng.choice("abcd ") for _ in range(rng.randrange(5, 14))).strip() + "x" for _ in range(300)} | {"a", "ab", "abc", "abcd", "é", "long " * 30, "long " * 11 + "x", "b" * 700})
    asked = sorted({k[: rng.randrange(1, len(k) + 1)] + rng.choice("abz") + k[3:] for k in known[:120]} | {"", "a", "abc", "abd", "abcde", "é", "long " * 29, "long " * 12, "b" * 600})
    index = spark.createDataFrame([(k, k) for k in [*known, *known[:9]]], "norm string, rec string")
    got = {r.name: (r.close, r.n_close) for r in reconcile.fuzzy(spark.createDataFrame([(a,) for a in [*asked, *asked[:5]]], "normalized_name string"), index).collect()}
    close = {a: c for a in asked if (c := difflib.get_close_matches(a, known, n=5, cutoff=0.85))}
    want = {a: (c, min(5, sum(1 + (x in known[:9]) for x in c))) for a, c in close.items()}
    assert got == want and len(want) > 30
    assert reconcile.fuzzy(spark.createDataFrame([], "normalized_name string"), index).count() == 0


@pytest.mark.parametrize("cutoff", [0.6, 0.85, 0.95])
def test_signatures_lose_no_pair(cutoff):
    rng = random.Random(7)
    for _ in range(3000):
        n = rng.choice([1, 2, 3, 4, 5, 8, 15, 30, 44, 45, 58, 62, 80])
        x = "".join(rng.choice("aeisrt qz") for _ in range(n))
        y = list(x)
        for _ in range(rng.randrange(0, 2 + n // 4)):
            k = rng.randrange(len(y) + 1)
            y[k : k + 1] = rng.choice([[], [rng.choice("aeisrt qzü")], [rng.choice("aei"), "s"]])
        y = "".join(y)
        if y and difflib.SequenceMatcher(None, y, x).ratio() >= cutoff:
            assert set(reconcile.signatures(x, cutoff)) & set(reconcile.signatures(y, cutoff)), (x, y)


def test_few_names_are_compared(spark):
    """5,000 two-word names against each other: what the signatures leave is a small share of all pairs."""
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice(["ar", "an", "eus", "dia", "lyc", "osa", "the", "rid", "ion", "mi", "cro", "pho", "lcus", "te", "gen", "aria"]) for _ in range(n))
    names = sorted({f"{word(3)} {word(rng.choice([3, 4, 5]))}" for _ in range(5000)})
    asked = names[::50]
    left = spark.createDataFrame([(n,) for n in asked], "name string")
    right = spark.createDataFrame([(n,) for n in names], "cand string")
    made = reconcile.fuzzy_candidates(left, right).count()
    assert len(asked) <= made < 0.01 * len(asked) * len(names)
    got = {r.name: r.close for r in reconcile.fuzzy(left.withColumnRenamed("name", "normalized_name"), right.selectExpr("cand as norm")).collect()}
    assert got == {a: difflib.get_close_matches(a, names, n=5, cutoff=0.85) for a in asked}


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "k int, v string, w string")
    new = spark.createDataFrame([(2, "c", None), (3, "d", "y")], "k int, v string, w string")
    assert {tuple(r) for r in upsert.coalesce_merge(old, new, ["k"], ["w"]).collect()} == {(1, "a", None), (2, "b", "x"), (3, "d", "y")}
    assert {tuple(r) for r in upsert.last_wins(old, new, ["k"], "v").collect()} == {(1, "a", None), (2, "c", None), (3, "d", "y")}
    first = upsert.first_wins(old, new, ["k"], "v")
    assert {(r.k, r.v, r.inserted) for r in first.collect()} == {(1, "a", 0), (2, "b", 0), (3, "d", 1)}
    again = upsert.first_wins(first.drop("inserted"), new, ["k"], "v")
    assert again.where("inserted = 1").count() == 0


def test_gates(spark):
    src = spark.createDataFrame([("e1", "T", "book", "https://doi.org/10.1234/x", None, None, None), ("e2", "T", "book", None, None, None, None), ("e3", "", "blog", "11.1/x", "12a", "9-7-8", "ftp://x"), ("e1", "T", "book", None, "5", None, None)], "id string, title string, source_type string, doi string, pmid string, isbn string, url string")
    got = sorted((r.entity, r.message) for r in gates.evidence_sources(src).collect())
    assert got == [("e1", "occurs 2 times"), ("e2", "no locator"), ("e3", "lacks title"), ("e3", "malformed DOI"), ("e3", "malformed PMID"), ("e3", "malformed url"), ("e3", "unknown source_type")]
    a = spark.createDataFrame([("t1", None, "PL", "r", ["e1"], "w", "2020-02-30", "draft"), ("t2", "uncertain", "", "r", ["e9", " "], "w", "2020-01-01", "odd")], "taxon string, category string, geographic_scope string, rationale string, evidence_ids array<string>, reviewer string, review_date string, status string")
    got = sorted((r.gate, r.entity) for r in gates.assessments(a, src, a.where("taxon = 't1'")).collect())
    assert got == [("assessment", "t2"), ("category", "t1"), ("evidence_ids", "t2"), ("evidence_ids", "t2"), ("review_date", "t1"), ("status", "t2"), ("taxon", "t2")]
    rows = spark.createDataFrame([("a", "medically_significant", ""), ("b", "none_known", ""), ("c", "uncertain", "disputed"), ("d", "none_known", "")], "taxon string, category string, exposure_context string")
    ev = spark.createDataFrame([("a", "approve"), ("b", "approve"), ("c", "approve"), ("c", "approve"), ("c", "reject")], "entity_id string, decision string")
    assert {r.taxon: r.adjudicated for r in gates.adjudicate(rows, ev).collect()} == {"a": "in_review", "b": "approved", "c": "rejected", "d": "draft"}
    suite = spark.createDataFrame([("x", "i", "p", "o", "A", ["A", "B"]), ("x", "j", "q", "o", "Z", ["A", "A"])], "task_id string, image_sha256 string, pixel_sha256 string, observation_id string, correct_taxon string, candidates array<string>")
    assert sorted(r.gate for r in gates.suite(suite).collect()) == ["candidates", "candidates", "unique_observation_id", "unique_task_id"]
    assert spark.range(1).select(gates.display_ordinal(F.lit("uncertain")), gates.display_ordinal(F.lit("x"))).first()[:] == (3, None)


def test_photo_picker(spark):
    photo = "struct<id:bigint,license_code:string,url:string,original_url:string,large_url:string>"
    rows = [
        ("T a", 0, 1, None, ("T a", "species"), ("u", "n"), [(1, "CC-BY-ND", "x", None, None), (2, "CC-BY", "http://inaturalist/square.jpg", None, None)]),
        ("T a", 1, 2, "research", ("T a", "species"), ("u", "n"), [(3, "CC0", "y", None, None)]),
        ("T a", 2, 3, "research", ("T b", "species"), ("u", "n"), [(4, "CC0", "z", None, None)]),
        ("T a", 3, 4, "research", ("T a", "genus"), ("u", "n"), [(5, "CC0", "z", None, None)]),
    ]
    df = spark.createDataFrame(rows, f"asked string, place int, id bigint, quality_grade string, taxon struct<name:string,rank:string>, user struct<login:string,name:string>, photos array<{photo}>")
    got = [(r.id, r["rank"], r.url, r.research) for r in coverage.pick_photos(df, ["cc0", "cc-by"]).orderBy("rank").collect()]
    assert got == [(2, 1, "y", True), (1, 2, "http://inaturalist/large.jpg", False)]
    seen = spark.createDataFrame([(2,)], "id bigint")
    assert [(r.id, r["rank"]) for r in coverage.pick_photos(df, ["cc0", "cc-by"], n=1, seen=seen).collect()] == [(1, 1)]


def test_photo_rows_are_not_gathered(spark):
    """The picker's query collects no observation's photos, and rows of other licenses go before a shuffle."""
    from gleanery.plans.registry import QUERIES

    plan = QUERIES["photo_picker"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "posexplode" not in plan
    photo = "struct<id:bigint,license_code:string,url:string,original_url:string,large_url:string>"
    rows = [("T", 0, 1, None, "u", 2, (8, "CC0", "x", None, None)), ("T", 0, 1, None, "u", 1, (9, "nope", "x", None, None)), ("T", 1, 2, "research", "u", 1, (7, "CC0", "x", None, None)), ("T", 1, 2, "research", "u", 1, (6, "CC0", "x", None, None))]
    df = spark.createDataFrame(rows, f"asked string, place int, id bigint, quality_grade string, observer string, pos int, p {photo}")
    assert [(r.id, r["rank"], r.photo_id) for r in coverage.pick_photo_rows(df, ["cc0"]).orderBy("rank").collect()] == [(2, 1, 6), (1, 2, 8)]
