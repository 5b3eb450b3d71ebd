import random

from gleanery.operators.components import connected_components


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components_match_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)] + [(7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == brute([(u, v) for u, v in edges if u != v])


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_hot_keys_meet_their_row_by_broadcast(spark):
    from gleanery.operators.skew import join_spread

    rows = [(k % 7 if k < 60 else 9, k) for k in range(200)] + [(50, 1)]
    df = spark.createDataFrame(rows, "u long, v long")
    counts = {u: sum(x == u for x, _ in rows) for u, _ in rows if u != 50} | {77: 1}
    one = spark.createDataFrame([(u, u * 10, n) for u, n in counts.items()], "u long, m long, n long")
    want = sorted((u, v, u * 10) for u, v in rows if u != 50)
    for few, least in ((0, 20), (0, 1000), (10**6, 1)):
        got = join_spread(df, one, "u", "n", len(rows), least=least, few=few, hot_keys=50)
        assert sorted(tuple(r) for r in got.select("u", "v", "m").collect()) == want
