"""The filter audit against a plain loop over documents and orders."""

import re
from collections import Counter, defaultdict
from itertools import permutations

from pyspark.sql import functions as F
from test_native import no_python

from gleanery.llm import filteraudit

CLEAN = " ".join(f"word{k}" for k in range(60))
TEXTS = [
    None, "", " \n\t ", "short", CLEAN, CLEAN, CLEAN, CLEAN + " $", CLEAN.upper(), "a b " * 40, "A B $ " * 40, "A B $ " * 40, "é É " * 60, "x\x85y " * 55, "# " + CLEAN, CLEAN.title(), "AB", "AB", "$" * 200_000,
    " ".join(f"w{k}" for k in range(49)), " ".join(f"w{k}" for k in range(50)), " ".join(f"w{k % 65}" for k in range(100)), " ".join(f"w{k % 64}" for k in range(100)), "x" * 95 + "ABCDE", "x" * 94 + "ABCDEF",
]


def plain(docs, labels):
    def fails(i, text, first):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        found = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text))}
        return {f for f, yes in found.items() if yes} | ({"E"} if i is not None and i in first and first[i] else set())

    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1))
    rows = defaultdict(list)
    for i, text, source in docs:
        own = fails(i, text or "", {i: i is not None and least[text or ""] < i})
        rows[source or ""].append((own, i in good, i in toxic))
    out = []
    for part, all_ in rows.items():
        shapley, each = Counter(), []
        for order in map("".join, permutations("ABCDE")):
            left = all_
            for k, f in enumerate(order):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                failing = sum(f in r[0] for r in all_)
                shapley[f] += len(gone)
                each.append((part, order, k + 1, len(left), len(gone), failing - len(gone), sum(r[0] == {f} for r in all_), sum(r[1] for r in gone), sum(r[2] for r in gone), f))
        out += [(*r[:-1], shapley[r[-1]]) for r in each]
    return sorted(out)


def found(df):
    no_python(df)
    return sorted(map(tuple, df.collect()))


def test_audit_matches_a_plain_loop(spark, monkeypatch):
    docs = [(k, t, ["a", "b", None, ""][k % 4]) for k, t in enumerate(TEXTS)]
    docs += [(None, CLEAN, "a"), (None, None, "c"), (3, "short", "a"), (3, "other", "b"), (5, CLEAN, "a"), (5, CLEAN, "a")]
    docs += [(100 + k, CLEAN, "hot") for k in range(300)]
    labels = [(k, (1, 0, None)[k % 3], (0, 1)[k % 2]) for k in range(20)] + [(7, 1, 1), (7, 0, 0), (None, 1, 1), (150, 1, 1), (9999, 1, 1), (5, 1, None)]
    a = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns({c: F.lit("x") for c in ("mask", "key", "n", "part", "label", "first")})
    b = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("n", F.lit(1))
    want = plain(docs, labels)
    assert found(filteraudit.audit(a.repartition(5), b)) == want
    import functools

    from gleanery.operators.skew import join_spread

    monkeypatch.setattr(filteraudit, "join_spread", functools.partial(join_spread, least=2, hot_keys=20, few=0))  # hot keys apart from the others
    assert found(filteraudit.audit(a.repartition(5), b)) == want


def test_no_rows_and_numbered_parts(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source int")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filteraudit.audit(none, labels).count() == 0
    one = spark.createDataFrame([(1, "x", 7)], "doc_id long, text string, source int")
    got = filteraudit.audit(one, labels)
    assert got.count() == 600 and {r.part for r in got.collect()} == {"7"}


def test_sums_give_cells_back(spark):
    import random

    rng = random.Random(2)
    want = [rng.randrange(1000) for _ in range(32)]
    moves = spark.createDataFrame([(m, n, "p") for m, n in enumerate(want)], "mask int, weight int, part string")
    got = filteraudit.parity_sums(moves, "part").select(filteraudit.cells(F.col("sums")).alias("c"), F.col("sums")[0].alias("all")).first()
    assert got.c == want and got["all"] == sum(want)
