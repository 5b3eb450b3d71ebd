"""Filter interaction audit by Walsh-Hadamard sums: how five filters overlap, in every order, from one pass over the texts.

A document's failures are a mask of five bits. Instead of masks, each part (a value of a column) and label gathers 32 signed sums: for
each set s of filters, the number of documents that fail an even number of s less those that fail an odd number. They add up
over tasks, so a part that holds a third of all rows costs one row a task, and the inverse transform gives every mask's
count back exactly. What the 120 orders keep and remove at each step are sums over these 32 cells, and so is a filter's Shapley value: a
document that fails k filters is removed first by each of them in 120 / k of the orders.

Filter E (a copy of a document with a smaller id) needs the whole table. Texts travel as their md5, of which the least id
is taken map-side. The sums are linear, so the copies need no place in the main pass: each is taken out of its cell and put into
that with E. Documents meet labels and least ids by joins that keep hot ids and hot texts where they are.

Null texts count as empty. A document without an id is no copy, makes none and has no label; rows that repeat an id each count, and of
its labels any 1 counts. Null sources are the part ''. Texts are read whole, however long; an empty table has no parts and so
no rows. Only doc_id, text, the part column and the labels' doc_id, quality and toxic are read, so other columns can't clash.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import table
from gleanery.operators.skew import join_spread
from gleanery.session import cut

FILTERS = "ABCDE"
SETS = 1 << len(FILTERS)
COPY = 1 << FILTERS.index("E")
ORDERS = ["".join(p) for p in permutations(FILTERS)]
BLANKS = " \t\n\x0b\f\r"


def text_failures(docs: DataFrame, text: str, *keep: Column) -> DataFrame:
    """``keep`` and the column ``mask``: the bits of filters A to D that a text fails."""
    t = F.coalesce(F.col(text), F.lit(""))
    bare = F.btrim(t, F.lit(BLANKS))
    words = F.when(bare != "", F.split(bare, r"[ \t-\r]+")).otherwise(F.array().cast("array<string>"))
    capitals = F.length(t) - F.length(F.regexp_replace(t, "[A-Z]+", ""))
    # The words are a column of their own, so that they are made once.
    rows = docs.select(*keep, words.alias("_w"), (100 * capitals > 5 * F.length(t)).alias("_c"), t.rlike(r"[#$%&*|]").alias("_d"))
    n, different = F.size("_w"), F.size(F.array_distinct("_w"))
    fails = [n < 50, 100 * different < 65 * n, F.col("_c"), F.col("_d")]
    mask = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))
    return rows.withColumn("mask", mask).drop("_w", "_c", "_d")


def sign(a: Column, b: Column | int) -> Column:
    """1 where two sets have an even number in common, else -1."""
    return F.lit(1) - 2 * (F.bit_count(a.bitwiseAND(b)) % 2)


def parity_sums(moves: DataFrame, *by: str) -> DataFrame:
    """For each group the array ``sums`` over all sets of filters, from rows with a mask and a weight."""
    sums = [F.sum(F.col("weight") * sign(F.col("mask"), s)).cast("long") for s in range(SETS)]
    return moves.groupBy(*by).agg(F.array(*sums).alias("sums"))


def cells(sums: Column) -> Column:
    """Each mask's count: the inverse transform."""
    at = F.sequence(F.lit(0), F.lit(SETS - 1))
    one = lambda m: F.aggregate(F.transform(sums, lambda x, s: x * sign(s, m)), F.lit(0).cast("long"), lambda a, x: a + x)
    return F.transform(at, lambda m: F.shiftright(one(m), len(FILTERS)))


def moves(docs: DataFrame, part: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, part, mask, weight) whose weights sum to each mask's documents, and (doc_id, n): how many rows there are for each id."""
    t = F.coalesce(F.col("text"), F.lit(""))
    own = F.coalesce(F.col(part).cast("string"), F.lit(""))
    rows = cut(text_failures(docs, "text", F.col("doc_id"), own.alias("part"), F.md5(t).alias("key")))
    known = rows.where("doc_id is not null")
    copied = known.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n")).where("first < last").drop("last")
    ids = known.groupBy("doc_id").agg(F.count("*").alias("n"))
    copies = cut(join_spread(known, cut(copied), "key", "n", known.count()).where("doc_id > first").select("doc_id", "part", "mask"))
    moved = rows.select("doc_id", "part", "mask", F.lit(1).alias("weight"))
    for shift, weight in ((0, -1), (COPY, 1)):
        moved = moved.unionByName(copies.select("doc_id", "part", (F.col("mask") + shift).alias("mask"), F.lit(weight).alias("weight")))
    return moved, ids


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """One row for each part, order of the filters and step; see the module's docstring."""
    moved, ids = moves(docs, part)
    flags = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    flags = cut(flags.where("good = 1 or toxic = 1").join(ids, "doc_id"))
    held = flags.agg(F.sum("n")).first()[0] or 0
    # A row has three moves at most.
    labelled = join_spread(moved, flags.withColumn("n", 3 * F.col("n")), "doc_id", "n", 3 * max(held, docs.count()))
    of = lambda rows, label: rows.select("part", F.lit(label).alias("label"), "mask", "weight")
    each = of(moved, "all").unionByName(of(labelled.where("good = 1"), "good")).unionByName(of(labelled.where("toxic = 1"), "toxic"))
    sums = parity_sums(each, "part", "label")
    by_label = sums.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("label", "sums"))).alias("m"))  # three rows at most
    none = F.array_repeat(F.lit(0).cast("long"), SETS)
    parts = cut(by_label.select("part", *[cells(F.coalesce(F.element_at("m", F.lit(k)), none)).alias(k) for k in ("all", "good", "toxic")]))
    return replay(parts)


def replay(parts: DataFrame) -> DataFrame:
    """All orders and steps of each part, from its cells (columns all, good, toxic: counts by mask)."""
    bit = F.create_map(*[F.lit(x) for k, f in enumerate(FILTERS) for x in (f, 1 << k)])
    steps = parts.select("*", F.explode(F.lit(ORDERS)).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    earlier = F.aggregate(F.split(F.expr("substring(filter_order, 1, step - 1)"), ""), F.lit(0), lambda a, x: a + F.coalesce(F.element_at(bit, x), F.lit(0)))
    own = F.element_at(bit, F.expr("substring(filter_order, step, 1)"))
    steps = steps.withColumns({"before": earlier, "own": own})
    has = lambda m, s: m.bitwiseAND(F.col(s)) != 0
    first = lambda m: has(m, "own") & ~has(m, "before")

    def total(label, when, times=lambda m: F.lit(1)):
        return F.aggregate(F.transform(label, lambda x, m: F.when(when(m), x * times(m)).otherwise(0)), F.lit(0).cast("long"), lambda a, x: a + x)

    orders = F.lit(len(ORDERS))
    return steps.select(
        "part",
        "filter_order",
        "step",
        total("all", lambda m: ~has(m, "own") & ~has(m, "before")).alias("kept"),
        total("all", first).alias("removed"),
        total("all", lambda m: has(m, "own") & has(m, "before")).alias("redundant"),
        total("all", lambda m: m == F.col("own")).alias("unique_fails"),
        total("good", first).alias("good_lost"),
        total("toxic", first).alias("toxic_lost"),
        total("all", lambda m: has(m, "own"), lambda m: (orders / F.bit_count(m)).cast("long")).alias("shapley"),
    )


def op13_filteraudit(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return audit(docs, table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(CAST(source AS VARCHAR), '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
copied AS (SELECT text, min(doc_id) AS first FROM t GROUP BY text),
flag AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
         FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
fails AS (
  SELECT t.part, coalesce(flag.good, 0) AS good, coalesce(flag.toxic, 0) AS toxic,
         CASE WHEN len(w) < 50 THEN 1 ELSE 0 END AS a,
         CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 1 ELSE 0 END AS b,
         CASE WHEN 100 * length(regexp_replace(t.text, '[^A-Z]', '', 'g')) > 5 * length(t.text) THEN 1 ELSE 0 END AS c,
         CASE WHEN regexp_matches(t.text, '[#$%&*|]') THEN 1 ELSE 0 END AS d,
         CASE WHEN copied.first < t.doc_id THEN 1 ELSE 0 END AS e
  FROM t JOIN copied ON t.text = copied.text LEFT JOIN flag ON t.doc_id = flag.doc_id),
cell AS (
  SELECT part, a, b, c, d, e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, a, b, c, d, e),
long AS (SELECT part, n, good, toxic, [a, b, c, d, e] AS f, a + b + c + d + e AS k FROM cell),
letter AS (SELECT * FROM (VALUES (1), (2), (3), (4), (5)) AS x(i)),
orders AS (
  SELECT [p.i, q.i, r.i, s.i, u.i] AS o, substr('ABCDE', p.i, 1) || substr('ABCDE', q.i, 1) || substr('ABCDE', r.i, 1) || substr('ABCDE', s.i, 1) || substr('ABCDE', u.i, 1) AS filter_order
  FROM letter p, letter q, letter r, letter s, letter u WHERE len(list_distinct([p.i, q.i, r.i, s.i, u.i])) = 5),
steps AS (SELECT filter_order, CAST(i AS INTEGER) AS step, o[i] AS own, o[1:i - 1] AS before FROM orders, letter),
hit AS (
  SELECT part, filter_order, step, n, good, toxic, k, f[own] AS fails_it, CASE WHEN len(list_filter(before, lambda x: f[x] = 1)) > 0 THEN 1 ELSE 0 END AS gone
  FROM long, steps)
SELECT part, filter_order, step,
       CAST(sum(CASE WHEN fails_it = 0 AND gone = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN fails_it = 1 AND gone = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
       CAST(sum(CASE WHEN fails_it = 1 AND gone = 1 THEN n ELSE 0 END) AS BIGINT) AS redundant,
       CAST(sum(CASE WHEN fails_it = 1 AND k = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
       CAST(sum(CASE WHEN fails_it = 1 AND gone = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
       CAST(sum(CASE WHEN fails_it = 1 AND gone = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
       CAST(sum(CASE WHEN fails_it = 1 THEN n * 120 // k ELSE 0 END) AS BIGINT) AS shapley
FROM hit GROUP BY part, filter_order, step
"""
