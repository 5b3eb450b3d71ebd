"""Line dedup by a log-template tree, with DataFrame functions only.

Each line goes down a tree of fixed depth: its number of tokens, then its leading tokens, where a token with a digit is
a variable field (``<*>``). In a leaf, lines are one template if their tokens agree, variable fields aside. Fields
without digits are generalised too: the tokens after the leading ones are parted into three runs, and lines of a leaf that agree in
two of the three are one template (lines of fewer than MIN_FIELDS tokens must agree in all).

A template that two documents or more share is recurring: all but the lines of its first document (least doc_id) are
dropped. Lines of fewer than MIN_TOKENS tokens are templates as they stand, digits and all; blank lines have none. Lines repeated
within one document only stay.

A template travels as two hashes, of 64 and 32 bits, so no text is shuffled to count it, and the first document is a minimum that
combines map-side: a line shared by a third of all documents costs one row for each task, and its lines meet that minimum by a broadcast of the hot templates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import fresh, table
from gleanery.operators.skew import join_spread
from gleanery.session import cut

LEADING = 3
MIN_TOKENS = 3
MIN_FIELDS = 9
BLANKS = " \t\r\f\x0b"
SPACE = r"[ \t\r\f\x0B]+"


def tokens(line: Column) -> Column:
    """The line's tokens, those with a digit as ``<*>``."""
    words = F.split(F.btrim(line, F.lit(BLANKS)), SPACE)
    return F.when(line.rlike("[0-9]"), F.transform(words, lambda w: F.when(w.rlike("[0-9]"), "<*>").otherwise(w))).otherwise(words)


def template_keys(words: Column, line: Column) -> Column:
    """Hashes (t, s) of the leaf with each of the three ways to leave one run of tokens open; of the whole line for short ones, as it stands for those of
    fewer than MIN_TOKENS tokens; none for blank lines."""
    n = F.size(words)
    rest = n - LEADING
    a, b = F.floor(rest / 3).cast("int"), F.floor(rest * 2 / 3).cast("int")
    runs = F.array(
        F.slice(words, 1, LEADING), F.slice(words, F.lit(LEADING + 1), a), F.slice(words, a + LEADING + 1, b - a), F.slice(words, b + LEADING + 1, rest - b)
    )
    # Each run is hashed once; the array lets the three keys share that.
    runs = F.transform(runs, lambda r: F.struct(F.xxhash64(r).alias("t"), F.hash(r).alias("s")))
    two = lambda h, x, y, k: F.struct(F.xxhash64(n, h[0]["t"], h[x]["t"], h[y]["t"], F.lit(k)).alias("t"), F.hash(n, h[0]["s"], h[x]["s"], h[y]["s"]).alias("s"))
    open_run = F.transform(F.array(runs), lambda h: F.array(two(h, 2, 3, 1), two(h, 1, 3, 2), two(h, 1, 2, 3)))[0]
    whole = F.array(F.struct(F.xxhash64(n, words, F.lit(0)).alias("t"), F.hash(words).alias("s")))
    bare = F.split(F.btrim(line, F.lit(BLANKS)), SPACE)
    short = F.array(F.struct(F.xxhash64(bare, F.lit(4)).alias("t"), F.hash(bare).alias("s")))
    none = F.array().cast("array<struct<t: bigint, s: int>>")
    return F.when(n >= MIN_FIELDS, open_run).when(n >= MIN_TOKENS, whole).when(F.btrim(line, F.lit(BLANKS)) != "", short).otherwise(none)


def drop_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with text without the lines that a template of an earlier document covers, n_chars (if there) as it is then,
    and ``_n_lines``, ``_n_dropped``, which replace columns of these names in any case; all others stay.

    Null texts stay null. A text may become empty; no row is lost. Rows that repeat a doc_id are one document. Rows
    without a doc_id lose nothing and cause no loss."""
    key = F.xxhash64("doc_id", "text")  # tells apart different texts under one id
    lines = docs.where("doc_id is not null and text is not null").select("doc_id", key.alias("k"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    lines = lines.select("doc_id", "k", "pos", "line", tokens(F.col("line")).alias("w"))
    lines = lines.select("doc_id", "k", "pos", template_keys(F.col("w"), F.col("line")).alias("keys"))
    lines = cut(lines)  # unfiltered: a filter on keys would be pushed down and work them out a second time
    each = lines.select("doc_id", "k", "pos", F.explode("keys").alias("key"))
    first = each.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n")).where("first < last").drop("last")
    total = lines.agg(F.sum(F.size("keys"))).first()[0] or 0
    d, k, gone = fresh(docs, "_d", "_k", "_drop")
    # Lines of the commonest templates stay where they are.
    drop = join_spread(each, cut(first), "key", "n", total).where("first < doc_id").groupBy(F.col("doc_id").alias(d), F.col("k").alias(k)).agg(F.collect_set("pos").alias(gone))
    old = F.split("text", "\n", -1)
    joined = docs.join(drop, (F.col("doc_id") == F.col(d)) & (key == F.col(k)), "left")
    lost = F.col(gone).isNotNull()
    kept = F.when(lost, F.array_join(F.filter(old, lambda x, i: ~F.array_contains(F.col(gone), i)), "\n")).otherwise(F.col("text"))
    n_lines = F.when(F.col("text").isNotNull(), F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).otherwise(0)
    own = [kept.alias(c) if c == "text" else F.col(c) for c in docs.columns if c.lower() not in ("_n_lines", "_n_dropped")]
    out = joined.select(*own, n_lines.alias("_n_lines"), F.coalesce(F.array_size(gone), F.lit(0)).alias("_n_dropped"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out


def op3_linededup(spark, sf_dir):
    out = drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", F.col("_n_lines").cast("long").alias("n_lines"), F.col("_n_dropped").cast("long").alias("n_dropped"))


OP3_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
w AS (
  SELECT doc_id, pos, line, list_transform(list_filter(string_split_regex(line, '[ \t\r\f\x0B]+'), lambda x: x <> ''),
         lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS w FROM l),
s AS (SELECT doc_id, pos, line, w, len(w) AS n, (len(w) - 3) // 3 AS a, (len(w) - 3) * 2 // 3 AS b FROM w),
k AS (
  SELECT doc_id, pos, unnest(CASE WHEN n >= 9 THEN [
           concat('1 ', n, ' ', array_to_string(w[1:3] || ['|'] || w[a + 4:], ' ')),
           concat('2 ', n, ' ', array_to_string(w[1:3 + a] || ['|'] || w[b + 4:], ' ')),
           concat('3 ', n, ' ', array_to_string(w[1:3 + b] || ['|'], ' '))]
         WHEN n >= 3 THEN [concat('0 ', array_to_string(w, ' '))]
         WHEN n >= 1 THEN [concat('4 ', array_to_string(list_filter(string_split_regex(line, '[ \t\r\f\x0B]+'), lambda x: x <> ''), ' '))] ELSE [] END) AS t FROM s),
f AS (SELECT t, min(doc_id) AS first FROM k GROUP BY t),
d AS (SELECT DISTINCT k.doc_id, k.pos FROM k JOIN f USING (t) WHERE f.first < k.doc_id)
SELECT l.doc_id, coalesce(string_agg(line, chr(10) ORDER BY l.pos) FILTER (WHERE d.pos IS NULL), '') AS text,
       count(*) AS n_lines, count(d.pos) AS n_dropped
FROM l LEFT JOIN d ON l.doc_id = d.doc_id AND l.pos = d.pos GROUP BY l.doc_id
"""
