"""Document fingerprints: bottom-k sketches of shingle hashes, with DataFrame functions only.

A sketch is the sorted array of the K least distinct 32-bit hashes of a text's 5-word shingles. Sketches of parts merge
into the sketch of the whole (union, sort, keep K). From two sketches: resemblance is the share of common hashes among
the K least of their union; the number of distinct shingles is estimated from the K-th least hash, and containment
from both. Texts with at most K different shingles have exact sketches.

Words are what white space parts (ASCII space and control white space), taken as they are. A text of fewer than five words is one shingle
of all its words; one without words has an empty sketch. Long texts are read whole; of an equal hash one counts. What ``edited_pairs`` does with nulls, repeated
ids and empty tables stands there; it reads doc_id and text alone, so no other column's name can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.common import table
from gleanery.session import cut

K = 128
SHINGLE = 5
HASH_BITS = 32


def sketch(text: Column, k: int = K, size: int = SHINGLE) -> Column:
    """Sorted array<bigint> of the k least distinct shingle hashes (unsigned 32-bit) of a text; null counts as empty.

    Words are hashed once; a shingle's hash is that of its word hashes in order, so no shingle text is ever built."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+"), lambda w: w != "")
    return F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), lambda h: _least(h, k, size))[0]


def _least(h: Column, k: int, size: int) -> Column:
    cut32 = F.lit((1 << HASH_BITS) - 1)
    # sequence() counts down when its end is below its start, so short texts take the other branch.
    many = F.transform(F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(size)]).bitwiseAND(cut32))
    few = F.when(F.size(h) > 0, F.array(F.xxhash64(h).bitwiseAND(cut32))).otherwise(F.array().cast("array<bigint>"))
    return F.when(F.size(h) >= size, F.slice(F.sort_array(F.array_distinct(many)), 1, k)).otherwise(few)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two texts' shingles together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingle sets: 1 for two empty sketches, 0 for one."""
    least = merge(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(a, b), least))
    return F.when(F.size(least) == 0, 1.0).otherwise(common / F.size(least).cast("double"))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of different shingles; exact for sketches that aren't full."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * float(1 << HASH_BITS) / F.get(a, F.lit(k - 1)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has: J / (1 + J) * (|A| + |B|) / |A|, at most 1; 1 for an empty a."""
    j = resemblance(a, b, k)
    na, nb = distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), j / (1 + j) * (na + nb) / na))


def as_text(a: Column) -> Column:
    """Eight hexadecimal digits for each hash, in order."""
    return F.array_join(F.transform(a, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def next_ids(ids: DataFrame) -> DataFrame:
    """(doc_id, need, next_id) for a table (doc_id, need) of different ids: each id's successor in ascending order, the first
    following the last. Ids are dealt by range and sorted within each part; a part's last id gets the first id of the next
    part that has any. Only ids move, and no task holds more than a part."""
    n = max(1, int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = cut(ids.repartitionByRange(n, "doc_id").withColumn("part", F.spark_partition_id()))
    within = parts.withColumn("next_id", F.lead("doc_id").over(Window.partitionBy("part").orderBy("doc_id")))
    firsts = parts.groupBy("part").agg(F.min("doc_id").alias("first"))  # one row for each part
    heads = firsts.select("part", F.coalesce(F.lead("first").over(Window.orderBy("part")), F.min("first").over(Window.partitionBy())).alias("following"))
    return within.join(F.broadcast(heads), "part").select("doc_id", "need", F.coalesce("next_id", "following").alias("next_id"))


def edited_pairs(docs: DataFrame, k: int = K, share: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, text, edited text (the last n_chars // share code points replaced by the first
    as many, or all, of the next document's), both sketches and the next document's.

    Null texts count as empty. Rows that repeat an id each get their row; as a successor, the repeated id stands with its
    greatest text. Rows without an id have no successor: their edited text lacks the tail and ``next_sketch`` is null.

    Two shuffles carry text: each text with its sketch once by id (both joins use it), and each next document's head once more."""
    text = F.coalesce("text", F.lit(""))
    own = docs.where("doc_id is not null").select("doc_id", text.alias("text")).withColumn("sketch", sketch(F.col("text"), k))
    tail = (F.length("text") / share).cast("long").cast("int")
    lens = docs.where("doc_id is not null").select("doc_id", text.alias("text")).groupBy("doc_id").agg(F.max(tail).alias("need"), F.count("*").alias("n"))
    lens = cut(lens)
    follows = next_ids(lens.select("doc_id", "need")).withColumnRenamed("doc_id", "before")
    heads = own.join(follows, F.col("doc_id") == F.col("next_id")).select("before", F.substring("text", F.lit(1), F.col("need")).alias("head"), F.col("sketch").alias("next_sketch"), "next_id", "text")
    if lens.where("n > 1").limit(1).count():
        heads = heads.groupBy("before").agg(F.max_by(F.struct("head", "next_sketch"), "text").alias("h")).select("before", "h.head", "h.next_sketch")
    else:
        heads = heads.select("before", "head", "next_sketch")
    both = own.join(heads, F.col("doc_id") == F.col("before")).drop("before")
    bare = docs.where("doc_id is null").select("doc_id", text.alias("text")).withColumn("sketch", sketch(F.col("text"), k))
    both = both.unionByName(bare.withColumns({"head": F.lit(""), "next_sketch": F.lit(None).cast("array<bigint>")}).select(both.columns))
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - tail), F.substring("head", F.lit(1), tail))
    return both.withColumn("edited", edited).withColumn("edited_sketch", sketch(F.col("edited"), k)).drop("head")


def op9_fingerprint(spark, sf_dir):
    rows = edited_pairs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
