"""What several operators share: table reads, held-out folds, bounded training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch sent to Python, at most (a longer row goes alone); whole texts go in, so batches are kept small.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """A column name for each stem that ``df`` doesn't have, whatever the case."""
    taken, out = {c.lower() for c in df.columns}, []
    for stem in stems:
        name = stem
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of a Python worker's batch, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def fold(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; null ids fall into fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % of, F.lit(0))


def uniform(key: Column) -> Column:
    """A fixed pseudo-random number in [0, 1) for a key, the same on every run and cluster."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(1 << 31)) / float(1 << 31)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, bound: int) -> list[tuple[str, int]]:
    """At most about ``bound`` labelled texts (binomially), chosen by a hash of doc_id: the only rows that go
    to the driver. ``keep`` selects the training folds by doc_id. Null texts, ids and labels are left out.

    A document's draw depends on its id alone, so the sample is the same however the tables are partitioned."""
    known = labels.select("doc_id", F.col(label).alias("_y")).where(F.col("doc_id").isNotNull() & F.col("_y").isNotNull() & keep)
    n = known.count()
    if not n:
        return []
    # The ids drawn are about `bound` longs, whatever the tables' size: safe to broadcast.
    drawn = known.where(uniform(F.col("doc_id")) < min(1.0, bound / n)).dropDuplicates(["doc_id"])
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "_y").collect()
    return [(r.text, int(r._y)) for r in sorted(rows, key=lambda r: (r.doc_id, r.text))]
