"""Corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark decontamination, BPE.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame. A stage sees all
rows its predecessor kept, whole; all but the last return the columns of documents. ``run`` writes each stage's
result as Parquet in the shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.llm import bpe, decontaminate, linededup, similar, toxicity
from gleanery.llm.common import fresh, table
from gleanery.operators.skew import join_spread
from gleanery.session import cut


def drop_toxic(spark, docs, sf_dir):
    """Documents that the toxicity lexicon scores at its threshold or above go. Null and empty texts score as texts without a hit and stay; long ones are scored whole;
    rows that repeat share their score, so all go or stay; an empty table stays empty. Other columns are kept, whatever their names."""
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score(docs, lexicon) < toxicity.THRESHOLD).select(docs.columns)


def dedup_lines(spark, docs, sf_dir):
    """Lines whose template an earlier document has go, short ones too; every document stays, a copy perhaps without text."""
    return linededup.drop_lines(docs).select(docs.columns)


def dedup_documents(spark, docs, sf_dir):
    """Of each group of near copies (5-word shingles, 0.8 or more) one row stays, of the least id; different texts under one id are told
    apart, rows that repeat are one. Rows without an id stay. Null and empty texts are copies of each other; long texts are compared whole; an empty table stays empty.

    Fingerprints at 0.8 lie some ten bits apart, where no tree over 64 bits prunes: most links come from texts that share one of their sets' least hashes, and all are confirmed by whole
    sets. A pair is missed with a chance of about 1e-7 (``similar.near_copies``)."""
    known = cut(similar.near_copies(docs))
    least = known.groupBy("component").agg(F.min(F.struct("doc_id", "t")).alias("least"), F.count("*").alias("n"))
    ids = known.count()
    named = join_spread(known, least, "component", "n", ids)
    d, t = fresh(docs, "_d", "_t")
    gone = cut(named.where(F.struct("doc_id", "t") != F.col("least")).select(F.col("doc_id").alias(d), F.col("t").alias(t)))
    left = docs.join(gone, (F.col("doc_id") == F.col(d)) & (F.xxhash64("text") == F.col(t)), "left_anti")
    if docs.where("doc_id is not null").count() > ids:
        left = left.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).unionByName(left.where("doc_id is null"))
    return left


def drop_contaminated(spark, docs, sf_dir):
    """Documents that hold a test item, whole or edited, go. Null and empty texts hold none and stay; long ones are searched whole; rows that repeat go or stay
    together; without items or documents nothing happens."""
    held = decontaminate.held_items(docs, table(spark, sf_dir, "benchmark"))
    return docs.where(F.size(held) == 0).select(docs.columns)


def encode(spark, docs, sf_dir):
    """Token counts and digests of the ids and of the decoded text of every document left, one row for each, rows that repeat included. Null and empty texts have no tokens;
    long ones are encoded piece by piece; an empty table gives an empty result."""
    return docs.select("doc_id", bpe.encode(docs).alias("e")).select("doc_id", "e.n_tokens", "e.ids_sha256", "e.decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_documents),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: Learned lexicons, SimHash groups, alignments and BPE merges can't be said in SQL: tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs
