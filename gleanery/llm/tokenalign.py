"""Cross-tokenizer alignment by segment deduplication: how a byte-level BPE (A) and a piece BPE with byte fallback (B) cut the same bytes.

A text, with a space before it, is split before runs of white space, where neither vocabulary can merge across: A's pattern never takes
white space after another sign into one word, and B's pieces are searched for one that does; a white-space sign that any piece holds
after another sign is no place to split (``Pair.load``). So a text's tokens are its segments' tokens in order, and token ends,
groups and links of a text are those of its segments.

1. Segments are counted over all texts, each task adding up its own first: one row for each distinct segment.
2. Each distinct segment is tokenised and aligned once, in Arrow batches.
3. Links, weighted by the segments' counts, add up to each id pair's count; each segment then gets the sum of its links' counts and the number of its
   links that are their B id's most frequent. Pair counts are sent whole to the tasks only while there are at most PAIRS; beyond, links meet them by a join
   that spreads hot pairs.
4. Alignments are joined back. The most frequent segments (LEXICON of them, of LEXICON_CHARS code points each at most) go to
   every task; the others are the corpus's rare ones, none of which has more than 1 / LEXICON of all occurrences but a very long one (those
   rows are split by adaptive execution), so the join by segment has no hot key. Each text's rare alignments come back as one array, no longer
   than the text, and the text's digests are composed in one pass. Copies of a text share one array.

B writes a space as U+2581, so a text that holds that letter isn't given back by B's pieces: it has no tokens and counts for nothing. Null and
empty texts have none either; ids aren't read, null ones included. Texts are taken whole; a long run without white space is one segment. Repeated rows each count and
each come out. Without any text the result has zeros, without rows none. Only an id column and the text are read, so no other name can clash.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.bpe import byte_letters
from gleanery.llm.common import small_batches, table
from gleanery.operators.skew import join_spread
from gleanery.session import cut, uncut

FILES = ("byte_bpe_50k.json", "piece_bpe_32k.model")
#: Segments sent to every task at most, and their length; id pairs sent to every task at most (20 bytes each).
LEXICON, LEXICON_CHARS, PAIRS = 350_000, 64, 3_000_000
#: Texts of which so many copies exist at least, and over 1 / HOT_TEXTS of all rows, are composed once.
LEAST_COPIES, HOT_TEXTS = 256, 1000
#: Distinct segments that a task counts before it hands them on.
COUNTED = 300_000
SPACE = "▁"
BITS = 20


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return tuple(public_tokenizers.path(f) for f in FILES)


@dataclass
class Pair:
    """Both tokenizers: files' places, each id's length in bytes and the white space before which texts may be split."""

    paths: tuple[str, str]
    a_len: np.ndarray
    b_len: np.ndarray
    before: str

    @classmethod
    def load(cls, paths: tuple[str, str]) -> Pair:
        """Reads both files and checks what splitting rests on; ValueError if they don't hold."""
        with open(paths[0], encoding="utf-8") as f:
            spec = json.load(f)
        level, model = spec["pre_tokenizer"], spec["model"]
        if spec["normalizer"] or spec["post_processor"] or (level["type"], level["add_prefix_space"], level["use_regex"]) != ("ByteLevel", False, True):
            raise ValueError(f"{paths[0]} isn't a byte-level BPE that takes texts as they are")
        if model["type"] != "BPE" or not all(x in model["vocab"] for x in byte_letters()) or any(not t["special"] for t in spec["added_tokens"]):
            raise ValueError(f"{paths[0]} lacks a letter for some byte or adds tokens of its own")
        a_len = np.zeros(max(model["vocab"].values()) + 1, np.int64)
        for token, i in model["vocab"].items():
            a_len[i] = len(token)  # one letter for each byte
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(paths[1], "rb") as f:
            proto.ParseFromString(f.read())
        how, train, kinds = proto.normalizer_spec, proto.trainer_spec, proto.SentencePiece
        if how.name != "identity" or how.precompiled_charsmap or how.normalization_rule_tsv or not how.add_dummy_prefix or how.remove_extra_whitespaces or not how.escape_whitespaces or train.treat_whitespace_as_suffix:
            raise ValueError(f"{paths[1]} changes texts")
        if train.model_type != train.BPE or sum(p.type == kinds.BYTE for p in proto.pieces) != 256 or any(p.type == kinds.USER_DEFINED for p in proto.pieces):
            raise ValueError(f"{paths[1]} isn't a BPE with byte fallback alone")
        pieces = [p.piece.replace(SPACE, " ") if p.type == kinds.NORMAL else None for p in proto.pieces]
        b_len = np.array([1 if p is None else len(p.encode()) for p in pieces], np.int64)
        before = "".join(w for w in " \n\t\r" if not any(p and re.search(rf"\S{w}", p) for p in pieces) and (w == " " or not any(p and w in p and " " in p for p in pieces)))
        if " " not in before or SPACE not in {p.piece for p in proto.pieces}:
            raise ValueError(f"{paths[1]} merges across spaces")
        return cls(tuple(paths), a_len, b_len, before)


class Splitter:
    """Texts to segments, which joined give the text with a space before it."""

    def __init__(self, before: str):
        odd = f"[^\\S{re.escape(before)}]"
        self.odd = re.compile(odd).search
        self.quick = re.compile(r"\s*\S+").findall
        self.slow = re.compile(rf"\s*\S+(?:{odd}\s*\S+)*").findall

    def __call__(self, text: str) -> list[str]:
        """None for texts without tokens: null, empty, or with a letter that B doesn't give back."""
        if not text or SPACE in text:
            return []
        text = " " + text
        full = text.rstrip()  # so that white space always has a sign after it, and a search never starts again within a run
        if not full:
            return [text]
        out = (self.quick if self.odd(full) is None else self.slow)(full)
        if len(full) < len(text):
            out[-1] += text[len(full) :]
        return out


class Aligner:
    def __init__(self, pair: Pair):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.pair = pair
        self.a = Tokenizer.from_file(pair.paths[0])
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=pair.paths[1])
        self.space = self.b.piece_to_id(SPACE)
        self.a_len, self.b_len = pair.a_len.tolist(), pair.b_len.tolist()

    def encode(self, segments: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of A and B. B puts a space before what it gets: it takes the place of a segment's own first one, or goes again."""
        a = self.a.encode_batch_fast(segments, add_special_tokens=False)
        b = self.b.encode([s[1:] if s[0] == " " else s for s in segments], num_threads=1)
        for s, x, y in zip(segments, a, b, strict=True):
            yield x.ids, (y or [self.space]) if s[0] == " " else y[1:]

    def align(self, segment: str, a: list[int], b: list[int]) -> tuple[str, list[int]]:
        """The segment's groups as text, and its links, an A id above a B id in one number each."""
        a_len, b_len = self.a_len, self.b_len
        groups, links = [], []
        i = j = i0 = j0 = 0
        at_a, at_b = a_len[a[0]], b_len[b[0]]
        while True:
            links.append(a[i] << BITS | b[j])
            if at_a == at_b:
                groups.append(f"{','.join(map(str, a[i0 : i + 1]))}|{','.join(map(str, b[j0 : j + 1]))}")
                i0, j0 = i + 1, j + 1
                if i0 == len(a) or j0 == len(b):
                    break
                i, j = i0, j0
                at_a += a_len[a[i]]
                at_b += b_len[b[j]]
            elif at_a < at_b:
                i += 1
                at_a += a_len[a[i]]
            else:
                j += 1
                at_b += b_len[b[j]]
        if i0 != len(a) or j0 != len(b) or at_a != len(segment.encode()):
            raise ValueError(f"tokens don't give the segment back: {segment!r}")
        return ";".join(groups), links


@lru_cache(maxsize=2)
def _pair(paths: tuple[str, str]) -> Pair:
    return Pair.load(paths)


@lru_cache(maxsize=2)
def _aligner(paths: tuple[str, str]) -> Aligner:
    return Aligner(_pair(paths))


def count_segments(docs: DataFrame, text: str, before: str) -> DataFrame:
    """(segment, n) over all texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, seen = Splitter(before), Counter()

        def out() -> pd.DataFrame:
            return pd.DataFrame({"segment": pd.Series(list(seen), dtype=object), "n": np.fromiter(seen.values(), np.int64, len(seen))})

        for batch in batches:
            for t in batch["t"]:
                seen.update(split(t))
                if len(seen) > COUNTED:
                    yield out()
                    seen.clear()
        yield out()

    return docs.select(F.col(text).alias("t")).mapInPandas(run, "segment string, n long").groupBy("segment").agg(F.sum("n").alias("n"))


def align_segments(counted: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """(segment, n, n_a, groups, links) of each distinct segment."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = _aligner(paths)
        for batch in batches:
            segments = batch["segment"].tolist()
            got = [(len(a), *aligner.align(s, a, b)) for s, (a, b) in zip(segments, aligner.encode(segments), strict=True)]
            yield pd.DataFrame({"segment": batch["segment"], "n": batch["n"], "n_a": [a for a, _, _ in got], "groups": pd.Series([g for _, g, _ in got], dtype=object), "links": pd.Series([k for _, _, k in got], dtype=object)})

    return counted.mapInPandas(run, "segment string, n long, n_a int, groups string, links array<long>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(link, rows, count, best): how many links of the corpus are this id pair, in how many segments' rows, and whether no other
    pair of its B id has more."""
    each = aligned.select("n", F.explode("links").alias("link"))
    counts = cut(each.groupBy("link").agg(F.sum("n").alias("count"), F.count("*").alias("rows")))
    b = F.col("link").bitwiseAND((1 << BITS) - 1)
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))  # a row for each id of B: bounded by its vocabulary
    return counts.join(F.broadcast(most), b == F.col("b")).select("link", "rows", "count", (F.col("count") == F.col("most")).alias("best"))


def weigh_segments(aligned: DataFrame, pairs_bound: int = PAIRS) -> DataFrame:
    """(segment, n, n_a, groups, n_best, count_sum)."""
    pairs = cut(pair_counts(aligned))
    n = pairs.count()
    if n <= pairs_bound:
        rows = pairs.select("link", "count", "best").toPandas().sort_values("link")
        shared = aligned.sparkSession.sparkContext.broadcast(tuple(rows[c].to_numpy(d) for c, d in (("link", np.int64), ("count", np.int64), ("best", bool))))

        @F.pandas_udf("n_best long, count_sum long")
        def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            link, count, best = shared.value
            for s in batches:
                sizes = np.fromiter(map(len, s), np.int64, len(s))
                at = np.searchsorted(link, np.concatenate(s.tolist()) if len(s) else np.zeros(0, np.int64))
                ends = np.cumsum(sizes)
                sums = [np.concatenate([[0], np.cumsum(x[at])]) for x in (best.astype(np.int64), count)]
                yield pd.DataFrame({k: x[ends] - x[ends - sizes] for k, x in zip(("n_best", "count_sum"), sums, strict=True)})

        return aligned.select("segment", "n", "n_a", "groups", weigh("links").alias("w")).select("segment", "n", "n_a", "groups", "w.n_best", "w.count_sum")
    each = aligned.select("segment", F.explode("links").alias("link"))
    total = pairs.agg(F.sum("rows")).first()[0]
    got = join_spread(each, pairs, "link", "rows", total).groupBy("segment").agg(F.sum(F.col("best").cast("long")).alias("n_best"), F.sum("count").alias("count_sum"))
    return aligned.select("segment", "n", "n_a", "groups").join(got, "segment")


def lexicon(known: DataFrame, limit: int = LEXICON) -> DataFrame:
    """The most frequent segments of bounded length, ``limit`` at most, by a least count that histograms of counts give: no sort and nothing unbounded."""
    step = F.when(F.col("n") < 64, F.col("n")).otherwise(F.expr("cast(64 * pow(1.05, floor(ln(n / 64.0) / ln(1.05))) as bigint)"))
    short = known.where(F.length("segment") <= LEXICON_CHARS)
    least, total = None, 0
    for r in sorted(short.groupBy(step.alias("s")).count().collect(), reverse=True):
        if total + r["count"] > limit:
            break
        least, total = r.s, total + r["count"]
    return short.where(step >= least) if least is not None else short.where("false")


RESULT = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def digest(got: list[tuple[str, int, int, int]]) -> tuple:
    """The columns of RESULT from the alignments (groups, n_a, n_best, count_sum) of a text's segments in order."""
    if not got:
        return 0, 0, 0, 0, 0, 0, ""
    groups, n_a, n_best, count_sum = zip(*got, strict=True)
    shown, a = ";".join(groups), sum(n_a)
    n_groups = shown.count(";") + 1
    b = shown.count(",") + 2 * n_groups - a
    # A group's tokens end at different places but for the last two, so each token but one adds a link.
    return a, b, n_groups, a + b - n_groups, sum(n_best), sum(count_sum), hashlib.sha256(shown.encode()).hexdigest()


_LEXICONS: dict[str, dict[str, tuple[str, int, int, int]]] = {}


def _lexicon(name: str, columns: tuple) -> dict[str, tuple[str, int, int, int]]:
    """The worker process's dictionary of the segments sent to every task: built once."""
    if name not in _LEXICONS:
        _LEXICONS.clear()
        facts = [c if isinstance(c, list) else c.tolist() for c in columns[1:]]
        _LEXICONS[name] = dict(zip(columns[0], zip(*facts, strict=True), strict=True))
    return _LEXICONS[name]


def compose(texts: DataFrame, known: DataFrame, before: str, limit: int) -> DataFrame:
    """The columns of ``texts`` (h, a text's hash, and t among them) but t, and a struct ``r`` of RESULT. ``known``: all segments' alignments."""
    name, facts = uuid.uuid4().hex, ("groups", "n_a", "n_best", "count_sum")
    few = lexicon(known, limit).toPandas()  # at most ``limit`` segments of bounded length
    shared = texts.sparkSession.sparkContext.broadcast(tuple(few[c].tolist() if few[c].dtype == object else few[c].to_numpy() for c in ("segment", *facts)))
    del few

    def rare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A text's different segments that aren't in the lexicon, numbered."""
        split, have = Splitter(before), _lexicon(name, shared.value)
        for batch in batches:
            keys, places, segments, seen = [], [], [], set()
            for h, t in zip(batch["h"], batch["t"], strict=True):
                if h not in seen:
                    seen.add(h)
                    new = [s for s in dict.fromkeys(split(t)) if s not in have]
                    keys += [h] * len(new)
                    places += range(len(new))
                    segments += new
            yield pd.DataFrame({"h": pd.Series(keys, dtype=batch["h"].dtype), "k": np.array(places, np.int32), "segment": pd.Series(segments, dtype=object)})

    asked = texts.select("h", "t").mapInPandas(rare, f"h {dict(texts.dtypes)['h']}, k int, segment string")
    info = F.concat_ws("\t", *facts)
    infos = asked.join(known.select("segment", info.alias("info")), "segment").groupBy("h").agg(F.collect_set(F.struct("k", "info")).alias("x"))
    infos = infos.select("h", F.array_join(F.transform(F.sort_array("x"), lambda x: x["info"]), "\n").alias("x"))

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        split, have = Splitter(before), _lexicon(name, shared.value)
        for batch in batches:
            out = []
            for t, x in zip(*batch, strict=True):
                segments = split(t)
                if x:
                    facts_ = [(g, int(a), int(b), int(c)) for g, a, b, c in [i.split("\t") for i in x.split("\n")]]
                    own = dict(zip([s for s in dict.fromkeys(segments) if s not in have], facts_, strict=True))
                    out.append(digest([have.get(s) or own[s] for s in segments]))
                else:
                    out.append(digest([have[s] for s in segments]))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")]).astype({"groups_sha256": object})

    return texts.join(infos, "h", "left").withColumn("r", run("t", "x")).drop("t", "x")


def hash64(t: Column) -> Column:
    return F.xxhash64(t)


def align_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", paths: tuple[str, str] | None = None, limit: int = LEXICON, pairs_bound: int = PAIRS, least_copies: int = LEAST_COPIES) -> DataFrame:
    """One row per row of ``docs``: ``key`` and the columns of RESULT; see the module's docstring."""
    spark = docs.sparkSession
    small_batches(spark)
    paths = tuple(paths or default_paths())
    before = _pair(paths).before
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("t"))
    aligned = cut(align_segments(count_segments(docs, "t", before), paths))
    known = cut(weigh_segments(aligned, pairs_bound))
    uncut(aligned)
    # Texts with very many copies are composed once, and their few results go to all their rows.
    some = F.coalesce(F.col("t"), F.lit("")) != ""
    many_rows = F.lit(max(least_copies, docs.count() // HOT_TEXTS))
    # A short hash names a text, a long one if two texts should have the same short one.
    long = F.unhex(F.md5("t"))
    named = lambda h: docs.where(some).select("key", h.alias("h"), "t")
    seen = named(hash64(F.col("t"))).groupBy("h").agg(F.count("*").alias("n"), (F.min(long) != F.max(long)).alias("clash"))
    seen = cut(seen.where((F.col("n") > many_rows) | F.col("clash")))
    rows, many = named(hash64(F.col("t"))), seen.select("h")
    if seen.where("clash").limit(1).count():
        rows = named(long)
        many = cut(rows.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > many_rows).select("h"))
    if not many.limit(1).count():
        done = compose(rows, known, before, limit)
    else:
        hot = F.broadcast(many)  # HOT_TEXTS hashes at most
        once = rows.join(hot, "h").groupBy("h").agg(F.min("t").alias("t"))
        both = rows.join(hot, "h", "left_anti").select("h", "t", "key", F.lit(False).alias("hot"))
        both = both.unionByName(once.select("h", "t", F.lit(None).cast(docs.schema["key"].dataType).alias("key"), F.lit(True).alias("hot")))
        got = cut(compose(both, known, before, limit))
        spread = rows.select("key", "h").join(F.broadcast(got.where("hot").select("h", "r")), "h")
        done = got.where("not hot").select("key", "r").unionByName(spread.select("key", "r"))
    none = F.struct(*[F.lit("" if kind == "string" else 0).cast(kind).alias(c) for c, kind in (x.split() for x in RESULT.split(", "))])
    done = done.select("key", "r").unionByName(docs.where(~some).select("key", none.alias("r")))
    return done.select(F.col("key").alias(key), "r.*")


def op12_tokenalign(spark, sf_dir):
    return align_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
