"""Benchmark decontamination: rare word-pair seeds, then Smith-Waterman alignment.

Texts are lower-cased runs of word characters. Items and documents are aligned locally, word by word (match 2, other -1,
gap -1). The score is the best alignment's, divided by that of the item with itself. From THRESHOLD on, the document holds the item.

Seeds are an item's rare pairs, and miss nothing. Of an alignment's matched words, two that follow each other with at most one edit between them stand at
most 2 apart in item and document: such a pair is a seed, one for each word of the item that begins one. If s of the k - 1 steps between k matches are seeds, the others cost 2 or
more, so the score is at most 2k - 2(k - 1 - s) = 2 + 2s. From THRESHOLD x 2n on (n words in the item), s is THRESHOLD x n - 1 at
least. So the d places of an item whose pairs are the commonest over all items may be left out as long as d < s: any alignment still has s - d rare seeds, and
an item is aligned only where so many lie within the longest alignment's reach. Half of s is left out: these few places would make most of the hits. No seed that is left and no candidate is
capped. Documents meet items map-side: the seed table is that of a block of about BLOCK_ITEMS items and BLOCK_WORDS words, so its size is bounded
whatever the benchmark's; a larger benchmark has several blocks, and each document is held against all of them.

Null and empty texts hold nothing, nor does anything where either table is empty; long texts are searched whole, windows of an alignment's reach at a time;
repeated rows and items are each reported; equal scores go to the first place in the text. The result is a column, so no name can clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import small_batches, table

THRESHOLD = 0.4
MATCH, OTHER, GAP = 2, -1, -1
#: Items, and words of items, that are held at once (about: a block has at least one item).
BLOCK_ITEMS, BLOCK_WORDS = 20_000, 2_000_000
_WORDS = re.compile(r"\w+").findall


def words_of(text: str | None) -> list[str]:
    return _WORDS((text or "").lower())


@dataclass
class Block:
    """Some test items: their ids, words as numbers (from 1) and the vocabulary. A pair of words has the code a * base + b, far below 2^63 for the
    words of a block."""

    ids: list[int | None]
    items: list[np.ndarray]
    vocab: dict[str, int]
    threshold: float

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return seed_table(self)

    @cached_property
    def short(self) -> list[int]:
        """Items of one or two words: held only as their whole word sequence."""
        return [k for k, x in enumerate(self.items) if 0 < len(x) < 3]

    @cached_property
    def steps(self) -> np.ndarray:
        """For each item, the number of seeds that any alignment at the threshold has; out of reach for items under three words."""
        n = np.array([len(x) for x in self.items], np.int64)
        return np.where(n < 3, 1 << 40, np.maximum(1, np.ceil(self.threshold * n - 1 - 1e-9).astype(np.int64)))

    @cached_property
    def least(self) -> np.ndarray:
        """Of these, how many are among the item's rare ones."""
        return self.steps - self.steps // 2

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.vocab.get, words, repeat(0)), np.int64, len(words))


def block_of(items: list[tuple[int | None, str | None]], threshold: float = THRESHOLD) -> Block:
    """Items as numbers."""
    vocab: dict[str, int] = {}
    split = [(i, words_of(t)) for i, t in items]
    for _, words in split:
        for w in words:
            vocab.setdefault(w, len(vocab) + 1)
    block = Block([i for i, _ in split], [], vocab, threshold)
    block.items = [block.numbers(w) for _, w in split]
    return block


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Smith-Waterman: (best score, position in ``text`` just after its alignment). Number 0 matches nothing."""
    n = len(text)
    row, best, end = np.zeros(n + 1, np.int64), 0, 0
    steps = np.arange(n + 1) * -GAP
    for w in item:
        new = np.zeros(n + 1, np.int64)
        new[1:] = np.maximum(row[:-1] + np.where((text == w) & (w > 0), MATCH, OTHER), row[1:] + GAP)
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + steps) - steps  # gaps in the item, all at once
        if (top := int(row.max())) > best:
            best, end = top, int(row.argmax())
    return best, end


#: Bits of the first test of a pair: one look at a bit map instead of a search.
MAP_BITS = 22


def _place(code: np.ndarray) -> np.ndarray:
    return code.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - MAP_BITS)


def seed_table(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A map of the codes, the sorted codes of the items' rare word pairs (at a distance of 1 or 2), where each one's items start, and these."""
    base = len(block.vocab) + 1
    codes, items, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, own in enumerate(block.items):
        for gap in (1, 2) if len(own) > 2 else ():
            codes.append(own[:-gap] * base + own[gap:])
            places.append(np.arange(len(codes[-1])))
            items.append(np.full(len(codes[-1]), k))
    code, item, place = (np.concatenate(x) for x in (codes, items, places))
    _, at, often = np.unique(code, return_inverse=True, return_counts=True)
    # How often the pairs that begin at a place occur over all items: the commonest steps // 2 places of each item go.
    first = np.concatenate([[0], np.cumsum([len(x) for x in block.items])]).astype(np.int64)
    weight = np.bincount(first[item] + place, often[at], first[-1]) if len(code) else np.zeros(0)
    kept = np.ones(first[-1], bool)
    for k in range(len(block.items)):
        if first[k + 1] - first[k] > 2 and (gone := int(block.steps[k] - block.least[k])):
            kept[first[k] + np.argsort(-weight[first[k] : first[k + 1]], kind="stable")[:gone]] = False
    rare = kept[first[item] + place]
    code = np.unique(code[rare] * len(block.items) + item[rare])
    code, item = code // max(1, len(block.items)), code % max(1, len(block.items))  # an item once for each code
    code, starts = np.unique(code, return_index=True)
    seen = np.zeros(1 << MAP_BITS, bool)
    seen[_place(code)] = True
    return seen, code, np.append(starts, len(item)), item


def seeds(block: Block, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(item, position in the text) where two words of a rare pair of the item stand at most 2 apart in the text; some may be there twice."""
    seen, code, starts, item = block.table
    base = len(block.vocab) + 1
    items, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for gap in (1, 2):
        if not len(code) or len(numbers) <= gap:
            continue
        wanted = numbers[:-gap] * base + numbers[gap:]
        p = np.flatnonzero(seen[_place(wanted)])
        wanted = wanted[p]
        k = np.minimum(np.searchsorted(code, wanted), len(code) - 1)
        same = code[k] == wanted
        p, k = p[same], k[same]
        n = starts[k + 1] - starts[k]
        items.append(item[np.repeat(starts[k] - np.cumsum(n) + n, n) + np.arange(n.sum())])
        at.append(np.repeat(p, n))
    return np.concatenate(items), np.concatenate(at)


def matches(block: Block, words: list[str]) -> list[tuple[int, float, int]]:
    """(index of item, score, words up to the alignment's end) of each item that a document holds, by item."""
    return all_matches(block, [words])[0]


def all_matches(block: Block, texts: Iterable[list[str]]) -> list[list[tuple[int, float, int]]]:
    """The same for many documents, searched in one go: two words that no item has stand between them."""
    own_numbers = [block.numbers(words) for words in texts]
    out: list[list[tuple[int, float, int]]] = [[] for _ in own_numbers]
    if not out:
        return out
    lens = np.array([len(x) for x in own_numbers], np.int64)
    first = np.cumsum(lens + 2) - lens - 2
    gap = np.zeros(2, np.int64)
    numbers = np.concatenate([x for own in own_numbers for x in (own, gap)])
    for item in block.short:
        own = block.items[item]
        held = numbers == own[0] if len(own) == 1 else np.append((numbers[:-1] == own[0]) & (numbers[1:] == own[1]), False)
        at = np.flatnonzero(held)
        docs, k = np.unique(np.searchsorted(first, at, "right") - 1, return_index=True)
        for d, p in zip(docs.tolist(), at[k].tolist(), strict=True):
            out[d].append((item, 1.0, p - int(first[d]) + len(own)))
    items, at = seeds(block, numbers)
    names = (np.searchsorted(first, at, "right") - 1) * len(block.items) + items
    hit = np.lexsort((at, names))
    names, at = names[hit], at[hit]
    new = np.append(True, (names[1:] != names[:-1]) | (at[1:] != at[:-1]))[: len(names)]
    names, at = names[new], at[new]
    names, starts, counts = np.unique(names, return_index=True, return_counts=True)
    enough = counts >= block.least[names % max(1, len(block.items))]
    for name, lo, n in zip(names[enough].tolist(), starts[enough].tolist(), counts[enough].tolist()):
        doc, item = divmod(name, len(block.items))
        own, p, text = block.items[item], at[lo : lo + n] - first[doc], own_numbers[doc]
        most, need, few = (0, 0), block.threshold * MATCH * len(own), int(block.least[item])
        span = len(own) + int((MATCH * len(own) - need) / -GAP) + 1  # an alignment over the threshold can afford no more gaps
        dense = np.flatnonzero(p[few - 1 :] - p[: len(p) - few + 1] <= span)
        ends = []
        for k in dense.tolist():
            # All of the alignment, whose first rare seed may be its middle one.
            a, b = max(0, int(p[k]) - span), int(p[k + few - 1]) + span + 1
            if ends and a <= ends[-1][1]:
                ends[-1][1] = b
            else:
                ends.append([a, b])
        for a, b in ends:
            part = text[a:b]
            if MATCH * np.isin(part, own).sum() >= need:  # no alignment scores more than its matches
                score, end = align(own, part)
                most = max(most, (score, -(a + end)))
        if most[0] >= need and most[0] > 0:
            out[doc].append((item, most[0] / (MATCH * len(own)), -most[1]))
    return [sorted(x) for x in out]


def held_items(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> Column:
    """A column for ``docs``: array of (item_id, score, end) of the test items that each whole text holds; empty for none and for
    null texts. Items of one or two words are held
    as their whole word sequence only; items without words and null item texts are left out. Items that repeat
    are each reported. No shuffle of documents."""
    small_batches(docs.sparkSession)
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    n, words = rows.agg(F.count("*"), F.coalesce(F.sum(F.size(F.split("text", r"\W+"))), F.lit(0))).first()
    parts = max(1, -(-n // BLOCK_ITEMS), -(-words // BLOCK_WORDS))
    columns = []
    for part in range(parts):
        mine = rows.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(parts)) == part) if parts > 1 else rows
        block = block_of(sorted((tuple(r) for r in mine.collect()), key=lambda r: (r[0] is None, r)), threshold)
        _ = block.table  # made once, here
        columns.append(_find(docs, block))
    return F.concat(*columns) if len(columns) > 1 else columns[0]


def _find(docs: DataFrame, block: Block) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(block)

    @F.pandas_udf("array<struct<item_id: long, score: double, end: long>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        block = shared.value
        for s in batches:
            yield pd.Series([[{"item_id": block.ids[k], "score": x, "end": e} for k, x, e in found] for found in all_matches(block, map(words_of, s))], dtype=object)

    return run(F.col("text"))


def op8_decontaminate(spark, sf_dir):
    """(doc_id, item_id, score, end): the test items that each document holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = held_items(docs, table(spark, sf_dir, "benchmark"))
    return docs.select("doc_id", F.explode(held).alias("h")).select("doc_id", "h.item_id", "h.score", "h.end")
