"""Language identification by prediction by partial matching (PPM, escape method C) over UTF-8 bytes.

For each language, the counts of bytes after every context of up to ORDER bytes form a context tree. They are
frozen after training. A text's score under a language is its exact code length: each byte costs
-log2 p(byte | longest known context), where an unseen byte first pays that context's escape probability and
then goes on with the next shorter context, down to a uniform order over all byte values.

As statistics are frozen, a byte's cost is a function of its context and itself. The trees of all languages are merged into one trie of
contexts, found by hashing. Kept are only the pairs of context and byte that occur, with their cost in every language, and each
context's escape; another byte pays the escape and then what the shorter context asks. So the model's size follows what the sample holds, not the number of languages
times that of contexts and bytes. Scoring walks the trie for all positions of a batch at once, by array lookups.

Null texts and those without a letter are ``und``, as all are if nothing could be learned (an empty table, no known language); long texts are
scored whole, CHUNK bytes at a time; languages of equal cost go by name; repeated rows come out as often as they go in. The result is a column, so
no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import fold, small_batches, table, uniform

ORDER = 3
#: Training texts a language may draw at most (about): the documented bound of the sample.
TRAIN_DOCS = 500
#: Bytes scored at once, and windows whose costs a task remembers.
CHUNK, MEMO = 1 << 20, 500_000


class Places:
    """Where each of some whole numbers stands among them, by open addressing: at most half of the slots are taken."""

    def __init__(self, numbers: np.ndarray):
        self.bits = max(3, int(2 * len(numbers)).bit_length())
        self.slots, self.place = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        todo, at = np.arange(len(numbers)), self._home(numbers)
        while len(todo):
            free = self.slots[at] < 0
            first = np.zeros(len(todo), bool)
            first[np.unique(at, return_index=True)[1]] = True  # of those that want one slot the first gets it
            put = free & first
            self.slots[at[put]], self.place[at[put]] = numbers[todo[put]], todo[put]
            todo, at = todo[~put], (at[~put] + ~(free & ~first)[~put]) & (len(self.slots) - 1)

    def _home(self, numbers: np.ndarray) -> np.ndarray:
        return ((numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, numbers: np.ndarray) -> np.ndarray:
        """Each one's place, -1 if it isn't there."""
        at = self._home(numbers)
        held = self.slots[at]
        out = np.where(held == numbers, self.place[at], -1)
        todo = np.nonzero((held != numbers) & (held >= 0))[0]
        at = at[todo]
        while len(todo):
            at = (at + 1) & (len(self.slots) - 1)
            held, wanted = self.slots[at], numbers[todo]
            hit = held == wanted
            out[todo[hit]] = self.place[at[hit]]
            on = ~hit & (held >= 0)
            todo, at = todo[on], at[on]
        return out


@dataclass
class Order:
    """Contexts of one length: ``contexts`` are (row of the next shorter context) * letters + (the letter before it), ``pairs`` (row) * letters + (letter), ``cost`` the
    bits of each pair and ``escape`` those of leaving each row, in every language (0 where a language doesn't know the context)."""

    contexts: Places
    pairs: Places
    cost: np.ndarray
    escape: np.ndarray


@dataclass
class PPM:
    """``symbol``: byte -> letter of the reduced alphabet (0: before the text, 1: a byte never seen in training). ``bare``: (letter, language) -> bits without
    context. ``orders``: contexts of one byte and more; their rows count from 1, the shortest context is row 0."""

    languages: list[str]
    symbol: np.ndarray
    bare: np.ndarray
    orders: list[Order]

    @property
    def letters(self) -> int:
        return len(self.bare)


def train(texts: dict[str, list[str]], order: int = ORDER) -> PPM:
    """Count contexts of each language and lay out the merged trie.

    Contexts never cross from one text to the next: each text starts from letter 0."""
    languages = sorted(texts)
    raw = {lang: [np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8) for t in texts[lang]] for lang in languages}
    seen = np.unique(np.concatenate([np.unique(a) for arrays in raw.values() for a in arrays] or [np.zeros(0, np.uint8)]))
    symbol = np.ones(256, np.int64)
    symbol[seen] = np.arange(2, len(seen) + 2)
    n_letters, n_lang = len(seen) + 2, max(1, len(languages))
    pad = np.zeros(order, np.int64)
    streams = {lang: (np.concatenate([x for a in raw[lang] for x in (pad, symbol[a])] or [pad])) for lang in languages}
    real = {lang: (np.concatenate([x for a in raw[lang] for x in (pad, np.ones(len(a), np.int64))] or [pad])).astype(bool) for lang in languages}
    rows = {lang: np.zeros(len(streams[lang]), np.int64) for lang in languages}
    # The uniform order is over all 256 byte values, seen or not.
    above_pairs, above_cost = np.arange(n_letters, dtype=np.int64), np.full((n_letters, n_lang), 8.0)
    bare, orders = np.full((n_letters, n_lang), 8.0), []
    for k in range(order + 1):
        known = np.zeros(0, np.int64)
        if k:
            # Order-k contexts: the letter k places back, under the row of the nearer k - 1 letters.
            keys = {lang: rows[lang] * n_letters + np.concatenate([np.zeros(k, np.int64), streams[lang][:-k]]) for lang in languages}
            known = np.unique(np.concatenate([keys[lang][real[lang]] for lang in languages] or [known]))
            rows = {lang: _index(known, keys[lang]) + 1 for lang in languages}
        counted = {}
        for lang in languages:
            use = real[lang] & ((rows[lang] > 0) if k else True)
            counted[lang] = np.unique(rows[lang][use] * n_letters + streams[lang][use], return_counts=True)
        pairs = np.unique(np.concatenate([p for p, _ in counted.values()] or [np.zeros(0, np.int64)])) if k else np.arange(n_letters, dtype=np.int64)
        escape = np.zeros((len(known) + 1, n_lang))
        parent = np.concatenate([[0], known // n_letters]) if k else np.zeros(1, np.int64)
        # A pair that occurs after a context occurs after the shorter one too.
        cost = above_cost[_index(above_pairs, parent[pairs // n_letters] * n_letters + pairs % n_letters)] if len(pairs) else np.zeros((0, n_lang))
        for j, lang in enumerate(languages):
            pair, n = counted[lang]
            row = pair // n_letters
            total, kinds = np.bincount(row, n, len(escape)), np.bincount(row, minlength=len(escape))
            there = total > 0
            escape[there, j] = np.log2(total[there] + kinds[there]) - np.log2(kinds[there])
            cost[:, j] += escape[pairs // n_letters, j]  # escape, then the shorter context
            cost[_index(pairs, pair), j] = np.log2(total[row] + kinds[row]) - np.log2(n)
        if k:
            orders.append(Order(Places(known), Places(pairs), cost.astype(np.float32), escape.astype(np.float32)))
        else:
            bare = cost
        above_pairs, above_cost = pairs, cost
    return PPM(languages, symbol, bare.astype(np.float32), orders)


def _index(numbers: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Each one's index in the sorted ``numbers``, -1 if it isn't there."""
    if not len(numbers):
        return np.full(len(wanted), -1, np.int64)
    k = np.minimum(np.searchsorted(numbers, wanted), len(numbers) - 1)
    return np.where(numbers[k] == wanted, k, -1)


def window_bits(model: PPM, windows: np.ndarray) -> np.ndarray:
    """(windows, languages): the bits of a letter after its context, both as one number: the letter + letters * (the one before it) + ..."""
    n = model.letters
    letter, rest = windows % n, windows // n
    bits = model.bare[letter]
    at, row = np.arange(len(windows)), np.zeros(len(windows), np.int64)
    for level in model.orders:
        row = level.contexts.find(row * n + rest % n).astype(np.int64) + 1
        known = row > 0  # where the context isn't known, longer ones aren't either
        at, row, rest = at[known], row[known], rest[known] // n
        if not len(row):
            break
        pair = level.pairs.find(row * n + letter[at])
        cost = bits[at] + level.escape[row]
        cost[pair >= 0] = level.cost[pair[pair >= 0]]
        bits[at] = cost
    return bits


class Memo:
    """The bits of windows met before, MEMO of them at most; others are worked out as they come."""

    def __init__(self, model: PPM):
        self.model, self.known = model, np.zeros(0, np.int64)
        self.places, self.costs = Places(self.known), np.zeros((0, len(model.languages)), np.float32)

    def bits(self, windows: np.ndarray) -> np.ndarray:
        at = self.places.find(windows)
        out = self.costs[at] if len(self.costs) else np.zeros((len(windows), self.costs.shape[1]), np.float32)
        lacks = at < 0
        if lacks.any():
            new, back = np.unique(windows[lacks], return_inverse=True)
            costs = window_bits(self.model, new)
            out[lacks] = costs[back]
            if len(self.known) // 8 < len(new) <= MEMO - len(self.known):
                self.known, self.costs = np.concatenate([self.known, new]), np.concatenate([self.costs, costs])
                self.places = Places(self.known)
        return out


def code_lengths(model: PPM, texts: list[str], memo: Memo | None = None) -> np.ndarray:
    """(texts, languages): the bits that each whole text costs."""
    memo = memo or Memo(model)
    out = np.zeros((len(texts), len(model.languages)))
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    n, order = model.letters, len(model.orders)
    at = 0
    while at < len(coded):  # texts are taken together up to CHUNK bytes; a longer one is scored in overlapping pieces
        end, size = at, 0
        while end < len(coded) and (end == at or size + len(coded[end]) <= CHUNK):
            size += len(coded[end])
            end += 1
        for lo in range(0, max(size, 1), CHUNK) if end == at + 1 else (0,):
            if end == at + 1:
                piece, lead = coded[at][max(0, lo - order) : lo + CHUNK], min(lo, order)
                stream = np.concatenate([np.zeros(order - lead, np.int64), model.symbol[np.frombuffer(piece, np.uint8)]])
                live = np.arange(len(stream)) >= order
                owner = np.full(len(stream), at)
            else:
                pad = bytes(order)
                joined = np.frombuffer(pad + pad.join(coded[at:end]), np.uint8)
                lens = np.array([len(c) for c in coded[at:end]])
                owner = np.repeat(np.arange(at, end), lens + order)
                first = np.repeat(np.cumsum(lens + order) - lens - order, lens + order)
                live = np.arange(len(joined)) - first >= order
                stream = np.where(live, model.symbol[joined], 0)
            if not live.any():
                continue
            window = stream.copy()
            for k in range(1, order + 1):
                window[k:] += stream[:-k] * n**k
            bits = np.zeros((len(stream), len(model.languages)), np.float32)
            bits[live] = memo.bits(window[live])
            for j in range(len(model.languages)):
                out[:, j] += np.bincount(owner, bits[:, j], len(texts))
        at = end
    return out


def predict(model: PPM, texts: list[str], memo: Memo | None = None) -> tuple[list[str], np.ndarray]:
    """Each text's language and its posterior probability under equal priors; ties go to the first by name."""
    bits = code_lengths(model, texts, memo)
    best = bits.argmin(axis=1)
    odds = np.exp2(-np.minimum(bits - bits.min(axis=1, keepdims=True), 1000))
    return [model.languages[k] for k in best], 1 / odds.sum(axis=1)


def fit(docs: DataFrame, folds: int = 5, bound: int = TRAIN_DOCS, order: int = ORDER) -> PPM:
    """Learn from rows with a language and a text whose crc32(doc_id) mod ``folds`` isn't 0: ``bound`` texts of each
    language at most (about), drawn by a hash of doc_id."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != 0))
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    drawn = F.lit(False)
    for lang, n in sorted(sizes.items()):
        drawn = drawn | ((F.col("lang") == lang) & (uniform(F.col("doc_id")) < min(1.0, bound / n)))
    texts: dict[str, list[str]] = {lang: [] for lang in sizes}
    for r in sorted(known.where(drawn).select("doc_id", "lang", "text").collect()):
        texts[r.lang].append(r.text)
    return train({k: v for k, v in texts.items() if v}, order)


def identify(docs: DataFrame, model: PPM, text: str = "text"):
    """A struct column (lang, score). Null texts and those without a letter, and all texts if nothing could be
    learned, are ``und`` with score 0. No shuffle."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        memo = Memo(model)
        for s in batches:
            texts = ["" if t is None else t for t in s]
            some = [any(map(str.isalpha, t)) and bool(model.languages) for t in texts]
            lang, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            if any(some):
                got, p = predict(model, [t for t, k in zip(texts, some, strict=True) if k], memo)
                lang[some], score[some] = got, p
            yield pd.DataFrame({"lang": lang, "score": score})

    return run(F.col(text))


def op6_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs)
    found = docs.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), identify(docs, model).alias("_f"))
    return found.select("doc_id", "held_out", F.col("_f.lang").alias("lang_pred"), F.col("_f.score").alias("score"))
