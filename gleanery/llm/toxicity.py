"""Toxicity: a weighted lexicon matched by one Aho-Corasick automaton over folded text.

Folding undoes disguise: compatibility forms and accents, look-alike letters of other scripts, and digits or
signs that stand for letters (``1``, ``i`` and ``l`` become one class). Exception phrases are matched by the same
automaton and cancel the lexicon hits that they cover. The weights of the hits left, divided by a power of the
text's length in words, go through a logistic curve to give the score.

Entries are words, phrases and beginnings of words, so that an ending never seen is still a hit. Lexicon, weights, exceptions and curve are learned from a bounded sample of labelled rows; with no labels a
short built-in lexicon is used. Labelled rows that repeat a text count once.

Null and empty texts, and those without words, get the score of no hits, which an empty table of documents has none of. Long texts are matched whole, in time in
proportion. Rows that repeat come out as often as they go in, with equal scores. The score is a column, so no name can clash.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import fold as id_fold
from gleanery.llm.common import labelled_sample, small_batches, table

#: Labelled documents that learning may draw at most (about): the documented bound of its sample.
TRAIN_DOCS = 6000
#: A lexicon word needs so many different preceding words in toxic rows, and this log odds ratio at least.
MIN_CONTEXTS, MIN_LOG_ODDS = 5, 2.5
#: Letters of a beginning that counts as an entry, and the different words that must share it; parts into which the rows are dealt to fit the curve.
MIN_STEM, MAX_STEM, MIN_ENDINGS, CROSS = 4, 12, 3, 3
THRESHOLD = 0.7
BUILT_IN = ("idiot", "moron", "stupid", "scum", "loser", "pathetic", "worthless", "disgusting")
BUILT_IN_EXCEPTIONS = ("not stupid", "not an idiot", "idiot proof", "stupid simple")

# Look-alikes: Cyrillic, Greek, Armenian and Latin letters without a decomposition, by the ASCII letter they resemble.
LOOKALIKES = {
    "a": "аαɑ", "b": "ьβв", "c": "сϲç", "d": "ԁɗđ", "e": "еεєəё", "g": "ɡց", "h": "һհ", "i": "іιıӏ", "j": "јϳ", "k": "кκ", "m": "мʍ",
    "n": "ոпη", "o": "оοσօø", "p": "рρ", "q": "ԛ", "r": "гɾ", "s": "ѕꜱ", "t": "тτŧ", "u": "υսμ", "v": "νѵ", "w": "ԝωш", "x": "хχ", "y": "уγү", "z": "ᴢ",
}
DIGITS = {"0": "o", "1": "i", "l": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"!": "i", "|": "i", "$": "s", "@": "a", "€": "e"}
_SIGN = re.compile(r"[!|$@€](?=[^\W_])")


class _Table(dict):
    """Code point to folded text, worked out when first met: letters stay, marks go, all else is a space."""

    def __missing__(self, c: int) -> str:
        ch = chr(c)
        got = ch if ch.isalnum() else "" if unicodedata.combining(ch) or unicodedata.category(ch) == "Cf" else " "
        self[c] = got
        return got


_TABLE = _Table({ord(x): k for k, v in LOOKALIKES.items() for x in v} | {ord(k): v for k, v in DIGITS.items()})
for _k in list(_TABLE):  # look-alikes of l and i end in the same class
    _TABLE[_k] = DIGITS.get(_TABLE[_k], _TABLE[_k])


def fold_text(text: str) -> str:
    """Folded words, each preceded and the last followed by one space."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
    text = text.lower()
    if any(s in text for s in SIGNS):
        text = _SIGN.sub(lambda m: SIGNS[m[0]], text)
    words = text.translate(_TABLE).split()
    return f" {' '.join(words)} " if words else " "


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    power: float = 0.5
    slope: float = 4.0
    intercept: float = -4.0


def entry(w: str) -> str:
    """What the automaton looks for: a folded word or phrase with its spaces, of a beginning (``stem*``) the space before it only."""
    return fold_text(w[:-1]).rstrip() if w.endswith("*") else fold_text(w)


class Matcher:
    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.automaton = ahocorasick.Automaton()
        for w, weight in lexicon.weights.items():
            self.automaton.add_word(entry(w), (len(entry(w)), weight))
        for phrase in lexicon.exceptions:
            self.automaton.add_word(fold_text(phrase), (len(fold_text(phrase)), None))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def mass(self, text: str | None) -> tuple[float, int]:
        """(sum of the weights of hits that no exception covers, number of words). Of entries that begin at one place the greatest weight counts."""
        folded = fold_text(text or "")
        words = folded.count(" ") - 1
        if self.empty or words < 1:
            return 0.0, max(words, 0)
        hits, excused = [], []
        for end, (n, weight) in self.automaton.iter(folded):
            (hits if weight is not None else excused).append((end - n + 1, end, weight))
        best: dict[int, float] = {}
        for start, _, weight in _uncovered(hits, excused) if excused else hits:
            best[start] = max(weight, best.get(start, weight))
        return sum(best.values()), words

    def score(self, text: str | None) -> float:
        mass, words = self.mass(text)
        return curve(self.lexicon, mass, words)


def _uncovered(hits: list[tuple], excused: list[tuple]) -> list[tuple]:
    """The hits (start, end, weight) that no excused span covers, in one sweep: the farthest end of the spans that start at a hit's start or
    before tells whether one covers it."""
    hits, excused = sorted(hits), sorted(excused, key=lambda e: e[0])
    out, far, k = [], -1, 0
    for h in hits:
        while k < len(excused) and excused[k][0] <= h[0]:
            far = max(far, excused[k][1])
            k += 1
        if h[1] > far:
            out.append(h)
    return out


def curve(lex: Lexicon, mass: float, words: int) -> float:
    z = lex.intercept + lex.slope * math.log1p(mass / max(words, 1) ** lex.power)
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def learn(sample: list[tuple[str, int]]) -> Lexicon:
    """Weights from all rows; power and curve from masses that rows get by weights learned without them (CROSS parts), so that rows seen don't look surer than
    others. Rows of only one label give the built-in lexicon."""
    seen: set[str] = set()
    rows = [(fold_text(t), y) for t, y in sample if not (t in seen or seen.add(t))]
    if len({y for _, y in rows}) < 2:
        return Lexicon({fold_text(w).strip(): 2.0 for w in BUILT_IN}, list(BUILT_IN_EXCEPTIONS))
    found: list[tuple[float, int, int]] = []
    for part in range(CROSS):
        matcher = Matcher(weigh([r for k, r in enumerate(rows) if k % CROSS != part]))
        found += [(*matcher.mass(text), y) for text, y in rows[part::CROSS]]
    return _fitted(weigh(rows), found)


def weigh(rows: list[tuple[str, int]]) -> Lexicon:
    """Entries, weights and exceptions from folded texts. A word's weight is its smoothed log odds ratio. It counts once for each different preceding word, so
    copies of one text don't make its words look typical. A beginning that words of toxic rows share is an entry likewise (``stem*``) if it counts for more than
    its own beginnings; a word is one if it counts for more than those. Words of clean rows are counted only if toxic rows
    make them candidates: the driver's memory stays near the sample's size."""
    stems_of = lambda w: [f"{w[:n]}*" for n in range(MIN_STEM, min(len(w), MAX_STEM + 1))]
    size = [0, 0]
    toxic: dict[str, set[str]] = defaultdict(set)
    for text, y in rows:
        words = text.split()
        size[y] += len(words)
        for prev, w in zip(["", *words], words, strict=False) if y else ():
            toxic[w].add(prev)
    stems: dict[str, set[str]] = defaultdict(set)
    endings: Counter = Counter()
    for w, before in toxic.items():
        for stem in stems_of(w):
            stems[stem] |= before
            endings[stem] += 1
    candidates = {w: len(c) for w, c in toxic.items() if len(c) >= MIN_CONTEXTS}
    candidates |= {w: len(c) for w, c in stems.items() if len(c) >= MIN_CONTEXTS and endings[w] >= MIN_ENDINGS}
    del toxic, stems
    clean: dict[str, set[str]] = {w: set() for w in candidates}
    # More contexts in clean rows than these, and an entry fails the test whatever follows: it needn't be followed on.
    most = {w: (n + 0.5) * (size[0] + 1) / (size[1] + 1) / math.exp(MIN_LOG_ODDS) - 0.5 for w, n in candidates.items()}
    vocabulary: set[str] = set()
    for text, _ in rows:
        vocabulary.update(text.split())
    known = {w: own for w in vocabulary if (own := [k for k in (w, *stems_of(w)) if k in clean])}  # of each word, what it counts for
    failed: set[str] = set()
    for text, y in rows:
        if not y:
            words = text.split()
            for prev, w in [(prev, w) for prev, w in zip(["", *words], words, strict=False) if w in known]:
                own = known[w]
                for k in own:
                    clean[k].add(prev)
                    if len(clean[k]) > most[k]:
                        failed.add(k)
                if not failed.isdisjoint(own):
                    known[w] = [k for k in own if k not in failed]
    odds = {w: math.log((n + 0.5) / (size[1] + 1)) - math.log((len(clean[w]) + 0.5) / (size[0] + 1)) for w, n in candidates.items() if w not in failed}
    del clean, known
    weights: dict[str, float] = {}
    for w in sorted((w for w in odds if odds[w] >= MIN_LOG_ODDS), key=lambda w: (not w.endswith("*"), len(w), w)):
        stem = w.removesuffix("*")
        if odds[w] > max((weights.get(f"{stem[:n]}*", 0.0) for n in range(MIN_STEM, len(stem))), default=0.0):
            weights[w] = odds[w]
    weights = weights or {fold_text(w).strip(): 2.0 for w in BUILT_IN}
    # A neighbour pair that holds a lexicon word, recurs in clean rows and never occurs in toxic ones excuses the word.
    pairs: tuple[Counter, Counter] = (Counter(), Counter())
    listed = {w for w in vocabulary if w in weights or any(f"{w[:n]}*" in weights for n in range(MIN_STEM, len(w) + 1))}
    for text, y in rows:
        words = text.split()
        if not listed.isdisjoint(words):
            pairs[y].update({f"{a} {b}" for a, b in zip(words, words[1:], strict=False) if a in listed or b in listed})
    return Lexicon(weights, sorted([p for p, n in pairs[0].items() if n >= 3 and p not in pairs[1]] + list(BUILT_IN_EXCEPTIONS)))


def _fitted(lexicon: Lexicon, found: list[tuple[float, int, int]]) -> Lexicon:
    """The lexicon with the power and the logistic curve that fit (mass, words, label) best."""
    best = None
    y = np.array([f[2] for f in found], float)
    for power in (0.0, 0.25, 0.5, 0.75, 1.0):
        x = np.array([math.log1p(m / max(n, 1) ** power) for m, n, _ in found])
        scale = x[y == 1].mean() or 1.0
        a, b = -2.0, 4.0
        for _ in range(40):  # Newton's method on the ridge-penalised logistic loss
            p = 1 / (1 + np.exp(-(a + b * x / scale)))
            g = np.array([(p - y).sum() + 0.01 * a, ((p - y) * x / scale).sum() + 0.01 * b])
            v = p * (1 - p)
            h = np.array([[v.sum() + 0.01, (v * x / scale).sum()], [(v * x / scale).sum(), (v * (x / scale) ** 2).sum() + 0.01]])
            step = np.linalg.solve(h, g)
            a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
        p = np.clip(1 / (1 + np.exp(-(a + b * x / scale))), 1e-9, 1 - 1e-9)
        loss = -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()
        if best is None or loss < best[0] - 1e-9:
            best = loss, power, b / scale, a
    _, power, slope, intercept = best
    return Lexicon(lexicon.weights, lexicon.exceptions, power, float(slope), float(intercept))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, bound: int = TRAIN_DOCS) -> Lexicon:
    """Learn from labelled rows whose crc32(doc_id) mod ``folds`` isn't ``held``, ``bound`` of them at most (about)."""
    return learn(labelled_sample(docs, labels, "toxic", id_fold(F.col("doc_id"), folds) != held, bound))


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text"):
    """A column with the toxicity of each whole text, 0 to 1; null and empty texts get that of no hits.
    Rows are scored where they lie: no shuffle."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(shared.value)
        for s in batches:
            yield pd.Series([matcher.score(t) for t in s], dtype="float64")

    return run(F.col(text))


def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = fit(docs, table(spark, sf_dir, "labels"))
    out = docs.select("doc_id", (id_fold(F.col("doc_id"), 3) == 1).alias("held_out"), score(docs, lexicon).alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
