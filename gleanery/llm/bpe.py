"""BPE encoding and decoding with a lexicon compiled into a minimal acyclic transducer.

The corpus's most frequent words are merged once, on the driver, and compiled into an automaton whose states share both
prefixes and suffixes. Every edge carries the number of words that sort before those it leads to, so a word's walk
adds up to its rank, and the rank finds its ids. The arrays are written to one file that each worker maps into memory.
Words are looked up many at a time, one array step for each byte position; a word that isn't in the lexicon is merged
exactly, by rank and then position. Each worker remembers what it has encoded.

The tokenizer file is read as the tokenizers library reads it: NFC, white space to one space, lower case, a split into
contractions, letters, single digits and other signs, byte-level letters, ``</w>`` on the last, no decoder. The special tokens'
strings in a text are the special tokens. Where the library's Unicode tables are older or newer than Python's, its own hold.

Null and empty texts have no ids. Texts are taken together up to PIECE code points, and a longer one goes piece by piece, cut at white
space, so memory is bounded by a piece and the cache besides the text itself. Rows that repeat come out as often as they go in; the result is
a column, so no name of an input column can clash with it.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import struct
import tempfile
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import small_batches, table
from gleanery.session import cut

#: Words in the lexicon at most, and how often a word must occur to be one.
LEXICON_WORDS, MIN_COUNT = 100_000, 4
#: Words that a worker remembers, and code points that it takes at once (more only for one run without white space).
CACHE_WORDS, PIECE = 400_000, 1 << 18
TOKENIZER = "word_bpe_49k.json"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable, else the next free one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = [""] * 256, 256
    for b in range(256):
        out[b] = chr(b) if b in own else chr(free)
        free += b not in own
    return out


@dataclass
class Rules:
    """What a tokenizer file says: vocabulary, merge ranks, word pattern and special tokens."""

    vocab: dict[str, int]
    ranks: dict[tuple[str, str], int]
    pattern: str
    end: str
    special: dict[str, int]

    @classmethod
    def load(cls, path: str) -> Rules:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, (split, level) = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] or level["type"] != "ByteLevel" or model["unk_token"]:
            raise ValueError(f"{path} isn't a word-level BPE with NFC, one space, lower case and no decoder")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or not t["content"] or t["content"].split() != [t["content"]] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has added tokens that match by more than their own string")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        return cls(model["vocab"], {m: k for k, m in enumerate(merges)}, split["pattern"]["Regex"], model["end_of_word_suffix"] or "", {t["content"]: t["id"] for t in spec["added_tokens"]})


class Merger:
    """Exact merges of one word, the pair of least rank first and the leftmost of equals. Pairs are whole numbers made of two ids, and what a pair gives is its rank
    followed by the id of the two together, so that the least is the next to be merged."""

    def __init__(self, rules: Rules):
        vocab, letters = rules.vocab, byte_letters()
        self.bits = max(vocab.values(), default=1).bit_length()
        self.first = [vocab.get(x, -1) for x in letters]
        self.last = [vocab.get(x + rules.end, -1) for x in letters]
        self.complete = min(self.first + self.last) >= 0
        self.pairs = {vocab[x] << self.bits | vocab[y]: rank << self.bits | vocab[x + y] for (x, y), rank in rules.ranks.items()}
        self.none = (len(rules.ranks) + 1) << self.bits

    def __call__(self, word: str) -> list[int]:
        coded = word.encode("utf-8", "surrogatepass")
        if not coded:
            return []
        ids = [self.first[b] for b in coded]
        ids[-1] = self.last[coded[-1]]
        if not self.complete:
            ids = [i for i in ids if i >= 0]
        if len(ids) > 48:
            return self._long(ids)
        get, none, bits, mask = self.pairs.get, self.none, self.bits, (1 << self.bits) - 1
        near = [get(a << bits | b, none) for a, b in zip(ids, ids[1:], strict=False)]  # what each gives with the next
        while near and (least := min(near)) != none:
            k = near.index(least)
            ids[k] = new = least & mask
            del ids[k + 1], near[k]
            if k < len(near):
                near[k] = get(new << bits | ids[k + 1], none)
            if k:
                near[k - 1] = get(ids[k - 1] << bits | new, none)
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        pairs, bits, mask, n = self.pairs, self.bits, (1 << self.bits) - 1, len(ids)
        nxt, prev, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(pairs[p], k, p) for k, p in enumerate(a << bits | b for a, b in zip(ids, ids[1:], strict=False)) if p in pairs]
        heapq.heapify(heap)
        while heap:
            gives, k, pair = heapq.heappop(heap)
            j = nxt[k] if alive[k] else n
            if j >= n or ids[k] << bits | ids[j] != pair:
                continue
            ids[k] = gives & mask
            alive[j] = False
            nxt[k] = nxt[j]
            if nxt[k] < n:
                prev[nxt[k]] = k
            for a, b in ((prev[k], k), (k, nxt[k])):
                if a >= 0 and b < n and (p := ids[a] << bits | ids[b]) in pairs:
                    heapq.heappush(heap, (pairs[p], a, p))
        return [i for i, live in zip(ids, alive, strict=True) if live]


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """The minimal automaton of the words with their ids, as one block of bytes: a header of lengths, then int32 arrays.

    Words are added in order; once a word leaves a branch, the branch's states are merged with equal ones from the
    bottom up, so equal suffixes are stored once."""
    ordered = sorted(w for w in words if w)
    edges: list[dict[int, int]] = [{}]
    final = [False]
    register: dict[tuple, int] = {}
    path: list[tuple[int, int, int]] = []  # (parent, byte, child) of the word added last

    def settle(depth: int) -> None:
        while len(path) > depth:
            parent, byte, child = path.pop()
            sign = (final[child], tuple(edges[child].items()))
            edges[parent][byte] = register.setdefault(sign, child)

    before = b""
    for w in ordered:
        common = len(os.path.commonprefix([before, w]))
        settle(common)
        at = path[-1][2] if path else 0
        for byte in w[common:]:
            edges.append({})
            final.append(False)
            edges[at][byte] = len(edges) - 1
            path.append((at, byte, len(edges) - 1))
            at = len(edges) - 1
        final[at] = True
        before = w
    settle(0)
    number, todo = {0: 0}, [0]
    while todo:  # the states that are left, numbered anew
        for child in edges[todo.pop()].values():
            if child not in number:
                number[child] = len(number)
                todo.append(child)
    below: dict[int, int] = {}

    def count(state: int) -> int:
        stack = [state]
        while stack:
            s = stack[-1]
            missing = [c for c in edges[s].values() if c not in below]
            if missing:
                stack += missing
            else:
                below[s] = final[s] + sum(below[c] for c in edges[s].values())
                stack.pop()
        return below[state]

    count(0)
    rows = []
    for state, new in number.items():
        skip = int(final[state])
        for byte, child in sorted(edges[state].items()):
            rows.append((new << 8 | byte, number[child], skip))
            skip += below[child]
    table_ = np.array(sorted(rows), np.int64).reshape(-1, 3)
    finals = np.zeros(len(number), np.int64)
    finals[[new for s, new in number.items() if final[s]]] = 1
    ids = [words[w] for w in ordered]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])
    arrays = [table_[:, 0], table_[:, 1], table_[:, 2], finals, offsets, np.array([i for x in ids for i in x], np.int64)]
    head = np.array([len(a) for a in arrays], np.int32)
    return head.tobytes() + b"".join(a.astype("<i4").tobytes() for a in arrays)


class Lexicon:
    """A compiled lexicon, mapped into memory."""

    def __init__(self, block: bytes):
        with tempfile.NamedTemporaryFile(prefix="lexicon-") as f:
            f.write(block)
            f.flush()
            data = np.memmap(f.name, "<i4", "r")  # the map outlives the name
        lens, at, parts = data[:6], 6, []
        for n in lens:
            parts.append(data[at : at + int(n)])
            at += int(n)
        self.keys, self.target, self.skip, self.final, self.offset, self.ids = parts

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """Each word's rank, -1 for words that aren't here. One array step for each byte position."""
        n = len(words)
        lens = np.fromiter(map(len, words), np.int64, n)
        state, rank = np.zeros(n, np.int64), np.zeros(n, np.int64)
        rank[lens == 0] = -1
        if not len(self.keys):
            return np.full(n, -1, np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(lens) - lens
        live, pos = np.nonzero(lens > 0)[0], 0
        while len(live):
            key = state[live] << 8 | flat[start[live] + pos]
            k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[k] == key
            rank[live[~found]] = -1
            live, k = live[found], k[found]
            state[live] = self.target[k]
            rank[live] += self.skip[k]
            pos += 1
            done = lens[live] == pos
            ended = live[done]
            rank[ended[self.final[state[ended]] == 0]] = -1
            live = live[~done]
        return rank


#: Words of texts without other numerals, odd controls or code points past Latin: what the standard library's tables agree on with the pattern's.
PLAIN = re.compile(r"[^\x00-\x1b\x20-\u00b1\u00b4-\u00b8\u00ba\u00bb\u00bf-\u024f]")
#: Of these code points, those whose small letters are not among them.
LEAVING = re.compile(f"[{''.join(c for c in map(chr, range(0x250)) if PLAIN.search(c) is None and PLAIN.search(c.lower()))}]")
PLAIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _class(ranges: str) -> str:
    return "".join(f"\\U{int(a, 16):08x}-\\U{int(b or a, 16):08x}" for a, _, b in (r.partition("-") for r in ranges.split()))


# What the tokenizers library's Unicode tables have otherwise than Python's or the regex module's.
#: Letters and numbers to Unicode after version 16, neither to the library's patterns.
LATER = _class(
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a "
    "11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 "
    "18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed "
    "1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"
)
#: Marks of Unicode after version 9, which the library's NFC neither orders nor composes, and the one letter composed of such.
MARKS = _class(
    "7fd 898-89f 8ca-8d3 9fe c3c d3b-d3c eba 1715 1abf-1ace 1df6-1dfa a82c 10d24-10d27 10eab-10eac 10efd-10eff 10f46-10f50 10f82-10f85 11070 1133b 1145e "
    "11839-1183a 11930 11938 1193d-1193e 11943 119e0 11a34 11a47 11a99 11d42 11d44-11d45 11d97 11f41-11f42 16ff0-16ff1 1e08f 1e130-1e136 1e2ae 1e2ec-1e2ef "
    "1e4ec-1e4ef"
)
#: Capitals that Python's tables of Unicode 15 lack: first, last, small letter of the first.
CAPITALS = ((0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2, 0xA7D3), (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B), (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB))
_ODD = re.compile(f"[{LATER}{MARKS}{''.join(f'{chr(a)}-{chr(b)}' for a, b, _ in CAPITALS)}]")
_MARK = re.compile(f"([{MARKS}])")
_SMALL = {c: small + c - a for a, b, small in CAPITALS for c in range(a, b + 1)}


def nfc(text: str) -> str:
    """NFC by the library's tables: marks that they lack part what is normalised."""
    return "".join([x if k % 2 else unicodedata.normalize("NFC", x) for k, x in enumerate(_MARK.split(text))])


class Encoder:
    def __init__(self, rules: Rules, block: bytes):
        self.rules, self.lexicon, self.merge = rules, Lexicon(block), Merger(rules)
        self.find = regex.compile(rules.pattern).findall
        old = "".join(f"[{p}--[{LATER}]]" if p in (r"\p{L}", r"\p{N}") else p for p in re.split(r"(\\p\{[LN]\})", rules.pattern))
        self.find_old = regex.compile(old, regex.V1).findall  # the pattern by the library's tables
        self.quick = PLAIN_WORDS.findall if rules.pattern == PATTERN else None
        self.tokens = {i: t for t, i in rules.vocab.items()} | {i: t for t, i in rules.special.items()}
        self.special = regex.compile("|".join(map(regex.escape, sorted(rules.special, key=len, reverse=True)))) if rules.special else None
        self.known: dict[str, tuple[bytes, str]] = {}  # word -> (its ids in bytes, its decoded form)

    def words(self, text: str) -> list[str]:
        """The text's words, special tokens as they are (no word of the pattern can be one)."""
        if self.special is None or not any(s in text for s in self.rules.special):
            return self._plain(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += self._plain(text[at : m.start()]) + [m[0]]
            at = m.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[str]:
        if PLAIN.search(text) is None:  # neither odd, to be composed nor of other classes
            quick = self.quick is not None and (text.isascii() or LEAVING.search(text) is None)
            return (self.quick if quick else self.find)(text.lower())
        find = self.find
        if not text.isascii():
            if odd := _ODD.search(text):
                text, find = nfc(text), self.find_old
            else:
                text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # letters are lowered one by one: no final form
                text = text.replace("Σ", "σ")
            if odd:
                text = text.translate(_SMALL)
        text = text.lower()
        return self.quick(text) if self.quick and PLAIN.search(text) is None else find(text)

    def learn(self, new: list[str]) -> None:
        ranks = self.lexicon.ranks([w.encode("utf-8", "surrogatepass") for w in new])
        tokens, special = self.tokens, self.rules.special
        for w, r in zip(new, ranks.tolist(), strict=True):
            if r >= 0:
                packed = self.lexicon.ids[self.lexicon.offset[r] : self.lexicon.offset[r + 1]]
                ids, packed = packed.tolist(), packed.tobytes()
            else:
                ids = [special[w]] if w in special else self.merge(w)
                packed = struct.pack(f"<{len(ids)}I", *ids)
            self.known[w] = packed, " ".join([tokens[i] for i in ids])

    def batch(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of each text."""
        near, size = [], 0
        for t in texts:
            if near and size + len(t) > PIECE:
                yield from self._encode(near)
                near, size = [], 0
            if len(t) > PIECE:
                ids, shown = zip(*[x for piece in pieces(t, PIECE) for x in self._encode([piece])], strict=True)
                yield b"".join(ids), " ".join([x for x in shown if x])
            else:
                near.append(t)
                size += len(t)
        yield from self._encode(near)

    def _encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        words = [self.words(t) for t in texts]
        all_ = set()
        for w in words:
            all_.update(w)
        new = all_.difference(self.known)
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known, new = {}, all_
        self.learn(list(new))
        known = self.known
        for w in words:
            pairs = [known[x] for x in w]
            yield b"".join([p[0] for p in pairs]), " ".join([p[1] for p in pairs if p[1]])


def pieces(text: str, size: int) -> Iterator[str]:
    """The text in parts of at most ``size`` code points, each but the last ending in a space or line break; a longer run without
    any is one part. No word, special token or composed letter reaches over such a place."""
    lo = 0
    while len(text) - lo > size:
        end = max(text.rfind(" ", lo, lo + size), text.rfind("\n", lo, lo + size))
        if end < 0:
            far = [k for k in (text.find(" ", lo + size), text.find("\n", lo + size)) if k >= 0]
            if not far:
                break
            end = min(far)
        yield text[lo : end + 1]
        lo = end + 1
    yield text[lo:]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(rules: Rules, block: bytes) -> Encoder:
    """The worker process's encoder for a lexicon: what one task has learned serves the next."""
    key = hashlib.sha256(block).hexdigest() + str(len(rules.vocab))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(rules, block)
    return _ENCODERS[key]


def decode(rules: Rules, ids: list[int]) -> str:
    """The text of ids as decode(ids, skip_special_tokens=False) has it: without a decoder, tokens joined by spaces."""
    tokens = {i: t for t, i in rules.vocab.items()} | {i: t for t, i in rules.special.items()}
    return " ".join(tokens[i] for i in ids if i in tokens)


def frequent_words(docs: DataFrame, limit: int = LEXICON_WORDS) -> list[str]:
    """The ``limit`` most frequent runs of letters in all lower-cased texts, MIN_COUNT times at least: a lexicon that only
    saves time, so that a word's form here may differ from the encoder's. Counts combine before the one shuffle."""
    runs = docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("w"))
    counted = cut(runs.where("w <> ''").groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT))
    # How many words there are for each count's leading bits tells the count to start from, so that no task sends more than its share.
    step = F.when(F.col("n") < 64, F.col("n")).otherwise(F.expr("cast(64 * pow(1.05, floor(ln(n / 64.0) / ln(1.05))) as bigint)"))
    least, total = None, 0
    for r in sorted(counted.groupBy(step.alias("s")).count().collect(), reverse=True):
        if total + r["count"] > limit:
            break
        least, total = r.s, total + r["count"]
    return sorted(r.w for r in counted.where(step >= least).select("w").collect()) if least is not None else []


def encode(docs: DataFrame, path: str | None = None, text: str = "text"):
    """A struct column (n_tokens, ids_sha256, decoded_sha256) over each whole text; null counts as empty. No shuffle but
    for the word counts."""
    small_batches(docs.sparkSession)
    rules = Rules.load(path or default_path())
    merge = Merger(rules)
    block = compile_lexicon({w.encode(): merge(w) for w in frequent_words(docs)})
    shared = docs.sparkSession.sparkContext.broadcast((rules, block))

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(*shared.value)
        sha = hashlib.sha256
        for s in batches:
            got = [(len(ids) // 4, sha(ids).hexdigest(), sha(shown.encode("utf-8", "surrogatepass")).hexdigest()) for ids, shown in encoder.batch(["" if t is None else t for t in s])]
            yield pd.DataFrame(got, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return run(F.col(text))


def op5_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", encode(docs).alias("e")).select("doc_id", "e.n_tokens", "e.ids_sha256", "e.decoded_sha256")
