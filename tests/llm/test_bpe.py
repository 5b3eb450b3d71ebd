import hashlib
import random

import numpy as np
import pytest

from gleanery.llm import bpe as B

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def rules():
    return B.Rules.load(B.default_path())


@pytest.fixture(scope="module")
def theirs():
    return tokenizers.Tokenizer.from_file(B.default_path())


TEXTS = [
    "", " ", "Hello  World's 12 é\n!! ñ", "a<|endoftext|>b  <|startoftext|> C", "<|endoftext|><|endoftext|>", "<|endoftext", "İstanbul ǅ ﬁ 中文 👍🏽 naïvé",
    " x​z \x00 q\x1c\x1fr\x85s\xa0t", "ΟΔΥΣΣΕΥΣ ΣΑΣ Σ.", "éä Å", "it's we'll I'd they've I'm 'S 'Re", "1234.5e-7 ½ ² Ⅷ", "x" * 500, "aaaaabbbbb" * 300, "ſ K Å ẞ straße", "﻿bom   　 tab\tx",
    "don''t ''s 're's", "עברית عربى ไทย हिन्दी", "a_b __ -- ... ,,, $%^&*() 5€",
]


def test_encoder_equals_the_library(rules, theirs):
    rng = random.Random(4)
    alphabet = "abcdefgh ABC'st dé ñß 12\n\t<|>._-Σσς中👍́İ"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 120))) for _ in range(400)]
    assigned = lambda t: "".join(c for c in t if __import__("unicodedata").category(c) != "Cn")
    texts += [assigned("".join(chr(rng.choice([rng.randrange(0x20, 0x250), rng.randrange(0x370, 0x700), rng.randrange(0x1E00, 0x2200)])) for _ in range(40))) for _ in range(300)]
    merge = B.Merger(rules)
    block = B.compile_lexicon({w.encode(): merge(w) for w in ["hello", "world", "he", "hell", "naïvé", "abc", "bc"]})
    enc = B.Encoder(rules, block)
    for t, (ids, shown) in zip(texts, enc.batch(texts), strict=True):
        want = theirs.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, t
        assert shown == theirs.decode(want, skip_special_tokens=False) == B.decode(rules, want), t


def test_lexicon_is_minimal_and_exact():
    rng = random.Random(1)
    words = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))).encode(): [k, k + 1] for k in range(700)}
    lex = B.Lexicon(B.compile_lexicon(words))
    asked = [*words, b"", b"zzz", b"abcabcabcabc", b"a" * 30, *(w + b"x" for w in list(words)[:20]), *(w[:-1] for w in words)]
    for w, r in zip(asked, lex.ranks(asked), strict=True):
        got = lex.ids[lex.offset[r] : lex.offset[r + 1]].tolist() if r >= 0 else None
        assert got == words.get(w)
    # as many states as there are different sets of suffixes
    tails = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in {w[:k] for w in words for k in range(len(w) + 1)}}
    assert len(lex.final) == len(tails)
    assert B.Lexicon(B.compile_lexicon({})).ranks([b"a", b""]).tolist() == [-1, -1]


def test_query_on_odd_rows(spark, theirs):
    rows = [(k, t) for k, t in enumerate(TEXTS * 2)] + [(None, "no id"), (99, None), (99, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = df.select("text", B.encode(df).alias("e")).select("text", "e.*").collect()
    assert len(got) == len(rows)
    for r in got:
        e = theirs.encode(r.text or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(theirs.decode(e, skip_special_tokens=False).encode()).hexdigest()
    assert df.limit(0).select(B.encode(df.limit(0))).count() == 0


def test_every_code_point_has_the_library_s_class_case_and_normal_form(rules, theirs):
    enc = B.Encoder(rules, B.compile_lexicon({}))
    rng = random.Random(8)
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3100 or B._ODD.match(chr(c)) or rng.random() < 0.02)]
    texts = [f"a{chr(c)}{chr(c)}̖! x{chr(c)}" for c in points]
    odd = [chr(c) for c in points if B._ODD.match(chr(c))]
    texts += ["".join(rng.choice([rng.choice(odd), chr(rng.randrange(0x300, 0x370)), rng.choice("aΣ 1'é"), chr(rng.randrange(0x20, 0x3000))]) for _ in range(20)) for _ in range(3000)]
    for t, (ids, shown), e in zip(texts, enc.batch(texts), theirs.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == e.ids, ascii(t)
        assert shown == theirs.decode(e.ids, skip_special_tokens=False), ascii(t)


def test_long_texts_go_in_pieces_within_the_cache_s_bound(rules, theirs, monkeypatch):
    monkeypatch.setattr(B, "PIECE", 200)
    monkeypatch.setattr(B, "CACHE_WORDS", 50)
    rng = random.Random(3)
    long = "".join(rng.choice("abc  \n̖é<|endoftext|>") for _ in range(5000)) + "x" * 700 + " y's<|endoftext|>"
    texts = ["", long, "short one", long[:150], " " * 500, "z" * 500]
    enc = B.Encoder(rules, B.compile_lexicon({}))
    for t, (ids, shown) in zip(texts, enc.batch(texts), strict=True):
        want = theirs.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert shown == theirs.decode(want, skip_special_tokens=False)
        assert len(enc.known) <= 50 + 200
    assert "".join(B.pieces(long, 200)) == long


def test_clashing_names_stay(spark):
    df = spark.createDataFrame([(1, "a b", 5, "t")], "doc_id long, text string, e int, n_tokens string")
    got = df.select("*", B.encode(df).alias("_x")).first()
    assert (got.e, got.n_tokens, got._x.n_tokens) == (5, "t", 2)
