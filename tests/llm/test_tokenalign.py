"""Token alignment against whole-text encodings by both libraries."""

import hashlib
import json
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gleanery.llm import tokenalign
from gleanery.llm.bpe import byte_letters

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    import sentencepiece
    from tokenizers import Tokenizer

    paths = tokenalign.default_paths()
    a = Tokenizer.from_file(paths[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=paths[1])
    byte = {c: i for i, c in enumerate(byte_letters())}
    with open(paths[0], encoding="utf-8") as f:
        a_bytes = {i: bytes(byte[c] for c in t) for t, i in json.load(f)["model"]["vocab"].items()}

    def b_bytes(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()

    def spans(parts):
        out, at = [], 0
        for p in parts:
            out.append((at, at := at + len(p)))
        return out

    def one(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        parts = [a_bytes[i] for i in ids[0]], [b_bytes(i) for i in ids[1]]
        if any(b"".join(p) != (" " + text).encode() for p in parts):
            return None
        x, y = map(spans, parts)
        links, j = [], 0
        for i, (start, end) in enumerate(x):
            while y[j][1] <= start:
                j += 1
            k = j
            while k < len(y) and y[k][0] < end:
                links.append((ids[0][i], ids[1][k]))
                k += 1
        groups, both = [], {e for _, e in x} & {e for _, e in y}
        sides = []
        for own, sp in zip(ids, (x, y), strict=True):
            part, side = [], []
            for t, (_, end) in zip(own, sp, strict=True):
                part.append(str(t))
                if end in both:
                    side.append(",".join(part))
                    part = []
            sides.append(side)
        groups = ["|".join(g) for g in zip(*sides, strict=True)]
        return len(ids[0]), len(ids[1]), groups, links

    def all_(texts):
        rows = [one(t) if t else None for t in texts]
        count, most = Counter(), defaultdict(int)
        for r in rows:
            count.update(r[3] if r else [])
        for (_, y), n in count.items():
            most[y] = max(most[y], n)
        return [
            (r[0], r[1], len(r[2]), len(r[3]), sum(count[p] == most[p[1]] for p in r[3]), sum(count[p] for p in r[3]), hashlib.sha256(";".join(r[2]).encode()).hexdigest()) if r else (0, 0, 0, 0, 0, 0, "")
            for r in rows
        ]

    return all_


def found(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r[0]].append(tuple(r[1:]))
    return out


def odd_texts():
    rng = random.Random(5)
    signs = " \t\n\r\x0b 　▁abcABC'sé<>s/|0123é漢\x00\x1c\x85​᠎"
    texts = [None, "", " ", "   ", "\n", " \n a", "a ", "a\n", "<|endoftext|> <s></s> <0x41> <unk>", "a▁b", "x" * 20_000, " " * 20_000 + "y", "word " * 5_000]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(800)]
    texts += ["".join(map(chr, rng.choices(range(0x20, 0x3000), k=20))) for _ in range(300)]
    return texts + [f"a{chr(c)} b{chr(c)}\n{chr(c)}  {chr(c)}" for c in [*range(0x800), *range(0x1600, 0x1900), *range(0x2000, 0x2100), *range(0x2fff, 0x3010), *range(0x3100, 0x110000, 4999)] if not 0xD800 <= c < 0xE000]


@pytest.mark.parametrize("how", [{}, {"limit": 100, "pairs_bound": 10, "least_copies": 1}, {"limit": 0}])
def test_texts_match_both_libraries(spark, plain, how, monkeypatch):
    monkeypatch.setattr(tokenalign, "COUNTED", 500)
    if "least_copies" in how:
        monkeypatch.setattr(tokenalign, "HOT_TEXTS", 10**6)
    docs = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    texts = docs + odd_texts() + docs[:20] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({c: F.lit("x") for c in ("t", "h", "r", "key", "segment", "n")})
    got = found(tokenalign.align_texts(df.repartition(6), **how))
    want = plain(texts)
    assert {k: v for k, v in got.items() if v != [want[k]]} == {} and len(got) == len(texts)


def test_texts_of_one_short_hash_are_told_apart(spark, plain, monkeypatch):
    monkeypatch.setattr(tokenalign, "hash64", lambda t: F.length(t).cast("long"))
    texts = ["one two", "two one", "ene twe", "another text", *["the same again"] * 9]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert found(tokenalign.align_texts(df, limit=0, least_copies=3)) == {k: [v] for k, v in enumerate(plain(texts))}


def test_rows_without_id_and_empty_tables(spark, plain):
    df = spark.createDataFrame([(None, "the end"), (None, None), (1, "the end"), (1, "the end")], "doc_id long, text string")
    one, _, _, none = plain(["the end"] * 3 + [None])
    got = found(tokenalign.align_texts(df))
    assert sorted(got[None]) == sorted([one, none]) and got[1] == [one] * 2
    assert tokenalign.align_texts(df.where("text is null")).select("n_a", "groups_sha256").first() == (0, "")
    assert tokenalign.align_texts(df.limit(0)).count() == 0


def test_segments_join_to_the_text_and_none_is_slow():
    split = tokenalign.Splitter(" \n\t")
    for t in odd_texts():
        if t and "▁" not in t:
            assert "".join(split(t)) == " " + t
    assert split("one two\n\nthree ") == [" one", " two", "\n\nthree "]
    assert split("a b  c d") == [" a b  c", " d"]
