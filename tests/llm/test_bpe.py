import hashlib
import random

import public_tokenizers
import pytest
from helpers import DOCS, clashing
from tokenizers import Tokenizer as Library

from cohortframe.llm import bpe as B

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def both():
    return B.Tokenizer(PATH), Library.from_file(PATH)


def same(both, text):
    own, library = both
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text).tolist() == ids, text[:80]
    assert own.decode_bytes(own.encode(text)).decode() == library.decode(ids, skip_special_tokens=False), text[:80]


def test_special_cases(both):
    for t in ["", "  \n", "a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|>", "ΑΣ ΑΣΣ", "İstanbul", "it's we'll 'S 'LL don't", "é ̈a", "x\x1cy\x1f z", "!!!???", "</w> a</w>", "ﬁ ǅ",
              "1234 5a6", "　x\u0085y\u200by", "a" * 5000, "ab" * 4000, "zq" * 300 + "!" * 300, "日本語テキスト", "👩‍👩‍👧 ok", "\x00a\x01"]:
        same(both, t)


def test_every_code_point(both):
    own, library = both
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["a" + " a".join(chr(c) + "b" for c in points[i:i + 64]) for i in range(0, len(points), 64)]
    for t, e in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert own.encode(t).tolist() == e.ids


def test_random_words(both):
    rng = random.Random(1)
    signs = "abcdefghijklmnopqrstuvwxyz" * 3 + "éèüßñ'.,!?0 <|>/w"
    for _ in range(3000):
        same(both, "".join(rng.choice(signs) for _ in range(rng.randint(1, 40))))


def test_compatibility_is_that_of_the_merges(both):
    own, rng = both[0], random.Random(2)
    tokens = [t for t in own.ids if t in own.automaton]
    for _ in range(4000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        if ord(a[-1]) < B.LAST:
            assert own.compatible(a, b) == (own.merged(a + b) == [a, b])


def test_small_tables_change_nothing(both, monkeypatch):
    monkeypatch.setattr(B, "TABLE", 5)
    monkeypatch.setattr(B, "TOKENS", 7)
    for t in ("the quick brown fox jumps over the lazy dog " * 5, "a b c d e f g h i j the the a b"):
        same(both, t)


def test_latin_texts(both):
    for c in map(chr, range(256)):
        same(both, f"Ab{c}cd {c}{c} É{c} 1{c}2")
        same(both, f"Ab{c}cd {c}\u0301 {c}\u4e2d")


def test_words_are_kept_without_the_signs_beside_them(monkeypatch):
    own = B.Tokenizer(PATH)
    signs = ".,;:!?"
    own.encode(" ".join(f"{a}{b}word{c}" for a in signs for b in signs for c in signs) + " " + "x" * 5000)
    tables = [t for t in vars(own).values() if isinstance(t, B._Table)]
    words = [k for t in tables for k in t if isinstance(k, str)]
    assert sum("word" in k for k in words) == 1 and max(map(len, words)) < 64


def test_query_rows(make, both, spark):
    rows = [(1, "Hello, World"), (2, None), (3, ""), (4, "Hello, World"), (4, "Hello, World"), (None, "x"), (5, "word " * 30_000)]
    got = B.round_trip(clashing(make(rows)), PATH, keep_ids=True).collect()
    want = []
    for i, t in rows:
        ids = both[1].encode(t or "", add_special_tokens=False).ids
        text = both[1].decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), ids))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    assert B.round_trip(spark.createDataFrame([], DOCS), PATH).collect() == []
