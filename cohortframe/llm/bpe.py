"""BPE encoding by backtracking over longest token matches, and decoding by an offset table.

An Aho-Corasick automaton over the vocabulary gives the longest token that begins at each symbol of a
word.  Two neighbouring tokens are compatible when merging the symbols of both by rank ends in just
these two; a sequence of which all neighbours are compatible is the exact result of the merges.
Many words are the longest tokens one after the other, which one pass of the automaton gives.  For the rest
the encoder takes the longest match, steps to shorter tokens while it is incompatible with the
token before it, and steps back where no token fits; places that led nowhere are marked, so each is
left for good once and the time is linear in the word.  Compatibility is kept in a table filled as pairs occur.

The files are those of public tokenizers (``vocab`` and ``merges`` in one JSON) whose path is a parameter.
Normalizing and splitting follow the file's kind "words with an end mark": NFC, lower case, letters in
runs, digits alone, other signs in runs, bytes written as printable characters.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from cohortframe.llm.util import sliced

#: Fixed values of the vocabulary's format: the mark of a word's last token, and the split pattern.
END = "</w>"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
#: The same for texts in Latin-1, which normalizing leaves as they are: its letters, numbers and white space listed.
_LATIN = {k: "".join(re.escape(c) for c in map(chr, range(256)) if regex.match(rf"\p{{{k}}}", c)) for k in ("L", "N", "White_Space")}
LATIN_PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN['L']}]+|[{_LATIN['N']}]|[^{''.join(_LATIN.values())}]+"
#: The same where a text has letters or numbers of Unicode 17, which the format (Unicode 16) takes for signs.
NEWER = ("\u0558\u058b\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c\uab6d\U000107bb-\U000107bf"
         "\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb\U00011df1\U00016ea0-\U00016eb8"
         "\U00016ebb-\U00016ed3\U00016ff2\U00016ff3\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2"
         "\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81"
         "\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4\U0001e6e5\U0001e6e7-\U0001e6ed"
         "\U0001e6f0-\U0001e6f4\U0001e6fe\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f")
NEWER_PIECES = rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}--[{NEWER}]]+|[\p{{N}}--[{NEWER}]]|[[^\p{{White_Space}}\p{{L}}\p{{N}}]||[{NEWER}]]+"
#: Lower case of letters that came with Unicode 16 and 17, later than str.lower() knows; and no final sigma.
LOWER = {0x3A3: 0x3C3, 0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B} | {c: c + 0x20 for c in range(0x10D50, 0x10D66)}
LOWER |= {c: c + 1 for c in (0xA7CE, 0xA7D2, 0xA7D4)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}  # Unicode 17
#: Set on the last symbol of a word, so that one character holds symbol and mark.
LAST = 0xE000
#: Entries of the newer half of a table of words or pairs; bounds a worker's memory.  Longer pieces are not kept.
TABLE, KEPT = 150_000, 64
#: Tokens decoded at once.
TOKENS = 1 << 18


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else one from 256 on."""
    printable = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b if b in printable else next(rest)) for b in range(256)]


def _key(token: str) -> str:
    """A token as symbols, one character each."""
    if not token.endswith(END) or len(token) == len(END):
        return token
    body = token[:-len(END)]
    return body[:-1] + chr(ord(body[-1]) + LAST)


class _Table(dict):
    """Values made on demand.  At ``TABLE`` entries they become the older half, and the half before them goes;
    what is asked for again comes back from the older half, so frequent words stay.  Keys of ``KEPT`` and more letters are not stored."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        if isinstance(key, str) and len(key) >= KEPT:
            return self.make(key)
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= TABLE:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Tokenizer:
    """Encoder and decoder of one vocabulary file; equal to the merges it lists."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids = {_key(t): i for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.rank: dict[tuple[str, str], int] = {}
        self.made: dict[str, int] = {}  # rank of the merge that makes a token
        self.split: dict[str, tuple[str, str]] = {}
        for n, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            left, right = _key(left), _key(right)
            self.rank[left, right] = self.made[left + right] = n
            self.split[left + right] = left, right
        self.symbols = byte_symbols()
        self.byte_table = {b: s for b, s in enumerate(self.symbols)}
        self.automaton = ahocorasick.Automaton()
        for key in self.ids:
            if self.merged(key) == [key]:  # a token that its own merges do not reach never appears
                self.automaton.add_word(key, len(self.automaton))
        self.automaton.make_automaton()
        self.number = dict(self.automaton.items())
        self.tokens = sorted(self.number, key=self.number.get)
        self.id_of = [self.ids[t] for t in self.tokens]
        self.sizes = [len(t) for t in self.tokens]
        #: The longest token that begins a token and is shorter; None after a single symbol.
        self.shorter = [next((self.number[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.number), None) for t in self.tokens]
        count = len(self.tokens)
        self.fits = _Table(lambda pair: self.compatible(self.tokens[pair // count], self.tokens[pair % count]))
        self.words = _Table(self._word)
        self.special_split = regex.compile("(" + "|".join(regex.escape(t) for t in self.special) + ")") if self.special else None
        self.latin_pieces, self.lower = re.compile(LATIN_PIECES), frozenset(map(chr, LOWER))
        self.pieces, self.newer, self.newer_pieces = regex.compile(PIECES), regex.compile(f"[{NEWER}]"), regex.compile(NEWER_PIECES)
        texts = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        ids = range(max(texts) + 1)
        self.texts = _offsets([texts.get(i, "").encode() for i in ids])  # tokens are put together with a space between
        self.decimals = _offsets([str(i).encode() for i in ids])

    # -- encoding

    def merged(self, symbols: str) -> list[str]:
        """The merges by rank, the leftmost of equal rank first; for short runs of symbols."""
        parts = list(symbols)
        rank = self.rank
        while len(parts) > 1:
            best, at = min((rank.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:])))
            if best == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging the symbols of both tokens ends in just these two.

        Goes back through the merges that made them, the latest first.  Two parts that lay side by side
        would have been merged if that merge ranks before those that used up either part; of equal
        ranks the one further left comes first.
        """
        used_a = used_b = len(self.rank)
        while True:
            n = self.rank.get((a, b))
            if n is not None and n < used_a and n <= used_b:
                return False
            made_a, made_b = self.made.get(a, -1), self.made.get(b, -1)
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                used_a, a = made_a, self.split[a][1]
            else:
                used_b, b = made_b, self.split[b][0]

    def encode_symbols(self, symbols: str) -> list[int]:
        """Numbers (places in ``tokens``) of the tokens of one word given as symbols."""
        fits, shorter, sizes, count, size = self.fits, self.shorter, self.sizes, len(self.tokens), len(symbols)
        # most words are the longest tokens one after the other
        out = [token for _, token in self.automaton.iter_long(symbols)]
        last = -1
        for token in out:
            if last >= 0 and not fits[last * count + token]:
                break
            last = token
        else:
            if sum([sizes[token] for token in out]) == size:
                return out
        longest: list[int | None] = [None] * size
        for end, token in self.automaton.iter(symbols):  # by ascending end: the last one from a place is the longest
            longest[end + 1 - sizes[token]] = token
        out = []
        dead: set[int] = set()  # places from which no token led on
        at, token = 0, longest[0]
        while at < size:
            if out:
                last = out[-1] * count
                while token is not None and not (fits[last + token] and at + sizes[token] not in dead):
                    token = shorter[token]
            else:
                while token is not None and at + sizes[token] in dead:
                    token = shorter[token]
            if token is not None:
                out.append(token)
                at += sizes[token]
                if at < size:
                    token = longest[at]
            elif out:
                dead.add(at)
                token = out.pop()
                at -= sizes[token]
            else:
                raise ValueError(f"no token fits {symbols!r}")
        return out

    def _word(self, piece: str) -> bytes:
        """Ids of one piece of the split."""
        symbols = piece if piece.isalpha() and piece.isascii() else piece.encode().decode("latin-1").translate(self.byte_table)
        ids = [self.id_of[t] for t in self.encode_symbols(symbols[:-1] + chr(ord(symbols[-1]) + LAST))]
        return struct.pack(f"<{len(ids)}i", *ids)

    def _pieces(self, text: str) -> list[str]:
        """Normalized pieces of a text without special tokens."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            text = unicodedata.normalize("NFC", text)
            text = (text if self.lower.isdisjoint(set(text)) else text.translate(LOWER)).lower()
            return (self.newer_pieces if self.newer.search("".join(set(text))) else self.pieces).findall(text)
        return self.latin_pieces.findall(text.lower())

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; null is an empty one."""
        ids: list[bytes] = []
        for k, part in enumerate(self.special_split.split(text or "") if self.special_split else [text or ""]):
            if k % 2:
                ids.append(np.array([self.special[part]], "<i4").tobytes())
            else:
                ids.extend(map(self.words.__getitem__, self._pieces(part)))
        return np.frombuffer(b"".join(ids), "<i4")

    # -- decoding

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The decoded text in UTF-8."""
        return _joined(ids, *self.texts)

    def decimal_bytes(self, ids: np.ndarray) -> bytes:
        """The ids as decimal numbers, joined by a space."""
        return _joined(ids, *self.decimals)


def _offsets(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All entries, each with a space after it, as one array, and where each begins."""
    table = [t + b" " for t in entries]
    return np.frombuffer(b"".join(table), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in table])])


def _joined(ids: np.ndarray, blob: np.ndarray, offsets: np.ndarray) -> bytes:
    """The entries of ``ids`` joined by a space: slices of the table put together, without a loop over tokens."""
    out = []
    for at in range(0, len(ids), TOKENS):
        part = ids[at:at + TOKENS]
        start = offsets[part]
        length = offsets[part + 1] - start
        moved = np.repeat(start - (np.cumsum(length) - length), length)
        moved += np.arange(len(moved))
        out.append(blob[moved].tobytes())
    return b"".join(out)[:-1]


_LOADED: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """The file's tokenizer, built once in each worker."""
    if path not in _LOADED:
        _LOADED[path] = Tokenizer(path)
    return _LOADED[path]


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` for each row: its text encoded and decoded again.

    ``ids_sha256`` is over the decimal ids joined by a space, ``decoded_sha256`` over the decoded text;
    ``keep_ids`` appends the ids as an array.  A null or empty text has no tokens and decodes to an
    empty one.  Special tokens within a text keep their own ids.  Repeated rows give a row each, an
    empty table none; other columns are not looked at.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for b in sliced(batches):
            rows = []
            for text in b.column(1):
                ids = t.encode(text.as_py())
                written = hashlib.sha256(t.decimal_bytes(ids)).hexdigest()
                rows.append((len(ids), written, hashlib.sha256(t.decode_bytes(ids)).hexdigest()) + ((ids,) if keep_ids else ()))
            n, a, d, *ids = zip(*rows) if rows else ((), (), ())
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(list(x), pa.list_(pa.int32())) for x in ids], [c.split(" ")[0] for c in schema.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
