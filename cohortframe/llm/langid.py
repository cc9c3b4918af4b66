"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is lower-cased, everything but letters becomes a blank, and the n-grams of its UTF-8 bytes are
hashed to buckets.  Its vector is the mean of the buckets' embeddings; a linear layer and a softmax give
the languages.  Embeddings and layer are trained together by stochastic gradient descent in numpy on
a bounded sample of labelled pieces of text; a temperature fitted on pieces kept apart calibrates
the score, and the score below which a text is rejected is taken from the same pieces.

The mean of embeddings times the layer equals the mean of (embedding times layer), so a
prediction only looks up one short row for each n-gram of the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortframe.llm.ngrams import hashed, packed
from cohortframe.llm.util import sliced

BITS, DIM, SIZES = 16, 16, (1, 2, 3, 4)
#: The bounded training sample: documents looked at, characters of a piece, pieces of each language.
SAMPLE_DOCS, PIECE, PIECES = 4000, 240, 2500
#: N-grams from the last places of a text, all blanks, are not counted.
EDGE = max(SIZES) - 1
#: Passes over the pieces, but as many as give this number of steps where the pieces are few.
EPOCHS, STEPS, BATCH, RATE = 3, 400, 64, 30.0
#: Of the pieces, the part kept for calibration; of its rightly predicted ones, the part that may be rejected.
HELD, LOST = 5, 0.002
#: No threshold above this score: a text more likely right than not is kept.
MOST = 0.5
UNKNOWN = "und"
MAX_LANGUAGES = 1000
#: Bytes hashed at once.
BYTES = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")
_BLANKS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def prepared(text: str) -> bytes:
    """Lower-cased letters in UTF-8 between blanks; blanks at both ends, so that words have edges there, too."""
    return b" " + text.lower().encode().translate(_BLANKS) + b" " * max(SIZES)


@dataclass
class Model:
    """``table``: a row of language scores for each bucket; ``reject``: scores below it are too uncertain."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject: float

    def logits(self, texts: list[bytes]) -> np.ndarray:
        total = np.zeros((len(texts), len(self.languages)))
        count = np.zeros(len(texts))
        for data, starts, index in packed(texts, BYTES):
            sizes = np.diff(np.r_[starts, len(data)]) - EDGE
            ok = sizes > 0
            bounds = np.stack([starts[ok], starts[ok] + sizes[ok]], axis=1).ravel()  # no n-gram reaches into the next text
            if not len(bounds):
                continue
            index = np.array(index)[ok]
            for n in SIZES:
                rows = self.table[hashed(data, n, BITS)]
                np.add.at(total, index, np.add.reduceat(rows, bounds if bounds[-1] < len(rows) else bounds[:-1], axis=0)[::2])
                np.add.at(count, index, sizes[ok])
        return total / np.maximum(count, 1)[:, None] + self.bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether the score is too low; ``und``, 0 and rejected without a letter."""
        known = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if known and self.languages:
            p = _softmax(self.logits([prepared(texts[i]) for i in known]) / self.temperature)
            for i, row in zip(known, p):
                lang[i] = self.languages[int(row.argmax())]
                score[i] = min(1.0, float(row.max()))
        return lang, score, np.array([x == UNKNOWN for x in lang], bool) | (score < self.reject)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _features(text: str) -> np.ndarray:
    data = np.frombuffer(prepared(text), np.uint8)
    return np.concatenate([hashed(data, n, BITS)[:len(data) - EDGE] for n in SIZES])


def train(texts: list[str], labels: list[str], seed: int = 1) -> Model:
    """Fit embeddings and layer; no text at all gives a model that answers ``und``."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(0), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    y = np.array([languages.index(x) for x in labels])
    bags = [_features(t) for t in texts]
    order = rng.permutation(len(bags))
    held, fit = order[::HELD], np.setdiff1d(order, order[::HELD])
    if not len(fit):
        fit = held
    emb = (rng.random((1 << BITS, DIM), dtype=np.float32) - 0.5) / DIM
    layer, bias = np.zeros((DIM, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    an_epoch = -(-len(fit) // BATCH)
    epochs = max(EPOCHS, -(-STEPS // an_epoch))
    steps, done = epochs * an_epoch, 0
    for _ in range(epochs):
        mixed = rng.permutation(fit)
        for at in range(0, len(fit), BATCH):
            batch = mixed[at:at + BATCH]
            rate = RATE * (1 - done / steps)
            done += 1
            flat = np.concatenate([bags[i] for i in batch])
            size = np.array([len(bags[i]) for i in batch])
            mean = np.add.reduceat(emb[flat], np.cumsum(size) - size, axis=0) / size[:, None]
            p = _softmax(mean @ layer + bias)
            p[np.arange(len(batch)), y[batch]] -= 1
            p /= len(batch)
            back = (p @ layer.T) / size[:, None]
            layer -= (rate * mean.T @ p).astype(np.float32)
            bias -= (0.1 * p.sum(axis=0)).astype(np.float32)
            step = np.repeat((rate * back).astype(np.float32), size, axis=0)
            by = np.argsort(flat, kind="stable")
            first = np.flatnonzero(np.r_[True, flat[by][1:] != flat[by][:-1]])
            emb[flat[by][first]] -= np.add.reduceat(step[by], first, axis=0)
    model = Model(languages, (emb @ layer).astype(np.float32), bias.astype(np.float64), 1.0, 0.0)
    z = model.logits([prepared(texts[i]) for i in held])
    losses = {t: -np.log(np.maximum(_softmax(z / t)[np.arange(len(held)), y[held]], 1e-12)).mean() for t in np.geomspace(0.05, 4, 40)}
    model.temperature = float(min(losses, key=losses.get))
    p = _softmax(z / model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == y[held]]
    model.reject = float(min(MOST, np.quantile(right, LOST))) if len(right) else 0.0
    return model


def _share(*cols: str) -> Column:
    """A number from 0 to 1 that depends on the values alone."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / float(1 << 30)


def labelled_pieces(docs: DataFrame, text_col: str, lang_col: str, sample_docs: int = SAMPLE_DOCS, pieces: int = PIECES) -> DataFrame:
    """``(text, lang)``: a sample of labelled text, about ``pieces`` of ``PIECE`` characters for each language.

    Drawn by hash from about ``sample_docs`` whole documents a language, so the same rows give the same sample.
    """
    known = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("lang is not null and text rlike '[\\\\p{L}]'")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages")

    def drawn(df: DataFrame, counts: dict[str, int], most: int, key: str) -> DataFrame:
        few = [x for x in counts if counts[x] <= most]
        part = F.when(F.col("lang").isin(few), 2.0) if few else F.when(F.lit(False), 2.0)
        for x, n in counts.items():
            if n > most:
                part = part.when(F.col("lang") == x, most / n)
        return df.filter(_share(key) < part)

    cut = F.transform(F.sequence(F.lit(0), F.floor((F.char_length("text") - 1) / PIECE)), lambda i: F.substring("text", (i * PIECE + 1).cast("int"), PIECE))
    cut = drawn(known, sizes, sample_docs, "text").select("lang", F.explode(cut).alias("text")).filter("text rlike '[\\\\p{L}]'").distinct()
    counts = {r["lang"]: r["n"] for r in cut.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    return drawn(cut, counts, pieces, "text")


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS, pieces: int = PIECES) -> Model:
    """Train on a bounded sample of the labelled rows; rows without text or label are left out."""
    rows = sorted((r["text"], r["lang"]) for r in labelled_pieces(docs, text_col, lang_col, sample_docs, pieces).collect())
    return train([r[0] for r in rows], [r[1] for r in rows])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, lang_pred, score, rejected)`` for each row, from the whole text and nothing else.

    A null text or one without a letter is ``und`` with score 0, and rejected.  Repeated rows give a row
    each; an empty table gives none.  ``text_key`` is a hash of the text.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS rows of one number a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            lang, score, low = held.value.predict(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(low, pa.bool_())],
                                             ["doc_id", "text_key", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_key long, lang_pred string, score double, rejected boolean")


def keep_known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, with all their columns and no shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            _, _, low = held.value.predict(b.column(at).cast(pa.string()).to_pylist())
            yield b.filter(pa.array(~low))

    return docs.mapInArrow(run, docs.schema)
