"""Phrase collocations from count streams in prefix and suffix order.

Counting: every place of a text gives its longest window of up to five words that may still be frequent.
The windows, pre-counted in each task, are sorted in prefix order (word by word) over all tasks by range,
and the counts of all phrases are the lengths of the runs in that one stream: the run of a phrase holds the windows that
start with it.  Runs may cross from one task to the next, so a task passes on what its first and
last windows belong to, and those parts are added up; no phrase's windows need be in one task.

Which windows may be frequent is known from two passes: words, then pairs of words, with fewer occurrences than
the smallest phrase count end a window.  Pairs are tested in bit maps of fixed size by hash; a
collision only leaves a window longer than needed, and the runs count exactly.

Estimation: the frequent phrases are far fewer than the text.  They are kept as two streams, one sorted by first part
(prefix order) and one by last part (suffix order), and Spark's sort-merge joins read each in lockstep with
the sorted counts: the first gives the left counts and the right extensions, the second the
right counts and the left extensions.  A phrase that a longer one covers is covered by one that is a word longer too
(counts only fall on the way), so the extensions by one word decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortframe.llm.util import BROADCAST_KEYS, sliced, stage_table
from cohortframe.llm.words import table

LONGEST = 5
#: Bits of the maps of frequent words and pairs: 2 and 8 MB whatever the input.
WORD_BITS, PAIR_BITS = 24, 26
#: Words gathered before a chunk is counted, and distinct words of a chunk at most.
CHUNK, VOCABULARY = 1 << 20, 1 << 20
#: Bytes of a very long text split at once.
PART = 1 << 21
SEED = 42
#: Ends every word of a key, so that the keys' byte order is word by word; no word holds it.
END = b"\t"
_TEXT = table(b" \t", mark=b".,;:!?\n\x0b\x0c\r")
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Local numbers of words; 0 is the end of a piece."""

    def __init__(self):
        self.words = [b"\n"]
        super().__init__({b"\n": 0, b"": -1})

    def __missing__(self, word: bytes) -> int:
        self[word] = out = len(self.words)
        self.words.append(word)
        return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray, int]]:
    """``(lang, words, numbers, own)`` for about ``CHUNK`` words of a language; pieces end with 0.

    The first ``own`` numbers are counted here; the rest, after a cut within a very long text, are what the
    windows before the cut reach over, and come again.
    """
    open_: dict[str, tuple[_Words, list[np.ndarray]]] = {}
    held: dict[str, int] = {}

    def add(lang: str, tokens: list[bytes]) -> None:
        if lang not in open_:
            open_[lang], held[lang] = (_Words(), []), 0
        words, ids = open_[lang]
        new = np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens))
        ids.append(new[new >= 0])
        held[lang] += len(ids[-1])

    def full(lang: str) -> bool:
        return held[lang] >= CHUNK or len(open_[lang][0].words) >= VOCABULARY

    def close(lang: str, reach: int = 0) -> tuple[str, list[bytes], np.ndarray, int]:
        words, ids = open_.pop(lang)
        held.pop(lang)
        numbers = np.concatenate(ids)
        if reach:
            add(lang, [words.words[i] for i in numbers[-reach:]])
        return lang, words.words, numbers, max(0, len(numbers) - reach)

    for b in sliced(batches, 256):
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.large_binary())):
            text = (text.as_py() or b"").translate(_TEXT)
            at = 0
            while at < len(text):
                end = text.find(b" ", at + PART)
                end = len(text) if end < 0 else end
                add(lang, text[at:end].replace(b"\n", b" \n ").split(b" "))
                at = end + 1
                if at < len(text) and full(lang):
                    yield close(lang, LONGEST - 1)
            add(lang, [b"\n"])
            if full(lang):
                yield close(lang)
        while sum(held.values()) >= 2 * CHUNK:  # many languages, each with few words
            yield close(max(held, key=held.get))
    for lang in list(open_):
        yield close(lang)


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    h, start = xxhash.xxh64_intdigest, lang.encode()  # as Spark's xxhash64 of the language and the key
    return np.fromiter((h(start + w + END, SEED) for w in words), np.uint64, len(words))


def _pair_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a ^ (b * _MIX)) * _MIX
    return h ^ (h >> np.uint64(29))


def _in_map(bits: np.ndarray, h: np.ndarray, size: int) -> np.ndarray:
    h = h & np.uint64((1 << size) - 1)
    return bits[h >> np.uint64(3)] >> (h & np.uint64(7)).astype(np.uint8) & 1 == 1


def bit_map(hashes: DataFrame, col: str, size: int) -> np.ndarray:
    """``2 ** size`` bits, in bytes, of which those named by the low bits of ``col`` are set; built in blocks of 4 KB."""
    low = F.col(col).bitwiseAND(F.lit((1 << size) - 1))
    blocks = hashes.groupBy(F.shiftright(low, 15).alias("block")).agg(F.bitmap_construct_agg(low.bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
    out = np.zeros(1 << size - 3, np.uint8)
    for r in blocks.collect():
        out[r["block"] << 12:(r["block"] + 1) << 12] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))


def _frequent(words: list[bytes], hashes: np.ndarray, word_map: np.ndarray) -> np.ndarray:
    ok = _in_map(word_map, hashes, WORD_BITS)
    ok[0] = False  # the end of a piece
    return ok


def word_counts(texts: DataFrame) -> DataFrame:
    """``(lang, key, n)`` of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids, own in _chunks(batches):
            n = np.bincount(ids[:own], minlength=len(words))
            seen = np.flatnonzero(n[1:]) + 1
            keys = pa.array([words[i] + END for i in seen], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), keys, pa.array(n[seen])], ["lang", "key", "n"])

    return texts.mapInArrow(run, "lang string, key string, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _pairs(ids: np.ndarray, own: int, ok: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether both words at each place are frequent, and the hashes of those pairs; for all places but the last."""
    valid = ok[ids[:-1]] & ok[ids[1:]]
    at = np.flatnonzero(valid)
    return valid, _pair_hashes(hashes[ids[at]], hashes[ids[at + 1]])


def pair_counts(texts: DataFrame, word_map) -> DataFrame:
    """``(pair, n)``: occurrences by hash of the pairs of frequent words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids, own in _chunks(batches):
            hashes = _hashes(lang, words)
            valid, h = _pairs(ids, own, _frequent(words, hashes, word_map.value), hashes)
            h = h[np.flatnonzero(valid) < own]
            pair, n = np.unique(h, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair.view(np.int64)), pa.array(n)], ["pair", "n"])

    return texts.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def windows(texts: DataFrame, word_map, pair_map, longest: int = LONGEST) -> DataFrame:
    """``(lang, key, n)``: the longest window of at most ``longest`` words from each place that may be frequent, of two words at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids, own in _chunks(batches):
            hashes = _hashes(lang, words)
            valid, h = _pairs(ids, own, _frequent(words, hashes, word_map.value), hashes)
            valid[valid] = _in_map(pair_map.value, h, PAIR_BITS)
            ends = np.flatnonzero(np.r_[~valid, True])  # a window from i reaches the next place that does not go on
            at = np.flatnonzero(valid[:own])
            if not len(at):
                continue
            size = np.minimum(ends[np.searchsorted(ends, at)] - at + 1, longest)
            grams = np.zeros((longest, len(at)), np.int32)
            for k in range(longest):
                some = size > k
                grams[k, some] = ids[at[some] + k]
            order = np.lexsort(grams[::-1])
            grams = grams[:, order]
            first = np.flatnonzero(np.r_[True, (grams[:, 1:] != grams[:, :-1]).any(axis=0)])
            n = np.diff(np.r_[first, len(at)])
            ended = [b"", *(w + END for w in words[1:])]
            for some in np.array_split(np.arange(len(first)), 1 + len(first) // 100_000):
                columns = ([ended[i] for i in row] for row in grams[:, first[some]].tolist())
                keys = pa.array(map(b"".join, zip(*columns)), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), keys, pa.array(n[some])], ["lang", "key", "n"])

    return texts.mapInArrow(run, "lang string, key string, n long")


def _run_lengths(least: int):
    """Counts of all phrases from sorted windows: those of ``least`` at least, and the parts of runs that may go on in other tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[bytes] = []  # words of the windows' open runs
        since: list[int] = []  # occurrences before each run
        total, last = 0, None
        found: list[tuple[str, bytes, int]] = []

        def close(depth: int, lang: str, cut: bool = False) -> None:
            while len(stack) > depth:
                n = total - since[-1]
                if len(stack) > 1 and (n >= least or cut or not since[-1]):
                    found.append((lang, END.join(stack) + END, n))
                stack.pop(), since.pop()

        def flush() -> pa.RecordBatch:
            columns = list(zip(*found)) or [(), (), ()]
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.binary()).cast(pa.string()), pa.array(columns[2], pa.int64())], ["lang", "key", "n"])

        for b in batches:
            for lang, key, n in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist()):
                words = key.split(END)
                words.pop()
                depth = 0
                if lang == last:
                    for x, y in zip(stack, words):
                        if x != y:
                            break
                        depth += 1
                close(depth, last)
                for w in words[depth:]:
                    stack.append(w), since.append(total)
                total += n
                last = lang
            if len(found) >= 10_000:
                yield flush()
        close(0, last, cut=True)
        yield flush()

    return run


def phrase_counts(docs: DataFrame, least: int, longest: int = LONGEST, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """``(lang, key, words, n)`` of all phrases of 1 to ``longest`` words with ``least`` occurrences, and ``(lang, total)`` of all words."""
    spark = docs.sparkSession
    texts = _texts(docs, text_col, lang_col)
    words = stage_table(word_counts(texts), "phrases-words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    common = words.filter(F.col("n") >= least)
    word_map = spark.sparkContext.broadcast(bit_map(common.select(F.xxhash64(F.concat("lang", "key")).alias("h")), "h", WORD_BITS))
    pair_map = spark.sparkContext.broadcast(bit_map(pair_counts(texts, word_map).filter(F.col("n") >= least), "pair", PAIR_BITS))
    stream = stage_table(windows(texts, word_map, pair_map, longest), "phrases-windows")
    sorted_ = stream.repartitionByRange("lang", "key").sortWithinPartitions("lang", "key")
    runs = sorted_.mapInArrow(_run_lengths(least), "lang string, key string, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    counts = common.unionByName(runs).withColumn("words", F.size(F.split("key", "\t")) - 1)
    return stage_table(counts, "phrases-counts"), stage_table(totals, "phrases-totals")


def _piece(start: Column, length: Column) -> Column:
    return F.concat(F.array_join(F.slice("w", start, length), "\t"), F.lit("\t"))


def collocations(docs: DataFrame, least: int = 100, longest: int = LONGEST, top: int = 2000, scale: int = 1000, cover: int = 100, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each language.

    Texts are split at ``.,;:!?`` and line ends, and words stand between spaces or tabs.  A phrase of 2 to ``longest`` words with ``a >= least`` occurrences
    is cut after each of its words; ``l`` and ``r`` count its two parts, ``n`` all words of the language, and the cut with the
    least ``floor(scale * a * n / (l * r))`` counts, ties to the first.  A phrase goes when a
    longer one has ``cover`` hundredths of its occurrences at least.  Ranks go by score, then ``a``, then the phrase's bytes.
    Null and empty texts have no words, a null language is ``und``.  Repeated rows count each time.  An
    empty table gives no rows; further columns are not looked at.
    """
    counts, totals = phrase_counts(docs, least, longest, text_col, lang_col)
    part = counts.select(F.col("lang").alias("p_lang"), F.col("key").alias("p_key"), F.col("n").alias("p_n"))
    split = counts.filter("words > 1").select("lang", "key", "words", F.col("n").alias("a"), F.split("key", "\t").alias("w"))
    split = split.select("lang", "key", "words", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = split.select("lang", "key", "words", "a", "k", _piece(F.lit(1), F.col("k")).alias("first"), _piece(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    by_prefix = cuts.join(part.hint("merge"), (F.col("lang") == F.col("p_lang")) & (F.col("first") == F.col("p_key"))).withColumn("l", F.col("p_n")).drop("p_lang", "p_key", "p_n")
    by_suffix = by_prefix.join(part.hint("merge"), (F.col("lang") == F.col("p_lang")) & (F.col("rest") == F.col("p_key"))).withColumn("r", F.col("p_n")).drop("p_lang", "p_key", "p_n")
    cuts = stage_table(by_suffix, "phrases-cuts")
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    covers = lambda whole: wide("a") * 100 >= wide(whole) * cover
    gone = cuts.filter((F.col("words") > 2) & (F.col("k") == F.col("words") - 1) & covers("l")).select("lang", F.col("first").alias("key")) \
        .union(cuts.filter((F.col("words") > 2) & (F.col("k") == 1) & covers("r")).select("lang", F.col("rest").alias("key"))).distinct()
    few = totals.count() <= BROADCAST_KEYS
    scored = cuts.join(F.broadcast(totals) if few else totals, "lang") \
        .withColumn("score", F.expr(f"cast({scale} as decimal(5,0)) * cast(a as decimal(16,0)) * cast(total as decimal(16,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"))
    best = scored.groupBy("lang", "key", "a", "total").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    kept = best.join(gone.hint("merge"), ["lang", "key"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    rows = kept.select("lang", F.translate(F.rtrim("key", F.lit("\t")), "\t", " ").alias("phrase"), "a", "b.l", "b.r", F.col("total").alias("n"), "b.score")
    rows = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = """
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM words GROUP BY lang),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 6) t(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, phrase, k, a, c, array_to_string(w[1:c], ' ') AS head, array_to_string(w[c + 1:], ' ') AS tail
         FROM (SELECT lang, phrase, k, a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS c FROM f WHERE k > 1)),
s AS (SELECT x.lang, x.phrase, x.a, x.c, h.a AS l, t.a AS r, n, CAST(1000 * CAST(x.a AS HUGEINT) * n // (CAST(h.a AS HUGEINT) * t.a) AS BIGINT) AS score
      FROM cuts x JOIN f h ON h.lang = x.lang AND h.phrase = x.head JOIN f t ON t.lang = x.lang AND t.phrase = x.tail JOIN totals n ON n.lang = x.lang),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_ AS (SELECT DISTINCT lang, array_to_string(w[i:j], ' ') AS phrase, a FROM
           (SELECT lang, a, k, w, i, unnest(range(i + 1, k + 1)) AS j FROM (SELECT lang, a, k, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS i FROM f WHERE k > 2)) WHERE j - i + 1 < k),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.a >= 100 * b.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked WHERE rank <= 2000
"""
