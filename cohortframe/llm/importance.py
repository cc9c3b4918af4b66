"""Importance resampling towards a target distribution, cut off by a bracketed quantile.

Features are hashed to a fixed number of buckets.  One pass counts the buckets of the documents, one
those of the target texts; a bucket's gain is the logarithm of the ratio of its two smoothed shares.
The gains are an array of fixed length, so a document's weight is one look-up a feature.  Gumbel noise
made from the document's id turns the weights into scores of which the highest are a draw without replacement.

Only the cutoff is looked for, not the order of all scores: a mergeable quantile sketch gives a
bracket around it, one exact count of the rows before and inside validates the bracket (or widens
it), and the bracket narrows the same way until it is small.  Only the bracket is sorted.  Ties of the score are
cut by doc_id in the same manner, so a score that a third of all rows share is no group of its own.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortframe.llm.util import sliced, stage_table
from cohortframe.llm.words import ALNUM, parts
from cohortframe.operators.rank import distributed_row_number, quantile_bucket

BUCKETS = 10_000
SEED = 2024
#: Rows that are sorted to locate the cutoff, and the sketch's accuracy (its rank error is rows / accuracy).
BRACKET_ROWS, ACCURACY = 50_000, 2_000
#: Words whose bucket a worker keeps.
CACHE = 200_000
RANK_ROWS = 50_000


class _Buckets(dict):
    """Bucket of a feature, remembered for a bounded number of features."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[feature] = out = crc32(feature) % self.buckets
        return out


def _features(text: bytes, runs: int, of: _Buckets) -> Iterator[tuple[np.ndarray, int]]:
    """Buckets of all runs of 1 to ``runs`` words of ``text``, and how many words the part adds."""
    carry: list[bytes] = []
    for words in parts(text, ALNUM):
        line = carry + words
        found = list(map(of.__getitem__, words))
        for n in range(2, runs + 1):
            first = max(0, len(carry) - n + 1)  # runs that end in the new words
            found += [of[b" ".join(line[i:i + n])] for i in range(first, len(line) - n + 1)]
        yield np.array(found, np.int64), len(words)
        carry = line[len(line) - runs + 1:] if runs > 1 else []


def bucket_counts(texts: DataFrame, text_col: str, buckets: int, runs: int) -> np.ndarray:
    """Features of all texts by bucket: one partial array a task, added up; ``buckets`` rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, of = np.zeros(buckets, np.int64), _Buckets(buckets)
        for b in sliced(batches):
            for text in b.column(0).cast(pa.large_binary()):
                for found, _ in _features(text.as_py() or b"", runs, of):
                    total += np.bincount(found, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    rows = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares, target over corpus, rounded down."""
    size, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + size) / ((s + 1) * (t_all + size)))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(key: str) -> int:
    """Gumbel noise in thousandths, from the first 32 bits of the key's SHA-256."""
    h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", runs: int = 1, seed: int = SEED) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _Buckets(len(gain))
        for b in sliced(batches):
            out: list[list[int]] = [[], [], [], []]
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.large_binary())):
                n_words = n_features = weight = 0
                for found, n in _features(text.as_py() or b"", runs, of):
                    n_words, n_features, weight = n_words + n, n_features + len(found), weight + int(gain[found].sum())
                score = weight + noise(f"{seed}:{'' if doc is None else doc}")
                for column, value in zip(out, (n_words, n_features, weight, score)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in out)], ["doc_id", "n_words", "n_features", "weight", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def _keys() -> list[Column]:
    """Sort keys of the draw, each ascending; a null id last.  Rows equal in all of them are equal rows."""
    last = F.lit((1 << 63) - 1)
    return [-F.col("score"), F.coalesce("doc_id", last), -F.col("weight"), -F.col("n_features")]


def bracket(rows: DataFrame, key: Column, wanted: int, bracket_rows: int = BRACKET_ROWS, accuracy: int = ACCURACY) -> tuple[int, int, int, int]:
    """``(low, high, before, inside)``: the value of ``key`` at rank ``wanted`` (from 1) lies in [low, high].

    ``before`` and ``inside`` are exact counts.  Ends when the bracket holds at most ``bracket_rows``
    rows or one value.  ``rows`` is read twice a round, so it should be a stage table.
    """
    low, high, inside = rows.agg(F.min(key), F.max(key), F.count("*")).first()
    before, margin = 0, 2.0
    while inside > bracket_rows and low < high:
        within = rows.filter(key.between(low, high))
        share, slack = (wanted - before) / inside, margin / accuracy
        a, b = low, high
        if slack < 1:
            a, b = within.agg(F.percentile_approx(key, [max(0.0, share - slack), min(1.0, share + slack)], accuracy)).first()[0]
        fewer, held = within.agg(F.count_if(key < a), F.count_if(key.between(a, b))).first()
        if not before + fewer < wanted <= before + fewer + held:
            margin *= 4  # the sketch was off: widen, at last to all that is left
            continue
        if (a, b) == (low, high):
            # no narrower by sketch: halve the range of values, by exact count
            middle = a + (b - a) // 2
            left = within.filter(key <= middle).count()
            low, high, before, inside = (a, middle, before, left) if before + left >= wanted else (middle + 1, b, before + left, inside - left)
            continue
        low, high, before, inside = a, b, before + fewer, held
    return low, high, before, inside


def cutoff(rows: DataFrame, wanted: int, bracket_rows: int = BRACKET_ROWS, accuracy: int = ACCURACY) -> tuple:
    """Sort keys of the row at rank ``wanted``; only the bracket's rows are sorted."""
    fixed, left = [], wanted
    keys = _keys()
    for i, key in enumerate(keys):
        low, high, before, inside = bracket(rows, key, left, bracket_rows, accuracy)
        rows, left = rows.filter(key.between(low, high)), left - before
        if low == high and i + 1 < len(keys):
            fixed.append(low)
            continue
        rest = [k.alias(f"k{j}") for j, k in enumerate(keys[i:])]
        at = rows.select(*rest).orderBy(*[f"k{j}" for j in range(len(rest))]).offset(left - 1).limit(1).first()
        return (*fixed, *at)
    return tuple(fixed)


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, buckets: int = BUCKETS, runs: int = 1, seed: int = SEED,
             id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", bracket_rows: int = BRACKET_ROWS, accuracy: int = ACCURACY) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)`` for each row of ``docs``; ``rank`` is null unless drawn.

    Of the documents with at least ``min_words`` words the ``percent`` hundredths with the highest scores are
    drawn, ties to the smaller doc_id.  Null and empty texts have no features and weight 0, and are never
    drawn for ``min_words`` above 0; an empty target leaves the smoothed gains.  A null doc_id has
    the noise of the empty id and comes last among ties.  Repeated rows are rows of their own.  An
    empty table gives no rows; further columns are not looked at.
    """
    gain = gains(bucket_counts(docs, text_col, buckets, runs), bucket_counts(target, target_col, buckets, runs))
    rows = stage_table(scored(docs, gain, id_col, text_col, runs, seed), "importance-scores")
    pool = rows.filter(F.col("n_words") >= min_words)
    wanted = percent * pool.count() // 100
    if not wanted:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    keys, cut = _keys(), cutoff(pool, wanted, bracket_rows, accuracy)
    upto, same = F.lit(False), F.lit(True)
    for key, value in zip(keys, cut):
        upto, same = upto | (same & (key < value)), same & (key == value)
    chosen = (F.col("n_words") >= min_words) & (upto | same)
    n = min(1024, max(64, wanted // RANK_ROWS))  # runs of scores that are ranked apart
    drawn = quantile_bucket(rows.filter(chosen).withColumns({"all": F.lit(0), "key": keys[0]}), "key", n, "run")
    ranked = distributed_row_number(drawn, ["all"], "run", keys, "rank").select(*rows.columns, F.col("rank").cast("long").alias("rank"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))  # equal rows at the cutoff
    return ranked.unionByName(rows.filter(~chosen).withColumn("rank", F.lit(None).cast("long")))


#: The words' CRC-32 is made from its polynomial, a byte at a time, for each distinct word.
ORACLE_SQL = f"""
WITH crc_table AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(256) r(i)),
d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark),
words AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM d UNION SELECT w FROM b)),
crc AS (SELECT w, xor(list_reduce([CAST('0x' || x[2 * i + 1:2 * i + 2] AS BIGINT) for i in range(length(x) // 2)],
                                  lambda c, y: xor(c >> 8, t[1 + CAST(xor(c, y) & 255 AS INTEGER)]), 4294967295::BIGINT), 4294967295::BIGINT) % {BUCKETS} AS bucket FROM words CROSS JOIN crc_table),
s AS (SELECT bucket, count(*) AS s FROM d JOIN crc USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN crc USING (w) GROUP BY bucket),
n AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS s_all, (SELECT coalesce(sum(t), 0) FROM t) AS t_all),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (s_all + {BUCKETS}) AS DOUBLE) / CAST((s + 1) * (t_all + {BUCKETS}) AS DOUBLE))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket) CROSS JOIN n),
w AS (SELECT doc_id, count(*) AS n_features, sum(gain) AS weight FROM d JOIN crc USING (w) JOIN g USING (bucket) GROUP BY doc_id),
e AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
             CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('{SEED}:' || doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM documents LEFT JOIN w USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM e WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM e LEFT JOIN r USING (doc_id)
"""
