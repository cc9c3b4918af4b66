import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
from helpers import DOCS, clashing, words

from cohortframe.llm import importance as I


def slow(rows, target, percent=10, least=20, buckets=50, runs=1):
    def features(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, runs + 1) for i in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    out = []
    for doc, text in rows:
        f = features(text)
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    pool = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2], -r[1]))
    for i, r in enumerate(pool[:percent * len(pool) // 100]):
        r[4] = i + 1
    return sorted((str(r[:5]) for r in out))


def texts(n, seed, vocabulary=300):
    rng = random.Random(seed)
    return [" ".join(f"{rng.choice('aeéß')}{rng.randrange(vocabulary)}" for _ in range(rng.randint(1, 60))) for _ in range(n)]


def got(docs, target, **kw):
    out = I.resample(docs, target, buckets=50, **kw).select("doc_id", "n_features", "weight", "score", "rank")
    return sorted(str(list(r)) for r in out.collect())


ROWS = [(i, t) for i, t in enumerate(texts(400, 1))] + [(500, None), (501, ""), (502, "..."), (7, "Repeated row " * 30), (7, "Repeated row " * 30), (None, "no id " * 30), (None, "no id " * 30)]


def test_matches_brute_force_also_with_narrow_brackets(make, spark):
    target = texts(20, 2, 40)
    docs, goal = clashing(make(ROWS)), spark.createDataFrame([(t, "x") for t in target], "text string, score string")
    want = slow(ROWS, target)
    assert got(docs, goal) == want
    assert got(docs, goal, bracket_rows=3, accuracy=20) == want
    for percent in (0, 1, 100):
        assert got(docs, goal, percent=percent, bracket_rows=10, accuracy=50) == slow(ROWS, target, percent)


def test_ties_are_cut_by_id(make, spark, monkeypatch):
    # equal texts and equal noise: one score for all rows
    rows = spark.range(300).selectExpr("id * 7 % 300 AS doc_id", "20L AS n_words", "20L AS n_features", "0L AS weight", "5L AS score")
    assert I.cutoff(rows, 100, bracket_rows=10, accuracy=30)[:2] == (-5, 99)
    assert I.cutoff(rows, 300, bracket_rows=10, accuracy=30)[:2] == (-5, 299)
    assert I.cutoff(rows, 1, bracket_rows=10, accuracy=30)[:2] == (-5, 0)


def test_a_wrong_sketch_only_widens(spark, monkeypatch):
    from pyspark.sql import functions as F
    rows = spark.range(1000).selectExpr("id AS doc_id", "20L AS n_words", "20L AS n_features", "0L AS weight", "id AS score")
    real, calls = F.percentile_approx, []

    def wrong(col, shares, accuracy):
        calls.append(shares)
        return F.array(F.lit(-3).cast("long"), F.lit(-1).cast("long")) if len(calls) < 3 else real(col, shares, accuracy)

    monkeypatch.setattr(I.F, "percentile_approx", wrong)
    low, high, before, inside = I.bracket(rows, -F.col("score"), 400, 50, 100)
    assert before < 400 <= before + inside and inside <= 50 and low <= -600 <= high and len(calls) > 2


def test_runs_of_words_across_parts(monkeypatch):
    of = I._Buckets(1000)
    text = "One two, THREE four five! six".encode()
    whole = np.sort(np.concatenate([f for f, _ in I._features(text, 3, of)]))
    monkeypatch.setattr("cohortframe.llm.words.PART", 5)
    cut = list(I._features(text, 3, of))
    w = words(text.decode())
    want = sorted(zlib.crc32(" ".join(w[i:i + n]).encode()) % 1000 for n in (1, 2, 3) for i in range(len(w) - n + 1))
    assert whole.tolist() == want == sorted(np.concatenate([f for f, _ in cut]).tolist()) and sum(n for _, n in cut) == 6


def test_empty_tables(spark, make):
    empty = spark.createDataFrame([], DOCS)
    assert got(empty, empty.select("text")) == []
    rows = ROWS[:30]
    assert got(make(rows), empty.select("text")) == slow(rows, [])
