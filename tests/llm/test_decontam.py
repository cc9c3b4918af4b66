import hashlib
import random

from pyspark.sql import functions as F

from helpers import DOCS, clashing, words

from cohortframe.llm import decontam as D

ITEMS = "item_id long, text string"


def slow(docs, items, n=10):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(len(w) - n, 0) + 1) if w else ():
            wins.setdefault(tuple(w[k:k + n]), set()).add("null" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for size in {len(x) for x in wins}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in wins:
                    hit |= set(range(k, k + size))
                    ids |= wins[tuple(w[k:k + size])]
        out.append((str(i), len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def corpus():
    rng = random.Random(5)
    v = [rng.choice("abcdef") + rng.choice(["", "x", "é", "É", "ß"]) for _ in range(40)]
    text = lambda n: " ".join(rng.choice(v).upper() if rng.random() < 0.1 else rng.choice(v) for _ in range(n))
    items = [(i, text(rng.randint(8, 30))) for i in range(12)] + [(50, "Zz Yy"), (51, "qq qq qq"), (51, "qq qq qq"), (52, ""), (53, None), (None, "w1 w2 w3"), (54, "...")]
    docs = []
    for i in range(60):
        t = text(rng.randint(0, 60))
        if i % 3 == 0:
            t = t + " " + (rng.choice(items)[1] or '').replace(" ", rng.choice([" ", "\n", ", "])) + "! " + text(5) if items[i % 12][1] else t
        docs.append((i, t))
    docs += [(100, None), (101, ""), (102, "zz, YY"), (103, "qq " * 50), (104, "W1-w2-W3"), (None, "zz yy zz yy"), (105, "zz yy"), (105, "zz yy"), (105, "no such words"), (106, "Éx " + items[0][1])]
    return docs, items


def columns(df):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in df.collect())


def test_matches_brute_force(make, spark):
    docs, items = corpus()
    items = [(i, t) for i, t in items]
    got = columns(D.decontaminate(clashing(make(docs)), spark.createDataFrame(items, ITEMS).withColumn("win", F.lit(1))))
    assert got == slow(docs, items)


def test_empty_tables(make, spark):
    none = spark.createDataFrame([], ITEMS)
    got = D.decontaminate(make([(1, "a b"), (2, None)]), none).collect()
    assert [(r["n_words"], r["contaminated"]) for r in sorted(got)] == [(2, False), (0, False)]
    assert D.decontaminate(spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b")], ITEMS)).collect() == []


def test_long_text(make, spark):
    text = " ".join(f"w{i % 997}" for i in range(60_000)) + " needle one two"
    r = D.decontaminate(make([(1, text)]), spark.createDataFrame([(1, "needle one two")], ITEMS)).first()
    assert (r["n_words"], r["n_hit"]) == (60_003, 3)


def test_proximity(make, spark):
    docs = make([(1, "the red fox ran far"), (2, "the fox so red"), (3, "red and a lot of words before a fox came"), (4, "fox alone")])
    index = D.Index(docs, spark.createDataFrame([(1, "red fox")], ITEMS), "doc_id", "text", "item_id", "text", 10)
    assert [(r["doc_id"], r["kind"]) for r in D.matches(index).collect()] == [(1, "exact")]
    got = {(r["doc_id"], r["kind"]) for r in D.matches(index, slop=3).collect()}
    assert (1, "exact") in got and (2, "proximity") in got and not any(d in (3, 4) for d, _ in got)


def test_proximity_of_ten_words_matches_brute_force(make, spark):
    rng = random.Random(9)
    items = ["a b c d e f g h i j", "a a b c d e f g h j", "k a"]
    docs = ["a j b c d e f g h i", "x x j a b c d e f g h i x", "a b c d e f g h j", "j i h g f e d c b a", "x a b c d e f g h i j x", "x " * 12 + "a j", "k x x x a", "k x x x x x x x x a"]
    for _ in range(30):
        w = list(rng.choice(items[:2]).replace(" ", ""))
        rng.shuffle(w)
        docs.append(" ".join(w[:5] + ["x"] * rng.randint(0, 8) + w[5:]))
    want, slop = set(), 3
    for d, t in enumerate(docs):
        w = t.split()
        for i, item in enumerate(x.split() for x in items):
            for s in range(-len(item) - slop, len(w) + slop + 1):
                span = w[max(s - slop, 0):max(s + len(item) + slop, 0)]
                if s >= 0 and w[s:s + len(item)] == item:
                    want.add((d, i, s, "exact"))
                elif all(span.count(x) >= item.count(x) for x in item):
                    want.add((d, i, s, "proximity"))
    for extra in ("", " a" * 50 + " x" * 50, " j" * 50 + " x" * 50):  # each makes other terms the rarest
        index = D.Index(make(list(enumerate(docs)) + [(900, extra)]), spark.createDataFrame(list(enumerate(items)), ITEMS), "doc_id", "text", "item_id", "text", 10)
        got = D.matches(index, slop).join(index.items, "win").filter("doc_id < 900").collect()
        assert {(r["doc_id"], int(r["item_id"]), r["start"], r["kind"]) for r in got} == want
        assert len(got) == len(want)
