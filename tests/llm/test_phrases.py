import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from helpers import DOCS, clashing

from cohortframe.llm import phrases as P


def pieces(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for p in re.split(r"[.,;:!?\x0A-\x0D]", text) if (w := [x for x in re.split(r"[\x20\x09]+", p) if x])]


def counts(rows, longest=5):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for w in pieces(text):
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    return f, n


def slow(rows, least, top=2000, cover=100):
    f, n = counts(rows)
    found = {}
    for (lang, w), a in f.items():
        if len(w) > 1 and a >= least:
            found[lang, w] = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
    gone = {(lang, w[i:j]) for lang, w in found for i in range(len(w)) for j in range(i + 2, len(w) + 1) if j - i < len(w) and 100 * f[lang, w] >= cover * f[lang, w[i:j]]}
    out = []
    for lang in n:
        best = sorted(((-s, -f[lang, w], " ".join(w).encode(), l, r) for (x, w), (s, _, l, r) in found.items() if x == lang and (x, w) not in gone))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(best[:top])]
    return sorted(out)


def texts(n, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["of", "the", "AN", "New", "york", "times", "á", "\x01", "x-y", "y\x1fz", "ß"] + [f"w{i}" for i in range(60)])
    out = []
    for _ in range(n):
        w = [rng.choice(["New York Times", "new  york", "of the", "as\tfar as I know", word(), word(), word()]) + rng.choice(["", "", "", ".", ", ", "\n", "\x0b", "!?"]) for _ in range(rng.randint(0, 60))]
        out.append(rng.choice([" ", "  ", "\t", " "]).join(w))
    return out


def got(docs, **kw):
    return sorted(tuple(r) for r in P.collocations(docs, **kw).collect())


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, (lang, t) in enumerate(rows)], DOCS)


def test_matches_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["en", "en", "en", "fr", None]), t) for t in texts(250, 5)] + [("en", None), ("de", ""), ("de", " .. "), (None, None)]
    rows += rows[:9]
    for kw in ({"least": 4}, {"least": 9, "top": 7}, {"least": 6, "cover": 80}):
        assert got(clashing(table(spark, rows)).selectExpr("*", "1 AS n", "'x' AS key", "2 AS words"), **kw) == slow(rows, **kw)


def test_runs_over_many_tasks(spark):
    rows = [("en", t) for t in texts(60, 7)] + [("en", "to be or not to be " * 40)]
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "41")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(table(spark, rows).repartition(9), least=3) == slow(rows, 3)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    assert spark.range(1).select(F.expr("cast(1000 as decimal(5,0)) * cast(4000000000000 as decimal(16,0)) * cast(900000000000000 as decimal(16,0)) div (cast(4000000000001 as decimal(19,0)) * cast(5000000000000 as decimal(19,0)))")).first()[0] \
        == 1000 * 4000000000000 * 900000000000000 // (4000000000001 * 5000000000000)


def test_chunks_of_a_long_text_count_each_place_once(monkeypatch):
    text = " ".join(texts(40, 2))
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "fr", "en"]), pa.array([text, "à la", text[:200]])], ["lang", "text"])

    def windows():
        out = Counter()
        for lang, words, ids, own in P._chunks(iter([batch])):
            for i in range(own):
                w = [words[j] for j in ids[i:i + 5].tolist()]
                w = w[:w.index(b"\n")] if b"\n" in w else w
                out.update((lang, tuple(w[:k])) for k in range(1, len(w) + 1))
        return out

    want, _ = counts([("en", text), ("fr", "à la"), ("en", text[:200])])
    want = Counter({(lang, tuple(x.encode() for x in w)): n for (lang, w), n in want.items()})
    assert windows() == want
    for part, chunk in ((50, 30), (7, 3), (500, 90)):
        monkeypatch.setattr(P, "PART", part)
        monkeypatch.setattr(P, "CHUNK", chunk)
        assert windows() == want


def test_bit_map_tells_every_member(spark):
    rows = spark.range(3000).selectExpr("xxhash64(id) AS h")
    bits = P.bit_map(rows, "h", 18)
    h = np.array([r[0] for r in rows.collect()]).view(np.uint64)
    assert P._in_map(bits, h, 18).all() and 2900 < np.unpackbits(bits).sum() <= 3000


def test_empty_table(spark):
    assert got(spark.createDataFrame([], DOCS)) == []
