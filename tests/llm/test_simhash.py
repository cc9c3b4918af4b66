import random

import numpy as np
import xxhash
from helpers import DOCS, clashing

from cohortframe.llm import simhash as S


def slow_fingerprint(text, k=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for i in range(64):
            ones[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * ones[i] > len(grams))


def slow_components(ids, fps, bits=3):
    lab = dict(enumerate(range(len(fps))))
    def find(i):
        while lab[i] != i:
            i = lab[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                lab[find(i)] = find(j)
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(find(i), []).append(ids[i])
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(fps))]


def texts(n=120, seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 5)))
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            w = rng.choice(out).split(" ")
            w[rng.randrange(len(w))] = word()
            out.append(" ".join(w))
        else:
            out.append(" ".join(word() for _ in range(rng.randint(1, 60))))
    return out


def test_fingerprint_matches_the_definition():
    for t in [None, "", " \t\n", "One", "one TWO", "a a a a", *texts(40), "Ünï ÀB c\x0bd\x0ce"]:
        assert S.fingerprint(None if t is None else t.encode()) == slow_fingerprint(t)


def test_long_text_is_hashed_whole(monkeypatch):
    text = " ".join(texts(30))
    want = S.fingerprint(text.encode())
    monkeypatch.setattr(S, "CHUNK", 7)
    assert S.fingerprint(text.encode()) == want == slow_fingerprint(text)


def test_index_finds_all_links_and_emits_a_forest():
    rng = np.random.default_rng(2)
    for n in (2, 17, 40, 300):
        base = rng.integers(0, 2**63, size=max(1, n // 12), dtype=np.uint64)
        f = base[rng.integers(0, len(base), n)]
        for _ in range(4):
            f = f ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)) * (rng.random(n) < 0.6).astype(np.uint64)
        f = np.unique(f)
        u, v = S.forest(f, np.array([0]), np.array([len(f)]), 3)
        assert len(u) < len(f)
        got = slow_components(list(range(len(f))), [int(x) for x in f])
        lab = {int(x): int(x) for x in f}
        def find(x):
            while lab[x] != x:
                x = lab[x]
            return x
        for a, b in zip(u, v):
            lab[find(int(a))] = find(int(b))
        assert len({find(int(x)) for x in f}) == len(set(got))


def test_components_match_brute_force_also_with_refined_nodes(make):
    rows = [(i * 3 % 1000, t) for i, t in enumerate(texts())] + [(5000, None), (5001, ""), (5002, "  "), (7, "same same"), (7, "same same"), (None, "same same"), (None, "alone in the world here")]
    fps = [slow_fingerprint(t) for _, t in rows]
    want = sorted(zip([str(i) for i, _ in rows], [f"{f:016x}" for f in fps], map(str, slow_components([i for i, _ in rows], fps))))
    for limit in (4096, 4):
        got = S.near_duplicates(clashing(make(rows)), node_limit=limit).select("doc_id", "fingerprint", "component_id").collect()
        assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == want


def test_keep_first_keeps_one_row_of_each_component(make):
    rows = [(3, "a b c d"), (1, "a b c d"), (1, "a b c d"), (2, "other words stand here"), (None, "a b c d"), (None, "nobody knows my id at all"), (9, None), (8, "")]
    docs = clashing(make(rows))
    kept = S.keep_first(docs, S.near_duplicates(docs))
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect()) == [("1", "a b c d"), ("2", "other words stand here"), ("8", ""), ("None", "nobody knows my id at all")]


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert S.near_duplicates(docs).collect() == [] and S.keep_first(docs, S.near_duplicates(docs)).collect() == []
