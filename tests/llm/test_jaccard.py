import random

import numpy as np
from helpers import DOCS, clashing

from cohortframe.llm import jaccard as J


def slow_set(text, k=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())


def slow(rows, percent=85):
    """(doc_id, set size, least id reachable) by comparing all pairs."""
    sets = [slow_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) > 0:
                label[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return sorted((str(rows[i][0]), len(sets[i]), str(min((x for x in groups[find(i)] if x is not None), default=None))) for i in range(len(rows)))


def texts(n, seed, longest=90, vocabulary=400, edits=4):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    out = []
    for _ in range(n):
        if out and rng.random() < 0.7:
            w = rng.choice(out).split()
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(len(w) + 1)
                w[at:at + rng.randint(0, 1)] = [word()] * rng.randint(0, 2)
            out.append(" ".join(w) or "one")
        else:
            out.append(" ".join(word() for _ in range(rng.randint(1, longest))))
    return out


def got(docs, **kw):
    return sorted((str(r[0]), r[1], str(r[2])) for r in J.join(docs, **kw).select("doc_id", "n_shingles", "component_id").collect())


def test_sets_are_those_of_the_definition(monkeypatch):
    of = J._Hashes()
    for t in [None, "", " \n", "One", "one TWO three", "a b c d", "a a a a a a", "É b\x0bc\x0cd e", *texts(30, 1)]:
        raw = None if t is None else t.encode()
        whole = J.gram_set(raw, 4, of)
        assert len(whole) == len(slow_set(t)) and (np.diff(whole.astype(object)) > 0).all()
        monkeypatch.setattr("cohortframe.llm.words.PART", 7)
        assert J.gram_set(raw, 4, of).tolist() == whole.tolist()
        monkeypatch.undo()
    assert J.gram_set(b"a b", 4, of).tolist() != J.gram_set(b"b a", 4, of).tolist()


def pairs(sets, percent):
    return {(i, j) for i in range(len(sets)) for j in range(len(sets)) if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])}


def test_tree_gives_all_partners_of_every_set():
    rng = random.Random(4)
    for percent in (50, 85, 100):
        for n in (1, 2, 9, 60):
            base = [rng.sample(range(200), rng.randint(1, 60)) for _ in range(max(1, n // 5))]
            sets = {frozenset(x for x in rng.choice(base) if rng.random() < 0.93) | ({rng.randrange(200)} if rng.random() < 0.5 else frozenset()) for _ in range(n)}
            sets = [s for s in sets if s]
            tree = J.Tree([np.array(sorted(s), np.uint64) for s in sets])
            found = {(tree.order[at], tree.order[j]) for at in range(len(sets)) for j in tree.partners(tree.paths[at], percent)}
            assert found == pairs(sets, percent)


def test_prefixes_and_segments_meet_every_pair():
    rng = np.random.default_rng(5)
    for n in (1, 2, 5, 6, 7, 13, 20, 47, 150, 700):
        for _ in range(60):
            a = rng.integers(0, 2**63, n, dtype=np.uint64)
            shared = rng.integers(J.least_overlap(n, 85), n + 1)
            most = shared * 185 // 85 - n  # size of the other set at which the two still link
            b = np.concatenate([a[:shared], rng.integers(0, 2**63, max(0, rng.integers(0, max(1, most - shared + 1))), dtype=np.uint64)])
            a, b = np.unique(a), np.unique(b)
            i = len(np.intersect1d(a, b))
            if 100 * i < 85 * (len(a) + len(b) - i):
                continue
            pa, pb = (s[:len(s) - J.least_overlap(len(s), 85) + J.extra(len(s))] for s in (a, b))
            least = 1 + J.MORE_PREFIX * J.least_overlap(min(len(a), len(b)), 85) // 100
            assert len(np.intersect1d(pa, pb)) >= min(least, i)
            names = [np.concatenate([J.segment_names(s, c, 85) for c in (J.size_class(len(s), 85) - 1, J.size_class(len(s), 85)) if c >= 0]) for s in (a, b)]
            assert len(np.intersect1d(*names))


def test_components_match_brute_force_also_in_small_trees(make):
    rows = [(i * 7 % 1000, t) for i, t in enumerate(texts(260, 9))]
    rows += [(5000, None), (5001, ""), (5002, " \n "), (5003, ""), (8, "the same four words"), (8, "the same four words"), (None, "The SAME four words"), (None, "nothing else"), (9, "two words"), (10, "Two  words")]
    want = slow(rows)
    docs = clashing(make(rows))
    assert got(docs) == want
    assert got(docs, tree_sets=5) == want


def test_one_large_group_of_near_copies(make):
    base = texts(1, 3, longest=80)[0].split() + [f"x{i}" for i in range(120)]
    rng = random.Random(8)
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"y{rng.randrange(9)}"
        rows.append((i, " ".join(w)))
    assert got(make(rows), tree_sets=16) == slow(rows)


def test_long_text_and_empty_table(make, spark):
    long = " ".join(f"w{i % 70000}" for i in range(200_000))
    rows = [(1, long), (2, long + " end"), (3, long[:len(long) // 2])]
    assert got(make(rows)) == slow(rows)
    assert got(spark.createDataFrame([], DOCS)) == []
