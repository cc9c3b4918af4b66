from collections import Counter

from helpers import DOCS, clashing

from cohortframe.llm import lines as L


def slow(rows, ratio, least):
    pages, seen = Counter(), Counter()
    for _, text, host in rows:
        if host is not None:
            pages[host] += 1
            for x in {y.strip(" \t\r") for y in (text or "").split("\n")} - {""}:
                seen[host, x] += 1
    bad = {k for k, n in seen.items() if n >= least and n > ratio * pages[k[0]]}
    out = []
    for i, text, host in rows:
        out.append((i, text if text is None else "\n".join(x for x in text.split("\n") if (host, x.strip(" \t\r")) not in bad)))
    return out


def test_lines_match_brute_force(spark, make):
    rows = [(i, f"Menu\nbody {i}\n\n  Menu \nline {i % 7}\r", "a") for i in range(40)]
    rows += [(100 + i, f"Menu\nbody {i}", "b") for i in range(2)] + [(200, None, "a"), (201, "", "a"), (202, "Menu", None), (203, "Menu", "a"), (203, "Menu", "a"), (None, "Menu\nx", "a")]
    docs = clashing(spark.createDataFrame([(i, t, "en", h, len(t or "")) for i, t, h in rows], DOCS))
    got = L.line_dedup(docs, ratio=0.2, min_pages=3, counts=True)
    assert got.columns[:len(docs.columns)] == docs.columns and got.columns[-2:] == ["_n_lines", "n_dropped"]
    got = got.collect()
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in got))) == sorted(map(str, slow(rows, 0.2, 3)))
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in got)
    assert {r["doc_id"]: r["text"] for r in got}[203] == "" and {r["doc_id"]: r["text"] for r in got}[202] == "Menu"


def test_a_line_on_exactly_the_ratio_stays(make):
    rows = [(i, "x" if i < 4 else f"y{i}", "h") for i in range(16)]
    assert all(r["text"] for r in L.line_dedup(make(rows), ratio=0.25).collect())
    assert sum(r["text"] == "" for r in L.line_dedup(make(rows), ratio=0.24).collect()) == 4


def test_empty_table_and_long_text(spark, make):
    assert L.line_dedup(spark.createDataFrame([], DOCS)).collect() == []
    long = "\n".join(f"line {i}" for i in range(50_000))
    assert L.line_dedup(make([(1, long)])).first()["text"] == long


def test_boilerplate_goes_from_every_host_that_has_it(make):
    import random
    rng = random.Random(5)
    rows = [(1000 * h + i, f"own text {h} {i}" + ("\nAll rights reserved." if rng.random() < 0.1 else "") + ("\nsee also" if rng.random() < 0.01 else ""), f"h{h}") for h in range(12) for i in range(400)]
    got = {r["doc_id"]: r["text"] for r in L.line_dedup(make(rows)).collect()}
    assert all("rights" not in t and "own text" in t for t in got.values())
    assert sum("see also" in t for t in got.values()) == sum("see also" in t for _, t, _ in rows)


def test_small_hosts_keep_what_does_not_repeat(make):
    rows = [(1, "a\nfooter", "two"), (2, "b\nfooter", "two"), (3, "c\nd", "one")]
    assert {r["doc_id"]: r["text"] for r in L.line_dedup(make(rows)).collect()} == {1: "a", 2: "b", 3: "c\nd"}
