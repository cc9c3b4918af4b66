import math

import numpy as np
from helpers import clashing

from cohortframe.llm import queries, urls as U

PAGES = "page_id long, url string"


def slow_rule(host, path, rules):
    best = None
    for verdict, h, p in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = h + p, verdict
    return best or (None, None)


def test_parts():
    assert U.parts("https://WWW.Ex.ÉOrg:80/A/b?c#d") == ("www.ex.Éorg:80", "/A/b")
    assert U.parts("http://a") == ("a", "") and U.parts("http://a?x/y") == ("a", "") and U.parts("http://a/p#f?x") == ("a", "/p")
    assert U.parts("x://a://b/c") == ("a:", "//b/c") and U.parts("mailto:x") == ("", "") == U.parts(None) and U.parts("") == ("", "")


def test_rules_match_brute_force():
    rules = queries.URL_RULES + [("block", "a.org", "/en/"), ("allow", "a.org", "/")]
    table = U.Rules(rules)
    hosts = ["org", "a.org", "b.a.org", "ba.org", "example.org", "x.example.org", "com", "m.com", "net", "", "org.", ".org"]
    for h in hosts:
        for p in ["", "/", "/en/", "/en/1", "/en/12", "/es/", "/es", "/fr/2", "/de/", "/x"]:
            if h:
                assert table.match(h, p) == slow_rule(h, p, rules), (h, p)


def right(model, rows):
    return sum((model.scores([U.parts(u)])[0] > 0.5) == bool(y) for u, y in rows) / len(rows)


def test_model_judges_names_it_has_not_seen():
    rows = U.labelled_urls()
    assert right(U.train(rows), rows) > 0.97
    name = lambda u: U.parts(u)[0]
    names = sorted({name(u) for u, _ in rows})
    found = []
    for k in range(5):
        held = set(names[k::5])  # names are held out whole
        found.append(right(U.train([r for r in rows if name(r[0]) not in held]), [r for r in rows if name(r[0]) in held]))
    assert sum(found) / 5 >= 0.8, found


def test_scores_match_brute_force():
    model = U.train(U.labelled_urls()[:60])
    for url in ("https://www.some-casino.net/a?b", "http://x/", "", "no url", "https://é.org/ü" * 3):
        z = model.bias
        for side, text in enumerate(U.parts(url)):
            data = b"^" + text.encode() + b"$"
            for n in U.SIZES:
                for at in range(len(data) - n + 1):
                    h = n * 0x85EBCA6B & 0xFFFFFFFF
                    for c in data[at:at + n]:
                        h = (h ^ c) * 0x9E3779B1 & 0xFFFFFFFF
                        h ^= h >> 15
                    z += model.weights[side][h >> 32 - U.BITS]
        assert abs(model.scores([U.parts(url)])[0] - 1 / (1 + math.exp(-z))) < 1e-9


def test_training_ends_at_the_minimum_of_its_loss():
    rows = U.labelled_urls()[::9]
    model = U.train(rows)
    y = np.array([label for _, label in rows], float)
    urls = [U.parts(u) for u, _ in rows]
    loss = lambda p: -np.log(np.where(y > 0, p, 1 - p)).mean()
    at = loss(model.scores(urls))
    assert at < 0.2
    for side in (0, 1):
        for k in np.argsort(-np.abs(model.weights[side]))[:5]:
            for step in (-0.2, 0.2):
                moved = U.Regression(model.weights.copy(), model.bias)
                moved.weights[side][k] += step
                assert loss(moved.scores(urls)) > at - 0.02


def test_query_rows(spark):
    rows = [(1, "https://www.cheap-viagra.example.net/en/1"), (2, "http://a.org/x"), (3, None), (4, ""), (5, "no url"), (6, "http://m.poker-bonus.example.com/fr/1"),
            (7, "http://thand.example.com/de/1"), (7, "http://thand.example.com/de/1"), (None, "http://free-slots.example.net/x"), (8, "http://a.net/" + "p" * 100_000)]
    df = clashing(spark.createDataFrame(rows, PAGES)).selectExpr("*", "1 as host", "2 as path", "3 as rule", "4 as verdict")
    got = {r["page_id"]: r for r in U.judge(df, queries.URL_RULES).collect()}
    assert got[1]["rule"] is None and got[1]["verdict"] == "block"
    assert (got[2]["rule"], got[2]["verdict"]) == ("org/", "allow")
    assert all((got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == ("", "", None, "allow") for i in (3, 4, 5))
    assert (got[6]["rule"], got[6]["verdict"]) == ("com/fr/", "allow") and (got[7]["rule"], got[7]["verdict"]) == ("com/de/", "block")
    assert got[None]["verdict"] == "block" and len(got[8]["path"]) == 100_001
    assert U.judge(spark.createDataFrame([], PAGES), queries.URL_RULES).collect() == []
    assert U.train([]).scores([("a", "/")])[0] < 0.5
