"""URL filter: explicit rules first, else logistic regression on hashed character n-grams of host and path.

The regression is trained by gradient descent in numpy from a small table of labelled URLs.  Rules are
looked up by the suffixes of a host and the prefixes of a path, so their number does not slow a row.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortframe.llm.ngrams import hashed, packed

BITS, SIZES = 14, (3, 4, 5)
RATE, STEPS, PENALTY = 2.0, 400, 1e-3
THRESHOLD = 0.5
#: Rules are sent to the tasks; more than this many belong in a table that is joined.
MAX_RULES = 100_000
BYTES = 1 << 20
UPPER = {c: c + 32 for c in range(65, 91)}

# Words that site names are made of, by what the sites offer (general vocabulary, no lists of sites).
_BLOCKED = {
    "gambling": "casino poker roulette blackjack jackpot slots bingo lottery bets betting bookmaker wager gambling",
    "adult": "adult porn xxx sex nude erotic escorts cams fetish hentai milf webcam hookup",
    "medicine": "pills viagra cialis tablets pharmacy steroids slimming diet detox weightloss meds",
    "money": "payday loans credit forex crypto doubler profit binary earn cash rich money",
    "lures": "free win winner prize bonus giveaway cheap discount deals coupon lucky hot vip",
    "piracy": "warez crack keygen torrent serial nulled cracked leaked stream",
    "spam": "spam seo links backlinks farm traffic clicks popup ads adserver track tracker doorway replica fake",
}
_ALLOWED = {
    "press": "news daily times herald journal gazette review report press post weekly magazine",
    "learning": "school university college library science physics history maths lessons academy institute course language",
    "places": "city town village river lake mountain harbour bridge county region island forest",
    "public": "council ministry health museum archive community radio station office public society",
    "life": "garden kitchen cooking travel family home music film theatre book photo art craft",
    "sport": "football chess hiking cycling running sailing club team league tennis",
    "work": "software code linux data engineering design studio works tools open project group",
}
#: Letters of made-up names, which say nothing: an unknown name alone is no reason to block.
_FIRST, _VOWELS, _LAST = "bcdfghjklmnprstvwz", "aeiou", ["", "n", "r", "l", "s", "t"]
_HOSTS = ("www.{}.com", "{}.net", "blog.{}.org", "m.{}.com", "{}.info", "shop.{}.co.uk")
_PATHS = ("/", "/index.html", "/2024/05/an-article", "/page/12", "/products?id=7", "/about")
#: Names made of each group of words, and made-up ones.
NAMES, MADE_UP = 40, 400


def _names(groups: dict[str, str], seed: int) -> list[str]:
    """Site names of two words: mostly of one group, else of any two, joined or hyphenated."""
    rng = random.Random(seed)
    every = [w.split() for w in groups.values()]
    out = []
    for words in every:
        for k in range(NAMES):
            a = words[k % len(words)]  # each word comes up
            b = rng.choice([w for w in (words if rng.random() < 0.6 else rng.choice(every)) if w != a])
            pair = [a, b] if rng.random() < 0.5 else [b, a]
            out.append(rng.choice(["-", "-", ""]).join(pair))
    return out


def labelled_urls(seed: int = 1) -> list[tuple[str, int]]:
    """The training table: some 960 rows ``(url, 1 to block or 0 to allow)``, made by rule from the words above."""
    rng = random.Random(seed)
    names = [(n, 1) for n in _names(_BLOCKED, seed)] + [(n, 0) for n in _names(_ALLOWED, seed + 1)]
    syllable = lambda: rng.choice(_FIRST) * (rng.random() < 0.8) + rng.choice(_VOWELS) + rng.choice(_LAST)
    names += [("".join(syllable() for _ in range(rng.randint(2, 4))), 0) for _ in range(MADE_UP)]
    rows = [(f"https://{_HOSTS[rng.randrange(len(_HOSTS))].format(n)}{rng.choice(_PATHS)}", y) for n, y in names]
    return [*rows, ("", 0), ("/relative/path", 0)]


def parts(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3:]
    end = min((k for k in map(rest.find, "/?#") if k >= 0), default=len(rest))
    tail = rest[end:]
    stop = min((k for k in map(tail.find, "?#") if k >= 0), default=len(tail))
    return rest[:end].translate(UPPER), tail[:stop]


def _grams(host: str, path: str) -> tuple[bytes, bytes]:
    return b"^" + host.encode() + b"$", b"^" + path.encode() + b"$"


class Regression:
    """Weights for each bucket of the host's and of the path's n-grams."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def scores(self, urls: list[tuple[str, str]]) -> np.ndarray:
        """Probability that each (host, path) is to be blocked."""
        z = np.full(len(urls), self.bias)
        for side, texts in enumerate(zip(*(_grams(h, p) for h, p in urls))) if urls else ():
            for i, rows in _buckets(texts):
                np.add.at(z, i, self.weights[side][rows])
        return 1 / (1 + np.exp(-z))


def _buckets(texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of the text, bucket) of every n-gram that lies within one text."""
    for data, starts, index in packed(texts, BYTES):
        sizes = np.diff(np.r_[starts, len(data)])
        owner, left = np.repeat(np.array(index), sizes), np.repeat(starts + sizes, sizes) - np.arange(len(data))
        for n in SIZES:
            rows = hashed(data, n, BITS)
            ok = left[:len(rows)] >= n
            yield owner[:len(rows)][ok], rows[ok]


def train(rows: list[tuple[str, int]]) -> Regression:
    """Fit on ``(url, 1 to block or 0)``; an empty table gives one that allows all."""
    weights, bias = np.zeros((2, 1 << BITS)), 0.0
    if not rows:
        return Regression(weights, -10.0)
    urls, y = [parts(u) for u, _ in rows], np.array([label for _, label in rows], float)
    sides = list(zip(*(_grams(h, p) for h, p in urls)))
    at = [[np.concatenate(x) for x in zip(*_buckets(side))] for side in sides]
    size = sum(np.bincount(i, minlength=len(rows)) for i, _ in at)
    for _ in range(STEPS):
        z = np.full(len(rows), bias)
        for side, (i, b) in enumerate(at):
            z += np.bincount(i, weights[side][b], len(rows))
        g = (1 / (1 + np.exp(-z)) - y) / len(rows)
        for side, (i, b) in enumerate(at):
            weights[side] -= RATE * (np.bincount(b, g[i], 1 << BITS) + PENALTY * weights[side] / max(1, size.mean()))
        bias -= RATE * g.sum() / 10
    return Regression(weights, bias)


class Rules:
    """``(verdict, host, path prefix)``: a rule fits its host and all below it, where the path begins with its path."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        if len(rules) > MAX_RULES:
            raise ValueError(f"over {MAX_RULES} rules")
        self.by_host: dict[str, dict[str, str]] = {}
        for verdict, host, path in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict {verdict!r}")
            self.by_host.setdefault(host, {}).setdefault(path, verdict)
        self.lengths = {host: sorted({len(p) for p in paths}, reverse=True) for host, paths in self.by_host.items()}

    def match(self, host: str, path: str) -> tuple[str | None, str | None]:
        """The longest fitting rule, host and path together, and its verdict."""
        best: tuple[int, str, str] | None = None
        name = host
        while True:
            for n in self.lengths.get(name, ()):
                verdict = self.by_host[name].get(path[:n]) if n <= len(path) else None
                if verdict:
                    found = len(name) + n, name + path[:n], verdict
                    best = found if best is None or found[0] > best[0] else best
                    break
            if "." not in name:
                return (best[1], best[2]) if best else (None, None)
            name = name.partition(".")[2]


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], model: Regression | None = None, id_col: str = "page_id", url_col: str = "url",
          threshold: float = THRESHOLD) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)`` for each row; ``score`` is the regression's, whatever the rules say.

    A null URL or one without ``://`` has an empty host and path; no rule fits it, and the regression judges it like
    any other (the training table has such rows, allowed).  Repeated rows give a row each; an empty table gives none; other
    columns are not looked at.
    """
    table, regression = Rules(rules), model or train(labelled_urls())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            urls = [parts(u) for u in b.column(1).to_pylist()]
            score = regression.scores(urls)
            found = [table.match(*u) for u in urls]
            verdict = [v or ("block" if s > threshold else "allow") for (_, v), s in zip(found, score)]
            cols = [pa.array(x, pa.string()) for x in ([h for h, _ in urls], [p for _, p in urls], [r for r, _ in found], verdict)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols, pa.array(score, pa.float64())], ["page_id", "host", "path", "rule", "verdict", "score"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    return rows.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, score double")
