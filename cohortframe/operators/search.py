"""Tree-structured Parzen search (I10): which settings to try next, from the trials so far.

The trials are split into the better ones and the rest; for each range two densities are kernels around their values, and of
candidates drawn from the first density the one with the highest ratio of the two is tried.  Trials come in
batches, which train side by side in one scan; a batch's own proposals count among the rest until
they are scored, so that it spreads.
"""

from __future__ import annotations

import math
import random

# Search ranges (kind, low, high).
SEARCH_SPACE = {
    "gbt_a": {"rounds": ("int", 100, 500), "depth": ("int", 3, 10), "rate": ("log", 0.01, 0.3), "row_share": ("float", 0.6, 1.0), "column_share": ("float", 0.6, 1.0),
              "least_gain": ("float", 0.0, 5.0), "least_weight": ("int", 1, 10), "l1": ("float", 0.0, 10.0), "l2": ("float", 0.0, 10.0)},
    "gbt_b": {"rounds": ("int", 100, 500), "depth": ("int", 3, 8), "rate": ("log", 0.01, 0.3), "row_share": ("float", 0.7, 1.0), "column_share": ("float", 0.7, 1.0),
              "least_rows": ("int", 20, 100), "leaves": ("int", 20, 100), "least_gain": ("float", 0.0, 1.0), "l1": ("float", 0.0, 5.0), "l2": ("float", 0.0, 5.0)},
    "gbt_c": {"rounds": ("int", 100, 500), "depth": ("int", 3, 10), "rate": ("log", 0.01, 0.3), "l2": ("float", 1.0, 10.0)},
}
TRIALS = 50
#: Random trials before the densities are used, trials of a batch, candidates for each range.
STARTUP, BATCH, CANDIDATES = 10, 10, 24


def _inside(kind: str, lo: float, hi: float) -> tuple[float, float]:
    """The range on which the kernels stand: logarithms, or whole numbers with half a step on each side."""
    if kind == "log":
        return math.log(lo), math.log(hi)
    return (lo - 0.5, hi + 0.5) if kind == "int" else (lo, hi)


def _to(kind: str, v: float) -> float:
    return math.log(v) if kind == "log" else float(v)


def _from(kind: str, x: float, lo: float, hi: float) -> float | int:
    if kind == "int":
        return int(min(hi, max(lo, round(x))))
    return min(hi, max(lo, math.exp(x) if kind == "log" else x))


class Parzen:
    """Truncated normal kernels around ``values`` and one wide kernel over the whole range, equally weighted."""

    def __init__(self, values: list[float], lo: float, hi: float):
        self.lo, self.hi = lo, hi
        middle, span = (lo + hi) / 2, hi - lo
        kernels = sorted([(v, False) for v in values] + [(middle, True)])
        least = span / min(100, 1 + len(kernels))
        self.kernels = []
        for i, (v, prior) in enumerate(kernels):
            below = v - (kernels[i - 1][0] if i else lo)
            above = (kernels[i + 1][0] if i + 1 < len(kernels) else hi) - v
            self.kernels.append((v, span if prior else min(span, max(least, below, above))))

    def draw(self, rng: random.Random) -> float:
        mean, width = rng.choice(self.kernels)
        for _ in range(100):
            x = rng.gauss(mean, width)
            if self.lo <= x <= self.hi:
                return x
        return min(self.hi, max(self.lo, mean))

    def log_density(self, x: float) -> float:
        cdf = lambda z: 0.5 * (1 + math.erf(z / math.sqrt(2)))
        total = 0.0
        for mean, width in self.kernels:
            mass = cdf((self.hi - mean) / width) - cdf((self.lo - mean) / width)
            total += math.exp(-0.5 * ((x - mean) / width) ** 2) / (width * max(mass, 1e-12))
        return math.log(max(total / len(self.kernels), 1e-300))


def draw_random(space: dict, rng: random.Random) -> dict:
    out = {}
    for name, (kind, lo, hi) in space.items():
        a, b = _inside(kind, lo, hi)
        out[name] = _from(kind, rng.uniform(a, b), lo, hi)
    return out


def better_count(n: int) -> int:
    """How many of ``n`` trials count as the better ones."""
    return min(25, -(-n // 10))


def propose(space: dict, trials: list[tuple[dict, float]], pending: list[dict], rng: random.Random, candidates: int = CANDIDATES) -> dict:
    """The next settings to try; ``trials`` are (settings, score), higher scores are better."""
    order = sorted(range(len(trials)), key=lambda i: (-trials[i][1], i))
    n = better_count(len(trials))
    good, rest = [trials[i][0] for i in order[:n]], [trials[i][0] for i in order[n:]] + pending
    out = {}
    for name, (kind, lo, hi) in space.items():
        a, b = _inside(kind, lo, hi)
        better, others = (Parzen([_to(kind, t[name]) for t in side], a, b) for side in (good, rest))
        drawn = [better.draw(rng) for _ in range(candidates)]
        out[name] = _from(kind, max(drawn, key=lambda x: better.log_density(x) - others.log_density(x)), lo, hi)
    return out


def search(space: dict, evaluate, n_trials: int = TRIALS, seed: int = 55, startup: int = STARTUP, batch: int = BATCH) -> list[tuple[dict, float, str | None]]:
    """``(settings, score, error)`` of every trial.

    ``evaluate`` takes the settings of a batch and gives ``(score, error)`` for each; a trial with an error
    scores 0.0.  If every trial fails there is nothing to choose from, and that is an error.
    """
    rng = random.Random(seed)
    done: list[tuple[dict, float, str | None]] = []
    while len(done) < n_trials:
        todo: list[dict] = []
        for _ in range(min(batch, n_trials - len(done))):
            known = [(d, s) for d, s, _ in done]
            todo.append(draw_random(space, rng) if len(done) + len(todo) < startup or not known else propose(space, known, todo, rng))
        for settings, (score, error) in zip(todo, evaluate(todo)):
            done.append((settings, score if error is None and score == score else 0.0, error))
    if all(e is not None for _, _, e in done):
        raise RuntimeError(f"every trial failed, the last with {done[-1][2]}")
    return done
