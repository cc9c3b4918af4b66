"""Exact quantiles by selection against the plain way."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortframe.operators import quantiles as Q

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(4)
    n = 6000
    rows = zip(range(n), (None if i % 7 == 0 else i % 3 for i in range(n)), map(float, rng.normal(size=n)), (float(x) if x else None for x in rng.integers(0, 6, n)),
               (float("nan") if i % 5 == 0 else float(v) for i, v in enumerate(rng.pareto(0.4, n))), (1.0 if i % 2 else 2.0 for i in range(n)))
    return spark.createDataFrame(rows, "id int, g int, a double, b double, c double, d double").withColumn("e", F.lit(None).cast("double")).cache()


def plain(values, p):
    v = np.array([x for x in values if x is not None and x == x])
    return None if not len(v) else float(np.quantile(v, p))


@pytest.mark.parametrize("gather", [5, 200, 20_000])
def test_all_columns_groups_and_probabilities(frame, gather):
    wanted = {c: (F.col(c), PROBS) for c in "abcde"}
    rows = frame.collect()
    for by in ([], ["g"]):
        got = Q.exact_quantiles(frame, wanted, by, gather)
        groups = {()} if not by else {(r["g"],) for r in rows}
        assert set(got) == groups
        for g in groups:
            for c in "abcde":
                own = [r[c] for r in rows if not by or (r["g"],) == g]
                for p, v in zip(PROBS, got[g][c]):
                    want = plain(own, p)
                    assert v is None if want is None else v == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_a_wrong_sketch_is_mended(frame, monkeypatch):
    real = Q._bracket
    calls = []

    def wrong(points, share, low, high):
        calls.append(share)
        return (points[0], points[1]) if len(calls) < 4 else real(points, share, low, high)
    monkeypatch.setattr(Q, "_bracket", wrong)
    got = Q.exact_quantiles(frame, {"a": (F.col("a"), [0.5, 0.9])}, gather=50)[()]["a"]
    values = [r["a"] for r in frame.collect()]
    assert got == pytest.approx([plain(values, 0.5), plain(values, 0.9)])


def test_empty_and_too_many_groups(spark, frame, monkeypatch):
    none = spark.createDataFrame([], "g int, a double")
    assert Q.exact_quantiles(none, {"a": (F.col("a"), [0.5])}) == {(): {"a": [None]}}
    assert Q.exact_quantiles(none, {"a": (F.col("a"), [0.5])}, ["g"]) == {}
    monkeypatch.setattr(Q, "MAX_GROUPS", 3)
    with pytest.raises(ValueError):
        Q.exact_quantiles(frame, {"a": (F.col("a"), [0.5])}, ["id"])


def test_no_fit_merges_all_values_in_one_task():
    import pathlib
    import re
    for f in pathlib.Path(Q.__file__).parent.glob("*.py"):
        assert not re.search(r"F\.(percentile|median)\(", f.read_text()), f.name
