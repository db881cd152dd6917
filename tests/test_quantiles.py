"""Cut points of many columns: one sketch a column, exact whatever the sketch says."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickforge.operators import ordering

MARKS = [i / 16 for i in range(1, 16)]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    n = 3000
    some = np.where(rng.random(n) < 0.3, np.nan, rng.exponential(size=n))
    return pd.DataFrame({"a": rng.normal(size=n), "few": rng.integers(0, 5, n).astype(float), "c.d": some, "none": [None] * n, "one": np.ones(n)})


def cuts(spark, data, small):
    df = spark.createDataFrame(data, "a double, few double, `c.d` double, none double, one double").repartition(5)
    return ordering.exact_cut_points(df, {c: F.col(f"`{c}`") for c in data}, MARKS, small, 50 if small == 0 else None)


def expected(data):
    return {c: sorted(set(np.quantile(data[c].dropna(), MARKS))) if c != "none" else [] for c in data}


@pytest.mark.parametrize("small", [None, 0])
def test_marks_of_a_column_share_one_aggregate(spark, data, small, monkeypatch):
    made = []
    for name in ("percentile", "percentile_approx"):
        monkeypatch.setattr(ordering.F, name, lambda *args, real=getattr(F, name): made.append(1) or real(*args))
    got = cuts(spark, data, small)
    assert len(made) == (5 if small is None else 4)  # a column never known needs no sketch
    for c, want in expected(data).items():
        assert got[c] == pytest.approx(want)


def test_cut_points_outside_the_brackets_are_found(spark, data, monkeypatch):
    wrong = F.array(*[F.lit(0.9 + i // 2 / 100) for i in range(2 * len(MARKS))])
    monkeypatch.setattr(ordering.F, "percentile_approx", lambda *args: F.first(wrong))
    got = cuts(spark, data, 0)
    for c, want in expected(data).items():
        assert got[c] == pytest.approx(want)
