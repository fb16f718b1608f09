"""Quantiles by selection against sorted values."""

import random

import numpy as np
import pytest

from wayfold.operators import analytics as A

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]


@pytest.mark.parametrize("parts", [2, 1024])
def test_quantiles_are_exact_for_skewed_values(spark, monkeypatch, parts):
    monkeypatch.setattr(A, "PARTS", parts)
    rnd = random.Random(1)
    values = {
        "even": [float(k) for k in range(101)], "one": [4.5], "pair": [1.0, 2.0], "same": [3.0] * 50,
        "far": [rnd.gauss(0, 1) for _ in range(300)] + [1e15, -1e12], "tiny": [rnd.random() * 1e-9 for _ in range(200)] + [7.0] * 30,
    }
    rows = [(k, x) for k, own in values.items() for x in own]
    df = spark.createDataFrame(rows, "k string, x double").groupBy("k", "x").count().withColumnRenamed("count", "n")
    found = {r["k"]: r["q"] for r in A.quantiles(df, ["k"], SHARES).collect()}
    for k, own in values.items():
        assert found[k] == pytest.approx(np.quantile(own, SHARES).tolist(), rel=1e-12), k


def test_box_and_distribution_of_few_and_no_values(spark):
    rows = [("a", float(v)) for v in [1, 2, 3, 4, 100]] + [("b", None), ("b", None), (None, 3.0), ("c", 1.0)]
    found = [tuple(r) for r in A.box_stats(spark.createDataFrame(rows, "k string, v double"), "k", "v", 2).collect()]
    assert found == [("a", 5, 1.0, 2.0, 3.0, 4.0, 100.0, 1.0, 4.0, 1), ("b", None, None, None, None, None, None, None, None, 0)]
    empty = spark.createDataFrame([], "v double")
    assert [tuple(r) for r in A.distribution(empty, "v").collect()] == [(None,) * 7]
