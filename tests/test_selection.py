"""Order statistics against a sort."""

import random

import numpy as np
import pytest

from tilewright.functions import selection

CASES = {
    "heavy tails": lambda r: r.choice([1e-300, 1.0, 1e300]) * r.random(),
    "two values": lambda r: r.choice([1.0, 2.0]),
    "one value": lambda r: 5.0,
    "ties and spread": lambda r: float(r.choice([0, 0, 0, r.randrange(1000)])),
    "signs": lambda r: r.gauss(0, 1),
}


@pytest.mark.parametrize("case", CASES)
def test_against_a_sort(spark, case):
    rng = random.Random(case)
    x = [CASES[case](rng) for _ in range(6000)]
    df = spark.createDataFrame([(v,) for v in x] + [(None,)] * 5, "v double").repartition(6)
    ranks = [0, 1, 17, 2999, 3000, 5400, 5998, 5999]
    want = sorted(x)
    assert selection.order_statistics(df, "v", ranks, few=50, error=0.05) == {r: want[r] for r in ranks}
    shares = [0.0, 0.01, 0.5, 0.9, 0.999, 1.0]
    n, got = selection.quantiles(df, "v", shares, few=3, error=0.1)
    assert n == 6000 and np.allclose(got, np.quantile(x, shares), rtol=1e-12, atol=0)


def test_few_none_and_out_of_range(spark):
    none = spark.createDataFrame([(None,)], "v double")
    assert selection.quantiles(none, "v", [0.5]) == (0, [None])
    assert selection.quantiles(spark.createDataFrame([(2.0,)], "v double"), "v", [0.0, 0.5, 1.0]) == (1, [2.0, 2.0, 2.0])
    with pytest.raises(ValueError):
        selection.order_statistics(none, "v", [0])
