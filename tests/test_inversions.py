"""Discordant pairs digit by digit against all pairs; groups raise when they outgrow ``leaf``."""

import numpy as np
import pytest

from tessera.operators import inversions as I
from tessera.operators import metrics as M

PAIR = "a double, b double, w long"


def brute(rows):
    """Pairs with a rising and b falling, by weight."""
    a, b, w = (np.array(x, dtype=object) for x in zip(*rows))
    return sum(int(w[i]) * int(w[j]) for i in range(len(a)) for j in range(len(a)) if a[i] < a[j] and b[i] > b[j])


def distinct(rng, n, hot):
    """Distinct pairs; a share ``hot`` of them in one value of a, as many in one value of b."""
    rows = {(float(rng.integers(60)), float(rng.integers(60))) for _ in range(n)}
    rows |= {(7.0, float(k)) for k in range(int(n * hot))} | {(float(k), 3.0) for k in range(int(n * hot))}
    return [(a, b, int(rng.integers(1, 5))) for a, b in sorted(rows)]


@pytest.mark.parametrize("leaf,bits", [(1, 2), (8, 3), (32, 8), (1 << 17, 8)])
def test_against_all_pairs_in_bounded_groups(spark, leaf, bits):
    rows = distinct(np.random.default_rng(leaf), 120, 0.5)
    df = spark.createDataFrame(rows, PAIR).repartition(5)
    assert int(I.discordant_weight(df, "a", "b", "w", leaf, bits).first().d) == brute(rows)


def test_sorted_and_reversed_orders(spark):
    """Orders that agree or oppose put a whole node into few blocks; blocks stay at ``leaf`` rows."""
    n = 100
    up = spark.createDataFrame([(float(k), float(k), 1) for k in range(n)], PAIR)
    down = spark.createDataFrame([(float(k), float(-k), 1) for k in range(n)], PAIR)
    assert int(I.discordant_weight(up, "a", "b", "w", 8, 2).first().d) == 0
    assert int(I.discordant_weight(down, "a", "b", "w", 8, 2).first().d) == n * (n - 1) // 2


def test_weights_beyond_64_bits(spark):
    big = 3_000_000_000
    rows = [(1.0, 3.0, big), (2.0, 2.0, big), (3.0, 1.0, big), (4.0, 4.0, 1)]
    df = spark.createDataFrame(rows, PAIR)
    for leaf in (1, 2, 16):
        assert int(I.discordant_weight(df, "a", "b", "w", leaf, 1).first().d) == 3 * big * big


def test_no_rows_nulls_and_one_value(spark):
    none = spark.createDataFrame([], "x double, y double")
    assert [(r.tau_b, r.n) for r in M.kendall_tau(none, "x", "y").collect()] == [(None, None)]
    part = spark.createDataFrame([(1.0, None), (None, 1.0), (float("nan"), 2.0), (1.0, 2.0), (2.0, 1.0), (-0.0, 0.0), (0.0, -0.0)],
                                 "x double, y double")
    r = M.kendall_tau(part, "x", "y", leaf=1).first()
    assert (r.n, r.discordant) == (4, 1)
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "x double, y double")
    assert M.kendall_tau(flat, "x", "y").first().tau_b is None
    with pytest.raises(ValueError):
        I.discordant_weight(none.withColumn("w", none.x), "x", "y", "w", 12)
