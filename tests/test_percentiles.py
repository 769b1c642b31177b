import random
import statistics

import numpy as np
import pytest

from envgrade.operators.percentiles import exact_median, exact_percentiles, exact_profile


def _rows(seed=3):
    rng = random.Random(seed)
    rows = [("hot", rng.uniform(-20, 400)) for _ in range(4000)]
    rows += [("hot", 0.0)] * 1500 + [("hot", -998.0)] * 3
    rows += [(f"g{rng.randrange(40)}", round(rng.gauss(12, 9), 1)) for _ in range(900)]
    rows += [("one", 7.25), ("two", 1.0), ("two", 2.0), ("neg", -0.3), ("neg", -0.1), ("neg", 0.1)]
    rows += [("tiny", v * 1e-9) for v in range(9)] + [("nulls", None), ("nulls", 5.0), (None, 3.0)]
    return rows


@pytest.fixture(scope="module")
def data(spark):
    rows = _rows()
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    return spark.createDataFrame(rows, "g string, v double").repartition(7), groups


def test_median_equals_brute_force(data):
    df, groups = data
    got = {r.g: (r.n, r.m) for r in exact_median(df, ["g"], "v", "m").collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert got[g][0] == len(values)
        assert got[g][1] == pytest.approx(statistics.median(values), abs=1e-12)


def test_percentiles_interpolate(data):
    df, groups = data
    probs = {"a": 0.0, "b": 0.25, "c": 0.9, "d": 1.0}
    got = {r.g: r for r in exact_percentiles(df, ["g"], "v", probs).collect()}
    for g, values in groups.items():
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.percentile(values, p * 100), rel=1e-12, abs=1e-12)


def test_nearest_rank_uses_half_even_ranks(data):
    df, groups = data
    got = {r.g: r.p for r in exact_percentiles(df, ["g"], "v", {"p": 0.5}, nearest_rank=True).collect()}
    for g, values in groups.items():
        assert got[g] == sorted(values)[round(0.5 * (len(values) - 1))]


def test_whole_frame_and_empty(data):
    df, groups = data
    everything = [v for vs in groups.values() for v in vs]
    assert exact_median(df, [], "v", "m").first().m == pytest.approx(statistics.median(everything))
    assert exact_median(df.where("v > 1e9"), ["g"], "v", "m").count() == 0


def test_not_a_number_sorts_last(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (2.0,), (-1.0,)], "v double")
    assert exact_percentiles(df, [], "v", {"m": 0.5, "x": 0.75}).first().x == float("inf")


def test_profile_of_several_columns(spark):
    rows = [("a", float(i), float(i * i)) for i in range(11)] + [("b", 1.0, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    out = {r.g: r for r in exact_profile(df, ["g"], {"x": {"mx": 0.5}, "y": {"my": 0.5, "hi": 1.0}}).collect()}
    assert (out["a"].mx, out["a"].my, out["a"].hi) == (5.0, 25.0, 100.0)
    assert (out["b"].mx, out["b"].my) == (1.0, None)


def test_values_are_shuffled_with_their_group_split(data):
    """The first shuffle spreads a group over its values, and is read by both sides."""
    df, _ = data
    out = exact_median(df, ["g"], "v", "m")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_g" in plan and "_v" in plan.split("hashpartitioning(_g", 1)[1][:60]
    assert "ReusedExchange" in plan


@pytest.mark.parametrize("low, high", [(20.0, 20.01), (1013.0, 1013.5), (0.0, 0.0005), (-7.0, -7.0)])
def test_narrow_ranges_are_exact(spark, low, high):
    rng = random.Random(8)
    values = [rng.uniform(low, high) for _ in range(5000)]
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double").repartition(5)
    row = exact_percentiles(df, ["g"], "v", {"a": 0.1, "m": 0.5, "z": 0.99}).first()
    for name, p in (("a", 10), ("m", 50), ("z", 99)):
        assert row[name] == pytest.approx(np.percentile(values, p), rel=1e-13, abs=1e-13)
