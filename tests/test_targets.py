"""Targets, scores, calibration and sampling."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from terrace.operators import sampling, scoring
from terrace.operators import targets as t
from terrace.operators.calibration import calibrate_to_group_mean
from terrace.plans import retail
from terrace.sources.staging import stage


@pytest.fixture(scope="module")
def national(spark):
    return spark.createDataFrame([(2023, 56.0), (2024, 59.2), (2025, 66.0)], "yr long, computed double")


@pytest.fixture(scope="module")
def actuals(spark):
    return spark.createDataFrame(
        [(1, 2023, 85.0), (1, 2024, 84.0), (2, 2024, 36.0), (3, 2025, 50.0)],
        "group_id long, yr long, computed double")


@pytest.fixture(scope="module")
def groups(spark):
    return spark.createDataFrame([(1,), (2,), (3,)], "group_id long")


def test_baselines(groups, actuals, national):
    rows = {r.group_id: (round(r.base, 6), r.base_source)
            for r in t.baselines(groups, actuals, national, 2023).collect()}
    assert rows == {1: (85.0, "BASE_YEAR"), 2: (32.8, "NEXT_YEAR"), 3: (56.0, "NATIONAL")}


def test_targets_reach_the_goal(groups, actuals, national):
    base = t.baselines(groups, actuals, national, 2023)
    rows = {(r.group_id, r.yr): r.target for r in t.group_targets(base, 2023, 2030).collect()}
    assert len(rows) == 24 and rows[1, 2023] is None
    assert {rows[g, 2030] for g in (1, 2, 3)} == {80.0}
    # never anchored on the result of the year under review
    assert rows[2, 2024] != 36.0 and rows[2, 2024] == round(32.8 + (80 - 32.8) / 7, 1)


def test_trajectory_is_clipped(spark):
    row = spark.range(1).select(
        t.trajectory(F.lit(150.0), F.lit(2024), 2023, 2030).alias("high"),
        t.trajectory(F.lit(-90.0), F.lit(2024), 2023, 2030).alias("low")).head()
    assert (row.high, row.low) == (100.0, 0.0)


def test_national_targets(spark):
    published = spark.createDataFrame(
        [(2024, 60.0), (2025, 64.0), (2026, 67.0), (2030, 80.0)], "yr long, target double")
    rows = {r.yr: (r.target, r.target_source)
            for r in t.national_targets(published, 2024, 2026, 2030).collect()}
    assert rows[2025] == (64.0, "PUBLISHED") and rows[2030] == (80.0, "PUBLISHED")
    assert rows[2028] == (73.5, "INTERPOLATED") and 67 < rows[2027][0] < 80


def test_group_values_with_fallback(spark, groups, national):
    published = spark.createDataFrame(
        [(1, 2024, 98.0), (1, 2025, 70.0), (2, 2024, 97.0)],
        "group_id long, yr long, published double")
    years = t.scaffold(groups, 2024, 2025)
    rows = {(r.group_id, r.yr): (r.value, r.value_source) for r in
            t.group_values_with_fallback(years, published, national, 2024).collect()}
    assert rows[1, 2025] == (70.0, "PUBLISHED")
    assert rows[2, 2025] == (99.0, "ESTIMATED")
    assert rows[3, 2024] == (59.2, "ESTIMATED")


def test_zscores(spark):
    values = [("a", 1.0), ("a", 2.0), ("a", 6.0), ("b", 5.0), ("b", 5.0), (None, 1.0), (None, 3.0)]
    df = spark.createDataFrame(values, "g string, x double")
    rows = scoring.zscores(df, ["x"], ["g"]).collect()
    a = np.array([1.0, 2.0, 6.0])
    assert sorted(r.x_z for r in rows if r.g == "a") == pytest.approx(sorted((a - a.mean()) / a.std()))
    assert [r.x_z for r in rows if r.g == "b"] == [0.0, 0.0]
    assert sorted(r.x_z for r in rows if r.g is None) == [-1.0, 1.0]
    whole = np.array([x for _, x in values])
    got = sorted(r.x_z for r in scoring.zscores(df, ["x"]).collect())
    assert got == pytest.approx(sorted((whole - whole.mean()) / whole.std()))


def test_zscores_with_imputation(spark):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,), (7.0,)], "x double")
    filled = pd.Series([1.0, None, 4.0, 7.0]).fillna(4.0).to_numpy()
    want = sorted((filled - filled.mean()) / filled.std())
    got = sorted(r.x_z for r in scoring.zscores(df, ["x"], impute_mean=True).collect())
    assert got == pytest.approx(want)


def test_volumes(spark):
    df = spark.createDataFrame([(1000,), (None,), (3,)], "pop long")
    out = [r.v for r in df.select(scoring.estimated_volume(F.col("pop"), 0.17).alias("v")).collect()]
    assert out == [170, 68, 5]
    row = spark.range(1).select(scoring.success_count(F.lit(10), F.lit(25.0)).alias("n")).head()
    assert row.n == 2


def brute_calibration(values, weights, target, rounds=40):
    values = np.clip(np.array(values, float), 2.0, 99.0)
    for _ in range(rounds):
        error = target - np.average(values, weights=weights)
        if abs(error) < 0.05:
            break
        values = np.clip(values + error, 2.0, 99.0)
    return values


def exact_calibration(values, weights, target, low=2.0, high=99.0):
    """Bisection of the shift."""
    values = np.clip(np.array(values, float), low, high)
    a, b = low - high, high - low
    for _ in range(200):
        middle = (a + b) / 2
        a, b = (middle, b) if np.average(np.clip(values + middle, low, high), weights=weights) < target else (a, middle)
    return np.clip(values + b, low, high)


@pytest.mark.parametrize("inside", [100_000, 3])
@pytest.mark.parametrize("low,high", [(2.0, 99.0), (-500.0, 25_000.0), (0.0, 1e9)])
def test_calibration_equals_bisection(spark, inside, low, high):
    rng = np.random.default_rng(6)
    span, rows = high - low, []
    share = {1: 0.6, 2: 0.97, 3: 0.02, 4: None, 5: 1.5, 6: -0.5, 7: 1.0, 8: 0.0}
    goals = {g: None if s is None else low + s * span for g, s in share.items()}
    for g, n in ((1, 900), *[(g, 40) for g in range(2, 9)]):
        for i in range(n):
            v = None if i % 13 == 0 else low + span * (0.5 if i % 3 == 0 else float(rng.normal(0.5, 0.45)))
            rows.append((g, g * 1000 + i, v, float(rng.integers(0, 40)) / 4))
    df = spark.createDataFrame(rows, "group_id long, id long, value double, weight double").repartition(3)
    targets = spark.createDataFrame(list(goals.items()), "group_id long, target double")
    out = calibrate_to_group_mean(df, targets, low=low, high=high, inside=inside).toPandas().sort_values("id")
    assert len(out) == len(rows) and out[out.value.isna()].calibrated.isna().all()
    out = out[out.value.notna()]
    for g, goal in goals.items():
        part = out[out.group_id == g]
        if goal is None:
            want = np.clip(part.value, low, high)
        else:
            want = exact_calibration(part.value, part.weight, goal, low, high)
            if low < goal < high:
                assert np.average(part.calibrated, weights=part.weight) == pytest.approx(goal, abs=1e-6 * span)
                want = np.where(part.weight > 0, want, part.calibrated)
        if goal is None or low < goal < high:
            assert np.allclose(part.calibrated, want, atol=1e-6 * span)
        else:
            assert np.allclose(part.calibrated[part.weight > 0], high if goal >= high else low, atol=1e-6 * span)


def test_calibration_is_as_near_as_the_rounds(spark):
    rng = np.random.default_rng(5)
    rows, goals = [], {1: 60.0, 2: 96.0, 3: 4.0, 4: None}
    for g, n in ((1, 400), (2, 50), (3, 50), (4, 5)):
        for i in range(n):
            rows.append((g, g * 1000 + i, float(rng.normal(50, 45)), int(rng.integers(1, 40))))
    df = spark.createDataFrame(rows, "group_id long, id long, value double, weight long")
    targets = spark.createDataFrame(list(goals.items()), "group_id long, target double")
    out = calibrate_to_group_mean(df, targets).toPandas().sort_values("id")
    for g, goal in goals.items():
        part = out[out.group_id == g]
        if goal is None:
            want = np.clip(part.value, 2.0, 99.0)
        else:
            # trying and shifting in rounds ends within its tolerance of the same values
            want = brute_calibration(part.value, part.weight, goal)
            assert abs(np.average(part.calibrated, weights=part.weight) - goal) < 1e-6
            assert abs(np.average(want, weights=part.weight) - goal) < 0.05
        assert np.allclose(part.calibrated, want, atol=1.0)


def test_weighted_sample_equals_brute_force(spark):
    weights = {k: (100_000 if k == 7 else (k * 37) % 11) for k in range(300)}
    df = spark.createDataFrame(list(weights.items()), "k long, w long")
    n = 3000
    out = {r.draw: r.k for r in sampling.weighted_sample(df, "k", "w", n, 9, buckets=16, cells=13).collect()}
    assert sorted(out) == list(range(n))
    hashed = df.where("w > 0").select(
        "k", "w", F.pmod(sampling.hash_number(F.col("k"), digest_bits=32), F.lit(16)).alias("b"))
    line = hashed.orderBy("b", "k").toPandas()
    ends = line.w.cumsum().to_numpy()
    spots = spark.range(n).select(F.pmod(
        sampling.hash_number(F.lit(9), F.col("id")), F.lit(int(ends[-1]))).alias("p")).toPandas().p
    want = line.k.to_numpy()[np.searchsorted(ends, spots, side="right")]
    assert [out[i] for i in range(n)] == want.tolist()
    assert all(weights[k] > 0 for k in out.values())
    hot = sum(k == 7 for k in out.values()) / n
    assert abs(hot - 100_000 / ends[-1]) < 0.01


def test_weighted_sample_is_repeatable(spark):
    df = spark.range(50).select(F.col("id").alias("k"), (F.col("id") + 1).alias("w"))
    a = sampling.weighted_sample(df, "k", "w", 200, cells=5)
    b = sampling.weighted_sample(df.repartition(7), "k", "w", 200, cells=40)
    assert a.exceptAll(b).isEmpty() and a.count() == 200


@pytest.mark.parametrize("factor", [1.0, 1e-7, 1e9])
def test_sample_with_fractions(spark, factor):
    weights = {"a": 0.9, "b": 1.9, "c": 0.0, "d": 0.2, "e": -1.0}
    df = spark.createDataFrame([(k, w * factor) for k, w in weights.items()] + [("f", None)], "k string, w double")
    n = 20_000
    out = sampling.weighted_sample(df, "k", "w", n, cells=5).groupBy("k").count().collect()
    assert {r.k for r in out} == {"a", "b", "d"} and sum(r["count"] for r in out) == n
    for r in out:
        assert r["count"] / n == pytest.approx(weights[r.k] / 3.0, abs=0.015)


def test_sample_of_whole_numbers_in_doubles(spark):
    whole = spark.createDataFrame([("a", 9.0), ("b", 19.0)], "k string, w double")
    assert {r.k for r in sampling.weighted_sample(whole, "k", "w", 200).collect()} == {"a", "b"}


def test_no_year_is_left_out(spark):
    """Years from 1990 to 2010 with gaps: every one is in the tables by year, and the goal lies seven years after the first."""
    rows = [(y, g, 100, 40 + g) for y in (1990, 1991, 1993, 1997, 2004, 2010) for g in (1, 2)]
    years = spark.createDataFrame([(y, e, g, a, s) for k, (y, g, a, s) in enumerate(rows) for e in (k,)],
                                  "yr long, entity_id long, group_id long, assessed long, successes long")
    groups = stage(retail.group_years(years), "groups")
    calendar = retail.calendar_of(groups)
    assert (calendar.first, calendar.last, calendar.goal, calendar.end) == (1990, 2010, 1997, 2010)
    national = {r.yr: r for r in retail.national_fact(groups).collect()}
    assert sorted(national) == list(range(1990, 2011)) and national[1990].target is None
    assert {national[y].target for y in (1997, 1998, 2010)} == {80.0} and national[1996].target < 80
    assert national[1993].available and not national[1992].available

    names = spark.createDataFrame([(1,), (2,), (3,)], "group_id long")
    base = t.baselines(names, groups, retail.national_years(groups), calendar.first)
    targets = t.group_targets(base, calendar.first, calendar.goal, 80.0, last_year=calendar.end)
    assert targets.count() == 3 * 21
    fact = retail.entity_fact(years, targets)
    assert fact.count() == len(rows) and fact.where("target is null").select("yr").distinct().collect() == [(1990,)]
    early = stage(retail.group_years(years.where("yr < 1992")), "groups")
    assert retail.calendar_of(early).end == 1997
    with pytest.raises(ValueError, match="no year"):
        retail.calendar_of(groups.limit(0))
