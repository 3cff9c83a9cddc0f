import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from weeksignal.operators import distribution, stats


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(3)
    rows = [(k, float(np.round(rng.normal(), 1)), int(rng.random() < 0.3)) for k in ("a", "b") for _ in range(700)]
    return rows, spark.createDataFrame(rows, "k string, v double, label_next2wk int").cache()


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("ranges", [2, 7, 200])
def test_ranged_totals_equal_plain_totals(spark, numbers, keys, descending, ranges):
    rows, df = numbers
    rows = rows + [(None, v, y) for _, v, y in rows[:90]] + [("a", None, 1), ("b", float("nan"), 0), (None, None, 0)]
    df = spark.createDataFrame(rows, df.schema)
    found = distribution.running_totals(distribution.value_counts(df, "v", keys), "v", ["n"], keys, descending, ranges)
    want = {}
    for k, v, _ in rows:
        if v is not None and v == v:
            key = k if keys else 0
            want.setdefault(key, {}).setdefault(v, 0)
            want[key][v] += 1
    expected = set()
    for key, counts in want.items():
        total = 0
        for v in sorted(counts, reverse=descending):
            total += counts[v]
            expected.add((key, v, counts[v], total))
    assert {(r["k"] if keys else 0, r["v"], r["n"], r["cum_n"]) for r in found.collect()} == expected


def test_quantiles_match_numpy(numbers):
    rows, df = numbers
    got = {r.k: r for r in distribution.quantiles(df, "v", {"q1": 0.25, "q9": 0.93}, ["k"]).collect()}
    near = distribution.quantiles(df, "v", {"q": 0.99}, method="nearest").first().q
    for k in ("a", "b"):
        values = [v for kk, v, _ in rows if kk == k]
        assert got[k].q1 == pytest.approx(np.percentile(values, 25))
        assert got[k].q9 == pytest.approx(np.percentile(values, 93))
    values = sorted(v for _, v, _ in rows)
    assert near == values[int(math.floor((len(values) - 1) * 0.99 + 0.5))]


def test_cap_keeps_types(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(201)], "m long, b double")
    out = distribution.cap_quantile(df, ["m", "b"])
    assert out.agg(F.max("m"), F.max("b")).first() == (198, 198.0)
    assert dict(out.dtypes) == {"m": "bigint", "b": "double"}


def test_histogram_is_a_density(numbers):
    rows, df = numbers
    got = distribution.histogram_density(df, "v", -1.0, 1.0, 8, ["k"]).collect()
    for k in ("a", "b"):
        want, _ = np.histogram([v for kk, v, _ in rows if kk == k], bins=8, range=(-1, 1))
        counts = np.zeros(8)
        for r in got:
            if r.k == k:
                counts[r.bin] = r.n
        assert counts.sum() == want.sum()
        assert sum(r.density for r in got if r.k == k) * 0.25 == pytest.approx(1.0)


def test_mann_whitney_by_definition(numbers):
    rows, df = numbers
    pos = np.array([v for _, v, y in rows if y]); neg = np.array([v for _, v, y in rows if not y])
    u = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    got = stats.with_normal_p(stats.mann_whitney(df, ["v"])).first()
    assert got.u == u
    assert 0 <= got.p <= 1
    greater = stats.with_normal_p(stats.mann_whitney(df, ["v"], alternative="greater"), "greater").first()
    # Both one-sided tests share the distance from the middle, bar the correction.
    assert (greater.p < 0.5) == (u > len(pos) * len(neg) / 2)


def test_p_values_against_tables():
    # Two-sided t quantiles: t(10) = 2.228139, t(30) = 2.042272 at 5 %.
    for dof, t in ((10, 2.2281388520), (30, 2.0422724563), (120, 1.9799304051)):
        r = t / math.sqrt(dof + t * t)
        assert stats.two_sided_p(r, dof + 2) == pytest.approx(0.05, abs=1e-9)
    assert stats.two_sided_p(0.0, 50) == pytest.approx(1.0)


def test_normal_tail(spark):
    df = spark.createDataFrame([(1.959963984540054,), (0.0,)], "z double")
    assert [r[0] for r in df.select(stats.normal_tail("z")).collect()] == pytest.approx([0.025, 0.5])


def test_correlation_matrix_without_rows_and_with_shifted_columns(spark):
    rows = spark.createDataFrame([(1e9 + k, 1e9 - k, 5.0) for k in range(50)], "a double, b double, c double")
    got = {(r.feature_a, r.feature_b): r.r for r in stats.correlation_matrix(rows, ["a", "b", "c"]).collect()}
    assert len(got) == 9 and got["a", "c"] is None and abs(got["a", "b"] + 1) < 1e-9 and got["b", "b"] == 1.0
    none = stats.correlation_matrix(rows.limit(0), ["a", "b", "c"]).collect()
    assert len(none) == 9 and all(r.r == (1.0 if r.feature_a == r.feature_b else None) for r in none)


def test_correlation_matrix(numbers):
    rows, df = numbers
    wide = df.select("v", (F.col("v") * F.col("v")).alias("sq"), F.col("label_next2wk").alias("y"), F.lit(1.0).alias("one"))
    got = {(r.feature_a, r.feature_b): r.r for r in stats.correlation_matrix(wide, ["v", "sq", "y", "one"]).collect()}
    v = np.array([x for _, x, _ in rows]); y = np.array([z for _, _, z in rows])
    assert got["v", "sq"] == pytest.approx(np.corrcoef(v, v * v)[0, 1])
    assert got["y", "v"] == pytest.approx(np.corrcoef(v, y)[0, 1])
    assert got["one", "v"] is None and got["v", "v"] == 1.0


def test_sweep_counts_rows_at_the_threshold(spark):
    df = spark.createDataFrame([(-1.0, 0), (-0.75, 1), (0.5, 1), (9.0, 0)], "s double, label_next2wk int")
    got = {r.threshold: r for r in stats.threshold_sweep(df, "s", -1.0, 0.25, 28).collect()}
    assert len(got) == 28
    assert (got[-1.0].n, got[-0.75].n, got[0.5].n, got[0.75].n, got[5.75].n) == (4, 3, 2, 1, 1)
    assert got[0.5].precision == 0.5 and got[-0.75].coverage == 0.75


def test_constant_columns_have_no_correlation(spark):
    df = spark.createDataFrame([("g", 1.0, 0), ("g", 1.0, 1), ("h", 1.0, 0), ("h", 2.0, 1)], "k string, v double, label_next2wk int")
    got = {r.k: r.r for r in stats.point_biserial(df, ["v"], keys=["k"]).collect()}
    assert got["g"] is None and got["h"] == pytest.approx(1.0)
    assert stats.label_correlations(df.where("k = 'g'"), ["v"]).first().r is None
