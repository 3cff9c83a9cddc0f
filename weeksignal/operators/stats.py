"""Statistics of features against a binary label, as Spark aggregations."""

from __future__ import annotations

import math
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from weeksignal.functions.scalars import safe_ratio
from weeksignal.operators import distribution
from weeksignal.operators.weekly import TOPIC_WEEK

LABEL = "label_next2wk"


def normal_tail(z) -> Column:
    """Upper tail of the standard normal; for tables with one row per test."""

    @F.pandas_udf(T.DoubleType())
    def tail(values: pd.Series) -> pd.Series:
        return values.map(lambda v: 0.5 * math.erfc(v / math.sqrt(2)), na_action="ignore")

    return tail(z)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz's method)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 500):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return value


def regularized_beta(a: float, b: float, x: float) -> float:
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1 - x) / b


def two_sided_p(r: float | None, n: int) -> float | None:
    """p of a correlation from the t distribution with n - 2 degrees of freedom."""
    if r is None or math.isnan(r) or n < 3:
        return None
    return regularized_beta((n - 2) / 2, 0.5, max(0.0, 1 - r * r))


def correlation_p(r, n) -> Column:

    @F.pandas_udf(T.DoubleType())
    def p_values(rs: pd.Series, ns: pd.Series) -> pd.Series:
        return pd.Series([two_sided_p(a, int(b)) for a, b in zip(rs, ns)], dtype="float64")

    return p_values(r, n)


def threshold_sweep(
    df: DataFrame,
    score: str,
    start: float,
    step: float,
    count: int,
    keys: list[str] = (),
    min_rows: int = 0,
    label: str = LABEL,
) -> DataFrame:
    """Precision and coverage of ``score >= t`` for evenly spaced thresholds.

    Each row is put into the interval between two thresholds; the tables above a
    threshold are then suffix sums over those intervals. Precision is 0 unless
    more than ``min_rows`` rows pass.
    """
    keys = list(keys)
    slot = F.floor((F.col(score) - start) / step).cast("int")
    slot = F.least(F.greatest(slot, F.lit(-1)), F.lit(count - 1))
    counts = df.where(F.col(score).isNotNull()).groupBy(*keys, slot.alias("_slot")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(label).alias("_pos")
    )
    # One row per key: interval totals as maps, expanded to the thresholds.
    per_key = counts.groupBy(*keys).agg(
        F.collect_list(F.struct("_slot", "_n", "_pos")).alias("_slots"), F.sum("_n").alias("_total")
    )
    spread = per_key.select(
        *keys, "_slots", "_total", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("_i")
    )
    above = lambda field: F.aggregate(
        F.filter("_slots", lambda s: s["_slot"] >= F.col("_i")),
        F.lit(0).cast("long"),
        lambda acc, s: acc + s[field],
    )
    rows = spread.withColumns({"_n": above("_n"), "_pos": above("_pos")})
    return rows.select(
        *keys,
        (F.lit(start) + F.col("_i") * step).alias("threshold"),
        F.when(F.col("_n") > min_rows, safe_ratio("_pos", "_n")).otherwise(F.lit(0.0)).alias("precision"),
        safe_ratio("_n", "_total").alias("coverage"),
        F.col("_n").alias("n"),
    )


def source_precision_curve(bursts: DataFrame, labelled: DataFrame) -> DataFrame:
    joined = bursts.join(labelled.select(*TOPIC_WEEK, LABEL), TOPIC_WEEK)
    return threshold_sweep(joined, "source_burst", -1.0, 0.5, 12, ["source_type"], min_rows=10)


def rate_by_sources(labelled: DataFrame, sources: str = "sources_bursting", label: str = LABEL) -> DataFrame:
    rates = labelled.groupBy(sources).agg(
        F.count(F.lit(1)).alias("n"), (F.avg(label) * 100).alias("rate_percent")
    )
    return rates.where(F.col(sources).between(0, 3))


def class_balance(df: DataFrame, label: str = LABEL) -> DataFrame:
    counts = df.agg(
        F.count(F.lit(1)).alias("total"), F.coalesce(F.sum(label), F.lit(0)).cast("long").alias("positive")
    )
    negative = F.col("total") - F.col("positive")
    return counts.select(
        "total",
        "positive",
        negative.alias("negative"),
        F.floor(negative / F.greatest(F.col("positive"), F.lit(1))).cast("long").alias("ratio"),
        safe_ratio(negative, "total").alias("all_zeros_accuracy"),
    )


def label_means(df: DataFrame, columns: list[str], label: str = LABEL) -> DataFrame:
    long = distribution.unpivot(df, columns, [label])
    return long.groupBy("feature", label).agg(F.avg("value").alias("mean"), F.count("value").alias("n"))


def split_medians(df: DataFrame, columns: list[str], label: str = LABEL) -> DataFrame:
    long = distribution.unpivot(df, columns, [label])
    return distribution.quantiles(long, "value", {"median": 0.5}, ["feature", label])


def mann_whitney(df: DataFrame, columns: list[str], label: str = LABEL, alternative: str = "two-sided") -> DataFrame:
    """U of the positive group per feature, with the tie-corrected normal z.

    Ranks come from counts per distinct value and running totals.
    """
    long = distribution.unpivot(df, columns, [label])
    counts = distribution.value_counts(long, "value", ["feature"], {"pos": F.col(label)})
    cum = distribution.running_totals(counts, "value", ["n"], ["feature"])
    n, pos = F.col("n"), F.col("pos")
    # Twice the mid-rank of a tie group is a whole number.
    twice_rank = 2 * (F.col("cum_n") - n) + n + 1
    sums = cum.groupBy("feature").agg(
        F.sum("pos").alias("n1"),
        F.sum(n - pos).alias("n0"),
        F.sum(pos * twice_rank).alias("_twice_r1"),
        F.sum(n.cast("double") * n * n - n).alias("_ties"),
    )
    n1, n0 = F.col("n1"), F.col("n0")
    total = n1 + n0
    u = (F.col("_twice_r1") - n1 * (n1 + 1)) / 2
    middle = n1 * n0 / 2
    spread = F.sqrt(n1 * n0 / 12 * ((total + 1) - F.col("_ties") / (total.cast("double") * (total - 1))))
    if alternative == "two-sided":
        distance = F.greatest(u, n1 * n0 - u) - middle - 0.5
    elif alternative == "greater":
        distance = u - middle - 0.5
    else:
        raise ValueError(f"unknown alternative {alternative!r}")
    return sums.select(
        "feature", "n1", "n0", u.alias("u"), F.when(spread > 0, distance / spread).alias("z")
    )


def with_normal_p(tests: DataFrame, alternative: str = "two-sided") -> DataFrame:
    p = normal_tail("z")
    if alternative == "two-sided":
        p = F.least(F.lit(1.0), 2 * p)
    return tests.withColumn("p", p)


def pearson(x: Column, y: Column) -> Column:
    """Pearson r over rows where both values are known; NULL when either is constant."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def point_biserial(df: DataFrame, columns: list[str], label: str = LABEL, keys: list[str] = ()) -> DataFrame:
    """Pearson r of each feature with the label; NULL when either is constant."""
    keys = list(keys)
    long = distribution.unpivot(df, columns, [*keys, label])
    r = pearson(F.col("value"), F.col(label))
    return long.groupBy(*keys, "feature").agg(r.alias("r"), F.count("value").alias("n"))


def with_correlation_p(tests: DataFrame) -> DataFrame:
    return tests.withColumn("p", correlation_p("r", "n"))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature_a, feature_b, r) for every ordered pair; NULL for a constant column.

    One aggregate over one pass. Its state, count, means and co-moments of every pair, is
    merged within the tasks first. Rows are turned into pairs of values in arrays, so that
    one state is kept for each pair, not a generated method for all of them.
    """
    wide = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("v"))
    pairs = list(combinations(range(len(columns)), 2))
    if not pairs:
        return wide.limit(1).select(F.lit(columns[0]).alias("feature_a"), F.lit(columns[0]).alias("feature_b"), F.lit(1.0).alias("r"))
    names = F.array(*[F.struct(F.lit(columns[a]).alias("a"), F.lit(columns[b]).alias("b"), F.lit(a).alias("i"), F.lit(b).alias("j")) for a, b in pairs])
    both = wide.select(F.inline(F.transform(names, lambda p: F.struct(p.a.alias("a"), p.b.alias("b"), F.get("v", p.i).alias("x"), F.get("v", p.j).alias("y")))))
    found = both.groupBy("a", "b").agg(pearson(F.col("x"), F.col("y")).alias("r"))
    # without rows every pair is still there; a row a pair of columns
    found = df.sparkSession.range(1).select(F.inline(names)).select("a", "b").join(F.broadcast(found), ["a", "b"], "left")
    one = F.lit(1.0)
    last, first = F.col("b") == columns[-1], F.col("a") == columns[0]
    ways = [
        F.struct(F.col(x).alias("feature_a"), F.col(y).alias("feature_b"), (one if x == y else F.col("r")).alias("r"))
        for x, y in (("a", "b"), ("b", "a"))
    ]
    own = F.struct(F.col("a").alias("feature_a"), F.col("a").alias("feature_b"), one.alias("r"))
    end = F.struct(F.col("b").alias("feature_a"), F.col("b").alias("feature_b"), one.alias("r"))
    rows = F.concat(F.array(*ways), F.when(last, F.array(own)).otherwise(F.array()), F.when(last & first, F.array(end)).otherwise(F.array()))
    return found.select(F.inline(rows))


def label_correlations(df: DataFrame, columns: list[str], label: str = LABEL) -> DataFrame:
    """Correlation of each feature with the label, strongest positive first."""
    wide = df.agg(*[pearson(F.col(c), F.col(label)).alias(c) for c in columns])
    long = wide.unpivot([], columns, "feature", "r")
    return long.orderBy(F.col("r").desc_nulls_last(), "feature")


def similarity_stats(df: DataFrame, column: str = "similarity") -> DataFrame:
    spread = distribution.quantiles(df, column, {"p25": 0.25, "median": 0.5, "p75": 0.75})
    basic = df.agg(F.struct(F.avg(column).alias("mean"), F.min(column).alias("min"))).scalar()
    return spread.select(
        basic.getField("mean").alias("mean"), "median", basic.getField("min").alias("min"), "p25", "p75"
    )
