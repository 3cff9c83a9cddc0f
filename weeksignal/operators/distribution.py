"""Order statistics that never sort a whole table in one task.

Everything here starts from one row per distinct value. ``running_totals`` then
splits the value axis into ranges, sums inside each range with a partitioned
window and adds the total of the ranges before it. There is one plan for all sizes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

RANGES = 200


def value_counts(df: DataFrame, value: str, keys: list[str] = (), weights: dict[str, Column] | None = None) -> DataFrame:
    """Distinct values with their row count and optional weighted sums."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for name, expr in (weights or {}).items():
        aggs.append(F.sum(expr).alias(name))
    clean = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return clean.groupBy(*keys, value).agg(*aggs)


def join_on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that may be NULL."""
    named = right.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return left.join(named, same, "left").drop(*[f"_key_{k}" for k in keys])


def running_totals(
    counts: DataFrame, value: str, sums: list[str], keys: list[str] = (), descending: bool = False, ranges: int = RANGES
) -> DataFrame:
    """Add ``cum_<s>``, the total of ``s`` up to and including each distinct value.

    ``counts`` holds one row per (keys, value). The value axis of each key is cut at its own
    approximate quantiles, which only steer the work: a window sums inside each range, and the
    totals of the ranges before it are added. Keys may be NULL.
    """
    keys = list(keys)
    v = F.col(value).cast("double")
    cuts = F.percentile_approx(v, F.array(*[F.lit(k / ranges) for k in range(1, ranges)]), F.lit(ranges * 10))
    bounds = counts.groupBy(*keys).agg(F.array_distinct(cuts).alias("_bounds"))
    if keys:
        split = join_on(counts, bounds, keys)
    else:
        split = counts.withColumn("_bounds", bounds.select("_bounds").scalar())
    split = split.withColumn("_range", F.size(F.filter("_bounds", lambda b: b <= v))).drop("_bounds")
    order = F.col(value).desc() if descending else F.col(value).asc()
    inside = Window.partitionBy(*keys, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)

    # At most ``ranges`` rows per key.
    totals = split.groupBy(*keys, "_range").agg(*[F.sum(s).alias(f"_tot_{s}") for s in sums])
    range_order = F.col("_range").desc() if descending else F.col("_range").asc()
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(range_order)
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        "_range",
        *[F.coalesce(F.sum(f"_tot_{s}").over(before), F.lit(0)).alias(f"_off_{s}") for s in sums],
    )
    summed = split.withColumns({f"cum_{s}": F.sum(s).over(inside) for s in sums})
    joined = join_on(summed, offsets, [*keys, "_range"])
    joined = joined.withColumns({f"cum_{s}": F.col(f"cum_{s}") + F.col(f"_off_{s}") for s in sums})
    return joined.drop("_range", *[f"_off_{s}" for s in sums])


def quantiles(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    keys: list[str] = (),
    method: str = "linear",
) -> DataFrame:
    """Exact quantiles, one column per entry of ``probs``.

    ``linear`` interpolates between neighbours, ``nearest`` takes the order
    statistic closest to ``(n - 1) * p`` (a tie goes up).
    """
    keys = list(keys)
    counts = value_counts(df, value, keys)
    cum = running_totals(counts, value, ["n"], keys)
    sizes = counts.groupBy(*keys).agg(F.sum("n").alias("_total"))
    if keys:
        cum = join_on(cum, sizes, keys)
        total = F.col("_total")
    else:
        cum = cum.withColumn("_total", sizes.select("_total").scalar())
        total = F.col("_total")

    def order_statistic(rank: Column) -> Column:
        return F.min(F.when(F.col("cum_n") > rank, F.col(value)))

    aggs = []
    for name, p in probs.items():
        position = (total - 1) * F.lit(p)
        if method == "nearest":
            aggs.append(order_statistic(F.floor(position + 0.5)).alias(name))
        elif method == "linear":
            low = F.floor(position)
            aggs.append(order_statistic(low).cast("double").alias(f"_lo_{name}"))
            aggs.append(order_statistic(F.least(low + 1, total - 1)).cast("double").alias(f"_hi_{name}"))
            aggs.append(F.max(position - low).alias(f"_part_{name}"))
        else:
            raise ValueError(f"unknown quantile method {method!r}")
    out = cum.groupBy(*keys).agg(*aggs)
    if method == "nearest":
        return out
    picked = [
        (
            F.col(f"_lo_{name}")
            + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * F.col(f"_part_{name}")
        ).alias(name)
        for name in probs
    ]
    return out.select(*keys, *picked)


def unpivot(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """(feature, value) rows for numeric columns."""
    wide = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(keep), columns, "feature", "value")


def cap_bounds(df: DataFrame, columns: list[str], p: float = 0.99) -> DataFrame:
    """(feature, cap): the nearest-rank quantile of each column, in one pass."""
    return quantiles(unpivot(df, columns), "value", {"cap": p}, ["feature"], method="nearest")


def cap_quantile(df: DataFrame, columns: list[str], p: float = 0.99) -> DataFrame:
    """Clip columns from above at their own quantile; integer columns stay integer."""
    caps = cap_bounds(df, columns, p)
    lookup = caps.agg(F.map_from_entries(F.collect_list(F.struct("feature", "cap")))).scalar()
    types = dict(df.dtypes)
    capped = {}
    for c in columns:
        cap = F.element_at(lookup, F.lit(c))
        if types[c] in ("int", "bigint"):
            cap = cap.cast("long")
        capped[c] = F.least(F.col(c), cap).cast(types[c])
    return df.withColumns(capped)


def histogram_density(
    df: DataFrame,
    value: str,
    low: float,
    high: float,
    bins: int,
    keys: list[str] = (),
    clip_values: bool = False,
) -> DataFrame:
    """Fixed-width bins as densities; the last bin includes its right edge.

    Values outside the range are left out unless ``clip_values`` moves them to it.
    Empty bins have no row.
    """
    keys = list(keys)
    v = F.col(value).cast("double")
    if clip_values:
        v = F.least(F.greatest(v, F.lit(low)), F.lit(high))
    width = (high - low) / bins
    inside = df.select(*keys, v.alias("_v")).where((F.col("_v") >= low) & (F.col("_v") <= high))
    binned = inside.withColumn(
        "bin", F.least(F.floor((F.col("_v") - low) / width), F.lit(bins - 1)).cast("int")
    )
    counts = binned.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    per_key = Window.partitionBy(*(keys or [F.lit(0)]))  # at most ``bins`` rows per key
    return counts.select(
        *keys,
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("bin_start"),
        "n",
        (F.col("n") / (F.sum("n").over(per_key) * width)).alias("density"),
    )


def range_histogram_density(df: DataFrame, value: str, bins: int, keys: list[str], low: Column, high: Column) -> DataFrame:
    """Density histogram per key after clipping to data-derived bounds.

    As a plotting library does, each key's bins span its own clipped minimum and maximum.
    """
    v = F.least(F.greatest(F.col(value).cast("double"), low), high)
    clipped = df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull())
    counts = clipped.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    spans = counts.groupBy(*keys).agg(
        F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_c").alias("_n")
    )
    # matplotlib/NumPy widen an empty span by half a unit on both sides.
    flat = F.col("_lo") == F.col("_hi")
    spans = spans.select(
        *keys,
        F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
        F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"),
        "_n",
    )
    counted = counts.join(spans, keys)
    width = (F.col("_hi") - F.col("_lo")) / bins
    binned = counted.withColumn(
        "bin",
        F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1)).cast("int"),
    )
    return (
        binned.groupBy(*keys, "bin")
        .agg(
            F.sum("_c").alias("n"),
            F.first("_lo").alias("_lo"),
            F.first("_hi").alias("_hi"),
            F.first("_n").alias("_n"),
        )
        .select(
            *keys,
            "bin",
            (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
            "n",
            (F.col("n") / (F.col("_n") * width)).alias("density"),
        )
    )
