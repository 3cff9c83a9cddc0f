"""Temporal split and ranking-oriented evaluation of scored topic-weeks.

Metrics take ``keys`` so that several models, grid points or strata are evaluated
by one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weeksignal.functions.scalars import safe_ratio
from weeksignal.functions.weeks import week_number
from weeksignal.operators import distribution, stats
from weeksignal.operators.stats import LABEL
from weeksignal.operators.weekly import TOPIC_WEEK


# --- split, weights, scaling ---------------------------------------------------

def split_cutoffs(df: DataFrame, train: float = 0.70, validation: float = 0.85) -> DataFrame:
    """One row with the first validation week and the first test week.

    The list of weeks is a calendar, so it fits one array.
    """
    weeks = df.select("week").distinct().agg(F.array_sort(F.collect_list("week")).alias("w"))
    n = F.size("w")
    pick = lambda share: F.try_element_at("w", F.floor(n * F.lit(share)).cast("int") + 1)
    return weeks.select(
        n.alias("weeks"), pick(train).alias("validation_from"), pick(validation).alias("test_from")
    )


def temporal_split(df: DataFrame, train: float = 0.70, validation: float = 0.85) -> DataFrame:
    """Label every row train, val or test by its week; nothing is shuffled."""
    cut = split_cutoffs(df, train, validation)
    cut = cut.select(F.struct("validation_from", "test_from")).scalar()
    week = F.col("week")
    return df.withColumn(
        "split",
        F.when(week < cut.getField("validation_from"), F.lit("train"))
        .when(week < cut.getField("test_from"), F.lit("val"))
        .otherwise(F.lit("test")),
    )


def split_summary(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(label).cast("long").alias("positives"),
        F.countDistinct("week").alias("weeks"),
        F.min("week").alias("first_week"),
        F.max("week").alias("last_week"),
    )


def balanced_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    """n / (2 * count of the class), one row per class present in the training rows."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(F.col(label).alias("label"), "n", (total / (2 * F.col("n"))).alias("weight"))


def with_class_weight(df: DataFrame, train: DataFrame, label: str = LABEL, out: str = "weight") -> DataFrame:
    """Add n / (2 * count of the row's class in ``train``); NULL for a class that ``train`` lacks."""
    counts = train.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("p"))
    ).scalar()
    n, pos = counts.getField("n"), counts.getField("p")
    return df.withColumn(out, F.try_divide(n, 2 * F.when(F.col(label) == 1, pos).otherwise(n - pos)))


def scaler(train: DataFrame, columns: list[str]) -> Column:
    """Means and population deviations of the training rows as one struct column."""
    parts = []
    for c in columns:
        x = F.col(c).cast("double")
        std = F.stddev_pop(x)
        parts.append(F.avg(x).alias(f"mean_{c}"))
        parts.append(F.when(std > 0, std).otherwise(F.lit(1.0)).alias(f"std_{c}"))
    return train.agg(F.struct(*parts)).scalar()


def standard_scale(df: DataFrame, train: DataFrame, columns: list[str]) -> DataFrame:
    fitted = scaler(train, columns)
    return df.withColumns(
        {
            c: (F.col(c).cast("double") - fitted.getField(f"mean_{c}")) / fitted.getField(f"std_{c}")
            for c in columns
        }
    )


# --- counts at a fixed threshold -----------------------------------------------

def confusion(df: DataFrame, keys: list[str] = (), label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    is_pos, said = F.col(label) == 1, F.col(prediction) == 1
    count = lambda cond: F.count_if(cond)
    return df.groupBy(*keys).agg(
        count(is_pos & said).alias("tp"),
        count(~is_pos & said).alias("fp"),
        count(is_pos & ~said).alias("fn"),
        count(~is_pos & ~said).alias("tn"),
    )


def f1_from_counts(tp, fp, fn) -> Column:
    return safe_ratio(2 * tp, 2 * tp + fp + fn)


def f1_score(df: DataFrame, keys: list[str] = (), **cols) -> DataFrame:
    counts = confusion(df, keys, **cols)
    return counts.select(*keys, f1_from_counts(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"))


def accuracy(df: DataFrame, keys: list[str] = (), **cols) -> DataFrame:
    counts = confusion(df, keys, **cols)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn
    return counts.select(
        *keys,
        safe_ratio(tp + tn, total).alias("accuracy"),
        safe_ratio(tn + fp, total).alias("all_zeros_accuracy"),
    )


def classification_report(df: DataFrame, names=("Not in NL", "In NL"), **cols) -> DataFrame:
    """Precision, recall, F1 and support per class with the usual averages."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    p0, r0 = safe_ratio(tn, tn + fn), safe_ratio(tn, tn + fp)
    p1, r1 = safe_ratio(tp, tp + fp), safe_ratio(tp, tp + fn)
    f0, f1 = f1_from_counts(tn, fn, fp), f1_from_counts(tp, fp, fn)
    n0, n1 = tn + fp, tp + fn
    total = n0 + n1
    acc = safe_ratio(tp + tn, total)
    mean = lambda a, b: (a + b) / 2
    weighted = lambda a, b: safe_ratio(a * n0 + b * n1, total)

    def row(name, p, r, f, n):
        return F.struct(
            F.lit(name).alias("class"),
            p.alias("precision"),
            r.alias("recall"),
            f.alias("f1"),
            n.alias("support"),
        )

    rows = F.array(
        row(names[0], p0, r0, f0, n0),
        row(names[1], p1, r1, f1, n1),
        row("accuracy", acc, acc, acc, total),
        row("macro avg", mean(p0, p1), mean(r0, r1), mean(f0, f1), total),
        row("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), total),
    )
    return confusion(df, **cols).select(F.inline(rows))


def grid_select(scored: DataFrame, position: str, params: list[str] = (), label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """The grid point with the best F1; of equal ones the earliest.

    A grid on which every F1 is 0 selects nothing and yields no row.
    """
    keys = [position, *params]
    scores = f1_score(scored, keys, label=label, prediction=prediction)
    best = scores.where(F.col("f1") > 0).orderBy(F.col("f1").desc(), position)
    return best.limit(1)


# --- curves and areas ------------------------------------------------------------

def score_curve(df: DataFrame, keys: list[str] = (), label: str = LABEL, score: str = "score") -> DataFrame:
    """Cumulative true and false positives per distinct score, highest first."""
    counts = distribution.value_counts(df, score, list(keys), {"pos": F.col(label)})
    counts = counts.withColumn("pos", F.col("pos").cast("long"))
    return distribution.running_totals(counts, score, ["n", "pos"], keys, descending=True)


def roc_curve(df: DataFrame, keys: list[str] = (), label: str = LABEL, score: str = "score") -> DataFrame:
    """The start point (0, 0) with an infinite threshold, then one point per distinct score.

    Rows whose score is NULL or NaN take no part, neither in the points nor in the totals;
    ``unscored`` counts them.
    """
    keys = list(keys)
    curve = score_curve(df, keys, label, score)
    valid = F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))
    sizes = df.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(valid, F.col(label).cast("long"))), F.lit(0)).alias("_p"),
        F.count(F.when(valid, F.lit(1))).alias("_all"),
        F.count(F.when(~valid, F.lit(1))).alias("unscored"),
    )
    points = curve.select(*keys, F.col(score).cast("double").alias("threshold"), "cum_pos", (F.col("cum_n") - F.col("cum_pos")).alias("cum_neg"))
    zero = F.lit(0).cast("long")
    points = points.unionByName(
        sizes.select(*keys, F.lit(float("inf")).alias("threshold"), zero.alias("cum_pos"), zero.alias("cum_neg"))
    )
    if keys:
        points = distribution.join_on(points, sizes, keys)
        p, n, unscored = F.col("_p"), F.col("_all"), F.col("unscored")
    else:
        one = sizes.select(F.struct("_p", "_all", "unscored")).scalar()
        p, n, unscored = (one.getField(f) for f in ("_p", "_all", "unscored"))
    return points.select(
        *keys, "threshold", "cum_pos", "cum_neg", safe_ratio(F.col("cum_neg"), n - p).alias("fpr"), safe_ratio("cum_pos", p).alias("tpr"),
        unscored.alias("unscored"),
    )


def ranking_areas(df: DataFrame, keys: list[str] = (), label: str = LABEL, score: str = "score") -> DataFrame:
    """Exact ROC-AUC (ties count one half) and step-wise average precision.

    NULL where a class is missing.
    """
    keys = list(keys)
    curve = score_curve(df, keys, label, score)
    pos, neg = F.col("pos"), F.col("n") - F.col("pos")
    above = F.col("cum_pos") - pos
    sums = curve.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.sum("pos").alias("positives"),
        F.sum((neg * (2 * above + pos)).cast("double")).alias("_twice_u"),
        F.sum(pos * F.col("cum_pos") / F.col("cum_n")).alias("_ap"),
    )
    p, q = F.col("positives"), F.col("n") - F.col("positives")
    return sums.select(
        *keys,
        "n",
        "positives",
        F.when((p > 0) & (q > 0), F.col("_twice_u") / 2 / (p.cast("double") * q)).alias("roc_auc"),
        F.when(p > 0, F.col("_ap") / p).alias("average_precision"),
    )


def calibration_curve(df: DataFrame, bins: int = 8, keys: list[str] = (), label: str = LABEL, score: str = "score") -> DataFrame:
    """Uniform bins on [0, 1]; a value on an inner edge belongs to the lower bin."""
    slot = F.greatest(F.ceil(F.col(score) * bins) - 1, F.lit(0)).cast("int")
    return df.groupBy(*keys, slot.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(score).alias("mean_score"),
        F.avg(label).alias("positive_rate"),
    )


# --- rankings per week -----------------------------------------------------------

def weekly_hits(df: DataFrame, ks=(3, 5, 10), keys: list[str] = (), label: str = LABEL, score: str = "score") -> DataFrame:
    """Hits among the k best-scored topics of each week that has a positive.

    The row-number filter lets Spark keep only the best rows of a week before the
    shuffle, so a week with millions of topics never lands in one task whole.
    """
    keys = list(keys)
    by_week = [*keys, "week"]
    order = Window.partitionBy(*by_week).orderBy(F.col(score).desc(), "canonical_topic")
    best = df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= max(ks))
    hits = best.groupBy(*by_week).agg(
        *[F.sum(F.when(F.col("_rank") <= k, F.col(label)).otherwise(0)).alias(f"hits_{k}") for k in ks]
    )
    sizes = df.groupBy(*by_week).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(label).cast("long")).alias("positives")
    )
    return sizes.where(F.col("positives") > 0).join(hits, by_week)


def precision_recall_at_k(df: DataFrame, ks=(3, 5, 10), keys: list[str] = (), label: str = LABEL, score: str = "score") -> DataFrame:
    """Means over weeks with a positive; precision also needs k rows in the week."""
    hits = weekly_hits(df, ks, keys, label, score)
    aggs = []
    for k in ks:
        aggs.append(F.avg(F.when(F.col("rows") >= k, F.col(f"hits_{k}") / k)).alias(f"p_at_{k}"))
    for k in ks:
        aggs.append(F.avg(F.col(f"hits_{k}") / F.col("positives")).alias(f"r_at_{k}"))
    out = hits.groupBy(*keys).agg(*aggs)
    return out.fillna(0.0, [f"p_at_{k}" for k in ks] + [f"r_at_{k}" for k in ks])


def random_baseline(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.agg(F.avg(label).alias("baseline"), F.count(F.lit(1)).alias("n"))


# --- lead time ---------------------------------------------------------------------

def in_test_weeks(newsletters_weekly: DataFrame, test: DataFrame) -> DataFrame:
    """Newsletter topic-weeks whose week occurs in the test rows."""
    weeks = test.select("week").distinct()
    return newsletters_weekly.select(*TOPIC_WEEK).distinct().join(weeks, "week", "left_semi")


def lead_times(
    test: DataFrame,
    newsletters_weekly: DataFrame | None = None,
    threshold: float = 0.3,
    anchor: str = "newsletter",
    score: str = "score",
    label: str = LABEL,
) -> DataFrame:
    """Weeks between the first confident prediction and the coverage it preceded.

    The earliest qualifying week before a coverage week is the topic's earliest
    qualifying week overall, provided that lies before it; so one minimum per topic
    and an equi-join replace the inequality join.
    """
    if anchor == "newsletter":
        covered = in_test_weeks(newsletters_weekly, test)
    elif anchor == "label":
        covered = test.where(F.col(label) == 1).select(*TOPIC_WEEK).distinct()
    else:
        raise ValueError(f"anchor must be 'newsletter' or 'label', not {anchor!r}")
    first = first_detection(test, threshold, score)
    joined = covered.join(first, "canonical_topic").where(F.col("first_week") < F.col("week"))
    lead = week_number("week") - week_number("first_week")
    return joined.select(
        "canonical_topic", F.col("week").alias("covered_week"), "first_week", lead.alias("lead_weeks")
    ).where(F.col("lead_weeks") > 0)


def first_detection(test: DataFrame, threshold: float = 0.3, score: str = "score") -> DataFrame:
    confident = test.where(F.col(score) >= threshold)
    return confident.groupBy("canonical_topic").agg(F.min("week").alias("first_week"))


def lead_time_stats(leads: DataFrame) -> DataFrame:
    middle = distribution.quantiles(leads, "lead_weeks", {"median": 0.5}).select("median").scalar()
    return leads.agg(
        F.count(F.lit(1)).alias("detections"),
        F.avg("lead_weeks").alias("mean_weeks"),
        F.max("lead_weeks").alias("max_weeks"),
    ).withColumn("median_weeks", middle)


# --- strata --------------------------------------------------------------------------

def with_strata(test: DataFrame, dormant_weeks: int = 10) -> DataFrame:
    """Each row once by novelty and once by recency."""
    novelty = F.when(F.col("is_novel_topic") == 1, F.lit("novel")).otherwise(F.lit("established"))
    recency = F.when(F.col("weeks_since_last_nl") >= dormant_weeks, F.lit("dormant")).otherwise(F.lit("recent"))
    return test.withColumn("stratum", F.explode(F.array(novelty, recency)))


def stratified_eval(test: DataFrame, label: str = LABEL, score: str = "score", dormant_weeks: int = 10) -> DataFrame:
    """Areas and burst correlation per stratum; all NULL where it has no positives."""
    strata = with_strata(test, dormant_weeks)
    areas = ranking_areas(strata, ["stratum"], label, score)
    burst = stats.point_biserial(strata, ["burst_score"], label, ["stratum"])
    burst = burst.select("stratum", F.col("r").alias("burst_r"))
    joined = areas.join(burst, "stratum", "left")
    has_positive = F.col("positives") > 0
    return joined.select(
        "stratum",
        "n",
        "positives",
        safe_ratio("positives", "n").alias("positive_rate"),
        "roc_auc",
        "average_precision",
        F.when(has_positive, F.col("burst_r")).alias("burst_r"),
    )


def model_comparison(scored: DataFrame, label: str = LABEL, score: str = "score", prediction: str = "prediction") -> DataFrame:
    """AUC, average precision and F1 per ``model``, from one union of scored rows."""
    areas = ranking_areas(scored, ["model"], label, score)
    f1 = f1_score(scored, ["model"], label=label, prediction=prediction)
    return areas.select("model", "roc_auc", "average_precision").join(f1, "model")
