"""Class-weighted MLlib classifiers tuned on the validation weeks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass, field

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from weeksignal.operators import evaluate, grids
from weeksignal.operators.stats import LABEL
from weeksignal.session import cut_lineage

# Fixed values, as the compared models use them.
FEATURES = [
    "burst_score", "mentions", "topic_nl_rate_8wk", "topic_nl_rate_alltime",
    "weeks_since_last_nl", "is_novel_topic", "past_nl_count",
]
TREE_DEPTHS = [2, 3, 4, 5, 6, 8, None]
REGULARISATION = [0.01, 0.05, 0.1, 0.5, 1.0, 5.0, 10.0]
FOREST_GRID = [(n, depth) for n in (100, 200, 300) for depth in (4, 6, 8)]
# The deepest tree MLlib can store; it stands for "no limit".
UNLIMITED_DEPTH = 30
SEED = 42
# Rows are dealt to so many partitions for every fit, whatever the cluster, since seeded
# draws go by partition.
FIT_PARTITIONS = 32
BINS = 256


@dataclass
class Prepared:
    """Split rows with class weights and feature vectors, raw and scaled."""

    rows: DataFrame
    features: list[str] = field(default_factory=lambda: list(FEATURES))

    def part(self, name: str) -> DataFrame:
        return self.rows.where(F.col("split") == name)


def prepare(matrix: DataFrame, features: list[str] | None = None) -> Prepared:
    """Split, weight and scale once; the result is written out for the many fits.

    Weights and scaling come from the training rows alone.
    """
    features = list(features or FEATURES)
    parted = cut_lineage(evaluate.temporal_split(matrix), "splits")
    train = parted.where(F.col("split") == "train")
    weighted = evaluate.with_class_weight(parted, train)
    fitted = evaluate.scaler(train, features)
    scaled = {
        f"_s_{c}": (F.col(c).cast("double") - fitted.getField(f"mean_{c}")) / fitted.getField(f"std_{c}")
        for c in features
    }
    wide = weighted.withColumns(scaled)
    wide = VectorAssembler(inputCols=features, outputCol="features").transform(wide)
    wide = VectorAssembler(inputCols=list(scaled), outputCol="scaled").transform(wide)
    rows = wide.select(
        "canonical_topic", "week", "split", LABEL, "weight", "features", "scaled",
        "burst_score", "is_novel_topic", "weeks_since_last_nl",
    )
    return Prepared(cut_lineage(rows, "prepared"), features)


def dealt(rows: DataFrame) -> DataFrame:
    """The same rows in the same partitions and order on every cluster."""
    keys = ["canonical_topic", "week"]
    return rows.repartition(FIT_PARTITIONS, *keys).sortWithinPartitions(*keys)


def _common(features: str) -> dict:
    return {"featuresCol": features, "labelCol": LABEL, "weightCol": "weight", "predictionCol": "_prediction"}


def fit_tree(train: DataFrame, depth: int | None):
    tree = DecisionTreeClassifier(
        maxDepth=UNLIMITED_DEPTH if depth is None else depth, impurity="gini", maxBins=BINS, seed=SEED, **_common("features")
    )
    return tree.fit(train)


def fit_logistic(train: DataFrame, c: float, l1: bool = False):
    """``c`` is the usual inverse regularisation strength on the summed loss.

    MLlib minimises the weighted mean loss, so its penalty is 1 / (c * sum of weights).
    """
    total = train.agg(F.sum("weight")).first()[0]
    model = LogisticRegression(
        regParam=1.0 / (c * total), elasticNetParam=1.0 if l1 else 0.0, maxIter=1000, tol=1e-8,
        standardization=False, **_common("scaled"),
    )
    return model.fit(train)


def fit_forest(train: DataFrame, trees: int, depth: int):
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=SEED, featureSubsetStrategy="sqrt", maxBins=BINS,
        maxMemoryInMB=1024,  # more tree nodes per pass over the rows
        **_common("features"),
    )
    return forest.fit(train)


def tree_grid(train: DataFrame, depths: list[int | None]) -> grids.Trees:
    """All depths from the deepest tree."""
    tree = fit_tree(train, None if None in depths else max(depths))
    points = [(1, UNLIMITED_DEPTH if depth is None else depth) for depth in depths]
    return grids.Trees(grids.Nodes.of(grids.node_table(tree)), points, tree.numFeatures)


def forest_grid(train: DataFrame, points: list[tuple[int, int]]) -> grids.Trees:
    """All points from the largest forest of the deepest trees: its first trees, cut at their depth."""
    forest = fit_forest(train, max(trees for trees, _ in points), max(depth for _, depth in points))
    return grids.Trees(grids.Nodes.of(grids.node_table(forest)), points, forest.numFeatures)


def logistic_grid(train: DataFrame, strengths: list[float]) -> grids.Lines:
    """All regularisation strengths, each pass over the rows serving all of them."""
    width = len(train.select("scaled").first()["scaled"])
    return grids.fit_lines(train, strengths, width, LABEL)


class Separate:
    """Grid points that were fitted one by one."""

    def __init__(self, fitted: list):
        self.fitted = fitted

    def add_scores(self, rows: DataFrame) -> DataFrame:
        for k, model in enumerate(self.fitted):
            rows = score(model, rows).withColumnRenamed("score", f"_score_{k}").drop("prediction")
        names = [f"_score_{k}" for k in range(len(self.fitted))]
        return rows.withColumn("scores", F.array(*names)).drop(*names)

    def at(self, position: int):
        return self.fitted[position]


#: Fits that give a whole grid at once, by the fit of one point.
WHOLE = {fit_tree: tree_grid, fit_forest: forest_grid, fit_logistic: logistic_grid}


def score(model, rows: DataFrame) -> DataFrame:
    """Add ``score`` (probability of coverage) and ``prediction``."""
    if hasattr(model, "add_scores"):
        scored = model.add_scores(rows).withColumn("score", F.get("scores", F.lit(0))).drop("scores")
        return scored.withColumn("prediction", (F.col("score") > 0.5).cast("int"))
    scored = model.transform(rows)
    return scored.withColumns(
        {
            "score": vector_to_array("probability")[1],
            "prediction": F.col("_prediction").cast("int"),
        }
    ).drop("rawPrediction", "probability", "_prediction")


@contextmanager
def training_rows(prepared: Prepared) -> Iterator[DataFrame]:
    """The training weeks as fits read them, kept in memory meanwhile.

    Spark keeps equal plans once, so fits at the same time must share this one: the first
    to end would else drop the rows under the others.
    """
    train = dealt(prepared.part("train")).cache()
    try:
        yield train
    finally:
        train.unpersist()


def tune(
    prepared: Prepared, grid: list, fit, fallback: int = 0, whole: bool = True, train: DataFrame | None = None
) -> tuple[object, DataFrame]:
    """Fit a grid on the training weeks, score all points on the validation weeks in one pass.

    Where the learner allows it, one fit gives the whole grid; ``whole=False`` fits every point
    on its own. ``train`` are the ``training_rows``, if the caller has them. Returns the model of the best point and the table of validation scores
    (grid_pos, params, f1, roc_auc). The first best point wins; where every F1 is 0
    the point ``fallback`` stays.
    """
    with training_rows(prepared) if train is None else nullcontext(train) as train:
        if whole and fit in WHOLE:
            fitted = WHOLE[fit](train, grid)
        else:
            fitted = Separate([fit(train, *(params if isinstance(params, tuple) else (params,))) for params in grid])
    points = fitted.add_scores(prepared.part("val")).select(F.posexplode("scores").alias("grid_pos", "score"), LABEL)
    named = F.element_at(F.array(*[F.lit(str(params)) for params in grid]), F.col("grid_pos") + 1)
    scored = points.select("grid_pos", named.alias("params"), LABEL, "score", (F.col("score") > 0.5).cast("int").alias("prediction"))
    scored = cut_lineage(scored, "grid")
    keys = ["grid_pos", "params"]
    table = evaluate.f1_score(scored, keys).join(
        evaluate.ranking_areas(scored, keys).select(*keys, "roc_auc", "average_precision"), keys
    )
    best = evaluate.grid_select(scored, "grid_pos").first()
    return fitted.at(best["grid_pos"] if best else fallback), table


def importance_table(spark: SparkSession, model, features: list[str], name: str) -> DataFrame:
    """Feature weights of a fitted model: gini importances or signed coefficients."""
    if hasattr(model, "weights"):
        values = model.weights()
    elif hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    else:
        values = model.coefficients.toArray()
    rows = [(name, f, float(v), abs(float(v))) for f, v in zip(features, values)]
    table = spark.createDataFrame(rows, "model string, feature string, weight double, magnitude double")
    return table.orderBy(F.col("magnitude").desc(), "feature")
