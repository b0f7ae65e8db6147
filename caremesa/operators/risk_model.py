"""Risk classification on the predictions table with Spark ML."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caremesa.operators.ordered import medians
from caremesa.sources.shared import settled

c = F.col

# Target, candidate features and settings of the training run.
KEY = "PredictionID"
TARGET = "PredictedClass"
FEATURES = ("PredictedValue", "ProbabilityScore", "RiskScore", "ThresholdUsed")
TREES, SEED, TEST_SHARE = 100, 42, 0.2


def feature_names(frame: DataFrame) -> list[str]:
    return [name for name in FEATURES if name in frame.columns]


def select_features(frame: DataFrame) -> DataFrame:
    """The row key, the target and the numeric features that exist."""
    return frame.select(KEY, TARGET, *feature_names(frame))


def coerce_numeric(frame: DataFrame) -> DataFrame:
    """Unreadable values become NULL."""
    return frame.withColumns({name: c(name).try_cast("double") for name in feature_names(frame)})


def impute_median(frame: DataFrame) -> DataFrame:
    """NULL features take the exact median over all rows; an empty column stays NULL."""
    fills = medians(frame, feature_names(frame))
    return frame.withColumns({name: F.coalesce(c(name), F.lit(fill).cast("double")) for name, fill in fills.items()})


def drop_untargeted(frame: DataFrame) -> DataFrame:
    """M04"""
    return frame.where(c(TARGET).isNotNull())


def prepared(frame: DataFrame) -> DataFrame:
    """M01-M04 in order; the medians see the rows that are dropped afterwards."""
    return drop_untargeted(impute_median(coerce_numeric(select_features(frame))))


def class_distribution(frame: DataFrame) -> DataFrame:
    """M05"""
    return frame.groupBy(TARGET).agg(F.count(F.lit(1)).alias("RowCount")).orderBy(c("RowCount").desc(), TARGET)


def stratified_split(frame: DataFrame, share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Adds ``IsTest``, true for exactly the rounded share of each class.

    Rows are ranked by a hash of their key. Its first three hex digits cut a
    class into 4096 even buckets whose counts show which bucket holds the limit;
    only the rows of that bucket are ranked, all others are decided row by row.
    """
    marked = frame.withColumn("_hash", F.md5(F.concat(c(KEY).cast("string"), F.lit(f"-{seed}")))).withColumn(
        "_bucket", F.substring("_hash", 1, 3)
    )
    of_class = Window.partitionBy(TARGET)
    upto = of_class.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        marked.groupBy(TARGET, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            TARGET, "_bucket", "_n", F.sum("_n").over(upto).alias("_upto"),
            F.floor(F.sum("_n").over(of_class) * share + 0.5).alias("_wanted"),
        )
        .where((c("_wanted") > c("_upto") - c("_n")) & (c("_wanted") <= c("_upto")))
        .select(TARGET, c("_bucket").alias("_cut"), (c("_wanted") - (c("_upto") - c("_n"))).alias("_left"))
    )
    placed = marked.join(cut, TARGET, "left")
    at_cut = c("_bucket") == c("_cut")
    decided = placed.where(~F.coalesce(at_cut, F.lit(False))).withColumn(
        "IsTest", F.coalesce(c("_bucket") < c("_cut"), F.lit(False))
    )
    rank = F.row_number().over(Window.partitionBy(TARGET, "_bucket").orderBy("_hash", KEY))
    ranked = placed.where(at_cut).withColumn("IsTest", rank <= c("_left"))
    return decided.unionByName(ranked).drop("_hash", "_bucket", "_cut", "_left")


@dataclass(frozen=True)
class Fit:
    model: PipelineModel
    features: list[str]
    test: DataFrame

    @property
    def forest(self):
        return self.model.stages[2]


#: The greatest depth that Spark grows trees to: they end where no split tells classes apart.
DEPTH = 30
#: Memory for the statistics of the nodes that are split in one pass, in MB: a level takes few passes.
NODE_MEMORY = 1024
#: Training rows in one task: with 100 trees a row and its nodes are kept in about 1.5 KB, so a task reads some 150 MB a level.
TASK_ROWS = 100_000


def fit(frame: DataFrame, trees: int = TREES, seed: int = SEED, depth: int = DEPTH) -> Fit:
    """A random forest on the training rows.

    The prepared rows are written once to the shared folder, and everything reads them
    there. Trees grow level by level to ``depth``; each row keeps the numbers of its nodes.
    """
    rows = settled(stratified_split(prepared(frame), seed=seed))
    names = feature_names(rows)
    trained = F.count(F.when(~c("IsTest"), 1)).alias("_trained")
    filled = rows.agg(*(F.count(name).alias(name) for name in names), trained).first()
    features = [name for name in names if filled[name] > 0]
    indexer = StringIndexer(inputCol=TARGET, outputCol="label").fit(rows.select(TARGET))
    forest = RandomForestClassifier(numTrees=trees, seed=seed, maxDepth=depth, cacheNodeIds=True, maxMemoryInMB=NODE_MEMORY)
    stages = [
        indexer,
        VectorAssembler(inputCols=features, outputCol="features"),
        forest,
        IndexToString(inputCol="prediction", outputCol="PredictedLabel", labels=indexer.labels),
    ]
    # every level is a pass over the rows: all cores take part in tasks of bounded size, and equal keys give equal trees
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(filled["_trained"] / TASK_ROWS))
    training = rows.where(~c("IsTest")).repartition(tasks, KEY)
    model = Pipeline(stages=stages).fit(training)
    return Fit(model, features, rows.where("IsTest"))


def forest_summary(fitted: Fit) -> DataFrame:
    """One row per tree."""
    spark = fitted.test.sparkSession
    shape = [(i, tree.depth, tree.numNodes) for i, tree in enumerate(fitted.forest.trees)]
    return spark.createDataFrame(shape, "Tree int, Depth int, Nodes int")


def predict(fitted: Fit) -> DataFrame:
    """Held-out rows with the predicted label."""
    return fitted.model.transform(fitted.test)


def accuracy(predictions: DataFrame) -> float:
    """M08"""
    return MulticlassClassificationEvaluator(metricName="accuracy").evaluate(predictions)


def accuracy_report(predictions: DataFrame) -> DataFrame:
    """Test rows, correct rows and accuracy in one aggregate."""
    correct = F.sum((c(TARGET) == c("PredictedLabel")).cast("int"))
    return predictions.agg(F.count(F.lit(1)).alias("TestRows"), correct.alias("CorrectRows")).withColumn(
        "Accuracy", F.when(c("TestRows") > 0, c("CorrectRows") / c("TestRows"))
    )


def classification_report(predictions: DataFrame, actual: str = TARGET, predicted: str = "PredictedLabel") -> DataFrame:
    """Precision, recall, F1 and support per class, with averages.

    Everything is read off the confusion counts, one record per pair of classes.
    A ratio without a denominator is 0.
    """
    counts = predictions.groupBy(c(actual).alias("a"), c(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = F.array(
        F.struct(c("a").alias("Class"), F.lit(0).alias("said"), c("n").alias("held")),
        F.struct(c("p").alias("Class"), F.lit(1).alias("said"), c("n").alias("held")),
    )
    per_class = (
        counts.select((c("a") == c("p")).alias("hit"), F.inline(sides))
        .groupBy("Class")
        .agg(
            F.sum(F.when(c("said") == 0, c("held")).otherwise(0)).alias("Support"),
            F.sum(F.when(c("said") == 1, c("held")).otherwise(0)).alias("said"),
            F.sum(F.when(c("hit") & (c("said") == 0), c("held")).otherwise(0)).alias("hits"),
        )
    )

    def ratio(num, den):
        return F.when(den > 0, num / den).otherwise(F.lit(0.0))

    scored = per_class.select(
        "Class", ratio(c("hits"), c("said")).alias("Precision"), ratio(c("hits"), c("Support")).alias("Recall"),
        "Support", "hits",
    ).withColumn("F1Score", ratio(2 * c("Precision") * c("Recall"), c("Precision") + c("Recall")))
    measures = ("Precision", "Recall", "F1Score")
    total = F.sum("Support")
    right = F.sum("hits") / total
    averages = scored.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("Class"), *(right.alias(m) for m in measures), total.alias("Support")),
            F.struct(F.lit("macro avg").alias("Class"), *(F.avg(m).alias(m) for m in measures), total.alias("Support")),
            F.struct(
                F.lit("weighted avg").alias("Class"),
                *((F.sum(c(m) * c("Support")) / total).alias(m) for m in measures), total.alias("Support"),
            ),
        ).alias("rows")
    ).select(F.inline("rows"))
    return scored.select("Class", *measures, "Support").unionByName(averages)


def feature_importance(fitted: Fit) -> DataFrame:
    """M10"""
    spark = fitted.test.sparkSession
    pairs = list(zip(fitted.features, map(float, fitted.forest.featureImportances.toArray())))
    return spark.createDataFrame(pairs, "Feature string, Importance double").orderBy(c("Importance").desc(), "Feature")
