"""The two tree candidates and probability scoring."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed

BOOSTED, FOREST = "boosted_trees", "random_forest"
FIT_ROWS = 250_000  # of a part that a learner keeps; rows take some 600 bytes there
BINS = 256  # histogram bins of a feature, the usual default of histogram trainers


def boosted_trees(
    rounds: int = fixed.BOOSTED_TREES["rounds"],
    depth: int = fixed.BOOSTED_TREES["depth"],
    rate: float = fixed.BOOSTED_TREES["rate"],
    row_share: float = fixed.BOOSTED_TREES["row_share"],
    column_share: float = fixed.BOOSTED_TREES["column_share"],
    seed: int = fixed.SEED,
) -> GBTClassifier:
    return GBTClassifier(
        featuresCol="vector", labelCol="target", weightCol="fit_weight", maxIter=rounds, maxDepth=depth,
        stepSize=rate, subsamplingRate=row_share, featureSubsetStrategy=str(column_share), seed=seed,
        maxBins=BINS, checkpointInterval=10, cacheNodeIds=True,
    )


def random_forest(
    trees: int = fixed.RANDOM_FOREST["trees"],
    depth: int = fixed.RANDOM_FOREST["depth"],
    min_leaf: int = fixed.RANDOM_FOREST["min_leaf"],
    seed: int = fixed.SEED,
) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol="vector", labelCol="target", weightCol="fit_weight", numTrees=trees, maxDepth=depth,
        minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt", seed=seed, maxBins=BINS,
        checkpointInterval=10, cacheNodeIds=True,
    )


def assemble(features: DataFrame, prefix: str = "", output: str = "vector") -> DataFrame:
    names = [prefix + name for name in fixed.FEATURE_NAMES]
    return VectorAssembler(inputCols=names, outputCol=output, handleInvalid="keep").transform(features)


def in_parts(features: DataFrame) -> DataFrame:
    """The stored feature table in parts of about ``FIT_ROWS`` rows. Scans cut by compressed bytes and by cores, so their parts grow with the table."""
    parts = -(-features.count() // FIT_ROWS)
    return features.repartition(parts) if parts > features.rdd.getNumPartitions() else features


@contextmanager
def one_file_a_part(spark: SparkSession):
    """Scans that begin in here do not put several files into one part: to open a file costs as much as a part may hold."""
    name, most = "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, spark.conf.get(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def fit_model(estimator, features: DataFrame, weight):
    """Fit on a feature table with a ``label`` column; ``weight`` is a Column."""

    def fitted(table: DataFrame):
        table = assemble(table).select(
            "vector", F.col("label").cast("double").alias("target"), weight.alias("fit_weight")
        )
        return estimator.fit(table)

    dealt = in_parts(features)
    if dealt is features:
        return fitted(features)
    with one_file_a_part(features.sparkSession):
        # A table in files of ``FIT_ROWS`` rows need not be shuffled.
        alone = features.select("*")
        return fitted(alone if in_parts(alone) is alone else dealt)


def with_probability(features: DataFrame, model, prefix: str = "") -> DataFrame:
    """Add ``<prefix>probability`` of the malicious class; works on streams."""
    vector, raw, output = f"_{prefix}vector", f"_{prefix}raw", f"_{prefix}probability"
    scorer = model.copy({
        model.featuresCol: vector, model.rawPredictionCol: raw, model.probabilityCol: output, model.predictionCol: "",
    })
    scored = scorer.transform(assemble(features, prefix, vector))
    return scored.withColumn(f"{prefix}probability", vector_to_array(F.col(output))[1]).drop(vector, raw, output)


def with_prediction(scored: DataFrame) -> DataFrame:
    return scored.withColumn("prediction", (F.col("probability") >= fixed.DECISION_THRESHOLD).cast("int"))
