"""Accuracy, weighted F1 and feature importances as tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.operators.quality import row_counts


def confusion(predictions: DataFrame, target: str = "target", prediction: str = "prediction") -> DataFrame:
    """Rows per (target, prediction)."""
    pairs = predictions.select(
        F.col(target).cast("double").alias("target"), F.col(prediction).cast("double").alias("prediction")
    )
    return row_counts(pairs, "target", "prediction")


def evaluate(predictions: DataFrame, target: str = "target", prediction: str = "prediction") -> DataFrame:
    """One row with ``accuracy`` and the weighted ``f1``, from a single pass over the predictions.

    Per class, F1 is twice the hits over the class's rows plus its predictions;
    classes weigh as many as they have rows.
    """
    cells = confusion(predictions, target, prediction)
    n = F.col("count")
    hit = F.when(F.col("target") == F.col("prediction"), n).otherwise(0)
    none = F.lit(0).cast("bigint")

    def side(label: str, actual: Column, predicted: Column, hits: Column) -> Column:
        return F.struct(
            F.col(label).alias("class"),
            actual.alias("actual"),
            predicted.alias("predicted"),
            hits.alias("hits"),
        )

    both = F.array(side("target", n, none, hit), side("prediction", none, n, none))
    sides = cells.select(F.explode(both).alias("side")).select("side.*")
    classes = sides.groupBy("class").agg(
        F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )
    class_f1 = 2 * F.col("hits") / (F.col("actual") + F.col("predicted"))
    return classes.agg(
        (F.sum("hits") / F.sum("actual")).alias("accuracy"),
        (F.sum(F.col("actual") * class_f1) / F.sum("actual")).alias("f1"),
    )


def importances(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(feature, importance), the most important first; as many rows as the model has inputs."""
    assembler, forest = model.stages[0], model.stages[-1]
    weights = forest.featureImportances.toArray().tolist()
    rows = list(zip(assembler.getInputCols(), weights, strict=True))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )
