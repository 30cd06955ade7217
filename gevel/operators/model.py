"""Floor-count model: a fitted pipeline applied to the feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _numeric(df: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """Number columns as double; a missing value is not the same as zero neighbours."""
    return df.withColumns({c: F.col(c).cast("double") for c in inputs})


def fit_floors(df: DataFrame, inputs: Sequence[str], label: str = "floors", rounds: int = 20, seed: int = 7) -> PipelineModel:
    """Gradient-boosted trees on imputed features."""
    filled = [f"{c}_known" for c in inputs]
    stages = [
        Imputer(inputCols=list(inputs), outputCols=filled, strategy="median"),
        VectorAssembler(inputCols=filled, outputCol="_x"),
        GBTRegressor(featuresCol="_x", labelCol=label, predictionCol="floors_predicted", maxIter=rounds, maxDepth=4, seed=seed),
    ]
    return Pipeline(stages=stages).fit(_numeric(df, [*inputs, label]))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict_floors(df: DataFrame, model: PipelineModel, inputs: Sequence[str]) -> DataFrame:
    """Adds ``floors`` and ``floors_int`` (rounded half to even)."""
    scored = model.transform(_numeric(df, inputs))
    return df_columns(scored, df.columns).withColumn("floors_int", F.rint("floors"))


def df_columns(scored: DataFrame, keep: Sequence[str]) -> DataFrame:
    return scored.select(*keep, F.col("floors_predicted").alias("floors"))


def predictions(df: DataFrame) -> DataFrame:
    """Rows of the predictions table."""
    return df.select("identificatie", F.rint("floors").cast("int").alias("b3_bouwlagen"))
