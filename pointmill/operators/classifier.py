"""Voxel classifier: a feed-forward network trained by Spark ML on the executors."""

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import IndexToString, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointmill.operators.features import SCALED, encode_labels, label_classes
from pointmill.schema import VOXEL_ML_FEATURES

INPUTS = [f"{c}{SCALED}" for c in VOXEL_ML_FEATURES]


def _filled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """A missing scaled feature takes 0, its mean, so no voxel is lost."""
    return df.fillna(0.0, subset=list(features))


def train_classifier(
    train: DataFrame,
    features: Sequence[str] = INPUTS,
    label: str = "majority_label",
    hidden: Sequence[int] = (64, 32),
    max_iter: int = 100,
    seed: int = 42,
) -> PipelineModel:
    """Fit on scaled features. The layers are inputs, hidden, one output per class.

    Hidden units are sigmoid and the solver is L-BFGS, as Spark ML offers; there
    is no dropout. Rows without a label are left out of the fit.
    """
    classes = label_classes(train, label)
    rows = encode_labels(_filled(train, features), classes, label).where("label_index IS NOT NULL")
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="features"),
        MultilayerPerceptronClassifier(
            layers=[len(features), *hidden, len(classes)],
            featuresCol="features",
            labelCol="label_index",
            predictionCol="predicted_index",
            maxIter=max_iter,
            seed=seed,
        ),
        IndexToString(inputCol="predicted_index", outputCol="predicted_text", labels=[str(c) for c in classes]),
    ]
    return Pipeline(stages=stages).fit(rows)


def classify(model: PipelineModel, df: DataFrame, features: Sequence[str] = INPUTS) -> DataFrame:
    """Add predicted, a label, and probability, an array with one entry per class."""
    scored = model.transform(_filled(df, features))
    return scored.withColumns(
        {"predicted": F.col("predicted_text").cast("int"), "probability": vector_to_array("probability")}
    ).drop("features", "rawPrediction", "predicted_index", "predicted_text")


def model_classes(model: PipelineModel) -> list[int]:
    return [int(text) for text in model.stages[-1].getLabels()]


def evaluate(scored: DataFrame, classes: Sequence[int], label: str = "majority_label") -> DataFrame:
    """Rows, accuracy and mean log loss. A label the model never saw gets the smallest probability."""
    rows = encode_labels(scored, classes, label)
    given = F.get(F.col("probability"), F.col("label_index"))
    return rows.agg(
        F.count("*").alias("n"),
        F.try_divide(F.count_if(F.col(label) == F.col("predicted")), F.count("*")).alias("accuracy"),
        F.avg(-F.ln(F.greatest(F.coalesce(given, F.lit(0.0)), F.lit(1e-15)))).alias("log_loss"),
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
