"""Random-forest scores of evidence rows, with Spark's own models."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The model's features, in order.
FEATURES = ("blast_pid", "blast_e-value", "blast_offset", "blast_percentage_aligned", "toga_pid", "toga_blosum", "toga_overlap_bp", "translationAI_orf_start", "translationAI_orf_stop")


def assemble(df: DataFrame, features=FEATURES) -> DataFrame:
    safe = [f"_f{i}" for i in range(len(features))]
    df = df.withColumns({s: F.col(f"`{c}`").cast("double") for s, c in zip(safe, features)})
    return VectorAssembler(inputCols=safe, outputCol="features", handleInvalid="error").transform(df).drop(*safe)


def train(df: DataFrame, label: str, features=FEATURES, trees: int = 20, depth: int = 5, seed: int = 1) -> RandomForestClassificationModel:
    return RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed).fit(assemble(df, features))


def load(path: str) -> RandomForestClassificationModel:
    return RandomForestClassificationModel.load(path)


def score(df: DataFrame, model: RandomForestClassificationModel, features=FEATURES) -> DataFrame:
    """class0_probability and class1_probability of every row; 0 for a class that training never showed."""
    p = vector_to_array("probability")
    return model.transform(assemble(df, features)).withColumns({"class0_probability": p[0], "class1_probability": F.coalesce(F.get(p, F.lit(1)), F.lit(0.0))}).drop("features", "rawPrediction", "probability", "prediction")
