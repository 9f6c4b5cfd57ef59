"""Model training and scoring with Spark ML pipelines."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def train(rows: DataFrame, features: Iterable[str], label: str, hidden: Iterable[int] = (8,), learning_rate: float = 0.03, batch_size: int = 128, epochs: int = 100, seed: int = 7) -> PipelineModel:
    """A perceptron on numeric features, or logistic regression if ``hidden`` is empty.

    Rows with a null feature or label are left out. Spark ML has no dropout.
    """
    features, hidden = list(features), list(hidden)
    rows = rows.na.drop(subset=[*features, label]).withColumn(label, F.col(label).cast("double"))
    gather = VectorAssembler(inputCols=features, outputCol="_features")
    names = {"featuresCol": "_features", "predictionCol": "_prediction", "probabilityCol": "_probability", "rawPredictionCol": "_raw", "labelCol": label}
    if hidden:
        model = MultilayerPerceptronClassifier(**names, layers=[len(features), *hidden, 2], stepSize=learning_rate, blockSize=batch_size, maxIter=epochs, seed=seed)
    else:
        model = LogisticRegression(**names, maxIter=epochs)
    return Pipeline(stages=[gather, model]).fit(rows)


def score(rows: DataFrame, model: PipelineModel | str, threshold: float = 0.8) -> DataFrame:
    """``rows`` with ``score``, the probability of class 1, and ``is_anomaly``; rows with a null feature have neither. Columns of these names give way.

    ``model`` is a fitted pipeline or the path of one.
    """
    if isinstance(model, str):
        model = PipelineModel.load(model)
    gather, last = model.stages[0].copy(), model.stages[-1]
    gather.setHandleInvalid("keep")  # null features are NaN for the model; their score is dropped behind it
    whole = reduce(lambda a, c: a & F.col(f"`{c}`").isNotNull(), gather.getInputCols(), F.lit(True))
    scored = reduce(lambda df, s: s.transform(df), [gather, *model.stages[1:]], rows)
    score = F.when(whole, vector_to_array(last.getProbabilityCol())[1])
    own = [F.col(f"`{c}`") for c in rows.columns if c not in ("score", "is_anomaly")]
    return scored.select(*own, score.alias("score"), (score >= threshold).alias("is_anomaly"))


def score_with(rows: DataFrame, function: Callable, features: Iterable[str], threshold: float = 0.8) -> DataFrame:
    """As :func:`score`, with a caller's pandas UDF over the feature columns for models that Spark ML has not trained."""
    return rows.withColumn("score", function(*features)).withColumn("is_anomaly", F.col("score") >= threshold)


#: Bytes of a foreign model that may be sent to the tasks.
MODEL_BYTES = 256 << 20


def split(rows: DataFrame, keys: Iterable[str], one_in: int = 4) -> tuple[DataFrame, DataFrame]:
    """Rows to learn from, and about one in ``one_in`` held out, by a hash of the keys: the same ones every time."""
    part = F.conv(F.left(F.md5(F.to_json(F.struct(*keys))), F.lit(7)), 16, 10).cast("int") % one_in
    return rows.where(part != 0), rows.where(part == 0)


def accuracy(scored: DataFrame, label: str) -> DataFrame:
    """One row: ``n``, ``n_right`` and ``n_most``, the rows right if the commoner label were always said. Rows without score or label are left out."""
    known = scored.where(F.col("is_anomaly").isNotNull() & F.col(label).isNotNull())
    yes = F.col(label).cast("double") > 0
    return known.agg(F.count("*").alias("n"), F.count_if(F.col("is_anomaly") == yes).alias("n_right"), F.greatest(F.count_if(yes), F.count_if(~yes)).alias("n_most"))


def score_loaded(rows: DataFrame, path: str, load: Callable[[bytes], Callable[[np.ndarray], np.ndarray]], features: Iterable[str], threshold: float = 0.8, batch_size: int = 4096) -> DataFrame:
    """As :func:`score`, with a model of any library from the file ``path``: ``load`` makes of its bytes a function from a matrix to scores.

    The file is read by Spark and sent to the tasks (``MODEL_BYTES`` at most, else a ValueError); a worker loads
    it once. Rows with a null feature have no score and do not reach the model.
    """
    features, spark = list(features), rows.sparkSession
    size, content = spark.read.format("binaryFile").load(path).select("length", "content").first()
    if size > MODEL_BYTES:
        raise ValueError(f"a model of {size} bytes")
    sent = spark.sparkContext.broadcast(bytes(content))

    def make():
        model = load(sent.value)

        def predict(values: np.ndarray) -> np.ndarray:
            whole = ~np.isnan(values).any(axis=1)
            out = np.full(len(values), np.nan)
            if whole.any():
                out[whole] = np.asarray(model(values[whole]), np.float64)
            return out

        return predict

    predict = predict_batch_udf(make, return_type=DoubleType(), batch_size=batch_size, input_tensor_shapes=[[len(features)]])
    whole = reduce(lambda a, c: a & F.col(f"`{c}`").isNotNull(), features, F.lit(True))
    values = F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in features])
    own = [F.col(f"`{c}`") for c in rows.columns if c not in ("score", "is_anomaly")]
    scored = rows.select(*own, F.when(whole, predict(values)).alias("score"))
    return scored.withColumn("is_anomaly", F.col("score") >= threshold)
