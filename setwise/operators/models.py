"""Tree models over samples: pipelines, grouped validation, chained scoring."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from statistics import fmean

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setwise.contract import (
    DOWN_LABEL, DOWN_MODEL, FEATURE_COLUMN, FEATURES, FOLDS, FOREST_PARAMS, SCALED_COLUMN, SET_LABEL, SET_MODEL,
    SPLIT_SEED, TRAIN_PERCENT, TREE_PARAMS, UP_LABEL, UP_MODEL,
)
from setwise.operators.relational import confusion_metrics, key_bucket
from setwise.session import work_dir
from setwise.sources.files import remove

_CLASSIFIERS = {"tree": DecisionTreeClassifier, "forest": RandomForestClassifier}
_PARAMS = {"tree": TREE_PARAMS, "forest": FOREST_PARAMS}


@dataclass(frozen=True)
class ModelSpec:
    """What to learn: the label, the kind of model and its inputs."""

    name: str
    label: str
    kind: str
    features: tuple[str, ...]
    params: Mapping | None = None

    def settings(self) -> dict:
        return dict(self.params if self.params is not None else _PARAMS[self.kind])

    def pipeline(self, seed: int = SPLIT_SEED) -> Pipeline:
        """Assemble the inputs, standardise them, classify."""
        classifier = _CLASSIFIERS[self.kind](
            labelCol=self.label, featuresCol=SCALED_COLUMN, seed=seed, **self.settings()
        )
        return Pipeline(
            stages=[
                VectorAssembler(inputCols=list(self.features), outputCol=FEATURE_COLUMN),
                StandardScaler(inputCol=FEATURE_COLUMN, outputCol=SCALED_COLUMN, withMean=True, withStd=True),
                classifier,
            ]
        )


def chained_specs(features: Sequence[str] = FEATURES, tree: Mapping | None = None, forest: Mapping | None = None):
    """The set model and the two phase models; these also get the set label as input."""
    features = tuple(features)
    chained = (*features, SET_LABEL)
    return (
        ModelSpec(SET_MODEL, SET_LABEL, "tree", features, tree),
        ModelSpec(UP_MODEL, UP_LABEL, "forest", chained, forest),
        ModelSpec(DOWN_MODEL, DOWN_LABEL, "forest", chained, forest),
    )


SHARE, FOLD = "__share", "__fold"
"""What a row's group decides, worked out once for all the passes of all fits."""


def with_shares(df: DataFrame, group: str, folds: int = FOLDS, seed: int = SPLIT_SEED) -> DataFrame:
    """Add the hundredth and the fold of the row's group; rows that have them stay as they are."""
    if SHARE in df.columns:
        return df
    return df.withColumns({SHARE: key_bucket(group, seed), FOLD: key_bucket(group, seed + 1, folds)})


@contextmanager
def kept(df: DataFrame, columns: Sequence[str]) -> Iterator[DataFrame]:
    """These columns, worked out once and kept in files of the shared folder: a fit passes over
    its rows a dozen times, with as many tasks as the files are large."""
    spark, path = df.sparkSession, work_dir(df.sparkSession, "kept")
    rows = df.select(*dict.fromkeys(columns)).hint("rebalance")
    rows.write.parquet(path)
    try:
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        remove(spark, path)


def validate_by_group(
    spec: ModelSpec, df: DataFrame, group: str, folds: int = FOLDS, seed: int = SPLIT_SEED
) -> CrossValidatorModel:
    """Cross-validate by F1 with whole groups per fold, so that no group is on both sides. As
    ``CrossValidator`` with a fold column does, but this checks folds by a Python function and
    caches the rows of each fold again."""
    f1 = MulticlassClassificationEvaluator(labelCol=spec.label, predictionCol="prediction", metricName="f1")
    with kept(with_shares(df, group, folds, seed), [*spec.features, spec.label, FOLD]) as rows:
        measured = []
        for fold in range(folds):
            rest, own = rows.where(F.col(FOLD) != fold), rows.where(F.col(FOLD) == fold)
            for side, name in ((rest, "training"), (own, "validation")):
                if side.isEmpty():
                    raise ValueError(f"the {name} data at fold {fold} is empty")
            measured.append(f1.evaluate(fit(spec, rest, seed).transform(own)))
        return CrossValidatorModel(fit(spec, rows, seed), [fmean(measured)])


def evaluate_by_group(
    spec: ModelSpec, df: DataFrame, group: str, folds: int = FOLDS, seed: int = SPLIT_SEED,
    percent: int = TRAIN_PERCENT,
) -> tuple[CrossValidatorModel, DataFrame]:
    """Validate on a share of the groups, then score the held-out groups.

    Returns the validated model and a one-row frame of hold-out metrics.
    """
    rows = with_shares(df, group, folds, seed)
    model = validate_by_group(spec, rows.where(F.col(SHARE) < percent), group, folds, seed)
    return model, confusion_metrics(model.transform(rows.where(F.col(SHARE) >= percent)), spec.label)


def fit(spec: ModelSpec, df: DataFrame, seed: int = SPLIT_SEED) -> PipelineModel:
    return spec.pipeline(seed).fit(df.select(*dict.fromkeys([*spec.features, spec.label])))


def predict(model: PipelineModel, df: DataFrame, out: str) -> DataFrame:
    """Add the prediction as ``out``; the model's working columns are dropped."""
    scored = model.transform(df)
    return scored.withColumnRenamed("prediction", out).select(*df.columns, out)


def score_chained(df: DataFrame, set_model: PipelineModel, up: PipelineModel, down: PipelineModel) -> DataFrame:
    """Predict the set label, then both phases from it. Everything stays on its row, so
    no join by key is needed. The set label is passed on before any smoothing."""
    df = predict(set_model, df, SET_LABEL)
    return predict(down, predict(up, df, UP_LABEL), DOWN_LABEL)


def fold_metrics(scored: DataFrame, label: str, prediction: str, fold: str = "fold") -> DataFrame:
    """``confusion_metrics`` of each fold, from stored predictions in one pass."""
    return confusion_metrics(scored, label, prediction, by=(fold,))


def out_of_fold(
    specs: Sequence[ModelSpec], df: DataFrame, group: str, path: str, folds: int = FOLDS, seed: int = SPLIT_SEED
) -> DataFrame:
    """Predictions of chained models for rows they were not fitted on, stored by fold.

    Whole groups form a fold. For each, the models are fitted on the others and score it; a
    later model gets the prediction of the first one, as in production. What a row was labelled
    is kept as ``told_<label>``. A fold is written as a whole, so a run that is repeated after
    a failure replaces what it had.
    """
    labels = {spec.label: f"told_{spec.label}" for spec in specs}
    with kept(df.withColumn("fold", key_bucket(group, seed + 1, folds)), [*df.columns, "fold"]) as rows:
        for fold in range(folds):
            rest, own = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
            scored = own.withColumnsRenamed(labels)
            for spec in specs:
                scored = predict(fit(spec, rest, seed), scored, spec.label)
            scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("fold").parquet(path)
    return df.sparkSession.read.parquet(path)
