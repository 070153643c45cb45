"""Training: eligible series -> features -> models, metrics and importances."""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from harvestlens.operators import features, models
from harvestlens.operators.features import KEYS
from harvestlens.session import write_and_read
from harvestlens.sources.star_store import StarStore


@dataclass
class Training:
    guards: DataFrame
    train: DataFrame
    test: DataFrame
    models: DataFrame  # with the error of those that could not be fitted

    @property
    def fitted(self) -> DataFrame:
        return models.solved(self.models)

    def evaluations(self, keys: list[str] = KEYS) -> DataFrame:
        return models.model_evaluation(self.test, self.fitted, keys)

    def importances(self, keys: list[str] = KEYS) -> DataFrame:
        return models.feature_importances(self.fitted, keys)

    def summary(self, keys: list[str] = KEYS) -> DataFrame:
        return models.training_summary(self.guards, self.models, keys)


def train_series(series: DataFrame, keys: list[str] = KEYS) -> Training:
    """One lazy plan over all series: guards, split features and ridge models."""
    guards = features.series_guards(series, keys)
    split = features.time_split(features.feature_matrix(series, keys, causal=True), keys)
    usable = features.trainable(split, guards, keys)
    train, test = usable.filter("NOT is_test"), usable.filter("is_test")
    return Training(guards, train, test, models.fit_ridge(train, keys))


def train_store(store: StarStore) -> DataFrame:
    """Train on the stored fact and upsert models, metrics and importances.

    A series that was not fitted this time keeps its earlier model beside its metrics.
    Returns the summary by status.
    """
    training = train_series(features.fact_series(store.star()))
    training.models = write_and_read(training.models, "models")
    store.upsert("series_models", training.fitted, KEYS)
    store.upsert("model_evaluation", training.evaluations(), KEYS)
    store.upsert("feature_importance", training.importances(), [*KEYS, "feature_name"])
    return training.summary()


def save_models(fitted: DataFrame, path: str) -> None:
    """The models as one coefficient table."""
    fitted.write.mode("overwrite").parquet(path)


def train_boosted(store: StarStore, trees: int = 1000) -> PipelineModel:
    """Fit the boosted model on all usable series of the stored fact and store it, replacing an earlier one."""
    training = train_series(features.fact_series(store.star()))
    model = models.fit_boosted(training.train, trees=trees)
    model.write().overwrite().save(store.path("boosted_model"))
    return model


def load_boosted(store: StarStore) -> PipelineModel | None:
    """The stored boosted model, None if none was fitted."""
    return PipelineModel.load(store.path("boosted_model")) if store.exists("boosted_model") else None
