"""Features to the serving table: train or reuse scores, recommend, add outreach texts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from liftlab.operators import ml, nudges, recommend
from liftlab.settings import Settings


def train_and_score(features: DataFrame, settings: Settings,
                    config: ml.TrainConfig = ml.TrainConfig()) -> tuple[ml.Propensity, DataFrame]:
    propensity = ml.fit_all(features, settings.products, config)
    return propensity, ml.score(propensity, features)


def user_recommendations(scores: DataFrame, features: DataFrame, catalog: DataFrame,
                         settings: Settings, generator: nudges.Generator, k: int = 750,
                         brand: str = "our platform") -> DataFrame:
    scored = recommend.with_context(scores, features, settings.products)
    base = recommend.recommendations(scored, catalog, settings)
    return nudges.assemble(base, generator, k, brand)
