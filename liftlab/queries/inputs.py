"""Inputs shared by the registered queries, all over whole tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlab import session
from liftlab.operators import experiments, features, nudges, recommend
from liftlab.sources import roles

SETTINGS = roles.SETTINGS
PRODUCTS = SETTINGS.products
TOP_K = 750


def user_features(spark: SparkSession, sf: str, settings=SETTINGS) -> DataFrame:
    return features.user_features(
        roles.users(spark, sf), roles.events(spark, sf, settings),
        roles.silver_assignments(spark, sf), settings)


def results(spark: SparkSession, sf: str) -> DataFrame:
    return experiments.results(user_features(spark, sf), SETTINGS)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Context and scores side by side: they come from one row, so no join is needed."""
    return roles.closed_form_scores(
        user_features(spark, sf), keep=recommend.context_columns(PRODUCTS))


def picked(spark: SparkSession, sf: str) -> DataFrame:
    return recommend.assemble(roles.closed_form_scores(user_features(spark, sf)), PRODUCTS)


def valued(spark: SparkSession, sf: str) -> DataFrame:
    return recommend.expected_value(picked(spark, sf), roles.catalog(spark), SETTINGS)


def recommendations(spark: SparkSession, sf: str) -> DataFrame:
    # ranked first, then compared with the group borders: two passes over one written table
    return recommend.recommendations(session.written(scored(spark, sf), "scored"), roles.catalog(spark), SETTINGS)


def write_text(prompts: pd.Series) -> pd.Series:
    """Stands in for a text model: repeatable, and it depends on the whole prompt."""
    return "You could try something new today. [" + prompts.str.len().astype(str) + "]"


def nudged(spark: SparkSession, sf: str) -> DataFrame:
    return nudges.assemble(recommendations(spark, sf), write_text, TOP_K)


def labelled(gold: DataFrame, salt: str = "prob") -> DataFrame:
    """(product, user_id, score, label) of all users in ``gold`` and all products."""
    wide = roles.closed_form_scores(gold, salt=salt, keep=["user_id", *(f"adopted_{p}" for p in PRODUCTS)])
    return experiments.by_product(wide, PRODUCTS, ["user_id"], score="prob_{}", label="adopted_{}")


def scored_labels(spark: SparkSession, sf: str, salt: str = "prob") -> DataFrame:
    return labelled(user_features(spark, sf), salt)
