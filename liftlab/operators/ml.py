"""Propensity models on Spark ML: features, split, boosted trees, scores, run log."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from liftlab import session
from liftlab.functions import numeric
from liftlab.operators import experiments, metrics

# The model inputs.
CATEGORIES = ("tier", "region", "age_band", "risk_profile", "kyc_status")
NUMBERS = ("account_balance_usd", "events_total", "trades_total", "logins_total",
           "deposit_total_usd", "sessions_total", "active_days", "tenure_days")

RUN_SCHEMA = ("product STRING, version INT, trees INT, depth INT, rate DOUBLE, seed INT, n_features INT, "
              "n_train BIGINT, roc_auc DOUBLE, avg_precision DOUBLE, accuracy DOUBLE, base_rate DOUBLE, "
              "finished_at TIMESTAMP")
# Rows of a training partition. Each level of each tree is a job of one task per partition and, after its shuffle, as many
# again that hold next to nothing; so few large ones, whose rows still fit many times into an executor.
_ROWS_A_TASK = 250_000


@dataclass(frozen=True)
class TrainConfig:
    """max_training_rows: upper bound, in expectation, of the labelled rows that a model is fitted
    on, None for all of them. Boosting is a chain of jobs over them; above a bound a share of the
    users is taken by a hash of the key. Scores, holdout metrics of the users left and base rates
    cover all users.
    """

    trees: int = 200
    depth: int = 3
    rate: float = 0.1
    test_share: float = 0.2
    seed: int = 42
    max_training_rows: int | None = None


def number_columns(products: Sequence[str]) -> list[str]:
    return [*NUMBERS, *(f"pre_{p}_interactions" for p in products)]


def clean_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every column as double; unreadable, NULL and NaN become 0."""
    return df.withColumns({c: numeric.to_number(c) for c in columns})


def check_no_leakage(columns: Sequence[str]) -> None:
    """The variant and the label must not be inputs of a model."""
    leaks = [c for c in columns if c.startswith(("variant", "adopted_"))]
    if leaks:
        raise ValueError(f"not allowed as model inputs: {leaks}")


def feature_stages(categories: Sequence[str], numbers: Sequence[str]) -> Pipeline:
    """One-hot categories and plain numbers. An unknown or NULL category is all zeros."""
    check_no_leakage([*categories, *numbers])
    index = StringIndexer(inputCols=list(categories), outputCols=[f"{c}_index" for c in categories],
                          handleInvalid="keep")
    one_hot = OneHotEncoder(inputCols=index.getOutputCols(),
                            outputCols=[f"{c}_onehot" for c in categories], dropLast=True)
    vector = VectorAssembler(inputCols=[*one_hot.getOutputCols(), *numbers], outputCol="features")
    return Pipeline(stages=[index, one_hot, vector])


def is_test(label: str, key: str, test_share: float, seed: int) -> Column:
    text = F.concat_ws(":", F.lit(str(seed)), F.col(label).cast("string"), F.col(key).cast("string"))
    bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return bucket < F.lit(int(test_share * (1 << 32)))


def stratified_split(df: DataFrame, label: str, key: str, test_share: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Adds ``is_test``: a hash of (seed, label, key) under a threshold.

    Map-only and stable under re-runs and re-partitioning. Each label gets the share in
    expectation, which at scale is the share itself.
    """
    return df.withColumn("is_test", is_test(label, key, test_share, seed))


def exact_split(df: DataFrame, strata: Sequence[str], key: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: in every stratum exactly its share of the rows, rounded half up.

    The rows with the least (hash, key) are taken, so the split is stable under re-partitioning. The border of a stratum is
    found by counting its hashes by their first bits, then those inside the border's cell by more bits: three narrow
    aggregations with map-side combine and at most 4,096 cells per stratum, and no sort or shuffle of rows. A stratum of
    NULLs is one of its own; the key must be unique within a stratum. ``df`` is read four times, so pass a written table.
    """
    names = [f"_s{i}" for i in range(len(strata))]
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in strata], F.col(key).cast("string"))
    hashed = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    rows = df.select(*[F.col(c).alias(n) for c, n in zip(strata, names)], hashed.alias("_h"), F.col(key).alias("_k"))
    within = Window.partitionBy(*names).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)

    def bordered(table: DataFrame, border: DataFrame) -> DataFrame:
        mine = border.withColumnsRenamed({n: f"_b{n}" for n in names})
        return table.join(mine, [F.col(n).eqNullSafe(F.col(f"_b{n}")) for n in names]).drop(*[f"_b{n}" for n in names])

    border = session.written(rows.groupBy(*names).agg(
        F.floor(F.count(F.lit(1)) * F.lit(float(test_share)) + 0.5).cast("long").alias("_left"), F.lit(0).cast("long").alias("_at")), "strata")
    for shift in (20, 8, 0):
        # rows of the cell that the border lies in, counted by the next bits
        width = {20: 32, 8: 20, 0: 8}[shift]
        inside = bordered(rows, border).where(F.shiftright("_h", width) == F.shiftright("_at", width))
        cells = inside.groupBy(*names, "_left", F.shiftleft(F.shiftright("_h", shift), shift).alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
        before = F.coalesce(F.sum("_n").over(within), F.lit(0))
        # the first cell by which at least ``_left`` rows are counted
        border = session.written(cells.withColumn("_before", before).where(
            "_left > 0 AND _before < _left AND _before + _n >= _left").select(
            *names, (F.col("_left") - F.col("_before")).alias("_left"), F.col("_cell").alias("_at")), "split-border")
    # rows that share all bits with the border: usually one
    tied = bordered(rows, border).where("_h = _at").withColumn(
        "_n", F.row_number().over(Window.partitionBy(*names).orderBy("_k"))).where("_n = _left")
    last = session.written(tied.select(*[F.col(n).alias(f"_b{n}") for n in names], "_at", F.col("_k").alias("_last")), "split-last")
    joined = df.join(last, [F.col(c).eqNullSafe(F.col(f"_b{n}")) for c, n in zip(strata, names)], "left")
    taken = (hashed < F.col("_at")) | ((hashed == F.col("_at")) & (F.col(key) <= F.col("_last")))
    return joined.withColumn("is_test", F.coalesce(taken, F.lit(False))).select(*df.columns, "is_test")


@dataclass
class Propensity:
    """The shared feature stages and one boosted-tree model per product."""

    features: PipelineModel
    models: dict[str, GBTClassificationModel]
    holdout: DataFrame | None = None
    n_train: Mapping[str, int] | None = None
    base_rates: Mapping[str, float] | None = None


def vectors(features: DataFrame, products: Sequence[str]) -> tuple[PipelineModel, DataFrame]:
    numbers = number_columns(products)
    cleaned = clean_numeric(features, numbers)
    model = feature_stages(CATEGORIES, numbers).fit(cleaned)
    return model, model.transform(cleaned)


def _training_partitions(rows: float) -> int:
    return math.ceil(rows / _ROWS_A_TASK) or 1


def fit_one(train: DataFrame, label: str, config: TrainConfig) -> GBTClassificationModel:
    return GBTClassifier(featuresCol="features", labelCol=label, maxIter=config.trees,
                         maxDepth=config.depth, stepSize=config.rate, seed=config.seed,
                         checkpointInterval=10).fit(train)


def fit_all(features: DataFrame, products: Sequence[str], config: TrainConfig = TrainConfig()) -> Propensity:
    """One model per product on the same cached vectors; holdout scores for the metrics."""
    spark = features.sparkSession
    session.scratch_root(spark)  # boosting cuts its lineage there every ten trees
    stages, assembled = vectors(features, products)
    labels = [f"adopted_{p}" for p in products]
    data = session.written(assembled.select("user_id", "features", *labels), "vectors")
    seen = data.agg(F.count(F.lit(1)).alias("n"), *[
        numeric.round_half_up(F.count_if(F.col(label) == 1) / F.count(label), 6).alias(p)
        for p, label in zip(products, labels)]).first().asDict()
    n = seen.pop("n")
    share = 1.0 if config.max_training_rows is None else min(1.0, config.max_training_rows / max(n, 1))
    chosen = data if share == 1.0 else data.where(
        F.pmod(F.xxhash64(F.lit(config.seed), "user_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))
    sample = chosen.repartition(_training_partitions(n * share), "user_id") \
        .persist(StorageLevel.MEMORY_AND_DISK)

    def train(label: str) -> GBTClassificationModel:
        split = stratified_split(sample, label, "user_id", config.test_share, config.seed)
        return fit_one(split.where("NOT is_test"), label, config)

    try:
        # Counted first, which also fills the cache before the models share it.
        counts = sample.agg(*[
            F.count_if(~is_test(label, "user_id", config.test_share, config.seed)).alias(p)
            for p, label in zip(products, labels)]).first()
        # Boosting is a chain of small jobs; the products' chains run side by side.
        with ThreadPool(len(products)) as pool:
            models = dict(zip(products, pool.map(inheritable_thread_target(spark)(train), labels)))
        holdout = session.written(_holdout(models, data, config), "holdout")
    finally:
        sample.unpersist()
    return Propensity(stages, models, holdout, counts.asDict(), seen)


def _holdout(models: Mapping[str, GBTClassificationModel], data: DataFrame, config: TrainConfig) -> DataFrame:
    """(product, user_id, score, label) of the rows that a product's model has not seen."""
    result = None
    for product, model in models.items():
        label = f"adopted_{product}"
        held = stratified_split(data, label, "user_id", config.test_share, config.seed).where("is_test")
        scored = _probability(model, held, "score").select(
            F.lit(product).alias("product"), "user_id", "score", F.col(label).alias("label"))
        result = scored if result is None else result.unionByName(scored)
    return result


def _probability(model: GBTClassificationModel, df: DataFrame, name: str) -> DataFrame:
    scored = model.transform(df)
    return (scored.withColumn(name, vector_to_array("probability")[1])
            .drop("rawPrediction", "probability", "prediction"))


def score(propensity: Propensity, features: DataFrame) -> DataFrame:
    """prob_{p} for every user, training rows included; map-only."""
    cleaned = clean_numeric(features, number_columns(list(propensity.models)))
    df = propensity.features.transform(cleaned).select("user_id", "features")
    for product, model in propensity.models.items():
        df = _probability(model, df, f"prob_{product}")
    return df.drop("features")


def holdout_metrics(propensity: Propensity, threshold: float = 0.5) -> DataFrame:
    held = propensity.holdout
    return (
        metrics.ranking_metrics(held, "score", "label", ["product"])
        .join(metrics.accuracy(held, "score", "label", threshold, ["product"]), "product")
        .join(metrics.base_rate(held, "label", ["product"]), "product")
    )


def record_run(path: str, propensity: Propensity, config: TrainConfig, version: int) -> None:
    """Measure on the holdout and append one row per product to the run log; the base rate is
    that of all users."""
    def of(values: Mapping[str, object] | None, kind: str) -> Column:
        result = F.lit(None).cast(kind)
        for product, value in (values or {}).items():
            result = F.when(F.col("product") == product, F.lit(value).cast(kind)).otherwise(result)
        return result

    widths = {product: model.numFeatures for product, model in propensity.models.items()}
    holdout_metrics(propensity).select(
        "product", F.lit(version).alias("version"), F.lit(config.trees).alias("trees"),
        F.lit(config.depth).alias("depth"), F.lit(float(config.rate)).alias("rate"),
        F.lit(config.seed).alias("seed"), of(widths, "int").alias("n_features"),
        of(propensity.n_train, "long").alias("n_train"), "roc_auc", "avg_precision", "accuracy",
        of(propensity.base_rates, "double").alias("base_rate"),
        F.lit(dt.datetime.now(dt.timezone.utc)).alias("finished_at"),
    ).write.mode("append").parquet(path)


def summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path).select(
        "product", "version", "roc_auc", "avg_precision", "accuracy", "base_rate")


def champion(runs: DataFrame) -> DataFrame:
    """The version with the best AUC per product; the newer one wins a tie."""
    best = F.max_by(F.col("version"), F.struct("roc_auc", "version"))
    return runs.where("roc_auc IS NOT NULL").groupBy("product").agg(
        best.alias("version"), F.max("roc_auc").alias("roc_auc"))


def save(propensity: Propensity, path: str, version: int) -> None:
    propensity.features.write().save(f"{path}/v{version}/features")
    for product, model in propensity.models.items():
        model.write().save(f"{path}/v{version}/{product}")


def load(path: str, version: int, products: Sequence[str]) -> Propensity:
    return Propensity(
        PipelineModel.load(f"{path}/v{version}/features"),
        {p: GBTClassificationModel.load(f"{path}/v{version}/{p}") for p in products})


def long_scores(scores: DataFrame, products: Sequence[str], keep: Sequence[str] = ("user_id",)) -> DataFrame:
    """Wide to long: one row per user and product."""
    return experiments.by_product(scores, products, keep, prob="prob_{}")
