import pytest
from pyspark.sql import functions as F

from liftlab import session
from liftlab.operators import ml

PRODUCTS = ("crypto",)


@pytest.fixture(scope="module")
def features(spark):
    """Adoption depends on the tier and on earlier interactions, so there is something to learn."""
    return session.written(spark.range(1500).selectExpr(
        "id AS user_id", "elt(CAST(id % 3 AS INT) + 1, 'gold', 'silver', 'bronze') AS tier", "'W' AS region",
        "'65+' AS age_band", "'moderate' AS risk_profile", "'verified' AS kyc_status",
        "IF(id % 50 = 0, 'n/a', CAST(id AS STRING)) AS account_balance_usd", "id % 20 AS events_total",
        "id % 5 AS trades_total", "id % 4 AS logins_total", "CAST(id % 7 AS DOUBLE) AS deposit_total_usd",
        "id % 6 AS sessions_total", "id % 8 AS active_days", "CAST(id % 90 AS INT) AS tenure_days",
        "id % 11 AS pre_crypto_interactions",
        "CAST(rand(7) < IF(id % 3 = 0, 0.5, 0.1) + (id % 11) / 25 AS INT) AS adopted_crypto"), "ml-features")


@pytest.fixture(scope="module")
def trained(features):
    return ml.fit_all(features, PRODUCTS, ml.TrainConfig(trees=4))


def test_model_beats_chance_on_the_holdout(trained):
    got = ml.holdout_metrics(trained).first()
    assert got.roc_auc > 0.6 and 0 < got.base_rate < 1 and got.avg_precision > got.base_rate


def test_split_is_stable_and_stratified(features, trained):
    split = ml.stratified_split(features, "adopted_crypto", "user_id")
    shares = {r.adopted_crypto: r.s for r in split.groupBy("adopted_crypto").agg(
        F.avg(F.col("is_test").cast("int")).alias("s")).collect()}
    assert all(0.15 < s < 0.25 for s in shares.values())
    assert split.where("NOT is_test").count() == trained.n_train["crypto"]
    assert trained.holdout.count() == 1500 - trained.n_train["crypto"]
    again = ml.stratified_split(features.repartition(9), "adopted_crypto", "user_id")
    assert split.where("is_test").exceptAll(again.where("is_test")).count() == 0


def test_every_user_gets_a_probability(features, trained):
    scored = ml.score(trained, features)
    assert scored.columns == ["user_id", "prob_crypto"]
    assert scored.where("prob_crypto BETWEEN 0 AND 1").count() == 1500


def test_unknown_and_null_category_are_all_zeros(spark, features, trained):
    odd = features.limit(2).withColumn("tier", F.when(F.col("user_id") % 2 == 0, "diamond"))
    cleaned = ml.clean_numeric(odd, ml.number_columns(PRODUCTS))
    for row in trained.features.transform(cleaned).select("tier_onehot").collect():
        assert row.tier_onehot.size == 3 and row.tier_onehot.numNonzeros() == 0


def test_bound_on_training_rows_leaves_scores_and_holdout_whole(features, trained):
    small = ml.fit_all(features, PRODUCTS, ml.TrainConfig(trees=2, max_training_rows=300))
    assert 150 < small.n_train["crypto"] < 350
    assert small.holdout.count() == trained.holdout.count() and ml.score(small, features).count() == 1500
    assert small.base_rates == trained.base_rates


def test_without_a_bound_all_rows_are_fitted_on_in_few_tasks(features):
    many = features.where("user_id < 1000").crossJoin(features.sparkSession.range(2010).withColumnRenamed("id", "copy")) \
        .withColumn("user_id", F.col("user_id") + 1_000_000 * F.col("copy")).drop("copy")
    whole = ml.fit_all(many, PRODUCTS, ml.TrainConfig(trees=1, depth=1))
    split = ml.stratified_split(many, "adopted_crypto", "user_id")
    assert whole.n_train["crypto"] == split.where("NOT is_test").count()
    assert whole.n_train["crypto"] + whole.holdout.count() == 2_010_000
    # a level of a tree starts two tasks per partition
    assert [ml._training_partitions(n) for n in (0, 1, 900_000, 5_400_000)] == [1, 1, 4, 22]


def test_leaking_columns_are_refused():
    for column in ("variant_crypto", "adopted_crypto"):
        with pytest.raises(ValueError):
            ml.feature_stages([column], [])


def test_save_load_and_run_log(spark, features, trained):
    base = session.fresh_path(spark, "models")
    ml.save(trained, base, 1)
    loaded = ml.load(base, 1, PRODUCTS)
    one, two = ml.score(trained, features), ml.score(loaded, features)
    assert one.exceptAll(two).count() == 0
    for version in (1, 2):
        ml.record_run(f"{base}/runs", trained, ml.TrainConfig(trees=4), version)
    log = ml.summary(spark, f"{base}/runs")
    assert log.count() == 2
    assert ml.champion(log).first().version == 2  # equal metrics: the newer version
