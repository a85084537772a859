import datetime as dt

import pytest
from pyspark.sql import functions as F

from liftlab import Settings
from liftlab.functions import numeric
from liftlab.operators import experiments, features, sessions, silver
from tests.conftest import rows

LAUNCH = Settings(launch="2026-06-01")
PROFILE = ("user_id string, signup_date date, tier string, region string, age_band string, "
           "risk_profile string, kyc_status string, account_balance_usd double, email string, account_ref string")


def _events(spark, extra=()):
    data = [
        # u1: behaviour before launch, adoption after
        ("e1", "u1", "2026-05-01 10:00:00", "login", None, None, "s1"),
        ("e2", "u1", "2026-05-01 11:00:00", "view_product", "crypto", None, "s1"),
        ("e3", "u1", "2026-05-02 11:00:00", "trade", "etf", 5.0, "s2"),
        ("e4", "u1", "2026-05-31 23:59:59", "deposit", None, 0.1, None),
        ("e5", "u1", "2026-05-31 23:59:59", "deposit", None, 0.2, "s2"),
        ("e6", "u1", "2026-06-01 00:00:00", "trade", "crypto", 5.0, "s3"),
        # u2: adopts without any event before launch
        ("e7", "u2", "2026-06-20 00:00:00", "trade", "options", 5.0, "s4"),
        # u3: views after launch, never trades; deposit without amount
        ("e8", "u3", "2026-05-20 00:00:00", "deposit", None, None, "s5"),
        ("e9", "u3", "2026-06-20 00:00:00", "view_product", "crypto", None, "s6"),
        # unreadable time: neither before nor after
        ("e10", "u3", None, "trade", "crypto", 1.0, "s7"),
        *extra,
    ]
    df = spark.createDataFrame(data, "event_id string, user_id string, event_ts string, event_type string, "
                                     "product string, amount_usd double, session_id string")
    return silver.type_events(df, LAUNCH.launch)


def _users(spark):
    born = dt.date(2026, 5, 2)
    return spark.createDataFrame([
        (u, dt.date(2026, 6, 3) if u == "u3" else born, "gold", "W", "65+", "moderate", "verified", 1.0,
         f"{u}@x.com", "ACCT-123456") for u in ("u1", "u2", "u3", "u4")], PROFILE)


def _assignments(spark):
    return spark.createDataFrame([
        ("crypto", "u1", "treatment"), ("crypto", "u2", "control"), ("options", "u2", "treatment"),
        ("crypto", "u3", "control"), ("agentic", "u1", "control"), ("agentic", "u1", "treatment"),
    ], "product string, user_id string, variant string")


def _features(spark, settings=LAUNCH):
    df = features.user_features(_users(spark), _events(spark), _assignments(spark), settings)
    return {r.user_id: r.asDict() for r in df.collect()}


def test_totals_before_launch(spark):
    u1 = _features(spark)["u1"]
    assert (u1["events_total"], u1["trades_total"], u1["logins_total"]) == (5, 1, 1)
    assert u1["deposit_total_usd"] == 0.3  # exact, unlike 0.1 + 0.2
    assert (u1["sessions_total"], u1["active_days"]) == (2, 3)
    assert u1["last_activity_ts"] == dt.datetime(2026, 5, 31, 23, 59, 59)
    assert u1["pre_crypto_interactions"] == 1 and u1["tenure_days"] == 30


def test_labels_and_zero_fill(spark):
    f = _features(spark)
    assert [f[u]["adopted_crypto"] for u in ("u1", "u2", "u3", "u4")] == [1, 0, 0, 0]
    assert f["u2"]["adopted_options"] == 1 and f["u2"]["events_total"] == 0
    assert f["u4"]["deposit_total_usd"] == 0.0 and f["u4"]["last_activity_ts"] is None
    assert f["u3"]["deposit_total_usd"] == 0.0 and f["u3"]["tenure_days"] == -2


def test_compatible_labels_need_earlier_activity(spark):
    f = _features(spark, Settings(launch="2026-06-01", labels_require_pre_activity=True))
    assert f["u1"]["adopted_crypto"] == 1 and f["u2"]["adopted_options"] == 0


def test_adoption_window(spark):
    f = _features(spark, Settings(launch="2026-06-01", post_window_days=10))
    assert f["u1"]["adopted_crypto"] == 1 and f["u2"]["adopted_options"] == 0


def test_no_personal_data_in_gold(spark):
    assert not {"email", "account_ref"} & set(_features(spark)["u1"])


def test_input_order_does_not_matter(spark):
    events = _events(spark)
    one = features.user_features(_users(spark), events, _assignments(spark), LAUNCH)
    two = features.user_features(_users(spark).repartition(5), events.repartition(7), _assignments(spark), LAUNCH)
    assert rows(one) == rows(two)


def test_parts_agree_with_the_single_pass(spark):
    events = _events(spark)
    whole = features.activity(events, LAUNCH)
    labels = features.labels(events, LAUNCH)
    for p in LAUNCH.products:
        assert rows(whole.where(f"adopted_{p} = 1"), "user_id") == rows(labels.where(f"adopted_{p} = 1"), "user_id")
    totals = features.behavior(events)
    assert rows(whole.where("events_total > 0").select(*totals.columns)) == rows(totals)


def test_no_event_is_multiplied(spark, sf):
    """One wide scan, one narrow scan for the sessions, and no Expand."""
    from liftlab.sources import roles
    df = features.activity(roles.events(spark, sf), LAUNCH)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "Expand" not in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,props:string>" in plan


def test_hot_user_is_spread_by_session_before_it_is_reduced(spark):
    hot = spark.range(20000).selectExpr(
        "concat('h', id) AS event_id", "IF(id % 3 = 0, 'hot', concat('u', id % 50)) AS user_id",
        "CAST(TIMESTAMP_NTZ'2026-01-01' + make_dt_interval(CAST(id % 90 AS INT)) AS STRING) AS event_ts",
        "'login' AS event_type", "CAST(NULL AS STRING) AS product", "CAST(NULL AS DOUBLE) AS amount_usd",
        "concat('s', id % 977) AS session_id")
    events = silver.type_events(hot, LAUNCH.launch)
    got = features.activity(events, LAUNCH).where("user_id = 'hot'").first()
    # ids divisible by 3 only meet the day numbers divisible by 3
    assert (got.events_total, got.sessions_total, got.active_days) == (6667, 977, 30)


def test_results_and_lift(spark):
    feats = spark.createDataFrame(
        [(f"t{i}", "treatment", int(i < 1983)) for i in range(4999)]
        + [(f"c{i}", "control", int(i < 1134)) for i in range(5001)]
        + [("n", None, 1)], "user_id string, variant_agentic string, adopted_agentic int")
    settings = Settings(launch="2026-06-01", products=("agentic",))
    results = experiments.results(feats, settings)
    assert rows(results, "experiment_id", "variant", "users", "adopters", "adoption_rate_pct") == [
        ("agentic_launch", "control", 5001, 1134, 22.68), ("agentic_launch", "treatment", 4999, 1983, 39.67)]
    assert rows(experiments.lift(results)) == [("agentic", 16.99)]
    assert experiments.best_variant(results).first().best_variant == "treatment"


def test_two_variants_for_one_user_are_reported(spark):
    assert rows(experiments.conflicting_assignments(_assignments(spark))) == [
        ("agentic", "u1", "control", "treatment")]


def test_exposure_window_borders(spark):
    events = _events(spark, [
        ("x1", "u9", "2026-06-05 00:00:00", "trade", "crypto", 1.0, "s"),
        ("x2", "u9", "2026-06-11 23:59:59", "trade", "crypto", 1.0, "s"),
        ("x3", "u9", "2026-06-12 00:00:00", "trade", "crypto", 1.0, "s"),
        ("x4", "u9", "2026-06-04 23:59:59", "trade", "crypto", 1.0, "s")])
    assigned = spark.createDataFrame([("crypto", "u9", "x", "control", dt.datetime(2026, 6, 5))],
                                     "product string, user_id string, experiment_id string, variant string, "
                                     "assigned_ts timestamp_ntz")
    assert rows(experiments.exposed_events(events, assigned, 7), "event_id") == [("x1",), ("x2",)]


@pytest.mark.parametrize("gap", [1, 60, 3600, 7200])
def test_sessions_equal_brute_force(spark, gap):
    times = [0, 1, 59, 60, 61, 3599, 3600, 7199, 7200, 10800, 10801, 50000, 50000, 57199, 57200]
    start = dt.datetime(2026, 1, 1)
    df = spark.createDataFrame([("u", start + dt.timedelta(seconds=t)) for t in times],
                               "user_id string, event_ts timestamp_ntz")
    expected, last = [], None
    for t in times:
        if last is None or t - last >= gap:
            expected.append([t, t, 0])
        expected[-1][1] = last = t
        expected[-1][2] += 1
    got = [(int((r.session_start - start).total_seconds()), int((r.session_end - start).total_seconds()), r.events)
           for r in sessions.by_gap(df, gap).orderBy("session_no").collect()]
    assert got == [tuple(e) for e in expected]


def test_hot_user_is_split_in_the_exposure_join(spark):
    """AQE cuts the hot user's partition into pieces; result rows stay whole."""
    events = silver.flag_launch(spark.range(60000).selectExpr(
        "id AS event_id", "IF(id % 3 = 0, 'hot', concat('u', id)) AS user_id",
        "TIMESTAMP_NTZ'2026-06-05 00:00:00' AS event_ts", "'trade' AS event_type", "'crypto' AS product",
        "uuid() AS filler"), LAUNCH.launch)
    assigned = spark.range(60000).selectExpr(
        "'crypto' AS product", "IF(id = 0, 'hot', concat('u', id)) AS user_id", "'x' AS experiment_id",
        "'control' AS variant", "TIMESTAMP_NTZ'2026-06-05 00:00:00' AS assigned_ts").where("id = 0 OR id % 3 <> 0")
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2"}
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        joined = experiments.exposed_events(events, assigned, 7)
        assert len(joined.collect()) == 60000
        assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_sums_do_not_saturate(spark):
    df = spark.createDataFrame([(2e10,), (4e10,)], "x double")
    assert df.agg(numeric.mean(F.col("x"), 2)).first()[0] == 3e10
    big = spark.createDataFrame([(1e14,), (float("nan"),), (None,)], "x double")
    assert big.select(numeric.round_half_up(F.col("x"), 6)).first()[0] == 1e14
    with pytest.raises(Exception, match="not finite"):
        big.agg(numeric.money_sum(F.col("x"))).collect()
