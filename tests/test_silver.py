import datetime as dt

from liftlab.operators import dedup, quality, silver
from tests.conftest import rows

EVENTS = ("event_id string, user_id string, event_ts string, event_type string, product string, "
          "amount_usd string, session_id string, seq int, file string")


def _bronze(spark):
    return spark.createDataFrame([
        ("E1", "u1", "2026-05-31 23:59:59", "trade", "crypto", "10.00", "s", 0, "a"),
        ("E1", "u1", "2026-05-31 23:59:59", "trade", "crypto", "12.00", "s", 1, "b"),
        ("E2", "u1", "2026-06-01 00:00:00", "trade", "crypto", "1", "s", 0, "a"),
        ("E2", "u1", "2026-06-01 00:00:00", "trade", "crypto", "2", "s", 0, "b"),
        (None, "u1", "2026-06-01 00:00:00", "login", None, None, "s", 0, "a"),
        ("E4", None, "2026-06-01 00:00:00", "login", None, None, "s", 0, "a"),
        ("E5", "u2", "zzz", "deposit", None, "zzz", "s", 0, "a"),
        ("E6", "u2", None, "login", None, None, "s", 0, "a"),
    ], EVENTS)


def test_newest_delivery_wins_and_ties_are_decided(spark):
    bronze = _bronze(spark)
    expected = {"E1": 12.0, "E2": 2.0, "E5": None, "E6": None}
    for df in (bronze, bronze.orderBy("file"), bronze.repartition(7)):
        kept = silver.events(df, "2026-06-01", ["seq", "file"])
        assert {r.event_id: r.amount_usd for r in kept.collect()} == expected


def test_launch_flag_is_three_valued_and_inclusive(spark):
    kept = silver.events(_bronze(spark), "2026-06-01", ["seq", "file"])
    assert {r.event_id: r.is_post_launch for r in kept.collect()} == {
        "E1": False, "E2": True, "E5": None, "E6": None}


def test_unreadable_values_become_null(spark):
    users = spark.createDataFrame(
        [("u1", "2024-02-30", "x"), ("u2", "2024-02-29", "3.5")],
        "user_id string, signup_date string, account_balance_usd string")
    assert rows(silver.type_users(users)) == [
        ("u1", None, None), ("u2", dt.date(2024, 2, 29), 3.5)]


def test_rules_drop_count_and_quarantine_the_same_rows(spark):
    bronze = _bronze(spark)
    good, bad = quality.split(bronze, silver.EVENT_RULES)
    assert good.count() == 6 and bad.count() == 2
    assert rows(bad, "failed_rules") == [("valid_event_id",), ("valid_user",)]
    assert rows(quality.expectation_report(bronze, silver.EVENT_RULES)) == [
        ("valid_event_id", 7, 1), ("valid_user", 7, 1)]


def test_null_predicate_counts_as_failure(spark):
    df = spark.createDataFrame([(None,), (1,), (5,)], "x int")
    assert rows(quality.expect_or_drop(df, {"small": "x < 3"})) == [(1,)]


def test_hot_key_leaves_one_row_per_map_task(spark):
    """A partial group limit sits below the shuffle, so re-deliveries do not travel."""
    df = spark.range(1000).selectExpr("id % 2 AS k", "id AS seq")
    kept = dedup.latest(df, ["k"], ["seq"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert rows(kept) == [(0, 998), (1, 999)]
