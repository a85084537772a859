import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from liftlab.operators import metrics, rank, targeting
from tests.conftest import rows


def _scores(spark, n, distinct=None, seed=1):
    rng = random.Random(seed)
    values = [(f"k{i:05d}", rng.randrange(distinct) / distinct if distinct else rng.random()) for i in range(n)]
    rng.shuffle(values)
    return spark.createDataFrame(values, "key string, score double"), values


@pytest.mark.parametrize("n,distinct", [(1, None), (500, None), (500, 1), (500, 3)])
def test_global_rank_equals_one_sorted_list(spark, n, distinct):
    df, values = _scores(spark, n, distinct)
    ordered = sorted(values, key=lambda v: (-v[1], v[0]))
    got = {r.key: r.overall_rank for r in rank.global_rank(df, "score", "key").collect()}
    assert got == {k: i + 1 for i, (k, _) in enumerate(ordered)}


def test_rank_puts_missing_scores_last(spark):
    df = spark.createDataFrame([("a", None), ("b", float("nan")), ("c", 0.1), ("d", 0.2)], "key string, score double")
    for ascending, first in ((False, ["d", "c"]), (True, ["c", "d"])):
        got = rank.global_rank(df, "score", "key", ascending).orderBy("overall_rank").collect()
        assert [r.key for r in got] == [*first, "a", "b"]


@pytest.mark.parametrize("n", [1, 2, 7, 10, 11, 15, 101])
def test_quantile_cut_equals_pandas(spark, n):
    df, values = _scores(spark, n, 4)
    got = {r.key: r.targeting_decile for r in rank.quantile_cut(df, "score", "key").collect()}
    if n == 1:
        assert got == {values[0][0]: 1}
        return
    pdf = pd.DataFrame(sorted(values), columns=["key", "score"])
    cut = pd.qcut(pdf["score"].rank(method="first"), 10, labels=False, duplicates="drop")
    assert got == dict(zip(pdf["key"], (10 - cut).astype(int)))


def test_empty_input(spark):
    empty = spark.createDataFrame([], "key string, score double")
    assert rank.global_rank(empty, "score", "key").count() == 0
    assert rank.quantile_cut(empty, "score", "key").count() == 0


def test_running_sums_per_group(spark):
    data = [(g, i, i % 7) for g in ("a", "b") for i in range(300)]
    df = spark.createDataFrame(data, "g string, i int, v int").repartition(9)
    got = rank.running_sums(df, [F.col("g").asc(), F.col("i").asc()], ["v"], ["g"]).collect()
    total, expected = {"a": 0, "b": 0}, {}
    for g, i, v in data:
        total[g] += v
        expected[g, i] = total[g]
    assert {(r.g, r.i): r.cum_v for r in got} == expected


def test_no_rank_runs_in_one_task(spark):
    """A skewed score must not fill one range: ties are split by the key."""
    df = spark.range(4000).selectExpr("id AS key", "IF(id % 3 = 0, 0.5, rand(1)) AS score")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small data would be joined
    try:
        table = rank.ranges(df, [F.col("score").desc(), F.col("key").asc()])
        sizes = [r["count"] for r in table.groupBy("_range").count().collect()]
        assert len(sizes) == 4 and max(sizes) < 2000
        ranked = rank.global_rank(df, "score", "key").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r.key for r in sorted(ranked, key=lambda r: r.overall_rank)] == [
        r.key for r in sorted(ranked, key=lambda r: (-r.score, r.key))]
    assert sorted(r.overall_rank for r in ranked) == list(range(1, 4001))


def _brute(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    ap = seen_p = seen = 0
    for s in sorted({s for s, _ in pairs}, reverse=True):
        here = [y for t, y in pairs if t == s]
        seen += len(here)
        seen_p += sum(here)
        ap += sum(here) / len(pos) * seen_p / seen
    return auc, ap


@pytest.mark.parametrize("distinct", [None, 1, 5])
def test_auc_and_ap_equal_brute_force(spark, distinct):
    rng = random.Random(3)
    pairs = [(rng.randrange(distinct) / distinct if distinct else rng.random(), int(rng.random() < 0.3))
             for _ in range(400)]
    df = spark.createDataFrame(pairs, "s double, y int")
    got = metrics.ranking_metrics(df, "s", "y").first()
    auc, ap = _brute(pairs)
    assert got.roc_auc == pytest.approx(auc, abs=1e-6) and got.avg_precision == pytest.approx(ap, abs=1e-6)
    if distinct == 1:
        assert got.roc_auc == 0.5


def test_metrics_without_both_classes_are_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1), (None, 0), (float("nan"), 0)], "s double, y int")
    assert tuple(metrics.ranking_metrics(df, "s", "y").first()) == (None, None)


def test_top_k_flags(spark):
    df = spark.createDataFrame(
        [("a", 0.5), ("b", 0.5), ("c", 0.9), ("d", float("nan")), ("e", None)], "user_id string, propensity_score double")

    def flagged(k):
        return "".join(r.user_id for r in targeting.flag_top_k(df, k).where("is_top_k").orderBy("user_id").collect())

    expected = {0: "", 1: "c", 2: "ac", 3: "abc", 4: "abcd", 99: "abcde"}
    assert {k: flagged(k) for k in expected} == expected
    assert targeting.flag_top_k(df, 2).count() == 5
    assert [r.user_id for r in targeting.top_users(df, 4).collect()] == ["c", "a", "b", "d"]


def test_top_k_keeps_scores_that_a_double_cannot_tell_apart(spark):
    df = spark.createDataFrame([("a", 9007199254740992), ("b", 9007199254740993), ("c", None)], "key string, s long")
    assert rows(targeting.flag_top_k(df, 1, "s", "key").where("is_top_k"), "key") == [("b",)]
    low = spark.createDataFrame([("a", None), ("b", float("-inf"))], "key string, s double")
    assert rows(targeting.flag_top_k(low, 1, "s", "key").where("is_top_k"), "key") == [("b",)]


def test_quantile_cut_moves_only_score_and_key(spark):
    df = spark.range(200).selectExpr("id AS key", "id % 7 AS score", "repeat('x', 10) AS wide")
    plan = rank.quantile_cut(df, "score", "key")._jdf.queryExecution().executedPlan().toString()
    assert not any("wide" in line for line in plan.splitlines() if "Exchange" in line)


def test_accuracy_ignores_missing(spark):
    df = spark.createDataFrame([(0.5, 1), (0.4, 0), (0.6, 0), (None, 1)], "s double, y int")
    assert math.isclose(metrics.accuracy(df, "s", "y").first().accuracy, 0.666667)


def test_metrics_keep_the_null_group_and_leave_nan_out(spark):
    rows_ = [(g, s, y) for g in (None, "a") for s, y in ((0.9, 1), (0.2, 0), (0.4, 1), (float("nan"), 0))]
    df = spark.createDataFrame(rows_, "g string, p double, y int")
    got = {r.g: r.roc_auc for r in metrics.ranking_metrics(df, "p", "y", ["g"]).collect()}
    assert got == {None: 1.0, "a": 1.0}
    assert {r.g: r.accuracy for r in metrics.accuracy(df, "p", "y", by=["g"]).collect()} == {
        None: 0.666667, "a": 0.666667}
